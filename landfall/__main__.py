"""python -m landfall --admissions ... --output ...: run the job and show its checks."""

from __future__ import annotations

import argparse
from dataclasses import MISSING, fields

from landfall.plans.job import JobConfig, run_job
from landfall.session import build_session


def parse_args(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="landfall")
    for field in fields(JobConfig):
        flag = "--" + field.name.replace("_", "-")
        if field.default is False:
            parser.add_argument(flag, action="store_true")
        elif field.default is MISSING:
            parser.add_argument(flag, required=True)
        else:
            kind = int if "int" in str(field.type) else str
            parser.add_argument(flag, type=kind, default=field.default)
    parser.add_argument("--shuffle-partitions", type=int)
    return parser.parse_args(argv)


def main(argv=None) -> None:
    given = vars(parse_args(argv))
    spark = build_session(shuffle_partitions=given.pop("shuffle_partitions"))
    result = run_job(spark, JobConfig(**given))
    result.fact.show()
    result.total.show()
    result.null_flags.show()
    result.report.show(truncate=False)


if __name__ == "__main__":
    main()
