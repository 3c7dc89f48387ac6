"""Checks on the fact and on the keys of the dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACT_KEYS = {
    "year": "year",
    "immigration_month": "month",
    "immigration_origin": "country",
    "to_immigration_state": "state",
}


def total_arrivals(fact: DataFrame) -> DataFrame:
    return fact.agg(F.sum("to_immigration_state_count").alias("fact_table_count"))


def null_flags(fact: DataFrame) -> DataFrame:
    """The combinations of missing keys that occur; sound when the only row is all false."""
    flags = [F.isnull(column).alias(name) for column, name in FACT_KEYS.items()]
    return fact.select(*flags).dropDuplicates()


def sums_by_year(fact: DataFrame) -> dict[int | None, dict]:
    """Of each year the arrivals, the rows with a missing key and the combinations of missing keys.

    Such sums of different years add up, so a year that did not change need not be read again.
    """
    flags = F.array(*[F.isnull(column) for column in FACT_KEYS])
    by_year = fact.groupBy("year").agg(
        F.sum("to_immigration_state_count").alias("arrivals"),
        F.count_if(F.array_contains(flags, True)).alias("missing"),
        F.collect_set(flags).alias("flags"),  # 16 at most
    )
    return {
        row["year"]: {"arrivals": row["arrivals"], "missing": row["missing"], "flags": row["flags"]}
        for row in by_year.collect()
    }


def report_of_sums(spark, sums, dimensions=None) -> DataFrame:
    """``quality_report`` from the sums of all years."""
    arrivals, missing = sum(s["arrivals"] for s in sums), sum(s["missing"] for s in sums)
    rows = spark.createDataFrame(
        [("total arrivals", arrivals > 0, arrivals), ("rows with a missing key", missing == 0, missing)],
        "check string, passed boolean, observed bigint",
    )
    for check, (dimension, keys) in (dimensions or {}).items():
        rows = rows.unionByName(repeated_keys(dimension, keys, check))
    return rows


def total_of_sums(spark, sums) -> DataFrame:
    """``total_arrivals`` from the sums of all years."""
    total = sum(s["arrivals"] for s in sums) if sums else None
    return spark.createDataFrame([(total,)], "fact_table_count bigint")


def null_flags_of_sums(spark, sums) -> DataFrame:
    """``null_flags`` from the sums of all years."""
    found = sorted({tuple(flags) for s in sums for flags in s["flags"]})
    return spark.createDataFrame(found, ", ".join(f"{name} boolean" for name in FACT_KEYS.values()))


def repeated_keys(dimension: DataFrame, keys, check) -> DataFrame:
    """How many keys of a dimension occur more than once; the star join needs none."""
    repeated = dimension.groupBy(*keys).count().where("count > 1")
    return _report_row(repeated.agg(F.count(F.lit(1)).alias("observed")), check, F.col("observed") == 0)


def quality_report(fact: DataFrame, dimensions=None) -> DataFrame:
    """Rows (check, passed, observed): arrivals, rows with a missing key, repeated keys.

    ``dimensions`` maps a check name to (dimension, key columns).
    """
    missing = reduce(lambda a, b: a | b, [F.isnull(column) for column in FACT_KEYS])
    seen = fact.agg(
        F.coalesce(F.sum("to_immigration_state_count"), F.lit(0)).alias("arrivals"),
        F.count_if(missing).alias("missing"),
    )
    # one pass over the fact, two report rows
    rows = seen.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("total arrivals").alias("check"),
                    (F.col("arrivals") > 0).alias("passed"),
                    F.col("arrivals").alias("observed"),
                ),
                F.struct(
                    F.lit("rows with a missing key").alias("check"),
                    (F.col("missing") == 0).alias("passed"),
                    F.col("missing").alias("observed"),
                ),
            )
        )
    )
    for check, (dimension, keys) in (dimensions or {}).items():
        rows = rows.unionByName(repeated_keys(dimension, keys, check))
    return rows


def enforce(report: DataFrame) -> None:
    """Stop the run when a check failed."""
    failed = [row["check"] for row in report.where("NOT passed").collect()]
    if failed:
        raise RuntimeError("failed checks: " + ", ".join(failed))


def _report_row(one_row, check, passed):
    return one_row.select(F.lit(check).alias("check"), passed.alias("passed"), "observed")
