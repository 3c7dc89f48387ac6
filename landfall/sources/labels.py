"""Label files: one ``'code' = 'label'`` per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Line patterns. The first accepts unquoted codes, doubled quotes and a closing ';'.
LABEL_LINE = r"^\s*'?([^'=]*?)'?\s*=\s*'(.*)'\s*;?\s*$"
RAW_LABEL_LINE = r"'(.*)'.*'(.*)'"


def load_labels(spark: SparkSession, path, **options) -> DataFrame:
    return parse_labels(spark.read.text(path), **options)


def parse_labels(lines: DataFrame, raw=False, on_bad_line="fail") -> DataFrame:
    """(code, label) rows from a frame with one text column ``value``.

    ``raw`` keeps padding and the greedy quoting of the plain pattern. A line of
    another shape stops the job, or is left out with ``on_bad_line='drop'``.
    """
    if on_bad_line not in ("fail", "drop"):
        raise ValueError(f"on_bad_line: {on_bad_line}")
    pattern = RAW_LABEL_LINE if raw else LABEL_LINE
    fits = F.col("value").rlike(pattern)
    if on_bad_line == "drop":
        lines = lines.where(fits)

    def group(number) -> Column:
        text = F.regexp_extract("value", pattern, number)
        if not raw:
            text = F.trim(F.replace(text, F.lit("''"), F.lit("'")))
        return F.when(fits, text).otherwise(
            F.raise_error(F.concat(F.lit("not a label line: "), F.col("value")))
        )

    return lines.select(group(1).alias("code"), group(2).alias("label"))


def reverse_labels(labels: DataFrame) -> DataFrame:
    """The same list keyed by label: its ``code`` column holds the label and the other way round."""
    return labels.select(F.col("label").alias("code"), F.col("code").alias("label"))
