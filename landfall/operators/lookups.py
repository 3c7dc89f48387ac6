"""Code lists applied by joins."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.codes import MODE_LABELS, OTHER_STATE, STATE_LABELS, VISA_LABELS
from landfall.operators.sizes import BROADCAST_BYTES


class CodeList(NamedTuple):
    """A checked list: codes are unique and its size is known."""

    frame: DataFrame
    rows: int
    bytes: int

    @property
    def is_small(self) -> bool:
        return self.bytes <= BROADCAST_BYTES

    def side(self) -> DataFrame:
        return F.broadcast(self.frame) if self.is_small else self.frame


def code_list(frame: DataFrame) -> CodeList:
    """Check a (code, label) frame. A repeated code would multiply joined rows, so it is an error."""
    found = (
        frame.groupBy("code")
        .agg(
            F.count(F.lit(1)).alias("uses"),
            F.sum(F.octet_length("code") + F.octet_length("label")).alias("bytes"),
        )
        .agg(F.sum("uses").alias("rows"), F.max("uses").alias("uses"), F.sum("bytes").alias("bytes"))
        .first()
    )
    if (found["uses"] or 0) > 1:
        raise ValueError("a code occurs more than once in the list")
    # 16 bytes a row for lengths and pointers
    rows = found["rows"] or 0
    return CodeList(frame, rows, (found["bytes"] or 0) + 16 * rows)


def fixed_list(spark: SparkSession, pairs) -> CodeList:
    """A code list from the constants of ``functions.codes``."""
    frame = spark.createDataFrame(pairs, "code string, label string")
    return CodeList(frame, len(pairs), sum(len(c) + len(n) + 16 for c, n in pairs))


def arrival_modes(spark: SparkSession) -> CodeList:
    return fixed_list(spark, MODE_LABELS)


def visa_categories(spark: SparkSession) -> CodeList:
    return fixed_list(spark, VISA_LABELS)


def us_states(spark: SparkSession) -> CodeList:
    """The dictionary's destination states without the code for all others."""
    return fixed_list(spark, [pair for pair in STATE_LABELS if pair[0] != OTHER_STATE])


def keep_listed(df: DataFrame, key: Column, codes: CodeList) -> DataFrame:
    """Rows whose key is in the list."""
    listed = codes.side().select(F.col("code").alias("_listed"))
    return df.join(listed, key == F.col("_listed"), "left_semi")


def decode(df: DataFrame, key: Column, codes: CodeList, into: str, on_unknown="null") -> DataFrame:
    """Add the label of ``key`` as column ``into``.

    A key outside the list gives NULL, stops the job ('fail') or loses its row ('drop').
    """
    if on_unknown not in ("null", "fail", "drop"):
        raise ValueError(f"on_unknown: {on_unknown}")
    named = codes.side().select(F.col("code").alias("_code"), F.col("label").alias("_label"))
    how = "inner" if on_unknown == "drop" else "left"
    label = F.col("_label")
    if on_unknown == "fail":
        shown = F.coalesce(key.cast("string"), F.lit("NULL"))
        label = F.coalesce(label, F.raise_error(F.concat(F.lit(f"no {into} for code "), shown)))
    joined = df.join(named, key == F.col("_code"), how)
    kept = [F.col(f"`{name}`") for name in df.columns if name != into]
    return joined.select(*kept, label.alias(into))


def bucket_other(df: DataFrame, key: Column, states: CodeList, into: str) -> DataFrame:
    """Add ``into``: the key itself where listed, else the code for all others."""
    listed = states.side().select(F.col("code").alias("_code"))
    joined = df.join(listed, key == F.col("_code"), "left")
    return joined.withColumn(into, F.coalesce("_code", F.lit(OTHER_STATE))).drop("_code")
