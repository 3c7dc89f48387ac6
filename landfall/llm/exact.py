"""Exact duplicates by a distributed most-significant-digit radix partition.

A text's key is its length in bytes followed by its bytes. Each round splits the
groups by their next digit, a run of bytes sixteen times as long as the one before;
groups of one row leave, and groups whose texts have ended are classes of equal texts.
Texts are told apart by their bytes alone; no digest decides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import saved

FIRST_DIGIT = 64  # bytes
GROWTH = 16


def normalised(text):
    """White-space runs as one space; null as the empty text."""
    return F.coalesce(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "), F.lit(""))


def classified(docs: DataFrame, key="doc_id", text="text") -> DataFrame:
    """(key, keep, size, text_sha256) of every given row, repeated ones as often as they are given.

    ``keep`` is the smallest key among the rows of equal texts, and ``size`` their number. Repeated keys
    are fine: each row goes by its own text. Null keys count as rows but become ``keep`` only where no
    row has another. The digest is passed through; it tells rows of one key apart later, never texts.

    Each round groups (group, digit) with partial counts per task, numbers and saves the groups of
    two and more, and joins them to the rows; a hot group is split by the skew join. The join
    is always a merge join, so that the plan is the same at every size.
    The text travels once, rests only for rows that still share a group.
    """
    rows = docs.select(
        F.col(key).alias("key"),
        F.encode(normalised(F.col(text)), "UTF-8").alias("rest"),
    ).select(
        "key", F.sha2("rest", 256).alias("text_sha256"), "rest", F.octet_length("rest").cast("long").alias("group")
    )
    done, width = [], FIRST_DIGIT
    alone = F.col("size").isNull()
    while True:
        split = rows.withColumn("digit", F.substring("rest", 1, width))
        groups = saved(
            split.groupBy("group", "digit")
            .agg(F.min("key").alias("keep"), F.count(F.lit(1)).alias("size"))
            .where("size > 1")
            .withColumn("number", F.monotonically_increasing_id()),
            "radix-groups",
        )
        if groups.isEmpty():
            done.append(rows.select("key", F.col("key").alias("keep"), F.lit(1).cast("long").alias("size"), "text_sha256"))
            break
        goes_on = ~alone & (F.octet_length("rest") > width)
        rows = saved(
            split.join(groups.hint("merge"), ["group", "digit"], "left").select(
                "key",
                "text_sha256",
                F.when(goes_on, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
                F.col("number").alias("group"),
                F.when(alone, F.col("key")).otherwise(F.col("keep")).alias("keep"),
                F.coalesce("size", F.lit(1)).alias("size"),
            ),
            "radix-rows",
        )
        done.append(rows.where("rest IS NULL").select("key", "keep", "size", "text_sha256"))
        rows = rows.where("rest IS NOT NULL").select("key", "text_sha256", "rest", "group")
        width *= GROWTH
    return reduce(DataFrame.unionByName, done)


def duplicate_classes(docs: DataFrame, key="doc_id", text="text") -> DataFrame:
    """(key, keep, size) of every row whose normalised text occurs more than once."""
    return classified(docs, key, text).where("size > 1").select("key", "keep", "size")


def exact_dedup(docs: DataFrame, key="doc_id", text="text") -> DataFrame:
    """The given rows, one of each class of equal texts: the one with the smallest key.

    All columns stay as they are, whatever their names. A null text equals an empty one. Rows with
    equal keys and equal texts stay together, as nothing tells which of them to keep, and so do
    rows without a key. Where a key has several texts, each of its rows goes by its own.
    """
    dropped = classified(docs, key, text).where("key > keep").select("key", "text_sha256").distinct()
    dropped = saved(dropped, "dropped")
    own = F.sha2(F.encode(normalised(docs[text]), "UTF-8"), 256)
    return docs.join(dropped, (docs[key] == dropped["key"]) & (own == dropped["text_sha256"]), "left_anti")


def op4_exact_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return classified(docs).select(
        F.col("key").alias("doc_id"),
        F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("keep") == F.col("key")).alias("kept"),
        "text_sha256",
    )


OP4_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, keep_id = doc_id AS kept, sha256(t) AS text_sha256
FROM n JOIN g USING (t)"""
