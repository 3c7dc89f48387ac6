"""Repeated passages by content-defined chunking with a gear rolling hash.

A cut falls where the top bits of the gear hash of the last 32 bytes are zero, at least
LEAST and at most MOST bytes after the last one and never inside a character, so that chunks fall into
step again soon after an insertion. Chunks are grouped by a 128-bit digest; all occurrences
but the first, by key and place, are repeats.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import blocks, saved, ship, span_hashes, text_bytes

CUT_BITS = 5  # a cut every 32 bytes or so beyond the least size
LEAST, MOST = 32, 256  # bytes of a chunk
RUN = 128  # bytes of consecutive repeated chunks from which a passage counts as repeated

_GEAR = np.random.default_rng(50).integers(0, 2**32, 256, dtype=np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """sum of GEAR[byte k places back] << k over 32 places, by doubling the span."""
    found = _GEAR[data]
    width = 1
    while width < 32:
        moved = np.zeros_like(found)
        moved[width:] = found[:-width] << np.uint32(width)
        found = found + moved
        width *= 2
    return found


def cut_points(data: np.ndarray) -> np.ndarray:
    """Places after which the content allows a cut."""
    allowed = gear_hashes(data) >> np.uint32(32 - CUT_BITS) == 0
    allowed[:-1] &= (data[1:] & 0xC0) != 0x80
    return np.flatnonzero(allowed) + 1


def chunk_ends(points: list, low: int, high: int, data: np.ndarray) -> list:
    """Ends of the chunks of data[low:high], given the sorted cut points of all data."""
    ends, at, place = [], low, bisect_left(points, low)
    while high - at > LEAST:
        place = bisect_left(points, at + LEAST, place)
        end = points[place] if place < len(points) else high
        if end > at + MOST:
            end = at + MOST
            while end < high and data[end] & 0xC0 == 0x80:
                end += 1
        if end >= high:
            break
        ends.append(end)
        at = end
    if high > low:
        ends.append(high)
    return ends


def chunks(docs: DataFrame, key="doc_id", text="text") -> DataFrame:
    """(key, start, end, one, two): the chunks of every text by byte place, and their digest."""
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for low, high in blocks(bounds):
                part, inner = data[bounds[low] : bounds[high]], (bounds[low : high + 1] - bounds[low]).tolist()
                points, ends, owner = cut_points(part).tolist(), [], []
                for i, (a, b) in enumerate(zip(inner, inner[1:])):
                    found = chunk_ends(points, a, b, part)
                    ends += found
                    owner += [i] * len(found)
                ends, owner = np.array(ends, np.int64), np.array(owner, np.int64)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(ends)]
                base = np.array(inner, np.int64)[owner]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner + low)),
                        pa.array((starts - base).astype(np.int32)),
                        pa.array((ends - base).astype(np.int32)),
                        pa.array(exact_hashes(part, starts, ends, 0x9E3779B97F4A7C15)),
                        pa.array(exact_hashes(part, starts, ends, 0xD1B54A32D192ED03)),
                    ],
                    names=["key", "start", "end", "one", "two"],
                )

    return docs.select(key, text).mapInArrow(cut, f"key {kind}, start int, end int, one long, two long")


def exact_hashes(data, starts, ends, step):
    """Digests that tell letter case apart: the case bits of a chunk are hashed as well."""
    upper = (data >= 0x41) & (data <= 0x5A)
    case = span_hashes(np.where(upper, np.uint8(0xFF), np.uint8(0xFE)), starts, ends, step)
    return (span_hashes(data, starts, ends, step) ^ (case << np.uint64(1))).view(np.int64)


def repeated_passages(docs: DataFrame, key="doc_id", text="text", run=RUN) -> DataFrame:
    """(key, n_chunks, n_repeated, repeated_bytes, spans) of every row.

    ``spans`` has the byte ranges [start, end) of at least ``run`` bytes made of consecutive chunks that
    occur earlier, in a smaller key or further ahead in the text; those are safe to drop.
    A null or empty text has no chunk. Rows with equal keys are one text to this operator.
    """
    parts = saved(chunks(docs, key, text), "chunks")
    first = saved(
        parts.groupBy("one", "two")
        .agg(F.min(F.struct("key", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("one", "two", F.col("first.key").alias("first_key"), F.col("first.start").alias("first_start")),
        "repeated-chunks",
    )
    later = saved(
        parts.join(first.hint("merge"), ["one", "two"])
        .where("key <> first_key OR start <> first_start")
        .select("key", "start", "end"),
        "repeats",
    )
    # consecutive repeats share the difference of their start and the repeated bytes before them
    before = Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("end") - F.col("start")
    runs = (
        later.withColumn("island", F.col("start") - F.coalesce(F.sum(size).over(before), F.lit(0)))
        .groupBy("key", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n"))
    )
    by_text = runs.groupBy("key").agg(
        F.sum("n").alias("n_repeated"),
        F.array_sort(F.collect_list(F.when(size >= run, F.struct("start", "end")))).alias("spans"),
    )
    counts = parts.groupBy("key").agg(F.count(F.lit(1)).alias("n_chunks"))
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return (
        docs.select(F.col(key).alias("key"))
        .join(counts, "key", "left")
        .join(by_text, "key", "left")
        .select(
            F.col("key").alias(key),
            F.coalesce("n_chunks", F.lit(0)).cast("long").alias("n_chunks"),
            F.coalesce("n_repeated", F.lit(0)).cast("long").alias("n_repeated"),
            F.coalesce(length, F.lit(0)).cast("long").alias("repeated_bytes"),
            F.coalesce("spans", F.expr("cast(array() as array<struct<start: int, end: int>>)")).alias("spans"),
        )
    )


def without_spans(text: str | None, spans) -> str | None:
    """The text without the given byte ranges; chunks never split a character."""
    if text is None or not spans:
        return text
    raw, kept, at = text.encode(), [], 0
    for start, end in spans:
        kept.append(raw[at:start])
        at = end
    return b"".join([*kept, raw[at:]]).decode()


def op7_substring_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return repeated_passages(docs).withColumn("repeated", F.size("spans") > 0)
