"""Which sides of a join are small enough to copy to every executor."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.session import settle

# Measured size up to which a side is broadcast; bigger sides are joined by shuffle.
BROADCAST_BYTES = 8 * 1024 * 1024


def row_bytes(df: DataFrame) -> int:
    """Size of all rows: 16 bytes, and 16 for each column, and the bytes of text on top.

    Only for flat frames of numbers, dates and text; other types are refused.
    """
    flat = ("string", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp")
    other = [name for name, kind in df.dtypes if kind not in flat and not kind.startswith("decimal")]
    if other:
        raise TypeError(f"no size known for columns {other}")
    text = [F.coalesce(F.octet_length(f"`{name}`"), F.lit(0)) for name, kind in df.dtypes if kind == "string"]
    fixed = 16 + 16 * len(df.columns)  # a decimal takes 16
    total = df.agg(F.sum(sum(text, F.lit(fixed))).alias("bytes")).first()["bytes"]
    return total or 0


def small_side(df: DataFrame, limit=BROADCAST_BYTES) -> DataFrame:
    """``df`` computed once, and marked for broadcast if its measured size allows.

    For dimensions that meet row-level data: Catalyst estimates an aggregate by
    its input, so without the measured size it would shuffle the rows.
    """
    kept = settle(df)
    return F.broadcast(kept) if row_bytes(kept) <= limit else kept


def small_sides(*frames: DataFrame) -> list[DataFrame]:
    """``small_side`` of each frame, their jobs running side by side."""
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        return list(pool.map(small_side, frames))
