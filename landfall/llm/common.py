"""What the operators share: saved intermediate tables, shipped code, whole-column word hashing."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from landfall.session import scratch_path

PACKAGE = Path(__file__).resolve().parents[1]
BLOCK = 4 << 20  # bytes of text taken at once; a longer single text is its own block
HASHED = 1 << 20  # bytes of text whose words are hashed at once
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SPACED_WORD = ~SPACE
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_STEP = 0x9E3779B97F4A7C15
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[0x41:0x5B] = _BYTE[0x61:0x7B]  # A-Z hash as a-z
_powers = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_landfall_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="landfall-code-"), "landfall_code.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for file in PACKAGE.rglob("*.py"):
            packed.write(file, f"{PACKAGE.name}/{file.relative_to(PACKAGE)}")
    context.addPyFile(path)
    context._landfall_shipped = True


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a derived table to the shared folder and read it back.

    Lineage ends there, so a lost executor costs no recomputation, and later
    plans see the size of the files.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64, at least n of them."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(1 << max(n, HASHED).bit_length(), base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        _powers[base] = have
    return have


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty) and where each text begins."""
    pa.default_memory_pool().release_unused()  # what earlier batches took
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, starts, data = column.buffers()
    bounds = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int = _STEP):
    """A 64-bit hash of each byte range: sum of byte values times powers of an odd step."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(data)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * powers(step, n)[:n], out=sums[1:])
        found = (sums[ends] - sums[starts]) * powers(pow(step, -1, 1 << 64), n)[starts]
        return mix(found + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray):
    """Starts and ends of the maximal runs of word bytes; none crosses a text's end."""
    inside = kind[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def running(lengths: pa.Array) -> np.ndarray:
    """Where each of items so long (null: nothing) begins, and the end of the last."""
    lengths = pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def blocks(bounds: np.ndarray, size=BLOCK):
    """Ranges of texts of at most ``size`` bytes, or one text."""
    at, n = 0, len(bounds) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
        yield at, to
        at = to


def word_hashes(column: pa.Array, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and per text the number of words.

    A-Z count as a-z. Different words share a hash with a chance of about 2**-64.
    """
    data, bounds = text_bytes(column)
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at, to in blocks(bounds, HASHED):
        part = data[bounds[at] : bounds[to]]
        inner = bounds[at : to + 1] - bounds[at]
        starts, ends = word_spans(part, inner, kind)
        hashes.append(span_hashes(part, starts, ends))
        counts.append(np.diff(np.searchsorted(starts, inner)))
    return np.concatenate(hashes), np.concatenate(counts)
