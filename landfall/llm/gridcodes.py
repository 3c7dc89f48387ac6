"""Product quantisation with memoised grid cells.

Vectors of integers are cut into parts; each part position has a codebook of its own, refined by
rounds of assignment and averaging in exact integer arithmetic. To assign a part, its grid cell
(the box of ``cell`` units a side that holds it) is looked up in a cache. On a miss the smallest and
the largest squared distance from each entry to the box are taken; an entry whose smallest
exceeds the least of the largest is dominated across the box and can be nearest to no point of it. The
others are cached, and only those are compared exactly.

The codebooks are of a fixed size, so they travel as part of the tasks. Assignments leave a task as sums
and counts by entry, which Spark adds up.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import saved, ship
from landfall.llm.vectors import EXACT, extent, matrix, scaled, usable

CELL = 16  # units a side; changes the work, never the result
CACHED = 1 << 15  # cells kept by a task for each part position; further ones are worked out anew
AT_ONCE = 1 << 12  # parts assigned at once


class GridCodebook:
    """The entries of one part position with the cache of their cells."""

    def __init__(self, entries: np.ndarray, cell=CELL, kind=np.int64):
        self.entries, self.cell, self.kind = entries, cell, kind
        self.cached = {}

    def survivors(self, cells: np.ndarray) -> np.ndarray:
        """(cells, entries): which entries are not dominated across the cell."""
        least = np.zeros((len(cells), len(self.entries)), self.kind)
        most = np.zeros_like(least)
        for place in range(cells.shape[1]):
            # cells share coordinates: one row of distances for each that occurs
            number, which = np.unique(cells[:, place], return_inverse=True)
            below = self.entries[None, :, place] - self.cell * number[:, None]
            above = self.cell - 1 - below
            outside = np.maximum(np.maximum(-below, -above), 0)
            farthest = np.maximum(np.abs(below), np.abs(above))
            least += (outside * outside).astype(self.kind)[which]
            most += (farthest * farthest).astype(self.kind)[which]
        return least <= most.min(axis=1, keepdims=True)

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """The survivors of each of the distinct cells, from the cache where it has them."""
        names = [c.tobytes() for c in cells]
        known = [self.cached.get(name) for name in names]
        missing = [at for at, bits in enumerate(known) if bits is None]
        if missing:
            for at, bits in zip(missing, np.packbits(self.survivors(cells[missing]), axis=1)):
                known[at] = bits
                if len(self.cached) < CACHED:
                    self.cached[names[at]] = bits
        return np.unpackbits(np.array(known), axis=1, count=len(self.entries)).astype(bool)

    def nearest(self, parts: np.ndarray):
        """(index of the nearest entry, its squared distance); equal distances go to the lower index."""
        index, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        for low in range(0, len(parts), AT_ONCE):
            some = parts[low : low + AT_ONCE]
            cells, cell_of = np.unique(some // self.cell, axis=0, return_inverse=True)
            row, entry = np.nonzero(self.candidates(cells)[cell_of.ravel()])
            exact = np.zeros(len(row), np.int64)
            for place in range(parts.shape[1]):
                apart = some[row, place] - self.entries[entry, place]
                exact += apart * apart
            order = np.lexsort((entry, exact, row))
            first = order[np.searchsorted(row[order], np.arange(len(some)))]
            index[low : low + len(some)] = entry[first]
            distance[low : low + len(some)] = exact[first]
        return index, distance


def refined(codebooks: np.ndarray, totals) -> np.ndarray:
    """Each entry as the floor of the mean of its parts; unused entries stay.

    ``totals`` are rows (part, entry, place, total), with place -1 for the count.
    """
    counts, sums = {}, {}
    for part, entry, place, total in totals:
        (counts if place < 0 else sums)[(part, entry, place)] = total
    out = codebooks.copy()
    for (part, entry, place), total in sums.items():
        out[part, entry, place] = total // counts[(part, entry, -1)]
    return out


def sha256_of(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def grid_codes(
    vectors: DataFrame, parts=4, entries=256, rounds=4, scale=1024, cell=CELL,
    key="vec_id", label="label", vector="embedding",
) -> tuple[DataFrame, np.ndarray]:
    """((key, label, codes, error) of every usable row, the final codebooks (part, entry, place)).

    Components become floor(scale * x). The first codebooks are the parts of the rows with the smallest
    keys (null keys last, equal keys by vector); fewer rows than ``entries`` give as many entries.
    Every row counts, repeated ones as often as they occur. Rows whose vector is null or holds a null
    or non-finite component are dropped. Vectors shorter than the longest, or whose length ``parts`` does not
    divide, are filled up with zeros. Components too large for exact 64-bit distances are an error.
    A null key or label is kept as it is. Other columns are not read. No rows give no rows and
    empty codebooks.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = saved(
        vectors.where(usable(F.col(vector))).select(
            F.col(key).alias("key"),
            F.col(label).alias("label"),
            scaled(F.col(vector), scale).alias("values"),
        ),
        "integer-vectors",
    )
    longest, largest = extent(rows)
    width = max(-(-longest // parts), 1)
    farthest = (2 * largest + 2 * cell) ** 2 * width
    if farthest >= EXACT:
        raise OverflowError("components are too large for exact 64-bit distances")
    kind = np.int32 if farthest < 1 << 31 else np.int64
    first = rows.orderBy(F.asc_nulls_last("key"), "values").limit(entries).select("values").toArrow()
    first = first.column(0).combine_chunks()
    books = matrix(first, parts * width).reshape(len(first), parts, width).transpose(1, 0, 2).copy()

    def assigned(batches, books):
        held = [GridCodebook(book, cell, kind) for book in books]
        for batch in batches:
            cut = matrix(batch.column(2), parts * width).reshape(batch.num_rows, parts, width)
            found = [held[p].nearest(np.ascontiguousarray(cut[:, p])) for p in range(parts)]
            yield batch, cut, found

    def summing(books):
        def work(batches):
            sums = np.zeros((parts, books.shape[1], width + 1), np.int64)
            for _, cut, found in assigned(batches, books):
                for p, (index, _) in enumerate(found):
                    used, first = np.unique(index[order := index.argsort(kind="stable")], return_index=True)
                    sums[p, used, 1:] += np.add.reduceat(cut[order, p], first)
                    sums[p, :, 0] += np.bincount(index, minlength=books.shape[1])
            part, entry = np.nonzero(sums[:, :, 0])
            total = sums[part, entry]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(part, width + 1), pa.int32()), pa.array(np.repeat(entry, width + 1), pa.int32()),
                 pa.array(np.tile(np.arange(-1, width), len(part)), pa.int32()), pa.array(total.ravel(), pa.int64())],
                names=["part", "entry", "place", "total"],
            )

        return work

    for _ in range(rounds if len(first) else 0):
        sums = rows.mapInArrow(summing(books), "part int, entry int, place int, total long")
        # parts x entries x (places + 1) rows at most
        totals = sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect()
        books = refined(books, totals)

    def final(batches):
        for batch, _, found in assigned(batches, books):
            codes = np.stack([index for index, _ in found], axis=1)
            errors = sum(distance for _, distance in found)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel(), pa.int32()), parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists.cast(pa.list_(pa.int32())), pa.array(errors, pa.int64())],
                names=["key", "label", "codes", "error"],
            )

    kinds = [rows.schema[name].dataType.simpleString() for name in ("key", "label")]
    schema = f"key {kinds[0]}, label {kinds[1]}, codes array<int>, error long"
    return rows.mapInArrow(final, schema), books


def decoded(codes, codebooks: np.ndarray) -> np.ndarray:
    """The integer vectors that rows of codes stand for."""
    codes = np.asarray(codes)
    return np.concatenate([codebooks[p][codes[:, p]] for p in range(len(codebooks))], axis=1)


def op12_grid_codes(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    coded, books = grid_codes(vectors)
    coded = saved(coded, "grid-codes")
    by_label = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    digits = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label"))).select(
        F.col("key").alias("vec_id"),
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(sha256_of(books)).alias("codebooks_sha256"),
    )


def _sql(parts=4, entries=256, rounds=4):
    """The same in SQL: one assignment and one averaging step a round."""
    steps = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
         [floor(1024 * x::DOUBLE)::BIGINT for x in embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
c AS MATERIALIZED (
  SELECT r, (i - 1) // (len(v) // {parts}) AS p, (i - 1) % (len(v) // {parts}) AS i, v[i] AS x
  FROM (SELECT r, v, unnest(range(1, len(v) + 1)) AS i FROM v)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, i, x FROM c WHERE r <= {entries})"""
    ]
    assign = """a{k} AS MATERIALIZED (
  SELECT r, p, min(row(d, e)) AS best FROM (
    SELECT c.r, c.p, b.e, sum((c.x - b.x) * (c.x - b.x))::BIGINT AS d
    FROM c JOIN b{k} b ON b.p = c.p AND b.i = c.i GROUP BY c.r, c.p, b.e) GROUP BY r, p)"""
    average = """b{n} AS MATERIALIZED (
  SELECT b.p, b.e, b.i, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN (
    SELECT a.p, a.best[2] AS e, c.i, (sum(c.x) - ((sum(c.x) % count(*)) + count(*)) % count(*))::BIGINT // count(*) AS x
    FROM a{k} a JOIN c ON c.r = a.r AND c.p = a.p GROUP BY a.p, a.best[2], c.i) m
  ON m.p = b.p AND m.e = b.e AND m.i = b.i)"""
    for k in range(rounds):
        steps += [assign.format(k=k), average.format(k=k, n=k + 1)]
    steps.append(assign.format(k=rounds))
    steps.append(
        f"""f AS MATERIALIZED (
  SELECT r, string_agg(lower(printf('%02x', best[2]::INTEGER)), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error
  FROM a{rounds} GROUP BY r),
l AS (SELECT label, sum(error)::BIGINT AS label_error FROM f JOIN v USING (r) GROUP BY label),
h AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM f JOIN v USING (r) JOIN l ON l.label IS NOT DISTINCT FROM v.label, h"""
    )
    return "WITH " + ",\n".join(steps)


OP12_SQL = _sql()
