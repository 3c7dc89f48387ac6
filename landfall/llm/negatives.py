"""Hard negatives by exact inner products from subset-sum tables (Four Russians).

Components are integers. A candidate is stored as bit planes: plane b holds bit b of every component, one
byte for each group of eight dimensions, the last plane with the weight of the sign. For a block
of anchors every group of eight dimensions has a table of all 256 subset sums of the anchors'
components, so that a candidate's byte is an index to what its plane adds to the scores of the
whole block. Looked-up sums are shifted and added into full exact scores.

Anchors and candidates meet in pairs of blocks, each a task's work: first within a label for
the positives, then across labels for what lies in the range that a positive sets. Each task
passes on its best few rows by anchor and positive; a window with a row limit joins them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import saved, ship
from landfall.llm.jaccard import batches_by_group
from landfall.llm.vectors import EXACT, extent, matrix, scaled, usable

ANCHORS = 512  # anchors of a block: 16 tables of 256 rows of them fill a few MB
CANDIDATES = 4096  # candidates of a block
MOST_TASKS = 100_000
KEYS = ["part", "i", "j"]


def bit_planes(values: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, groups of eight dimensions) bytes of the two's complement of integers."""
    rows, width = values.shape
    groups = -(-width // 8)
    padded = np.zeros((rows, groups * 8), np.int64)
    padded[:, :width] = values
    bits = (padded[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def subset_sums(anchors: np.ndarray, kind) -> np.ndarray:
    """(groups, 256, anchors): the sum of the components whose bit is set in the byte."""
    rows, width = anchors.shape
    groups = -(-width // 8)
    padded = np.zeros((rows, groups * 8), kind)
    padded[:, :width] = anchors
    by_place = padded.reshape(rows, groups, 8).transpose(1, 2, 0)
    sums = np.zeros((groups, 256, rows), kind)
    for place in range(8):  # the subsets with this bit are those without any bit from here on, plus it
        sums[:, 1 << place : 2 << place] = sums[:, : 1 << place] + by_place[:, place, None, :]
    return sums


def scores(sums: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """(candidates, anchors) exact inner products, plane by plane from the sign down."""
    rows, planes, groups = packed.shape
    total = np.zeros((rows, sums.shape[2]), sums.dtype)
    found = np.empty_like(total)
    for plane in range(planes - 1, -1, -1):
        total <<= 1
        for group in range(groups):
            np.take(sums[group], packed[:, plane, group], axis=0, out=found, mode="clip")
            if plane == planes - 1:
                total -= found
            else:
                total += found
    return total


def best(anchor, score, order, most: int, allowed=None) -> np.ndarray:
    """Places of the ``most`` best entries of each anchor: high scores, then low order."""
    at = np.arange(len(anchor)) if allowed is None else np.flatnonzero(allowed)
    at = at[np.lexsort((order[at], -score[at], anchor[at]))]
    if not len(at):
        return at
    new = np.concatenate([[True], anchor[at][1:] != anchor[at][:-1]])
    first = np.flatnonzero(new)
    return at[np.arange(len(at)) - first[np.cumsum(new) - 1] < most]


def top_rows(found: np.ndarray, order: np.ndarray, own: np.ndarray, most: int):
    """(candidate, anchor) of the best ``most`` candidates of each anchor but itself."""
    kept = found.astype(np.int64)
    kept[own] = np.iinfo(np.int64).min
    most = min(most, len(kept))
    # whoever is at least as good as the last of the best, ties included
    least = np.partition(kept, len(kept) - most, axis=0)[len(kept) - most]
    row, anchor = np.nonzero((kept >= least[None, :]) & (kept > np.iinfo(np.int64).min))
    chosen = best(anchor, kept[row, anchor], order[row], most)
    return row[chosen], anchor[chosen]


class Scorer:
    """Works off the groups of a partition: the anchors of a block against its candidates."""

    def __init__(self, width, planes, kind, work):
        self.width, self.planes, self.kind, self.work = width, planes, kind, work

    def __call__(self, batches):
        for table, starts in batches_by_group(batches, KEYS):
            for low, high in zip(starts[:-1].tolist(), starts[1:].tolist()):
                group = table.slice(low, high - low)
                is_anchor = group.column("values").is_valid().to_numpy()
                anchors, rows = group.filter(pa.array(is_anchor)), group.filter(pa.array(~is_anchor))
                if anchors.num_rows and rows.num_rows:
                    sums = subset_sums(matrix(anchors.column("values"), self.width), self.kind)
                    planes = rows.column("planes").combine_chunks()
                    packed = np.frombuffer(b"".join(planes.to_pylist()), np.uint8)
                    found = scores(sums, packed.reshape(len(planes), self.planes, -1))
                    yield from self.work(anchors, rows, found)


def dealt(anchors: DataFrame, rows: DataFrame, sizes: DataFrame, tasks: int) -> DataFrame:
    """Every anchor block of a part beside every candidate block of it, by (part, i, j).

    ``sizes`` has (part, n_anchors, n_rows). An anchor goes to all candidate blocks and a candidate to
    all anchor blocks of its part, so a hot part is cut as fine as any.
    """
    blocks = sizes.where("n_anchors > 0 AND n_rows > 0").select(
        "part",
        F.ceil(F.col("n_anchors") / ANCHORS).cast("int").alias("across"),
        F.ceil(F.col("n_rows") / CANDIDATES).cast("int").alias("down"),
    )
    a = anchors.join(blocks, "part").select(
        "part",
        F.pmod(F.xxhash64("id"), "across").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("down") - 1)).alias("j"),
        "id", "label", "values", F.lit(None).cast("binary").alias("planes"), "positives",
    )
    r = rows.join(blocks, "part").select(
        "part",
        F.explode(F.sequence(F.lit(0), F.col("across") - 1)).alias("i"),
        F.pmod(F.xxhash64("id", F.lit(1)), "down").cast("int").alias("j"),
        "id", "label", F.lit(None).cast("array<long>").alias("values"), "planes",
        F.lit(None).cast(anchors.schema["positives"].dataType).alias("positives"),
    )
    return a.unionByName(r).repartition(tasks, *KEYS).sortWithinPartitions(*KEYS)


def hard_negatives(
    vectors: DataFrame, is_anchor, positives=5, negatives=3, low=50, high=95,
    scale=256, key="vec_id", label="label", vector="embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors.

    ``is_anchor`` is a condition on ``key``. Scores are integer inner products of floor(scale * x).
    A row's rank by an anchor goes by score, ties by the smaller key. An anchor's positives are the
    first rows of its label but itself; its negatives for a positive are the first rows of other labels with
    low * positive <= 100 * negative <= high * positive, so a negative positive score has none.

    Rows without key, label or vector, or with a null or non-finite component, take no part. The key
    names a row: repeats of a key are one row, that with the smallest label, then vector. Shorter
    vectors count as zero beyond their end, so an empty one scores zero. Components too large for exact
    64-bit scores are an error. Other columns are not read. No rows give no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    given = vectors.select(
        F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector")
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    one = F.min(F.struct("label", scaled(F.col("vector"), scale).alias("values"))).alias("one")
    rows = saved(given.groupBy("id").agg(one).select("id", "one.label", "one.values"), "integer-vectors")
    width, largest = extent(rows)
    if largest * largest * max(width, 1) >= EXACT:
        raise OverflowError("components are too large for exact 64-bit inner products")
    planes = max(int(largest).bit_length() + 1, 2)
    # one plane more than the scores need room for, as they are shifted before they are added
    kind = np.int32 if 4 * (largest + 1) * (largest + 1) * max(width, 1) < 1 << 31 else np.int64
    id_type = rows.schema["id"].dataType.simpleString()
    label_type = rows.schema["label"].dataType.simpleString()

    def pack(batches):
        for batch in batches:
            packed = bit_planes(matrix(batch.column(2), max(width, 1)), planes)
            columns = [batch.column(0), batch.column(1), pa.array([p.tobytes() for p in packed], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "planes"])

    packed = saved(rows.mapInArrow(pack, f"id {id_type}, label {label_type}, planes binary"), "bit-planes")
    anchors = rows.withColumnRenamed("id", key).where(is_anchor).withColumnRenamed(key, "id")
    counts = packed.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"))
    asked = anchors.groupBy("label").agg(F.count(F.lit(1)).alias("n_anchors"))
    sizes = saved(asked.join(counts, "label").select(F.col("label").alias("part"), "n_anchors", "n_rows"), "sizes")

    def tasks_for(sizes):
        pairs = F.ceil(F.col("n_anchors") / ANCHORS) * F.ceil(F.col("n_rows") / CANDIDATES)
        return min(2 * (sizes.agg(F.sum(pairs)).first()[0] or 0) + 1, MOST_TASKS)

    def nearest(group, others, found):
        names, ids = group.column("id"), others.column("id")
        order = ids.to_numpy().argsort(kind="stable").argsort(kind="stable")
        own = np.nonzero(ids.to_numpy()[:, None] == names.to_numpy()[None, :])
        row, anchor = top_rows(found, order, own, positives)
        yield from named(names, ids, anchor, row, found[row, anchor])

    def named(names, ids, anchor, row, score):
        yield from pa.table(
            {"anchor": names.take(pa.array(anchor)), "id": ids.take(pa.array(row)), "score": pa.array(score, pa.int64())}
        ).to_batches()

    near = dealt(
        anchors.select("id", "label", F.col("label").alias("part"), "values", F.lit(None).cast("array<long>").alias("positives")),
        packed.select("id", "label", F.col("label").alias("part"), "planes"),
        sizes,
        tasks_for(sizes),
    ).mapInArrow(
        Scorer(max(width, 1), planes, kind, nearest), f"anchor {id_type}, id {id_type}, score long"
    )
    by_anchor = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    chosen = saved(
        near.withColumn("place", F.row_number().over(by_anchor)).where(F.col("place") <= positives), "positives"
    )

    # the scores of an anchor's positives, best first: as many as ``positives`` at most
    wanted = chosen.groupBy(F.col("anchor").alias("id")).agg(
        F.sort_array(F.collect_set("score"), False).alias("positives")
    )
    asked = saved(anchors.join(wanted, "id"), "anchors")
    whole = spark.createDataFrame([(0, asked.count(), packed.count())], "part int, n_anchors long, n_rows long")

    def in_range(group, others, found):
        names, ids = group.column("id"), others.column("id")
        order = ids.to_numpy().argsort(kind="stable").argsort(kind="stable")
        bounds = np.full((len(names), positives), -1, np.int64)
        for at, list_ in enumerate(group.column("positives").to_pylist()):
            bounds[at, : len(list_)] = list_
        least, most = -(-low * bounds // 100), high * bounds // 100  # empty for -1, as it is negative
        used = bounds >= 0
        from_, to = np.where(used, least, np.iinfo(np.int64).max).min(1), np.where(used, most, -1).max(1)
        other = others.column("label").to_numpy()[:, None] != group.column("label").to_numpy()[None, :]
        row, anchor = np.nonzero((found >= from_[None, :]) & (found <= to[None, :]) & other)
        score = found[row, anchor].astype(np.int64)
        for place in range(positives):
            fits = used[anchor, place] & (score >= least[anchor, place]) & (score <= most[anchor, place])
            kept = best(anchor, score, order[row], negatives, fits)
            yield from pa.table(
                {
                    "anchor": names.take(pa.array(anchor[kept])),
                    "positive_score": pa.array(bounds[anchor[kept], place], pa.int64()),
                    "id": ids.take(pa.array(row[kept])),
                    "score": pa.array(score[kept], pa.int64()),
                }
            ).to_batches()

    far = dealt(
        asked.select("id", "label", F.lit(0).alias("part"), "values", "positives"),
        packed.select("id", "label", F.lit(0).alias("part"), "planes"),
        whole,
        tasks_for(whole),
    ).mapInArrow(
        Scorer(max(width, 1), planes, kind, in_range),
        f"anchor {id_type}, positive_score long, id {id_type}, score long",
    )
    by_score = Window.partitionBy("anchor", "positive_score").orderBy(F.desc("score"), "id")
    ranked = far.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= negatives)
    pairs = chosen.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return pairs.join(ranked, ["anchor", "positive_score"]).select(
        F.col("anchor").alias("anchor_id"),
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def op13_hard_negatives(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", changed), F.col("vec_id") % 50 == 0)


OP13_SQL = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS vec_id, a.label = r.label AS same,
         list_inner_product(a.v, r.v)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
    AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3"""
