"""Near copies by many universal-hash minima, banding and exact confirmation.

The minima of HASHES multiply-add hashes over a text's shingles are cut into bands; texts with an equal band share
a bucket. A pair at the threshold shares no band with a chance of about 1e-9, and the same holds for
falling below the least agreement of signatures (a byte of each minimum), which screens pairs
before their full sets are compared.

A bucket's texts meet at its smallest key, the leader, once per leader. Work on a group of that kind is
drawn by components, since links within one say nothing new:
1. every member is compared with the leader,
2. then with the member that is most like the leader (the original among its variants),
3. the rest: members outside the largest component of the group are compared with all others, in pairs of blocks.
Members that came to lie in one component are thus never compared with one another, and a group of
one component is done. Components are found by alternating large-star and small-star steps.
"""

from __future__ import annotations

from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import mix, saved, ship
from landfall.llm.jaccard import batches_by_group, distinct_sets, forest, lists_of, named_links

BANDS = 44
ROWS = 6
HASHES = BANDS * ROWS
MISSED = 1e-9  # accepted chance that a pair at the threshold falls below the least agreement
BLOCK_ROWS = 512
BLOCK_TOKENS = 1 << 20
TEXTS = 256  # texts hashed at once
KEYS = ["leader", "i", "j"]

_rng = np.random.default_rng(20250611)
_FACTORS = _rng.integers(0, 2**64, HASHES, dtype=np.uint64) | np.uint64(1)
_SHIFTS = _rng.integers(0, 2**64, HASHES, dtype=np.uint64)


@cache
def least_agreement(percent: int) -> int:
    """How many of HASHES minima a pair at ``percent`` similarity shares but for a chance of MISSED."""
    chance, below = percent / 100, 0.0
    for k in range(HASHES + 1):
        below += comb(HASHES, k) * chance**k * (1 - chance) ** (HASHES - k)
        if below > MISSED:
            return k
    return HASHES


def minima(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(sets, HASHES) least hash values of the sets of tokens that begin at ``starts``; none is empty."""
    out = np.empty((len(starts), HASHES), np.uint64)
    hashed = np.empty_like(tokens)
    with np.errstate(over="ignore"):
        for k in range(HASHES):
            np.multiply(tokens, _FACTORS[k], out=hashed)
            hashed += _SHIFTS[k]
            out[:, k] = np.minimum.reduceat(hashed, starts)
    return out


def band_hashes(least: np.ndarray) -> np.ndarray:
    """(sets, BANDS) one hash of the band's number and its minima."""
    found = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(least), 1))
    with np.errstate(over="ignore"):
        for row in range(ROWS):
            found = mix(found * np.uint64(0x9E3779B97F4A7C15) + least[:, row::ROWS])
    return found


def signed(docs: DataFrame, words: int) -> DataFrame:
    """(row, n, one, two, bands, signature) of ``docs`` (key, text); ``one`` and ``two`` digest the whole set."""
    kind = docs.schema["key"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                keys, texts = batch.column(0).slice(at, TEXTS), batch.column(1).slice(at, TEXTS)
                sets = list(distinct_sets(texts, words))
                n = np.array([len(s) for s in sets], np.int64)
                there = np.flatnonzero(n)
                one, two = np.zeros((2, len(n)), np.uint64)
                bands, signature = [[]] * len(n), [b""] * len(n)
                if len(there):
                    tokens, starts = np.concatenate(sets), (np.cumsum(n) - n)[there]
                    with np.errstate(over="ignore"):
                        one[there] = np.add.reduceat(mix(tokens), starts)
                        two[there] = np.add.reduceat(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), starts)
                    least = minima(tokens, starts)
                    for k, band, byte in zip(there, band_hashes(least).view(np.int64), (mix(least) >> np.uint64(56))):
                        bands[k], signature[k] = band, byte.astype(np.uint8).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(n), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(signature, pa.binary())],
                    names=["row", "n", "one", "two", "bands", "signature"],
                )

    return docs.select("key", "text").mapInArrow(
        work, f"row {kind}, n long, one long, two long, bands array<long>, signature binary"
    )


def full_sets(docs: DataFrame, words: int, rows: DataFrame) -> DataFrame:
    """(row, n, one, tokens) of the texts whose row is in ``rows``; ``one`` as in ``signed``."""
    kind = docs.schema["key"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                sets = list(distinct_sets(part.column(1), words))
                one = [mix(s).sum(dtype=np.uint64) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(np.array(one, np.uint64).view(np.int64)),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    names=["row", "n", "one", "tokens"],
                )

    texts = docs.select("key", "text").join(rows.select(F.col("row").alias("key")), "key", "left_semi")
    return texts.mapInArrow(work, f"row {kind}, n long, one long, tokens array<long>")


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a key moves to the smallest key of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select("v", "u")).toDF("key", "other")
    least = both.groupBy("key").agg(F.min("other").alias("least"))
    least = least.select("key", F.least("key", "least").alias("least"))
    return both.join(least, "key").where("other > key").select(F.col("other").alias("u"), F.col("least").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """A key and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    moved = edges.join(least, "u").where("v <> least")
    own = least.select("u", F.col("least").alias("v"))
    return moved.select(F.col("v").alias("u"), F.col("least").alias("v")).union(own).distinct()


def all_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one neighbour only and is nobody's smaller end."""
    ends = edges.select(F.col("u").alias("key"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    met = ends.groupBy("key").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return met.where("up > 1 OR up = 1 AND down = 1").isEmpty()


def star_components(links: DataFrame) -> DataFrame:
    """(key, component) of every key in ``links`` (a, b); ``component`` is the smallest key reached.

    Large-star and small-star alternate until the links are stars: then each key hangs on its
    smallest. Neighbourhoods are never gathered; each step is a minimum by key and a join.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = saved(edges.distinct(), "star-links")
    while not all_stars(edges):
        edges = saved(small_star(large_star(edges)), "star-links")
    return edges.select(F.col("u").alias("key"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct()
    )


def across(askers: DataFrame, members: DataFrame, weight, content: DataFrame, work, schema: str) -> DataFrame:
    """Run ``work`` over the askers of each leader's group against its members, in pairs of blocks.

    Both have (leader, row, n, component); ``weight`` says how many longs a row's content takes. With
    few askers each member is in one block only: copies grow with askers times members, not with
    the square of the group.
    """

    def cut(rows, name):
        share = F.greatest(F.count(F.lit(1)) / BLOCK_ROWS, F.sum(weight) / BLOCK_TOKENS)
        return rows.groupBy("leader").agg(F.ceil(share).cast("int").alias(name))

    blocks = saved(cut(askers, "across").join(cut(members, "down"), "leader"), "group-blocks")

    def deal(rows, asks, own, own_blocks, other, other_blocks):
        return rows.join(blocks, "leader").select(
            "leader",
            F.pmod(F.xxhash64("row"), own_blocks).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(other_blocks) - 1)).alias(other),
            "row",
            "component",
            F.lit(asks).alias("asks"),
        )

    both = deal(askers, True, "i", "across", "j", "down").unionByName(
        deal(members, False, "j", "down", "i", "across")
    )
    return (
        both.join(content.hint("merge"), "row")  # at every size alike: content is what is large
        .repartition(*KEYS)
        .sortWithinPartitions(*KEYS)
        .mapInArrow(work, schema)
    )


def candidates(group, percent: int):
    """(asker, member) places of the pairs in a group that may be similar and lie in different components."""
    asks = group.column("asks").to_numpy()
    component, row = (group.column(name).to_numpy() for name in ("component", "row"))
    n = group.column("n").to_numpy()
    signature = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint8).reshape(-1, HASHES)
    askers, members = np.flatnonzero(asks), np.flatnonzero(~asks)
    found, floor = [], least_agreement(percent)
    step = max(1, (1 << 24) // (HASHES * max(len(members), 1)))
    for low in range(0, len(askers), step):
        some = askers[low : low + step]
        agree = (signature[some][:, None, :] == signature[members][None, :, :]).sum(2)
        small, large = np.minimum.outer(n[some], n[members]), np.maximum.outer(n[some], n[members])
        fits = (agree >= floor) & (100 * small >= percent * large)
        fits &= (component[some][:, None] != component[members][None, :]) & (
            row[some][:, None] != row[members][None, :]
        )
        a, b = np.nonzero(fits)
        found.append((some[a], members[b]))
    if not found:
        return askers[:0], members[:0]
    return tuple(np.concatenate(side) for side in zip(*found))


def groups_of(batches):
    for table, starts in batches_by_group(batches, KEYS):
        for low, high in zip(starts[:-1].tolist(), starts[1:].tolist()):
            if high - low > 1:
                yield table.slice(low, high - low)


def screen(percent: int):
    """(leader, row) of the rows that have a possible partner by signature."""

    def work(batches):
        for group in groups_of(batches):
            a, b = candidates(group, percent)
            alive = pa.array(np.union1d(a, b))
            yield from group.select(["leader", "row"]).take(alive).to_batches()

    return work


def shared_counts(tokens, begins, sizes, a: int, others: np.ndarray) -> np.ndarray:
    """How many tokens set ``a`` shares with each of the others."""
    own = tokens[begins[a] : begins[a] + sizes[a]]
    n = sizes[others]
    places = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begins[others], n)
    asked = tokens[places]
    there = own[np.minimum(np.searchsorted(own, asked), len(own) - 1)] == asked
    return np.add.reduceat(there.astype(np.int64), np.cumsum(n) - n)


def compare(percent: int, all_pairs: bool):
    """Exact similarity on full sets of the possible pairs.

    With ``all_pairs`` every possible pair goes out as (leader, a, b, similarity, linked), which is for groups with one
    asker; else a spanning forest of the links as (a, b).
    """

    def work(batches):
        for group in groups_of(batches):
            a, b = candidates(group, percent)
            if not len(a):
                continue
            tokens, sizes = lists_of(group.column("tokens"))
            begins = np.cumsum(sizes) - sizes
            cuts = np.append(np.flatnonzero(np.diff(a, prepend=-1)), len(a))
            shared = np.concatenate(
                [shared_counts(tokens, begins, sizes, a[low], b[low:high]) for low, high in zip(cuts[:-1], cuts[1:])]
            )
            union = sizes[a] + sizes[b] - shared
            near = 100 * shared >= percent * union
            if all_pairs:
                row = group.column("row")
                yield from pa.table(
                    {"leader": group.column("leader").take(pa.array(a)), "a": row.take(pa.array(a)),
                     "b": row.take(pa.array(b)), "similarity": pa.array(shared / union), "linked": pa.array(near)}
                ).to_batches()
            else:
                yield from named_links(group, forest(a[near], b[near]))

    return work


def minhash_links(docs: DataFrame, words: int, percent: int):
    """(links between class representatives, membership) for ``docs`` (key, text) without null keys.

    Links connect whatever pairs at ``percent`` or more connect; not every such pair is among them.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema["key"].dataType.simpleString()
    index = saved(signed(docs, words), "minhash-index")
    classes = saved(index.groupBy("n", "one", "two").agg(F.min("row").alias("rep")), "set-classes")
    members = saved(
        index.select("row", "n", "one", "two")
        .join(classes.hint("merge"), ["n", "one", "two"])
        .select("row", "n", F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("row")).alias("rep")),
        "set-members",
    )
    # a set of n has no other partner than its equals unless n of n + 1 tokens are enough
    reps = index.where(100 * F.col("n") >= percent * (F.col("n") + 1)).join(
        classes.select(F.col("rep").alias("row"), "n", "one", "two").hint("merge"), ["row", "n", "one", "two"], "left_semi"
    )
    reps = saved(reps.dropDuplicates(["row", "n", "one", "two"]).drop("two"), "representatives")
    posted = reps.select("row", "n", F.explode("bands").alias("bucket"))
    shared = saved(
        posted.groupBy("bucket")
        .agg(F.min("row").alias("leader"), F.max("row").alias("last"))
        .where("leader <> last")
        .select("bucket", "leader"),
        "bucket-leaders",
    )
    met = saved(
        posted.join(shared.hint("merge"), "bucket").select("leader", "row", "n").distinct(), "meetings"
    )
    sets = full_sets(docs, words, saved(met.select("row").distinct(), "met-rows"))
    if not index.groupBy("row").count().where("count > 1").isEmpty():
        sets = sets.dropDuplicates(["row", "n", "one"])  # one of repeated rows
    content = saved(
        sets.join(reps.select("row", "n", "one", "signature").hint("merge"), ["row", "n", "one"]).drop("one"),
        "shingle-sets",
    )

    def tested(askers, rows, all_pairs, schema):
        """Screen by signature, then compare the full sets of who is left."""
        alive = saved(
            across(
                askers, rows, F.lit(HASHES // 8), content.drop("tokens"), screen(percent), f"leader {kind}, row {kind}"
            ).distinct(),
            "alive",
        )
        askers, rows = (side.join(alive, ["leader", "row"]) for side in (askers, rows))
        return saved(across(askers, rows, F.col("n"), content, compare(percent, all_pairs), schema), "compared")

    links, pivots = None, []
    with_links = f"leader {kind}, a {kind}, b {kind}, similarity double, linked boolean"
    placed = met.withColumn("component", F.col("row"))
    for step in ("leader", "nearest"):
        if step == "leader":
            pivot = shared.select("leader", F.col("leader").alias("pivot")).distinct()
        else:
            most = F.max(F.struct("similarity", "b")).getField("b")
            pivot = found.groupBy("leader").agg(most.alias("pivot"))
        pivots.append(pivot)
        marked = saved(placed.join(pivot, "leader"), "pivots")
        found = tested(
            marked.where("row = pivot").drop("pivot"), marked.where("row <> pivot").drop("pivot"), True, with_links
        )
        new = found.where("linked").select("a", "b")
        links = new if links is None else links.unionByName(new)
        place = saved(star_components(links), "placed")
        # from here on their stars stand for the links
        links = place.select(F.col("key").alias("a"), F.col("component").alias("b"))
        placed = met.join(place.withColumnRenamed("key", "row"), "row", "left").withColumn(
            "component", F.coalesce("component", "row")
        )
    # pivots have met everyone of their group; others of groups of several components go on
    for pivot in pivots:
        placed = placed.join(pivot.withColumnRenamed("pivot", "row"), ["leader", "row"], "left_anti")
    placed = saved(placed, "unsettled")
    sizes = placed.groupBy("leader", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = F.max(F.struct("size", "component")).getField("component").alias("largest")
    open_groups = sizes.groupBy("leader").agg(largest, F.count(F.lit(1)).alias("parts")).where("parts > 1")
    rest = saved(placed.join(open_groups.drop("parts"), "leader"), "rest")
    more = tested(
        rest.where("component <> largest").drop("largest"), rest.drop("largest"), False, f"a {kind}, b {kind}"
    )
    return links.unionByName(more), members


def minhash_components(docs: DataFrame, words=5, percent=85, key="doc_id", text="text") -> DataFrame:
    """(key, n_shingles, component) of every row: components of links at ``percent`` Jaccard or more.

    A null or wordless text has the empty set and is linked with nothing. ``component`` is the smallest key
    reachable, the row's own included. Repeated rows are kept; texts that share a key may share
    their links. A row without a key has its set size and no component. Other columns
    are not read. No rows give no rows.
    """
    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    links, members = minhash_links(given.where("key IS NOT NULL"), words, percent)
    found = star_components(links).withColumnRenamed("key", "rep")
    named = members.join(found, "rep", "left").select(
        "row", "n", F.coalesce("component", "rep").alias("component")
    )
    nameless = signed(given.where("key IS NULL"), words).select("row", "n", F.col("row").alias("component"))
    return named.unionByName(nameless).select(
        F.col("row").alias(key), F.col("n").alias("n_shingles"), "component"
    )


def without_minhash_copies(docs: DataFrame, words=5, percent=85, key="doc_id", text="text") -> DataFrame:
    """The rows of ``docs`` with all their columns, one key of each component: the smallest. Rows without a key stay."""
    found = minhash_components(docs, words, percent, key, text)
    dropped = found.where(F.col("component") < F.col(key)).select(F.col(key)).distinct()
    return docs.join(dropped, key, "left_anti").select(*docs.columns)


def op11_minhash_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return minhash_components(docs).select(
        "doc_id", "n_shingles", F.col("component").alias("component_id"), (F.col("component") == F.col("doc_id")).alias("kept")
    )


OP11_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o
      FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, other) AS (SELECT a, b FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other),
m AS (SELECT doc_id, min(other) AS least_other FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.least_other, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(m.least_other, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)"""
