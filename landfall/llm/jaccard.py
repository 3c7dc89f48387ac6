"""Similarity join on word shingles with token-combination prefixes.

A text is its set of distinct shingles, hashed to 63 bits; the top bit marks frequent ones. Sets
are ordered rare first. A text of n shingles may lack at most T(n) of them in a partner,
so of any T(n)+1 tokens at its beginning one is shared. Rare tokens are indexed alone. Where
the prefix reaches frequent tokens, these fall into groups by hash; the prefix grows until
(rare) + sum over groups of (tokens - 1) exceeds T(n), and pairs of tokens within a group are
indexed: T(n) misses cannot break every one of them, so partners share an entry.

Texts that share an entry meet at its smallest key, the leader, once per leader. There pairs are
screened by profiles: how many shingles of a set fall into each range of hashes. Where two profiles differ,
so do the sets, so a pair is left out only if it cannot be similar. Who still has a possible partner
is compared exactly, by the difference of its set to that of a centre, the smallest
key of its component of possible pairs: for two sets x, y and a centre c, x ^ y equals
(x ^ c) ^ (y ^ c), and among near copies these differences are short. Large leader groups are cut into
blocks, and each pair of blocks is a task's work. Only a spanning forest of the links leaves a task.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import SPACED_WORD, mix, saved, ship, word_hashes
from landfall.llm.components import components

FREQUENT = 1_000_000  # at most so many tokens are frequent; 8 bytes each are broadcast
SLAB = 2_000_000  # shingles counted at once
GROUP_TOKENS = 4  # frequent tokens of a prefix to a group, about
BLOCK_ROWS = 512
BLOCK_TOKENS = 1 << 21
#: Sizes from which a new class begins; entries of texts of unlike size do not meet.
SIZES = sorted({max(k, int(1.5**k)) for k in range(1, 90)})
DENSE = 2_000_000  # pairs of entries from which a group is multiplied as a matrix
RANGE_SHINGLES = 8  # shingles to a range of a profile, about
COMPARED = 1 << 22  # places of profiles compared at once
TOP = np.uint64(1 << 63)


def shingle_sets(column: pa.Array, words: int):
    """Hashes of all shingles (63 bits, with repeats) in order, and how many each text has.

    A text of fewer words, but not none, has its whole sequence as one shingle.
    """
    hashes, counts = word_hashes(column, SPACED_WORD)
    starts = np.cumsum(counts) - counts
    n = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), n)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + starts[owner]
    last = (starts + counts)[owner]
    found = np.zeros(len(owner), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(words):
            there = at + k < last
            word = np.where(there, hashes[np.minimum(at + k, max(len(hashes) - 1, 0))], np.uint64(k + 1))
            found = mix(found * np.uint64(0x9E3779B97F4A7C15) + word)
    return found >> np.uint64(1), n


def distinct_sets(column: pa.Array, words: int):
    """The sorted distinct shingle hashes of each text, hashed a few hundred texts at a time."""
    for at in range(0, len(column), 256):
        found, n = shingle_sets(column.slice(at, 256), words)
        ends = np.cumsum(n)
        for a, b in zip((ends - n).tolist(), ends.tolist()):
            yield np.unique(found[a:b])


class Frequent:
    """The frequent tokens, with a quick test by their first 22 bits."""

    def __init__(self, tokens: np.ndarray):
        self.tokens = np.sort(tokens)
        self.near = np.zeros(1 << 22, bool)
        self.near[(self.tokens >> np.uint64(41)).astype(np.int64)] = True

    def mark(self, tokens: np.ndarray) -> np.ndarray:
        """The sorted tokens with the top bit set on frequent ones, sorted again."""
        near = self.near[(tokens >> np.uint64(41)).astype(np.int64)]
        if not near.any():
            return tokens
        close = tokens[near]
        at = np.minimum(np.searchsorted(self.tokens, close), len(self.tokens) - 1)
        frequent = np.zeros(len(tokens), bool)
        frequent[np.flatnonzero(near)[self.tokens[at] == close]] = True
        return np.concatenate([tokens[~frequent], tokens[frequent] | TOP])


def frequent_tokens(docs: DataFrame, words: int, limit: int) -> np.ndarray:
    """Tokens in at least total / limit texts, so at most ``limit`` of them.

    A slab of texts names the tokens that reach its share of that; what reaches twice
    the bound overall does so in slabs that name it often enough. Token -1 has the total.
    """

    def count(batches):
        held, size = [], 0

        def named():
            tokens, rows = np.unique(np.concatenate(held), return_counts=True)
            often = rows >= max(2, size / limit)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.append(tokens[often].view(np.int64), -1)), pa.array(np.append(rows[often], size))],
                names=["token", "rows"],
            )

        for batch in batches:
            for tokens in distinct_sets(batch.column(0), words):
                held.append(tokens)
                size += len(tokens)
                if size >= SLAB:
                    yield named()
                    held, size = [], 0
        if held:
            yield named()

    counted = docs.select("text").mapInArrow(count, "token long, rows long")
    counted = saved(counted.groupBy("token").agg(F.sum("rows").alias("rows")), "token-counts")
    total = counted.where("token < 0").agg(F.sum("rows")).first()[0] or 0
    often = counted.where((F.col("token") >= 0) & (F.col("rows") >= total / limit)).select("token")
    return often.toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64)


def sizes_of(n: int, percent: int) -> list[int]:
    """The size classes that partners of a set of n may be in; two partners have one in common."""
    return list(range(bisect_right(SIZES, -(-percent * n // 100)), bisect_right(SIZES, 100 * n // percent) + 1))


def entries(tokens: np.ndarray, percent: int):
    """The prefix of a marked set, and the index entries of its pairs of frequent tokens.

    The rare tokens of the prefix become entries by size class later on; pairs are so here.
    """
    n = len(tokens)
    if n < 2:  # has no partner but its own copies
        return tokens, tokens[:0]
    need = n - -(-percent * n // 100) + 1
    rare = int(np.searchsorted(tokens, TOP))
    if rare >= need:
        return tokens[:need], tokens[:0]
    frequent, to = tokens[rare:], 0
    found = [tokens[:0]]
    for level in sizes_of(n, percent):
        groups = max(1, (100 - percent) * SIZES[level - 1] // (100 * GROUP_TOKENS))
        group = (mix(frequent) % np.uint64(groups)).astype(np.int64)
        again = np.ones(len(frequent), np.int64)
        again[np.unique(group, return_index=True)[1]] = 0
        enough = int(np.searchsorted(np.cumsum(again), need - rare)) + 1
        to = max(to, enough)
        used, group = frequent[:enough], group[:enough]
        order = np.argsort(group, kind="stable")
        used, group = used[order], group[order]
        size = np.diff(np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group)))
        for shift in range(1, int(size.max())):
            same = group[shift:] == group[:-shift]
            a, b = used[:-shift][same], used[shift:][same]
            with np.errstate(over="ignore"):
                found.append(mix(mix(a + np.uint64(level)) * np.uint64(3) + b) | TOP)
    return tokens[: rare + to], np.concatenate(found)


def overlaps(owner: np.ndarray, token: np.ndarray, rows: int):
    """(a, b, shared) of all pairs of rows a < b that share a token; each row's tokens are distinct."""
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else token[:0]
    size = np.diff(np.append(first, len(token))).astype(np.int64)
    keep = size > 1
    first, size = first[keep].astype(np.int64), size[keep]
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if (size * (size - 1) // 2).sum() > DENSE:
        together = np.zeros((rows, rows), np.float32)
        for at in range(0, len(first), 4096):
            n = size[at : at + 4096]
            column = np.repeat(np.arange(len(n)), n)
            places = np.arange(len(column)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[at : at + 4096], n)
            part = np.zeros((rows, len(n)), np.float32)
            part[owner[places], column] = 1
            together += part @ part.T
        a, b = np.nonzero(np.triu(together, 1))
        return a, b, together[a, b].astype(np.int64)
    found = []
    for shift in range(1, int(size.max())):
        wide = size > shift
        n = size[wide] - shift
        places = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[wide], n)
        a, b = owner[places], owner[places + shift]
        found.append(np.minimum(a, b) * rows + np.maximum(a, b))
    pair, shared = np.unique(np.concatenate(found), return_counts=True)
    return pair // rows, pair % rows, shared


def profile(tokens: np.ndarray) -> bytes:
    """How many of a set's 63-bit hashes lie in each of 2**k equal ranges, 255 standing for more.

    k grows with the set; half as many ranges are the sums of neighbours.
    """
    bits = max(4, (len(tokens) // RANGE_SHINGLES).bit_length())
    counts = np.bincount((tokens >> np.uint64(63 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def folded(profiles: list[bytes], width: int) -> np.ndarray:
    """The profiles as rows of ``width`` ranges; none has fewer."""
    out = np.empty((len(profiles), width), np.int16)
    for k, one in enumerate(profiles):
        counts = np.frombuffer(one, np.uint8)
        if len(counts) > width:
            counts = np.minimum(counts.reshape(width, -1).sum(1, dtype=np.int64), 255)
        out[k] = counts
    return out


def profile_pairs(n: np.ndarray, profiles: list[bytes], percent: int):
    """Places of the pairs that may be similar by size and profile."""
    width = np.array([len(p) for p in profiles], np.int64)
    found = [(width[:0], width[:0])]
    for level in np.unique(width).tolist():
        first = np.flatnonzero(width == level)
        # a wider profile is that of a larger set
        second = np.flatnonzero((width >= level) & (percent * n <= 100 * n[first].max()))
        left, right = folded([profiles[k] for k in first], level), folded([profiles[k] for k in second], level)
        step = max(1, COMPARED // (level * len(second)))
        for at in range(0, len(first), step):
            some = first[at : at + step]
            apart = np.empty((len(some), len(second)), np.int64)
            wide = max(1, COMPARED // (level * len(some)))
            for to in range(0, len(second), wide):
                differ = np.abs(left[at : at + step, None, :] - right[None, to : to + wide, :])
                apart[:, to : to + wide] = differ.sum(2, dtype=np.int64)
            total = np.add.outer(n[some], n[second])
            small, large = np.minimum.outer(n[some], n[second]), np.maximum.outer(n[some], n[second])
            near = (100 * small >= percent * large) & ((100 + percent) * apart <= (100 - percent) * total)
            near &= (width[second] > level) | (some[:, None] < second)
            a, b = np.nonzero(near)
            found.append((some[a], second[b]))
    return tuple(np.concatenate(side) for side in zip(*found))


def batches_by_group(batches, columns):
    """Tables of whole groups: rows come sorted by the given columns."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows < 2048 and held.nbytes < 16 << 20:
            continue
        change = group_starts(held, columns)
        if change[-1] > 0:
            yield held.slice(0, change[-1]), change
            held = held.slice(change[-1])
    if held is not None and held.num_rows:
        yield held, np.append(group_starts(held, columns), held.num_rows)


def group_starts(table, columns):
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for name in columns:
        values = table.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def lists_of(column):
    """All values of a list column of long as unsigned, and the length of each list."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return values.view(np.uint64), np.diff(offsets)


def grouped_overlaps(table, starts, column):
    """The overlapping pairs of rows of each group."""
    values, n = lists_of(table.column(column))
    ends = np.concatenate([[0], np.cumsum(n)])
    light, weights = [], 0

    def run(groups):
        low, high = groups[0][0], groups[-1][1]
        owner = np.repeat(np.arange(high - low), n[low:high])
        token = values[ends[low] : ends[high]]
        if len(groups) > 1:  # many small groups at once: tokens of different groups differ
            number = np.repeat(np.arange(len(groups)), [b - a for a, b in groups])
            with np.errstate(over="ignore"):
                token = mix(token ^ mix(number[owner].astype(np.uint64)))
        a, b, shared = overlaps(owner, token, high - low)
        return a + low, b + low, shared

    for low, high in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if high - low > 256:
            if light:
                yield run(light)
                light, weights = [], 0
            yield run([(low, high)])
            continue
        light.append((low, high))
        weights += high - low
        if weights >= 1024:
            yield run(light)
            light, weights = [], 0
    if light:
        yield run(light)


def forest(a, b):
    """Links that connect what the given links connect, without circles."""
    above = {}

    def top(x):
        while x in above:
            if above[x] in above:
                above[x] = above[above[x]]
            x = above[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = top(x), top(y)
        if p != q:
            above[max(p, q)] = min(p, q)
            kept.append((x, y))
    return kept


def meet(members: DataFrame, content: DataFrame, work, schema: str) -> DataFrame:
    """Run ``work`` over the pairs of blocks of each leader's group.

    ``members`` has (leader, row), ``content`` (row, n, weight, ...). A group is cut by hash into
    as many blocks as its tokens and rows need; each member goes to every pair that its block is in.
    """
    weighed = members.join(content.select("row", "weight").hint("merge"), "row")
    by_rows, by_tokens = F.count(F.lit(1)) / BLOCK_ROWS, F.sum("weight") / BLOCK_TOKENS
    size = saved(
        weighed.groupBy("leader")
        .agg(F.ceil(F.greatest(by_rows, by_tokens)).cast("int").alias("blocks"), F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
        .drop("rows"),
        "blocks",
    )
    block = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    dealt = (
        members.join(size.hint("merge"), "leader")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "leader",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "row",
        )
        .join(content.hint("merge"), "row")
    )
    keys = ["leader", "i", "j"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(work, schema)


def similar_links(docs: DataFrame, words: int, percent: int, frequent=FREQUENT):
    """Links between class representatives and the membership, for ``docs`` (key, text)."""
    spark = docs.sparkSession
    ship(spark)
    marks = spark.sparkContext.broadcast(Frequent(frequent_tokens(docs, words, frequent)))

    def index(batches):
        for batch in batches:
            n, one, two, profiles, prefixes, found, levels = [], [], [], [], [], [], []
            for tokens in distinct_sets(batch.column(1), words):
                n.append(len(tokens))
                with np.errstate(over="ignore"):
                    one.append(int(mix(tokens).sum(dtype=np.uint64).view(np.int64)))
                    two.append(int(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
                prefix, entry = entries(marks.value.mark(tokens), percent)
                profiles.append(profile(tokens))
                prefixes.append(prefix[prefix < TOP].view(np.int64))
                found.append(entry.view(np.int64))
                levels.append(sizes_of(len(tokens), percent))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                 pa.array(profiles, pa.binary()), pa.array(levels, pa.list_(pa.int32())), pa.array(prefixes, longs),
                 pa.array(found, longs)],
                names=["row", "n", "one", "two", "profile", "levels", "rare", "entries"],
            )

    kind = docs.schema["key"].dataType.simpleString()
    rows = saved(
        docs.select("key", "text").mapInArrow(
            index,
            f"row {kind}, n long, one long, two long, profile binary, levels array<int>, rare array<long>, "
            "entries array<long>",
        ),
        "shingle-index",
    )
    # equal sets are one class: (n, 128 bits over the set)
    classes = saved(rows.groupBy("n", "one", "two").agg(F.min("row").alias("rep")), "set-classes")
    members = saved(
        rows.select("row", "n", "one", "two")
        .join(classes.hint("merge"), ["n", "one", "two"])
        .select("row", "n", F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("row")).alias("rep")),
        "set-members",
    )
    reps = saved(
        rows.where("n > 1")
        .join(classes.select(F.col("rep").alias("row")).hint("merge"), "row", "left_semi")
        .select("row", "n", F.octet_length("profile").cast("long").alias("weight"), "profile", "levels", "rare", "entries"),
        "representatives",
    )
    singles = reps.select("row", "levels", F.explode("rare").alias("token"))
    singles = singles.select("row", "token", F.explode("levels").alias("level"))
    pairs = reps.select("row", F.explode("entries").alias("entry"))
    posted = singles.select("row", F.xxhash64("token", "level").alias("entry")).unionByName(pairs)
    shared = saved(
        posted.groupBy("entry")
        .agg(F.min("row").alias("leader"), F.max("row").alias("last"))
        .where("leader <> last")
        .select("entry", "leader"),
        "entry-leaders",
    )
    met = saved(
        posted.join(shared.hint("merge"), "entry").select("leader", "row").distinct(), "meetings"
    )

    def possible(batches):
        """Links of rows that may be similar by size and profile."""
        for table, starts in batches_by_group(batches, ["leader", "i", "j"]):
            n = table.column("n").to_numpy()
            profiles = table.column("profile").to_pylist()
            for low, high in zip(starts[:-1].tolist(), starts[1:].tolist()):
                if high - low > 1:
                    a, b = profile_pairs(n[low:high], profiles[low:high], percent)
                    yield from named_links(table, forest(a + low, b + low), True)

    maybe = saved(
        meet(met, reps.select("row", "n", "weight", "profile"), possible, f"leader {kind}, a {kind}, b {kind}").distinct(),
        "possible-links",
    )
    alive = maybe.select("leader", F.explode(F.array("a", "b")).alias("row")).distinct()
    centres = saved(components(maybe.select("a", "b")), "centres")  # (key, component)

    def sets(batches):
        for batch in batches:
            found = [marks.value.mark(t).view(np.int64) for t in distinct_sets(batch.column(1), words)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int64()))],
                names=["row", "centre", "tokens"],
            )

    content = saved(
        docs.select("key", "text")
        .join(centres, "key")  # saved, so its size is known: texts are not shuffled for few keys
        .select("key", "text", "component")
        .mapInArrow(sets, f"row {kind}, centre {kind}, tokens array<long>"),
        "shingle-sets",
    )

    def differences(batches):
        for batch in batches:
            n = batch.column(2).value_lengths()
            apart = []
            for tokens, centre in zip(each_list(batch.column(2)), each_list(batch.column(3))):
                apart.append(np.setxor1d(tokens, centre, assume_unique=True).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), n.cast(pa.int64()),
                 pa.array([len(x) for x in apart], pa.int64()), pa.array(apart, pa.list_(pa.int64()))],
                names=["row", "centre", "n", "weight", "apart"],
            )

    middle = content.where("row = centre").select("centre", F.col("tokens").alias("middle"))
    apart = saved(
        content.join(middle.hint("merge"), "centre")
        .select("row", "centre", "tokens", "middle")
        .mapInArrow(differences, f"row {kind}, centre {kind}, n long, weight long, apart array<long>"),
        "differences",
    )

    def linked(batches):
        for table, starts in batches_by_group(batches, ["leader", "i", "j"]):
            n, d = table.column("n").to_numpy(), table.column("weight").to_numpy()
            centre = table.column("centre").to_numpy()
            # sizes alone link those near the centre, all with the nearest
            excess = (100 + percent) * d - (100 - percent) * n
            group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            order = np.lexsort((excess, centre, group))
            first = np.ones(len(order), bool)
            first[1:] = (np.diff(group[order]) != 0) | (centre[order][1:] != centre[order][:-1])
            nearest = order[heads_of(first)]
            close = excess[order] + excess[nearest] <= 0
            yield from named_links(table, forest(nearest[close], order[close]))
            for a, b, both in grouped_overlaps(table, starts, "apart"):
                shared = (n[a] + n[b] - d[a] - d[b]) // 2 + both
                near = (centre[a] == centre[b]) & (100 * shared >= percent * (n[a] + n[b] - shared))
                yield from named_links(table, forest(a[near], b[near]))

    links = meet(alive, apart, linked, f"a {kind}, b {kind}").where("a <> b").distinct()
    return saved(links, "set-links"), members


def heads_of(first):
    """The place of the last mark at or before each place."""
    return np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))


def each_list(column):
    values, sizes = lists_of(column)
    ends = np.cumsum(sizes)
    return [values[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist())]


def named_links(table, links, with_leader=False):
    """Links of rows as a batch of their keys."""
    if not links:
        return
    ends = np.array(links, np.int64)
    columns = {}
    if with_leader:
        columns["leader"] = table.column("leader").take(pa.array(ends[:, 0]))
    for k, name in enumerate("ab"):
        columns[name] = table.column("row").take(pa.array(ends[:, k]))
    yield from pa.table(columns).to_batches()


def near_components(docs: DataFrame, words=5, percent=80, key="doc_id", text="text", frequent=FREQUENT) -> DataFrame:
    """(key, n_shingles, component) of every row: components of links at ``percent`` Jaccard or more.

    A null or wordless text has the empty set and is linked with nothing. Rows with equal keys
    count as one text in the links. ``component`` is the smallest key reachable.
    """
    links, members = similar_links(
        docs.select(F.col(key).alias("key"), F.col(text).alias("text")), words, percent, frequent
    )
    found = components(links).withColumnRenamed("key", "rep")
    return members.join(found.hint("merge"), "rep", "left").select(
        F.col("row").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component")
    )


def without_near_copies(docs: DataFrame, words=5, percent=80, key="doc_id", text="text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, one of each component: that with the smallest key."""
    found = near_components(docs, words, percent, key, text)
    dropped = saved(found.where(F.col("component") < F.col(key)).select(F.col(key)), "dropped")
    return docs.join(dropped, docs[key] == dropped[key], "left_anti")


def op10_ngram_jaccard_join(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_components(docs, words=3, percent=90).withColumnRenamed("component", "component_id")


OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o
      FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 90 * (x.n + y.n - o)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, other) AS (SELECT a, b FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other),
m AS (SELECT doc_id, min(other) AS least_other FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.least_other, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)"""
