"""Benchmark passages in documents, found by an FM-index over each shard of the corpus.

A shard is a run of whole documents of one partition. Its words are mapped to the
phrase alphabet; words that no phrase has become sentinels, runs of them one sentinel,
and each document ends in one. Every sentinel counts as a symbol of its own, so
no match crosses it and suffix sorting ends there. Over the shard stand a full suffix order, the
Burrows-Wheeler text as a wavelet matrix, and sampled suffix positions. Phrases are searched
backwards, all at once; occurrences are located by walking to a sampled row.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import ALNUM_WORD, ship, word_hashes

WINDOW = 10
SHARD_WORDS = 1 << 19
SAMPLE = 16
#: Words of phrases held by a worker at once (8 bytes each); more are searched in further passes.
PHRASE_WORDS = 8_000_000


def heads(same: np.ndarray) -> np.ndarray:
    """For each place the first place of its group; ``same``: belongs to the group before it."""
    return np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))


def ordered(*keys: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    """The keys in lexicographic order, sorted as one packed number where they fit."""
    if bits * len(keys) <= 63:
        packed = keys[0].astype(np.int64)
        for key in keys[1:]:
            packed = packed << bits | key
        packed.sort()
        mask = (1 << bits) - 1
        return tuple(packed >> bits * (len(keys) - 1 - i) & mask for i in range(len(keys)))
    order = np.lexsort(keys[::-1])
    return tuple(key[order] for key in keys)


def suffix_array(text: np.ndarray, letters: int) -> np.ndarray:
    """The order of all suffixes of ``text``: 0 is a sentinel, each smaller than a later one.

    The last symbol must be 0. Prefix doubling over packed keys; only groups that are
    still tied and have met no sentinel are sorted again.
    """
    n = len(text)
    bits, letter_bits = max(1, int(n).bit_length()), max(1, int(letters).bit_length())
    step = max(1, (63 - bits) // letter_bits)
    step = min(step, 6)
    key, alive = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(step):
        symbol = np.zeros(n, np.int64)
        symbol[: max(0, n - j)] = text[j:]
        symbol[~alive] = 0
        alive &= symbol > 0
        key = key << letter_bits | symbol
    if step * letter_bits + bits <= 63:
        both = np.sort(key << bits | np.arange(n))
        order, key = both & ((1 << bits) - 1), both >> bits
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
    same = np.zeros(n, bool)
    same[1:] = (key[1:] == key[:-1]) & (key[1:] & ((1 << letter_bits) - 1) > 0)
    head = heads(same)
    rank = np.empty(n, np.int64)
    rank[order] = head
    while same.any():
        tied = same.copy()
        tied[:-1] |= same[1:]
        places = np.flatnonzero(tied)
        members = order[places]
        group, following, members = ordered(
            head[places], rank[members + step], members, bits=bits
        )
        order[places] = members
        again = np.zeros(len(places), bool)
        again[1:] = (group[1:] == group[:-1]) & (following[1:] == following[:-1])
        same[places] = again
        head[places] = places[heads(again)]
        rank[members] = head[places]
        step *= 2
    return order


class WaveletMatrix:
    """Ranks of any symbol in any prefix of a sequence, in one step per bit."""

    def __init__(self, symbols: np.ndarray, letters: int):
        self.bits = max(1, int(letters).bit_length())
        self.ones, self.zeros = [], []
        current = symbols
        for bit in reversed(range(self.bits)):
            on = current >> bit & 1
            count = np.zeros(len(current) + 1, np.int32)
            np.cumsum(on, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(current) - int(count[-1]))
            on = on.astype(bool)
            current = np.concatenate([current[~on], current[on]])
        self.begin = self._down(np.arange(letters + 1), np.zeros(letters + 1, np.int64))

    def _down(self, symbol, place):
        for level, bit in enumerate(reversed(range(self.bits))):
            ones = self.ones[level][place]
            place = np.where(symbol >> bit & 1, self.zeros[level] + ones, place - ones)
        return place

    def rank(self, symbol, place):
        """How often each symbol occurs before each place."""
        return self._down(symbol, place) - self.begin[symbol]

    def at(self, place):
        """The symbol at each place and how often it occurs before."""
        symbol = np.zeros(len(place), np.int64)
        for level in range(self.bits):
            ones = self.ones[level][place]
            on = self.ones[level][place + 1] - ones
            symbol = symbol << 1 | on
            place = np.where(on, self.zeros[level] + ones, place - ones)
        return symbol, place - self.begin[symbol]


class FMIndex:
    """Backward search and locating over one text of letters 1..letters and sentinels 0."""

    def __init__(self, text: np.ndarray, letters: int, sample: int = SAMPLE):
        order = suffix_array(text, letters)
        before = text[order - 1].astype(np.int32)
        self.size = len(text)
        self.wavelet = WaveletMatrix(before, letters)
        self.smaller = np.zeros(letters + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=letters + 1), out=self.smaller[1:])
        kept = (order % sample == 0) | (before == 0)  # a walk never has to pass a sentinel
        self.kept = np.zeros(len(text) + 1, np.int32)
        np.cumsum(kept, out=self.kept[1:])
        self.positions = order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray):
        """The rows [low, high) of the suffixes that begin with each phrase (0-padded on the right)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        for j in reversed(range(phrases.shape[1])):
            live = np.flatnonzero((lengths > j) & (low < high))
            symbol = phrases[live, j]
            low[live] = self.smaller[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.smaller[symbol] + self.wavelet.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        found, walked = np.empty(len(rows), np.int64), 0
        open_rows, rows = np.arange(len(rows)), rows.copy()
        while len(open_rows):
            kept = self.kept[rows + 1] > self.kept[rows]
            found[open_rows[kept]] = self.positions[self.kept[rows[kept]]] + walked
            open_rows, rows = open_rows[~kept], rows[~kept]
            symbol, rank = self.wavelet.at(rows)
            rows = self.smaller[symbol] + rank
            walked += 1
        return found


def spread(low, high):
    """Which range each row belongs to, and the rows, of many ranges."""
    n = high - low
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + low[which]


class Phrases:
    """Distinct windows of the benchmark items, as numbers of their sorted words."""

    def __init__(self, rows):
        self.alphabet = np.unique(np.array([w for _, words in rows for w in words], np.uint64))
        items = defaultdict(set)
        for item, words in rows:
            items[tuple(words)].add(item)
        windows = sorted(items)
        self.items = [sorted(items[w], key=str) for w in windows]
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.words = np.zeros((len(windows), max(map(len, windows), default=1)), np.int64)
        for i, window in enumerate(windows):
            self.words[i, : len(window)] = self.numbers(np.array(window, np.uint64))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """1.. for words of the alphabet, 0 for others."""
        if not len(self.alphabet):
            return np.zeros(len(hashes), np.int64)
        at = np.searchsorted(self.alphabet, hashes)
        at[at == len(self.alphabet)] = 0
        return np.where(self.alphabet[at] == hashes, at + 1, 0)


def search_shard(phrases: Phrases, hashes: np.ndarray, counts: np.ndarray):
    """Per document of a shard: merged spans of words [first, end), and the items that occur."""
    docs = len(counts)
    starts = np.cumsum(counts + 1) - (counts + 1)  # in slots: a document's words and its end
    slots = np.zeros(int(counts.sum()) + docs, np.int64)
    word = np.ones(len(slots), bool)
    word[starts + counts] = False
    slots[word] = phrases.numbers(hashes)
    kept = slots > 0
    kept[1:] |= slots[:-1] > 0  # the first sentinel after a word stands for the run of them
    places = np.flatnonzero(kept)
    if not len(places):
        return [[] for _ in range(docs)], [set() for _ in range(docs)]
    index = FMIndex(slots[places], len(phrases.alphabet))
    window, rows = spread(*index.search(phrases.words, phrases.lengths))
    begins = places[index.locate(rows)]
    change = np.zeros(len(slots) + 1, np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, begins + phrases.lengths[window], -1)
    hit = np.concatenate([[False], np.cumsum(change) > 0, [False]])
    first, end = np.flatnonzero(hit[1:] & ~hit[:-1]), np.flatnonzero(~hit[1:] & hit[:-1])
    spans, items = [[] for _ in range(docs)], [set() for _ in range(docs)]
    owner = np.searchsorted(starts, first, "right") - 1
    for d, a, b in zip(owner.tolist(), (first - starts[owner]).tolist(), (end - starts[owner]).tolist()):
        spans[d].append((a, b))
    owner = np.searchsorted(starts, begins, "right") - 1
    for pair in np.unique(owner * len(phrases.items) + window).tolist():
        d, w = divmod(pair, len(phrases.items))
        items[d].update(phrases.items[w])
    return spans, items


def search_batch(phrases: Phrases, texts: pa.Array):
    """(words, spans, items) of each text, shard by shard; a thousand texts are held as words at once."""
    counts, spans, items = [np.zeros(0, np.int64)], [], []
    for at in range(0, len(texts), 1024):
        found = search_texts(phrases, texts.slice(at, 1024))
        counts.append(found[0])
        spans += found[1]
        items += found[2]
    return np.concatenate(counts), spans, items


def search_texts(phrases: Phrases, texts: pa.Array):
    hashes, counts = word_hashes(texts, ALNUM_WORD)
    ends = np.concatenate([[0], np.cumsum(counts)])
    spans, items, at = [], [], 0
    while at < len(counts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + SHARD_WORDS, "right")) - 1)
        found = search_shard(phrases, hashes[ends[at] : ends[to]], counts[at:to])
        spans += found[0]
        items += found[1]
        at = to
    return counts, spans, items


def phrase_blocks(benchmark: DataFrame, key, text, window, limit=PHRASE_WORDS):
    """The windows of all items as broadcasts of at most about ``limit`` words each.

    A window is ``window`` consecutive words, or all of an item of fewer.
    """
    spark = benchmark.sparkSession
    kind = benchmark.schema[key].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            hashes, counts = word_hashes(batch.column(1), ALNUM_WORD)
            hashes, rows, windows, at = hashes.view(np.int64), [], [], 0
            for i, n in enumerate(counts.tolist()):
                for k in range(max(n - window + 1, min(n, 1))):
                    rows.append(i)
                    windows.append(hashes[at + k : at + min(k + window, n)])
                at += n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())),
                 pa.array(windows, pa.list_(pa.int64()))],
                names=["item", "words"],
            )

    windows = benchmark.select(key, text).mapInArrow(cut, f"item {kind}, words array<long>").distinct()
    total = windows.agg(F.sum(F.size("words"))).first()[0] or 0
    n = -(-total // limit) or 1
    for block in range(n):
        rows = windows.where(F.pmod(F.xxhash64("words"), F.lit(n)) == block).collect()
        built = Phrases([(r.item, np.array(r.words, np.int64).view(np.uint64).tolist()) for r in rows])
        yield spark.sparkContext.broadcast(built)


def find_leaks(docs: DataFrame, benchmark: DataFrame, key="doc_id", text="text", item_key="item_id",
               item_text="text", window=WINDOW, limit=PHRASE_WORDS) -> DataFrame:
    """(key, n_words, spans, items) of every row of ``docs``.

    ``spans`` has the merged word ranges [first, end) that benchmark windows cover,
    ``items`` the keys of the items with a window in the text, sorted as strings. A null text
    has no words; an item without words never matches; items without a key mark
    spans but are not listed. Rows are searched where they are; nothing is shuffled.
    """
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    item_kind = benchmark.schema[item_key].dataType.simpleString()
    names = ["key", "text", "n_words", "spans", "items"]
    pairs = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
    found = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<struct<first: bigint, end: bigint>>)").alias("spans"),
        F.expr(f"cast(array() as array<{item_kind}>)").alias("items"),
    )
    for block in phrase_blocks(benchmark, item_key, item_text, window, limit):

        def search(batches, block=block):
            for batch in batches:
                counts, spans, items = search_batch(block.value, batch.column(1))
                earlier = batch.column(3).to_pylist(), batch.column(4).to_pylist()
                for i, (old_spans, old_items) in enumerate(zip(*earlier)):
                    if old_spans:
                        spans[i] = merged(spans[i] + [(s["first"], s["end"]) for s in old_spans])
                        items[i].update(old_items)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(counts, pa.int64()),
                        pa.array([[{"first": a, "end": b} for a, b in s] for s in spans], pairs),
                        pa.array(
                            [sorted((x for x in s if x is not None), key=str) for s in items],
                            batch.column(4).type,
                        ),
                    ],
                    names=names,
                )

        found = found.mapInArrow(
            search,
            f"key {kind}, text string, n_words long, spans array<struct<first: long, end: long>>, "
            f"items array<{item_kind}>",
        )
    return found.select(F.col("key").alias(key), "n_words", "spans", "items")


def merged(spans):
    """Sorted spans with touching or overlapping ones made one."""
    out = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, text="text", item_key="item_id",
                   item_text="text", window=WINDOW, limit=PHRASE_WORDS) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text has no benchmark window."""
    ship(docs.sparkSession)
    column = docs.columns.index(text)
    for block in phrase_blocks(benchmark, item_key, item_text, window, limit):

        def search(batches, block=block):
            for batch in batches:
                _, spans, _ = search_batch(block.value, batch.column(column))
                yield batch.filter(pa.array([not s for s in spans], pa.bool_()))

        docs = docs.mapInArrow(search, docs.schema)
    return docs


def op2_decontamination(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.first)
    return find_leaks(docs, benchmark).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


_WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
OP2_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + 9], ' ') AS k
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS k
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)),
hits AS (SELECT doc_id, i, m, item_id FROM dw JOIN bw USING (m, k)),
words AS (SELECT doc_id, count(DISTINCT p) AS n
          FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit,
       coalesce(items.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""
