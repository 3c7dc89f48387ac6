"""Best-fit decreasing packing of tokenised documents into fixed-size sequences.

Pieces of one length are alike, so the packing works on the counts of the at most
``size`` lengths, which Spark takes over all pieces. Going down the lengths, a segment tree
over the remaining capacities finds the tightest open bins in O(log size). Bins are
held as runs of consecutive numbers, and the plan says which run takes which ranks
of a length. Its size depends on ``size`` alone, not on the documents. Ranks come
from a prefix sum over (length, salt) counts, so equal lengths spread over all tasks.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import blocks, running, saved, ship

SIZE = 4096
END_ID = 1
CACHE = 1_200_000  # words whose ids a worker remembers
SALTS = 1024
_tokenizers = {}


class WordTokenizer:
    """Ids of texts by a tokenizer whose tokens never span white space.

    Texts are cut at ASCII white space and each distinct word is encoded once; the
    result is the tokenizer's own for the whole text. A cut at fewer places than
    the tokenizer makes is always safe.
    """

    def __init__(self, path):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known = {"": b""}

    def encode(self, text):
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(found.ids, "<u4").tobytes()

    def learn(self, words):
        """Encode words: runs of letters all at once, as each gives one end-of-word token; others singly."""
        # dotted capital I is two characters in lower case, of which the second is no letter
        letters = [w for w in words if w.isalpha() and max(w) < "ɐ" and "İ" not in w]
        if letters:
            raw = self.encode(" ".join(letters))
            cuts = (4 * (np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) + 1)).tolist()
            if len(cuts) == len(letters):
                self.known.update(zip(letters, [raw[i:j] for i, j in zip([0, *cuts], cuts)]))
            else:  # a tokenizer that ends words otherwise
                letters = []
        for word in words.difference(letters):
            self.known[word] = self.encode(word)

    def ids_of_words(self, words):
        """Ids of distinct words."""
        missing = set(words).difference(self.known)
        if len(self.known) + len(missing) > CACHE:
            self.known = {"": b""}
            missing = set(words) - {""}
        if missing:
            self.learn(missing)
        return list(map(self.known.get, words))

    def ids(self, texts):
        """Little-endian unsigned 32-bit ids of each text, as bytes."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        words, bounds = separated(texts.cast(pa.large_string()))
        coded = words.dictionary_encode()
        found = self.ids_of_words(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        # the bytes of a column of binaries are those of its rows one after the other
        taken = pa.array(found, pa.large_binary()).take(coded.indices)
        cuts = running(pc.binary_length(taken))[bounds].tolist()
        raw = taken.buffers()[2]
        return [raw.slice(i, j - i).to_pybytes() if i < j else b"" for i, j in zip(cuts, cuts[1:])]


def separated(texts):
    """Words between ASCII white space of all texts, and each text's first; signs after a letter are words apart.

    The tokenizer itself lowers letters and never joins a letter and a sign in one token. It finds its
    special tokens before that, so a word that may hold one keeps its capitals; so does one beyond ASCII,
    where capitals may join with marks.
    """
    split = pc.ascii_split_whitespace(pc.replace_substring_regex(texts, _LETTER_AND_SIGN, r"\1 \2"))
    words = split.flatten()
    plain = pc.and_not(pc.string_is_ascii(words), pc.match_substring(words, "<|"))
    return pc.if_else(plain, pc.ascii_lower(words), words), running(pc.list_value_length(split))


# no apostrophe, with which endings begin, and no sign that special tokens have
_LETTER_AND_SIGN = r"([A-Za-zÀ-ÖØ-öø-ÿ])([!-&(-/:;=-@\[-`{}~])"


def _tokenizer(path):
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def pieces(docs: DataFrame, path: str, size=SIZE, end_id=END_ID, key="doc_id", text="text",
           with_ids=True) -> DataFrame:
    """(key, piece, start, length, ids, ids_crc32): documents as ids and an end id, cut at ``size``.

    A null text counts as empty: one piece with the end id. Only documents
    longer than ``size`` are cut. ``with_ids=False`` leaves ``ids`` null where
    only their checksum is wanted. The vocabulary file must be on every worker.
    """
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        tokenizer = _tokenizer(path)
        for batch in batches:
            keys = batch.column(0)
            texts = pc.fill_null(batch.column(1), "").cast(pa.large_string())
            for at, to in blocks(running(pc.binary_length(texts))):
                rows, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, raw in enumerate(tokenizer.ids(texts.slice(at, to - at)), at):
                    raw += end
                    for k, begin in enumerate(range(0, len(raw), 4 * size)):
                        part = raw[begin : begin + 4 * size]
                        rows.append(i)
                        piece.append(k)
                        start.append(begin // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32) if with_ids else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(rows, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                        pa.array(ids, pa.list_(pa.int32())),
                    ],
                    names=[key, "piece", "start", "length", "ids_crc32", "ids"],
                )

    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long, ids array<int>"
    return docs.select(key, text).mapInArrow(cut, schema)


class CapacityTree:
    """A segment tree over the capacities 0..size that tells which have open bins."""

    def __init__(self, size):
        self.leaves = 1 << size.bit_length()
        self.open = [0] * (2 * self.leaves)

    def mark(self, capacity, is_open):
        node = capacity + self.leaves
        self.open[node] = int(is_open)
        node //= 2
        while node:
            self.open[node] = self.open[2 * node] | self.open[2 * node + 1]
            node //= 2

    def tightest(self, need):
        """The smallest capacity of at least ``need`` with an open bin, or None."""
        node = need + self.leaves
        if self.open[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def best_fit(counts: dict, size: int):
    """Runs (length, rank, pieces, bin, each, offset) of best-fit decreasing, and the bins used.

    ``counts`` has the number of pieces by length. In a run, the pieces from ``rank`` on go
    to the bins from ``bin`` on, ``each`` to a bin, the first of them at ``offset``.
    Same bins as placing piece after piece: after a piece its bin is the tightest one
    still, as long as it has room.
    """
    tree, stock, used, plan = CapacityTree(size), defaultdict(list), 0, []

    def put_back(capacity, first, n):
        if n and capacity:
            if not stock[capacity]:
                tree.mark(capacity, True)
            stock[capacity].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, each = size, size // length
                first, n = used, -(-left // each)
                used += n
            else:
                each = capacity // length
                first, n = stock[capacity].pop()
                if not stock[capacity]:
                    tree.mark(capacity, False)
            offset, full = size - capacity, min(n, left // each)
            rest = min(left - full * each, each - 1) if full < n else 0
            if full:
                plan.append((length, rank, full * each, first, each, offset))
                put_back(capacity - each * length, first, full)
            if rest:
                plan.append((length, rank + full * each, rest, first + full, each, offset))
                put_back(capacity - rest * length, first + full, 1)
            untouched = n - full - bool(rest)
            put_back(capacity, first + full + bool(rest), untouched)
            rank += full * each + rest
            left -= full * each + rest
    return plan, used


def pack(parts: DataFrame, size=SIZE, key="doc_id") -> DataFrame:
    """``parts`` (key, piece, length, ...) with ``sequence_id`` and ``offset``.

    (key, piece) must be unique and ``length`` within 1..size. Sequences are gapless
    from offset 0 and no more than best-fit decreasing over all pieces needs.
    """
    spark = parts.sparkSession
    ship(spark)
    salted = parts.withColumn("_salt", F.pmod(F.xxhash64(key, "piece"), F.lit(SALTS)).cast("int"))
    cells = saved(salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("n")), "pack-cells")
    counts = {r.length: r.n for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if counts and not 1 <= min(counts) <= max(counts) <= size:
        raise ValueError(f"lengths must lie within 1..{size}")
    plan, _ = best_fit(counts, size)
    table = np.array(plan, np.int64).reshape(-1, 6)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    runs = spark.sparkContext.broadcast(table)
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "length", "_salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")
    )
    cell = Window.partitionBy("length", "_salt").orderBy(key, "piece")
    ranked = salted.join(cells, ["length", "_salt"]).withColumn(
        "_rank", F.col("_before") + F.row_number().over(cell) - 1
    )

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        table = runs.value
        starts = table[:, 0] << 40 | table[:, 1]
        length, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        run = table[np.searchsorted(starts, length << 40 | rank, "right") - 1]
        inside = rank - run[:, 1]
        return pd.DataFrame(
            {"sequence_id": run[:, 3] + inside // run[:, 4], "offset": run[:, 5] + inside % run[:, 4] * length}
        )

    return ranked.withColumn("_place", place("length", "_rank")).select(
        *parts.columns, "_place.sequence_id", "_place.offset"
    )


def pack_documents(docs: DataFrame, path: str, size=SIZE, end_id=END_ID, key="doc_id", text="text",
                   with_ids=True) -> DataFrame:
    """Tokenise, cut and pack; ids are computed once and saved, as packing reads them twice."""
    parts = pieces(docs, path, size, end_id, key, text, with_ids)
    return pack(saved(parts, "pieces"), size, key)


def public_vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_best_fit_packing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs, public_vocabulary(), with_ids=False).drop("ids")
