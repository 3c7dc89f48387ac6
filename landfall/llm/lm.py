"""Bigram model with interpolated modified Kneser-Ney smoothing.

Spark counts; the model is a folder of sorted arrays in the shared folder that workers map
into memory. A word's number is its place among the sorted hashes of all training words;
a bigram's key is (context number << 32) + word number. Arrays come in shards: words by the
first bits of their hash, bigrams by context, those of hot contexts by context and word. So
no task holds more than a shard, and the shards grow in number with the corpus.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import SPACED_WORD, blocks, mix, running, saved, ship, word_hashes
from landfall.session import scratch_path

SLAB = 1_000_000  # tokens counted at once
SLICE = 2 << 20  # bytes of text looked up at once; a longer single text is its own slice
SHARD_TOKENS = 4_000_000  # bigram tokens to a shard
SHARD_WORDS = 1 << 21
RANGE_BITS = 18  # word statistics are summed by ranges of so many numbers
END = np.uint64(0xE4D0F7E87)  # the hash of the end of a text
_mapped = {}


def _filesystem(folder):
    if "://" in folder or folder.startswith("file:"):
        return arrow_fs.FileSystem.from_uri(folder)
    return arrow_fs.LocalFileSystem(), folder


def put_array(folder: str, name: str, values: np.ndarray) -> None:
    """Write an array under a name of its own, then rename: a repeated task does no harm."""
    system, path = _filesystem(folder)
    system.create_dir(path, recursive=True)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        np.save(out, values)
    try:
        system.move(part, f"{path}/{name}.npy")
    except OSError:
        if system.get_file_info(f"{path}/{name}.npy").type != arrow_fs.FileType.File:
            raise


def mapped(folder: str, name: str) -> np.ndarray:
    """The array, mapped into memory: in place on a mounted folder, else from an unlinked copy."""
    if (folder, name) not in _mapped:
        if len(_mapped) > 4096:
            _mapped.clear()
        system, path = _filesystem(folder)
        if isinstance(system, arrow_fs.LocalFileSystem):
            found = np.load(f"{path}/{name}.npy", mmap_mode="r")
        else:
            handle, copy = tempfile.mkstemp()
            with os.fdopen(handle, "wb") as out, system.open_input_stream(f"{path}/{name}.npy") as given:
                shutil.copyfileobj(given, out)
            found = np.load(copy, mmap_mode="r")
            os.unlink(copy)
        _mapped[folder, name] = found
    return _mapped[folder, name]


@dataclass
class Vocabulary:
    folder: str
    bits: int  # shards are the first bits of the hash
    offsets: np.ndarray  # first number of each shard, and the number of words

    @property
    def size(self):
        return int(self.offsets[-1])

    def numbers(self, hashes: np.ndarray):
        """Number (-1: unknown) and count of each hash."""
        names, back = np.unique(hashes, return_inverse=True)
        number, count = np.full(len(names), -1, np.int64), np.zeros(len(names), np.int64)
        shard = (names >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(names), np.int64)
        cuts = np.searchsorted(shard, np.arange(len(self.offsets)))
        for s in range(len(self.offsets) - 1):
            part = names[cuts[s] : cuts[s + 1]]
            if not len(part) or self.offsets[s] == self.offsets[s + 1]:
                continue
            keys = mapped(self.folder, f"words-{s}")
            at = np.minimum(np.searchsorted(keys, part), len(keys) - 1)
            hit = keys[at] == part
            number[cuts[s] : cuts[s + 1]][hit] = at[hit] + self.offsets[s]
            count[cuts[s] : cuts[s + 1]][hit] = mapped(self.folder, f"counts-{s}")[at[hit]]
        return number[back], count[back]


@dataclass
class Model:
    folder: str
    vocabulary: Vocabulary
    tokens: int
    texts: int
    shards: int
    hot: int  # contexts counted more often have their bigrams spread over all shards
    bigrams: int = 0
    discounts: tuple = (0.0,) * 4  # by bigram count 0, 1, 2, 3 or more
    word_discounts: tuple = (0.0,) * 4  # by number of contexts
    floor: float = 0.0  # weight of the uniform distribution

    def tokenised(self, column: pa.Array):
        """Numbers, counts and context numbers of all tokens; tokens per text."""
        hashes, words = word_hashes(column, SPACED_WORD)
        ends = np.cumsum(words + 1) - 1
        tokens = np.empty(len(hashes) + len(words), np.uint64)
        is_end = np.zeros(len(tokens), bool)
        is_end[ends] = True
        tokens[~is_end], tokens[is_end] = hashes, END
        number, count = self.vocabulary.numbers(tokens)
        context, context_count = np.empty_like(number), np.empty_like(count)
        context[1:], context_count[1:] = number[:-1], count[:-1]
        first = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        context[first], context_count[first] = self.vocabulary.size, self.texts
        return number, count, context, context_count, words + 1

    def shard_of(self, key, context_count):
        by_context = mix(key >> np.uint64(32)) % np.uint64(self.shards)
        by_both = mix(key) % np.uint64(self.shards)
        return np.where(context_count > self.hot, by_both, by_context).astype(np.int64)

    def bigram_counts(self, key, context_count):
        names, first, back = np.unique(key, return_index=True, return_inverse=True)
        shard = self.shard_of(names, context_count[first])
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(self.shards + 1))
        found = np.zeros(len(names), np.int64)
        for s in np.unique(shard).tolist():
            part = order[cuts[s] : cuts[s + 1]]
            keys = mapped(self.folder, f"bigrams-{s}")
            if len(keys):
                at = np.minimum(np.searchsorted(keys, names[part]), len(keys) - 1)
                hit = keys[at] == names[part]
                found[part[hit]] = mapped(self.folder, f"bigram-counts-{s}")[at[hit]]
        return found[back]

    def statistics(self, number):
        """Rows of (contexts before, followers seen once, twice, more often) of known words."""
        found = np.zeros((len(number), 4), np.int64)
        if not self.bigrams:
            return found
        block = number >> RANGE_BITS
        for b in np.unique(block[number >= 0]).tolist():
            here = block == b
            found[here] = mapped(self.folder, f"statistics-{b}")[number[here] & ((1 << RANGE_BITS) - 1)]
        return found

    def log10(self, number, context, context_count):
        """The model's log10 probability of each token."""
        discounts, word_discounts = np.array(self.discounts), np.array(self.word_discounts)
        names, back = np.unique(np.concatenate([number, context]), return_inverse=True)
        known = names.copy()
        table = self.statistics(known)
        word, before = table[back[: len(number)]], table[back[len(number) :]]
        contexts = word[:, 0]
        total = max(self.bigrams, 1)
        lower = np.maximum(contexts - word_discounts[np.minimum(contexts, 3)], 0) / total
        lower += self.floor / (self.vocabulary.size + 1)
        seen = context_count > 0
        both = seen & (number >= 0)
        key = context[both].astype(np.uint64) << np.uint64(32) | number[both].astype(np.uint64)
        count = np.zeros(len(number), np.int64)
        count[both] = self.bigram_counts(key, context_count[both])
        mass = (before[:, 1:] * discounts[1:]).sum(1) / np.maximum(context_count, 1)
        upper = np.maximum(count - discounts[np.minimum(count, 3)], 0) / np.maximum(context_count, 1)
        return np.log10(np.where(seen, upper + mass * lower, lower))


def modified_discounts(n1, n2, n3, n4):
    """D1, D2, D3+ from counts of counts; where a class is empty its discount is 0 or within its bounds."""
    y = n1 / max(n1 + 2 * n2, 1)
    raw = (1 - 2 * y * n2 / max(n1, 1), 2 - 3 * y * n3 / max(n2, 1), 3 - 4 * y * n4 / max(n3, 1))
    return (0.0, *(float(min(max(d, 0.0), k)) for k, d in enumerate(raw, 1)))


def slices(column: pa.Array):
    """Ranges of texts of at most SLICE bytes, or one text."""
    return blocks(running(pc.binary_length(column)), SLICE)


def sum_bigrams(rows: list):
    """Distinct keys and their counts from the (keys, counts) buffers of a shard; ``rows`` is emptied."""
    keys = np.concatenate([np.frombuffer(keys, np.uint64) for keys, _ in rows])
    counts = np.concatenate([np.frombuffer(counts, np.uint32) for _, counts in rows])
    rows.clear()
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    del order
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    return keys[first], np.add.reduceat(counts, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)


def word_statistics(keys: np.ndarray, counts: np.ndarray):
    """Word numbers in order and, for each, rows of (contexts before, followers once, twice, more often).

    A word comes up to twice, as a word and as a context. ``keys`` are distinct and in order.
    """
    word, contexts = np.unique(keys.astype(np.uint32), return_counts=True)  # the lower half
    context = (keys >> np.uint64(32)).astype(np.uint32)
    new = np.ones(len(keys), bool)
    new[1:] = context[1:] != context[:-1]
    first = np.flatnonzero(new)
    names = np.concatenate([word, context[first]])
    del context, new
    table = np.zeros((len(names), 4), np.uint32)
    table[: len(word), 0] = contexts
    if len(first):
        for k, kind in enumerate((counts == 1, counts == 2, counts > 2), 1):
            table[len(word) :, k] = np.add.reduceat(kind, first, dtype=np.uint32)
    order = np.argsort(names, kind="stable")
    return names[order].astype(np.int64), table[order]


def train(docs: DataFrame, text="text") -> Model:
    """Count all rows of ``docs`` and write the model's arrays to the shared folder.

    A null text is empty: its end alone. Four passes of bounded tasks: words, bigrams, and the
    word statistics by range; discounts come from a handful of sums.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = scratch_path(spark, "bigram-model")
    texts = docs.select(F.col(text).alias("text"))

    def slabs(batches, counted):
        held, size = [], 0
        for batch in batches:
            for at, to in slices(batch.column(0)):
                held.append(counted(batch.column(0).slice(at, to - at)))
                size += len(held[-1])
                if size >= SLAB:
                    slab, held, size = np.concatenate(held), [], 0
                    yield slab
                    del slab
        if held:
            yield np.concatenate(held)

    def count_words(batches):
        def tokens(column):
            hashes, words = word_hashes(column, SPACED_WORD)
            return np.concatenate([hashes, np.full(len(words), END)])

        for slab in slabs(batches, tokens):
            names, n = np.unique(slab, return_counts=True)
            del slab
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n)], names=["word", "n"])

    words = saved(
        texts.mapInArrow(count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")),
        "word-counts",
    )
    size, tokens = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    bits = max(0, int(size // SHARD_WORDS).bit_length())

    def write_words(batches):
        shard, held = None, []

        def put():
            keys = np.concatenate([w for w, _ in held])
            order = np.argsort(keys)
            put_array(folder, f"words-{shard}", keys[order])
            put_array(folder, f"counts-{shard}", np.concatenate([n for _, n in held])[order])
            return pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([len(keys)])], names=["shard", "n"])

        for batch in batches:
            number = batch.column(0).to_numpy()
            for s in np.unique(number).tolist():
                if shard is not None and s != shard:
                    yield put()
                    held = []
                shard, here = s, number == s
                held.append((batch.column(1).to_numpy()[here].view(np.uint64), batch.column(2).to_numpy()[here]))
        if held:
            yield put()

    first_bits = F.shiftrightunsigned("word", 64 - bits) if bits else F.lit(0).cast("long")
    sizes = (
        words.select(first_bits.alias("shard"), "word", "n")
        .repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(write_words, "shard long, n long")
        .collect()
    )
    offsets = np.zeros((1 << bits) + 1, np.int64)
    for row in sizes:
        offsets[row.shard + 1] = row.n
    offsets = np.cumsum(offsets)
    if len(offsets) and offsets[-1] >= 1 << 32:
        raise ValueError("more than 2**32 words need wider bigram keys")
    shards = max(1, -(-tokens // SHARD_TOKENS))
    model = Model(folder, Vocabulary(folder, bits, offsets), tokens, docs.count(), shards, max(1, tokens // (4 * shards)))

    def count_bigrams(batches):
        def keys(column):
            number, _, context, context_count, _ = model.tokenised(column)
            return np.stack(
                [context.astype(np.uint64) << np.uint64(32) | number.astype(np.uint64), context_count.astype(np.uint64)],
                1,
            )

        for slab in slabs(batches, keys):
            names, first, n = np.unique(slab[:, 0], return_index=True, return_counts=True)
            shard = model.shard_of(names, slab[first, 1].astype(np.int64))
            del slab, first
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            parts = [order[cuts[s] : cuts[s + 1]] for s in range(shards)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(shards)),
                    pa.array([names[p].tobytes() for p in parts], pa.binary()),
                    pa.array([n[p].astype(np.uint32).tobytes() for p in parts], pa.binary()),
                ],
                names=["shard", "keys", "counts"],
            )

    def write_bigrams(batches):
        for s, rows in whole_groups(batches):
            keys, counts = sum_bigrams(rows)
            put_array(folder, f"bigrams-{s}", keys)
            put_array(folder, f"bigram-counts-{s}", counts.astype(np.uint32))
            found = np.bincount(np.minimum(counts, 5), minlength=6)
            names, table = word_statistics(keys, counts)
            del keys, counts
            cuts = np.flatnonzero(np.diff(names >> RANGE_BITS, prepend=-1))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(names)]):
                place = (names[a:b] & ((1 << RANGE_BITS) - 1)).astype(np.uint32)
                part = np.concatenate([place[:, None], table[a:b]], 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(names[a] >> RANGE_BITS)]), pa.array([part.tobytes()], pa.binary()),
                     pa.array([[0] * 6 if a else found.tolist()], pa.list_(pa.int64()))],
                    names=["range", "part", "found"],
                )

    dealt = texts.mapInArrow(count_bigrams, "shard long, keys binary, counts binary")
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard")
    parts = saved(dealt.mapInArrow(write_bigrams, "range long, part binary, found array<long>"), "word-statistics")
    sums = parts.agg(*(F.coalesce(F.sum(F.col("found")[k]), F.lit(0)).alias(f"n{k}") for k in range(6))).first()

    def write_statistics(batches):
        def put():
            put_array(folder, f"statistics-{at}", table.astype(np.uint32))
            found = np.bincount(np.minimum(table[:, 0], 5), minlength=6)
            return pa.RecordBatch.from_arrays([pa.array([found.tolist()], pa.list_(pa.int64()))], names=["found"])

        at = None
        for batch in batches:
            for r, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                if r != at:
                    if at is not None:
                        yield put()
                    at, table = r, np.zeros((1 << RANGE_BITS, 4), np.int64)
                part = np.frombuffer(part.as_buffer(), np.uint32).reshape(-1, 5)
                np.add.at(table, part[:, 0], part[:, 1:])
        if at is not None:
            yield put()

    ranges = parts.select("range", "part").repartition("range").sortWithinPartitions("range")
    found = ranges.mapInArrow(write_statistics, "found array<long>").agg(
        *(F.coalesce(F.sum(F.col("found")[k]), F.lit(0)).alias(f"n{k}") for k in range(6))
    ).first()
    model.bigrams = sum(sums[k] for k in range(1, 6))
    model.discounts = modified_discounts(*(sums[k] for k in range(1, 5)))
    model.word_discounts = modified_discounts(*(found[k] for k in range(1, 5)))
    taken = (found[1], found[2], sum(found[k] for k in range(3, 6)))
    spent = sum(d * n for d, n in zip(model.word_discounts[1:], taken))
    model.floor = spent / model.bigrams if model.bigrams else 1.0
    return model


def whole_groups(batches):
    """(value, buffers of the further columns by row) for the runs of equal values in the first column."""
    value, held = None, []
    for batch in batches:
        for key, *row in zip(batch.column(0).to_pylist(), *batch.columns[1:]):
            if held and key != value:
                yield value, held
                held = []
            value = key
            held.append([part.as_buffer() for part in row])
    if held:
        yield value, held


def score(docs: DataFrame, model: Model, key="doc_id", text="text") -> DataFrame:
    """(key, n_tokens, n_known, base_score, score): log10 probabilities of whole texts.

    ``base_score`` is the add-one unigram's. Workers map only the shards they look into.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # names and a few numbers

    def run(batches):
        model = held.value
        spread = np.log10(model.tokens + model.vocabulary.size + 1.0)
        for batch in batches:
            for at, to in slices(batch.column(1)):
                part = batch.slice(at, to - at)
                number, count, context, context_count, n = model.tokenised(part.column(1))
                first = np.cumsum(n) - n
                base = np.log10(count + 1.0) - spread
                logs = model.log10(number, context, context_count)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(n),
                        pa.array(np.add.reduceat((count > 0).astype(np.int64), first)),
                        pa.array(np.add.reduceat(base, first)),
                        pa.array(np.add.reduceat(logs, first)),
                    ],
                    names=[key, "n_tokens", "n_known", "base_score", "score"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_tokens long, n_known long, base_score double, score double"
    )


def op1_lm_scoring(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    model = train(docs.where(~held_out))
    return score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
