"""Language identification: averaged hashed subword embeddings and a linear softmax.

Subwords are byte 3- and 4-grams of the lower-cased text with everything but letters and bytes over
0x7F as a space. A text's vector is the mean of its subwords' embeddings. Stochastic gradient
descent in numpy fits embeddings and softmax on a bounded sample; a held-back fifth of it
sets the temperature and the score under which a prediction is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import blocks, saved, ship, text_bytes

BUCKETS = 1 << 16
DIMENSIONS = 16
GRAMS = (3, 4)
ROWS_PER_LANGUAGE = 600  # labelled rows of each language that are learned from, about
LANGUAGES = 2_000  # the most languages that are learned
REJECTED = 0.01  # share of right predictions that the rejection may cost
UNKNOWN = "und"

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def subwords(data: np.ndarray, bounds: np.ndarray):
    """(bucket of each gram at each byte, which of them lie within a text), for each gram size."""
    folded = _FOLD[data].astype(np.uint32)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    for n in GRAMS:
        code = np.zeros(len(folded), np.uint32)
        for k in range(n):
            shifted = np.zeros_like(folded)
            shifted[: max(0, len(folded) - k)] = folded[k:]
            code = code << np.uint32(8) | shifted
        blank = folded == 0x20
        inside = np.arange(len(folded)) + n <= ends
        inside[:-1] &= ~(blank[:-1] & blank[1:])  # runs of blanks say nothing
        code *= np.uint32(0x9E3779B1)
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x85EBCA77)
        yield (code >> np.uint32(16)).astype(np.int32) ^ np.int32(n), inside


def counted(column: pa.Array):
    """Per text: its buckets and how often each occurs."""
    data, bounds = text_bytes(column)
    for i in range(len(bounds) - 1):
        part = data[bounds[i] : bounds[i + 1]]
        found = [b[inside] for b, inside in subwords(part, np.array([0, len(part)]))]
        yield np.unique(np.concatenate(found), return_counts=True)


@dataclass
class LanguageModel:
    languages: list
    scores: np.ndarray  # (BUCKETS, languages): embeddings times the softmax's weights
    bias: np.ndarray
    temperature: float
    accepted: float

    def logits(self, column: pa.Array) -> np.ndarray:
        data, bounds = text_bytes(column)
        found = np.zeros((len(bounds) - 1, len(self.languages)))
        for at, to in blocks(bounds):
            part, inner = data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
            full = np.flatnonzero(np.diff(inner) > 0)
            if not len(full):
                continue
            total, n = np.zeros((len(full), len(self.languages))), np.zeros(len(full))
            for bucket, inside in subwords(part, inner):
                values = self.scores[bucket]
                values[~inside] = 0
                total += np.add.reduceat(values, inner[full], axis=0, dtype=np.float64)
                n += np.add.reduceat(inside, inner[full], dtype=np.int64)
            found[at + full] = total / np.maximum(n, 1)[:, None]
        return (found + self.bias) / self.temperature

    def predict(self, column: pa.Array):
        p = softmax(self.logits(column))
        best = p.argmax(1)
        return best, p[np.arange(len(p)), best]


def softmax(x):
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train_embeddings(texts, labels, classes, epochs=12, rate=0.5, seed=7):
    """Embeddings, weights and bias by stochastic gradient descent; ``texts``: (buckets, counts)."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    weights, bias = rng.normal(0, 0.1, (DIMENSIONS, classes)), np.zeros(classes)
    steps, done = epochs * len(texts), 0
    for _ in range(epochs):
        for i in rng.permutation(len(texts)):
            buckets, counts = texts[i]
            if not len(buckets):
                continue
            now = rate * (1 - done / steps)
            share = counts / counts.sum()
            hidden = share @ table[buckets]
            error = softmax((hidden @ weights + bias)[None])[0]
            error[labels[i]] -= 1
            back = weights @ error
            weights -= now * np.outer(hidden, error)
            bias -= now * 0.1 * error
            # the step of a subword grows with its share; scaled so that long texts learn too
            table[buckets] -= now * np.outer(np.minimum(share * len(buckets), 4.0), back) / 4
            done += 1
    return table, weights, bias


def fit(docs: DataFrame, key="doc_id", text="text", lang="lang", rows=ROWS_PER_LANGUAGE) -> LanguageModel | None:
    """Fit on about ``rows`` rows of each language, chosen by hash of the key; None without labels.

    The sample is bounded by ``rows`` times the number of languages and is all that reaches the driver.
    """
    spark = docs.sparkSession
    ship(spark)
    labelled = docs.where(f"`{text}` IS NOT NULL AND `{lang}` IS NOT NULL").select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")
    )
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    sizes = sizes.collect()
    if not sizes:
        return None
    languages = sorted(r.lang for r in sizes)
    share = spark.createDataFrame([(r.lang, rows / r.n) for r in sizes], "lang string, share double")
    # at most LANGUAGES rows
    place = F.pmod(F.xxhash64("key", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = labelled.join(F.broadcast(share), "lang").where(place < F.col("share"))

    def count(batches):
        for batch in batches:
            found = list(counted(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([b.astype(np.int32) for b, _ in found], pa.list_(pa.int32())),
                    pa.array([n.astype(np.int32) for _, n in found], pa.list_(pa.int32())),
                ],
                names=["lang", "buckets", "counts"],
            )

    given = sample.select("lang", "text").mapInArrow(count, "lang string, buckets array<int>, counts array<int>")
    given = saved(given, "language-sample").orderBy("lang", F.xxhash64("buckets", "counts")).toArrow()
    number = {name: i for i, name in enumerate(languages)}
    labels = np.array([number[name] for name in given.column("lang").to_pylist()], np.int64)
    texts = [
        (b.values.to_numpy(), n.values.to_numpy().astype(np.float64))
        for b, n in zip(given.column("buckets"), given.column("counts"))
    ]
    held = np.arange(len(texts)) % 5 == 4
    table, weights, bias = train_embeddings(
        [t for t, h in zip(texts, held) if not h], labels[~held], len(languages)
    )
    scores = (table @ weights).astype(np.float32)
    model = LanguageModel(languages, scores, bias, 1.0, 0.0)
    if held.any():
        logits = np.array([n @ scores[b] / max(n.sum(), 1) for (b, n), h in zip(texts, held) if h]) + bias
        right = labels[held]
        at = np.arange(len(right))

        def loss(t):
            return -np.log(np.maximum(softmax(logits / t)[at, right], 1e-12)).mean()

        model.temperature = float(min(np.geomspace(0.05, 5, 60), key=loss))
        p = softmax(logits / model.temperature)
        good = p.argmax(1) == right
        if good.any():
            model.accepted = float(np.quantile(p.max(1)[good], REJECTED))
    return model


def identify(docs: DataFrame, model: LanguageModel | None, key="doc_id", text="text") -> DataFrame:
    """(key, lang_pred, score, accepted) of every row; ``und`` with score 0 for a text without letters.

    ``accepted`` is false where the score is under the calibrated bound; a user may treat those
    as unknown. Only the text is looked at.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[key].dataType.simpleString()
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), letters.alias("letters"))
    held = spark.sparkContext.broadcast(model)  # BUCKETS times the number of languages

    def run(batches):
        model = held.value
        for batch in batches:
            has = batch.column(2).to_numpy(zero_copy_only=False)
            if model is None:
                names, score = [UNKNOWN] * len(batch), np.zeros(len(batch))
                sure = np.zeros(len(batch), bool)
            else:
                best, score = model.predict(batch.column(1))
                names = [model.languages[k] if h else UNKNOWN for k, h in zip(best.tolist(), has.tolist())]
                score = np.where(has, score, 0.0)
                sure = has & (score >= model.accepted)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(sure)],
                names=["key", "lang_pred", "score", "accepted"],
            )

    found = given.mapInArrow(run, f"key {kind}, lang_pred string, score double, accepted boolean")
    return found.withColumnRenamed("key", key)


def op8_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = fit(docs.where(~held_out))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted"
    )
