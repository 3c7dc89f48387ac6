"""Toxicity grades by cumulative-link ordinal regression on sparse word features.

Features are a text's distinct words and word beginnings (4 and 5 bytes), hashed to 64
bits. Feature counts over a bounded labelled sample pick at most ``FEATURES`` of them;
one weight per feature is shared by all thresholds: P(grade > k) = sigmoid(w.x - t_k), t_1 < t_2
< ... The expected severity is the sum of these over k.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import ALNUM_WORD, blocks, saved, ship, span_hashes, text_bytes, word_spans

SAMPLE_ROWS = 12_000  # labelled rows of each flag that the model is fitted on
FEATURES = 4_096
LEAST_ROWS = 5  # rows of the sample that a feature must occur in
LEAST_CHI2 = 12.0
BEGINNINGS = (4, 5)
MARKS = (3, 6)  # distinct marker features from which a flagged text is grade 2, 3


def text_features(column: pa.Array):
    """Distinct (text, feature) pairs of a column, block by block."""
    data, bounds = text_bytes(column)
    for at, to in blocks(bounds):
        part, inner = data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        starts, ends = word_spans(part, inner, ALNUM_WORD)
        owner = np.searchsorted(inner, starts, "right") - 1 + at
        found = [span_hashes(part, starts, ends)]
        for k, n in enumerate(BEGINNINGS, 1):
            long = ends - starts > n
            hashes = span_hashes(part, starts[long], starts[long] + n)
            found.append((owner[long], hashes ^ np.uint64(k << 60)))
        yield (
            np.concatenate([owner, *(o for o, _ in found[1:])]),
            np.concatenate([found[0], *(h for _, h in found[1:])]),
        )


def distinct_pairs(owner, feature):
    order = np.lexsort((owner, feature))
    owner, feature = owner[order], feature[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (feature[1:] != feature[:-1])
    return owner[new], feature[new]


@dataclass
class SeverityModel:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one per grade above 0

    def __post_init__(self):
        self.near = np.zeros(1 << 22, bool)  # a quick test by the first 22 bits
        self.near[(self.features >> np.uint64(42)).astype(np.int64)] = True

    def occurrences(self, column: pa.Array):
        """Distinct (text, number of a model feature) pairs."""
        owners, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for owner, feature in text_features(column):
            close = self.near[(feature >> np.uint64(42)).astype(np.int64)]
            owner, feature = owner[close], feature[close]
            if len(self.features) and len(feature):
                at = np.minimum(np.searchsorted(self.features, feature), len(self.features) - 1)
                hit = self.features[at] == feature
                owner, at = distinct_pairs(owner[hit], at[hit])
                owners.append(owner)
                numbers.append(at)
        return np.concatenate(owners), np.concatenate(numbers)

    def exceeds(self, rows: int, owner, number):
        """P(grade > k) of each text, a column per k."""
        z = np.bincount(owner, self.weights[number], rows) if len(owner) else np.zeros(rows)
        return sigmoid(z[:, None] - self.thresholds[None, :])


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(rows, owner, number, n_features, grades, steps=400, rate=0.05, penalty=1e-4):
    """Weights and thresholds of the cumulative-link model by Adam on the mean log loss."""
    top = int(grades.max()) if rows else 0
    if not top:
        return np.zeros(n_features), np.full(1, 40.0)
    above = grades[:, None] > np.arange(top)[None, :]
    share = np.clip(above.mean(0), 1e-3, 1 - 1e-3)
    first = np.log(1 / share - 1)
    # thresholds ascend: the first, then the logs of the steps
    params = np.concatenate([np.zeros(n_features), first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, t = params[:n_features], thresholds_of(params[n_features:])
        z = np.bincount(owner, w[number], rows)
        upper = np.concatenate([np.ones((rows, 1)), sigmoid(z[:, None] - t)], 1)
        lower = np.concatenate([upper[:, 1:], np.zeros((rows, 1))], 1)
        at = np.arange(rows)
        p = np.maximum(upper[at, grades] - lower[at, grades], 1e-12)
        up, low = upper[at, grades], lower[at, grades]
        d_up, d_low = up * (1 - up) / p, low * (1 - low) / p
        slope = -(d_up - d_low)  # of the loss in z
        gradient = np.empty_like(params)
        gradient[:n_features] = np.bincount(number, slope[owner], n_features) / rows + penalty * w
        by_threshold = np.zeros(top)
        np.add.at(by_threshold, grades[grades > 0] - 1, d_up[grades > 0])
        np.add.at(by_threshold, grades[grades < top], -d_low[grades < top])
        later = np.cumsum(by_threshold[::-1])[::-1] / rows
        gradient[n_features] = later[0]
        gradient[n_features + 1 :] = later[1:] * np.exp(params[n_features + 1 :])
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        params -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return params[:n_features], thresholds_of(params[n_features:])


def thresholds_of(raw):
    return raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])


def fit_severity(docs: DataFrame, labels: DataFrame, key="doc_id", text="text", flag="toxic",
                 sample_rows=SAMPLE_ROWS, features=FEATURES) -> SeverityModel:
    """Fit on at most ``sample_rows`` labelled rows of each flag (0, and 1 or more), by hash of the key.

    Flags above 1 are taken as grades. Where flags are only 0 and 1, a flagged text's grade is
    1, 2 or 3 by how many distinct features that speak for the flag it has (``MARKS``).
    Rows without key, text or flag are not learned from.
    """
    spark = docs.sparkSession
    ship(spark)
    named = labels.where(f"`{flag}` IS NOT NULL AND `{key}` IS NOT NULL").select(
        F.col(key).alias("key"), F.col(flag).cast("int").alias("flag")
    )
    picked = None
    for side in (F.col("flag") <= 0, F.col("flag") > 0):
        part = named.where(side).orderBy(F.xxhash64("key"), "key").limit(sample_rows)
        picked = part if picked is None else picked.unionByName(part)
    # at most 2 * sample_rows rows of two numbers
    sample = saved(
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .where("text IS NOT NULL")
        .join(F.broadcast(picked.groupBy("key").agg(F.max("flag").alias("flag"))), "key")
        .select("flag", "text"),
        "severity-sample",
    )

    def count(batches):
        for batch in batches:
            flags = batch.column(0).to_numpy(zero_copy_only=False) > 0
            for owner, feature in text_features(batch.column(1)):
                owner, feature = distinct_pairs(owner, feature)
                names, at = np.unique(feature, return_inverse=True)
                with_flag = np.bincount(at, flags[owner], len(names)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.view(np.int64)), pa.array(with_flag),
                     pa.array(np.bincount(at, minlength=len(names)))],
                    names=["feature", "flagged", "rows"],
                )

    totals = sample.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("flag") > 0).cast("long")).alias("p")).first()
    n, p = totals.n, totals.p or 0
    if not p or p == n:
        return SeverityModel(np.zeros(0, np.uint64), np.zeros(0), np.full(1, 40.0 if not p else -40.0))
    a = F.col("flagged")
    chi2 = F.pow(a * (n - p) - (F.col("rows") - a) * p, F.lit(2)) / (F.col("rows") * (n - F.col("rows")) + 1)
    chi2 = chi2 * n / (p * (n - p))
    chosen = (
        sample.mapInArrow(count, "feature long, flagged long, rows long")
        .groupBy("feature")
        .agg(F.sum("flagged").alias("flagged"), F.sum("rows").alias("rows"))
        .where(F.col("rows") >= LEAST_ROWS)
        .withColumn("chi2", chi2)
        .where(F.col("chi2") >= LEAST_CHI2)
        .orderBy(F.desc("chi2"), "feature")
        .limit(features)
        .collect()
    )
    names = np.array([r.feature for r in chosen], np.int64).view(np.uint64)
    speaks = np.array([r.flagged * n > 4 * r.rows * p for r in chosen], bool)
    order = np.argsort(names)
    empty = SeverityModel(names[order], np.zeros(len(names)), np.zeros(1))
    speaks = speaks[order]

    def present(batches):
        for batch in batches:
            owner, number = empty.occurrences(batch.column(1))
            lists = [[] for _ in range(len(batch))]
            for o, k in zip(owner.tolist(), number.tolist()):
                lists[o].append(k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lists, pa.list_(pa.int32()))], names=["flag", "numbers"]
            )

    rows = sample.mapInArrow(present, "flag int, numbers array<int>").collect()
    flags = np.array([r.flag for r in rows], np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r.numbers) for r in rows])
    number = np.array([k for r in rows for k in r.numbers], np.int64)
    grades = np.maximum(flags, 0)
    if flags.max() <= 1:
        marks = np.bincount(owner, speaks[number], len(rows)) if len(owner) else np.zeros(len(rows))
        grades = grades * (1 + sum((marks >= least).astype(np.int64) for least in MARKS))
    present_grades = np.unique(np.concatenate([[0], grades]))
    grades = np.searchsorted(present_grades, grades)  # a grade without rows has no threshold
    weights, thresholds = fit_ordinal(len(rows), owner, number, len(names), grades)
    return SeverityModel(names[order], weights, thresholds)


def score_severity(docs: DataFrame, model: SeverityModel, key="doc_id", text="text") -> DataFrame:
    """(key, severity, p_toxic): expected grade and chance of a grade above 0. Null text: no feature."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # at most FEATURES weights

    def score(batches):
        for batch in batches:
            p = held.value.exceeds(len(batch), *held.value.occurrences(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p.sum(1)), pa.array(p[:, 0])],
                names=[key, "severity", "p_toxic"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(score, f"`{key}` {kind}, severity double, p_toxic double")


def acceptable(docs: DataFrame, model: SeverityModel, text="text", limit=0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose chance of a grade above 0 is below ``limit``."""
    ship(docs.sparkSession)
    held, column = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def keep(batches):
        for batch in batches:
            p = held.value.exceeds(len(batch), *held.value.occurrences(batch.column(column)))
            yield batch.filter(pa.array(p[:, 0] < limit))

    return docs.mapInArrow(keep, docs.schema)


def op9_toxicity(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_severity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_severity(docs, model).withColumn("toxic", F.col("p_toxic") >= 0.5)
