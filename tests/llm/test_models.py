"""The trained operators: exact model against plain Python, held-out accuracy, odd input; and the pipeline."""

import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from landfall.llm import langid, lm, registry, severity

from .conftest import lowered

SF = "/root/testdata/sf0.001"


def brute_kneser_ney(train, texts):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", lowered(t)) + ["</s>"] for i, t in texts.items()}
    count = Counter(w for i in train for w in words[i])
    pairs, starts = Counter(), Counter()
    for i in train:
        for v, w in zip(["<s>", *words[i]], words[i]):
            pairs[v, w] += 1
            starts[v] += 1
    contexts = Counter(w for _, w in pairs)

    def discounts(values):
        n = Counter(values)
        return lm.modified_discounts(n[1], n[2], n[3], n[4])

    d, u = discounts(pairs.values()), discounts(contexts.values())
    followers = defaultdict(Counter)
    for (v, _), k in pairs.items():
        followers[v][min(k, 3)] += 1
    floor = sum(u[min(k, 3)] for k in contexts.values()) / len(pairs)

    def lower(w):
        return max(contexts[w] - u[min(contexts[w], 3)], 0) / len(pairs) + floor / (len(count) + 1)

    def p(v, w):
        if not starts[v]:
            return lower(w)
        k = pairs[v, w]
        mass = sum(d[j] * followers[v][j] for j in (1, 2, 3))
        return (max(k - d[min(k, 3)], 0) + mass * lower(w)) / starts[v]

    assert sum(lower(w) for w in count) + floor / (len(count) + 1) == pytest.approx(1)
    n, v = sum(count.values()), len(count)
    return {
        i: (
            len(ws), sum(count[w] > 0 for w in ws), sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws),
            sum(math.log10(p(a, b)) for a, b in zip(["<s>", *ws], ws)),
        )
        for i, ws in words.items()
    }


@pytest.mark.parametrize("small", [False, True])
def test_language_model(spark, docs, texts, monkeypatch, small):
    """With small shards hot contexts are spread and word numbers cross ranges."""
    if small:
        monkeypatch.setattr(lm, "SHARD_TOKENS", 300)
        monkeypatch.setattr(lm, "SHARD_WORDS", 16)
    train = [i for i in texts if i % 3]
    model = lm.train(docs.where("doc_id % 3 <> 0"))
    assert not small or (model.shards > 5 and model.vocabulary.bits > 1)
    found = {r.doc_id: r for r in lm.score(docs, model).collect()}
    want = brute_kneser_ney(train, texts)
    assert found.keys() == want.keys()
    for i, (n, known, base, score) in want.items():
        assert (found[i].n_tokens, found[i].n_known) == (n, known)
        assert found[i].base_score == pytest.approx(base) and found[i].score == pytest.approx(score)


def test_language_model_of_nothing(spark, docs, no_docs):
    model = lm.train(no_docs)
    assert {(r.n_known, r.score) for r in lm.score(docs, model).collect()} == {(0, 0.0)}
    assert lm.score(no_docs, lm.train(docs)).count() == 0


def two_languages(n=160):
    rng = random.Random(4)
    parts = {"aa": ["thel", "ing", "sho", "wat"], "bb": ["schu", "ung", "ein", "kö"]}
    rows = []
    for i in range(n):
        name = rng.choice(list(parts))
        words = ["".join(rng.choice(parts[name]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 40))]
        rows.append((i, " ".join(words), name))
    return rows


def test_language_identification(spark, docs, no_docs):
    rows = two_languages()
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(frame.where("doc_id % 4 <> 2"))
    odd = [(1000, None, None), (1001, "", None), (1002, "12 - !?", None), (1003, "日本", None)]
    found = {r.doc_id: r for r in langid.identify(frame.unionByName(spark.createDataFrame(odd, frame.schema)), model).collect()}
    held = [(i, lang) for i, _, lang in rows if i % 4 == 2]
    assert sum(found[i].lang_pred == lang for i, lang in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())
    assert [found[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and found[1003].lang_pred in ("aa", "bb")
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    assert langid.identify(no_docs, model).count() == 0


def test_ordinal_gradient_and_order():
    rng = np.random.default_rng(0)
    x = rng.random((400, 6)) < 0.4
    severity_of = x @ np.array([3.0, 2.0, 1.0, 0, 0, 0])
    grades = np.searchsorted([1.5, 3.5], severity_of + rng.normal(0, 0.2, 400))
    owner, number = np.nonzero(x)
    weights, thresholds = severity.fit_ordinal(400, owner, number, 6, grades)
    assert weights[0] > weights[1] > weights[2] > abs(weights[3:]).max() and np.all(np.diff(thresholds) > 0)
    model = severity.SeverityModel(np.arange(6, dtype=np.uint64), weights, thresholds)
    expected = model.exceeds(400, owner, number).sum(1)
    assert np.corrcoef(expected, grades)[0, 1] > 0.9


def test_toxicity(spark, docs, no_docs):
    rng = random.Random(6)
    rows, flags = [], []
    for i in range(400):
        words = [rng.choice("abcdefgh") * rng.randint(3, 6) for _ in range(30)]
        bad = rng.randint(1, 6) if i % 5 == 0 else 0
        for _ in range(bad):
            words[rng.randrange(30)] = rng.choice(["zzinsult", "zzslur", "grmpf", "grmpfen"])
        rows.append((i, " ".join(words)))
        flags.append((i, int(bad > 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*flags, (None, 1), (3, None)], "doc_id long, toxic int")
    model = severity.fit_severity(frame.where("doc_id < 300"), labels)
    found = {r.doc_id: r for r in severity.score_severity(frame, model).collect()}
    held = [(i, f) for i, f in flags if i >= 300]
    assert sum((found[i].p_toxic >= 0.5) == bool(f) for i, f in held) >= 0.97 * len(held)
    kept = severity.acceptable(docs, model)
    assert kept.schema == docs.schema and kept.count() == docs.count()
    assert severity.acceptable(no_docs, model).count() == 0
    for none in (labels.where("toxic = 0"), labels.limit(0)):  # nothing to tell apart: nothing is rejected
        assert severity.acceptable(docs, severity.fit_severity(frame, none)).count() == docs.count()


def test_features_of_null_and_empty():
    model = severity.SeverityModel(np.zeros(0, np.uint64), np.zeros(0), np.zeros(1))
    assert model.occurrences(pa.array([None, "", "abc"], pa.string()))[0].size == 0


def test_pipeline_stages(spark):
    """Each stage on all its predecessor kept, against the operators' own tests' properties."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.schema.names == ["doc_id", "text", "lang", "source", "n_chars"], name
        docs = corpus_pipeline.saved(kept, f"test-{name}")
        sizes.append(docs.count())
    assert all(a > b for a, b in zip(sizes, sizes[1:]))
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in docs.collect()]
    assert len(texts) == len(set(texts))
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


def test_registered():
    names = sorted(registry.QUERIES)
    assert [n for n in names if n.startswith("op")] == sorted(n for n in names if re.match(r"op\d+_", n)) and len(names) == 11
    assert set(registry.ORACLES) < set(names)


def test_memory_of_bigram_counting():
    """Counting a shard takes few times its bytes, and slices of long texts stay small."""
    rng = np.random.default_rng(5)
    keys = (rng.zipf(1.3, 400_000) % 9_000).astype(np.uint64) << np.uint64(32) | rng.integers(0, 3_000, 400_000).astype(np.uint64)
    rows = []
    for at in range(0, len(keys), 50_000):
        names, n = np.unique(keys[at : at + 50_000], return_counts=True)
        rows.append([pa.py_buffer(names.tobytes()), pa.py_buffer(n.astype(np.uint32).tobytes())])
    given = sum(a.size + b.size for a, b in rows)
    tracemalloc.start()
    distinct, counts = lm.sum_bigrams(rows)
    names, table = lm.word_statistics(distinct, counts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not rows and peak < 6 * given
    want, n = np.unique(keys, return_counts=True)
    assert (distinct == want).all() and (counts == n).all()
    got = defaultdict(lambda: np.zeros(4, int))
    for name, row in zip(names.tolist(), table):
        got[name] += row
    for name in got:
        after = n[want >> np.uint64(32) == name]
        before = np.count_nonzero(want & np.uint64(0xFFFFFFFF) == name)
        assert got[name].tolist() == [before, (after == 1).sum(), (after == 2).sum(), (after > 2).sum()]
    texts = pa.array(["a " * 700_000, None, "", "b " * 700_000, "c " * 2_000_000, "d"])
    assert list(lm.slices(texts)) == [(0, 3), (3, 4), (4, 5), (5, 6)]
