"""Exact and near copies against plain Python."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landfall.llm import common, exact, jaccard
from landfall.llm import components as module
from landfall.llm.components import components

from .conftest import lowered


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("kind,pattern", [
    (common.SPACED_WORD, r"[^\x20\x09-\x0D]+"),
    (common.ALNUM_WORD, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
])
def test_word_hashes_tell_words_apart(texts, kind, pattern):
    column = pa.array(list(texts.values())).slice(1)
    hashes, counts = common.word_hashes(column, kind)
    words = [re.findall(pattern, lowered(t)) for t in list(texts.values())[1:]]
    assert counts.tolist() == [len(w) for w in words]
    names = {}
    for word, value in zip([w for ws in words for w in ws], hashes.tolist()):
        assert names.setdefault(word, value) == value
    assert len(set(names.values())) == len(names)


def test_exact_classes(docs, texts):
    groups = {}
    for i, t in texts.items():
        groups.setdefault(squeezed(t), []).append(i)
    found = {r["key"]: (r["keep"], r["size"]) for r in exact.duplicate_classes(docs).collect()}
    assert found == {i: (min(g), len(g)) for g in groups.values() if len(g) > 1 for i in g}
    kept = exact.exact_dedup(docs)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(g) for g in groups.values())


def test_texts_that_differ_late_and_a_hot_group(spark):
    long = "abc " * 30_000
    rows = [(i, long + ("x" if i == 7 else "y" if i == 8 else "z")) for i in range(200)]
    found = {r["key"]: r["keep"] for r in exact.duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: 0 for i in range(200) if i not in (7, 8)}


def test_no_rows_and_null_keys(spark, no_docs):
    assert exact.exact_dedup(no_docs).count() == 0
    rows = spark.createDataFrame([(None, "a"), (1, "a"), (1, "a")], "doc_id long, text string")
    assert exact.exact_dedup(rows).count() == 3  # repeated keys and null keys are not told apart


def test_every_given_row_has_its_class(spark, tmp_path):
    """Repeated rows, keys with several texts, null keys, texts that differ after equal beginnings."""
    tail = "t" * 200
    rows = [(1, "a"), (1, "a"), (2, "a"), (5, "a" * 64 + tail), (6, "a" * 64 + tail), (5, "b" * 64 + tail), (7, "b" * 64 + tail),
            (None, "n" * 300), (None, "n" * 300), (None, "m"), (None, None), (8, ""), (1, "c"), (1, "d" * 100), (0, "d" * 100)]
    groups = {}
    for key, text in rows:
        groups.setdefault(squeezed(text), []).append(key)
    want = []
    for key, text in rows:
        same = groups[squeezed(text)]
        keep = min((k for k in same if k is not None), default=None)
        sha = hashlib.sha256(squeezed(text).encode()).hexdigest()
        want.append((key, keep, len(same), None if None in (key, keep) else key == keep, sha))
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, key int, dropped_key string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = exact.op4_exact_dedup(spark, str(tmp_path))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(want, key=repr)
    kept = exact.exact_dedup(docs)
    assert kept.schema == docs.schema
    left = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert left == sorted((r for r, w in zip(rows, want) if w[0] is None or w[3]), key=repr)


def test_near_copies_of_a_key_named_column(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text, 1, 2), (2, text + " x", 1, 2), (3, None, 1, 2)],
                                 "doc_id long, text string, dropped_key int, component int")
    kept = jaccard.without_near_copies(docs)
    assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(50)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(220)]
    links += [(1000, i) for i in range(1001, 1100)]
    above = {x: x for pair in links for x in pair}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in links:
        p, q = top(a), top(b)
        above[max(p, q)] = min(p, q)
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert {r["key"]: r["component"] for r in found.collect()} == {
        x: top(x) for pair in links if pair[0] != pair[1] for x in pair
    }


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    rounds, plain = [], module.saved

    def counted(frame, name):
        rounds.append(name)
        return plain(frame, name)

    monkeypatch.setattr(module, "saved", counted)
    chain = spark.range(300).selectExpr("struct(id AS k) AS a", "struct(id + 1 AS k) AS b")
    found = components(chain).select("key.k", F.col("component.k").alias("to")).collect()
    assert sorted((r.k, r.to) for r in found) == [(i, 0) for i in range(301)]
    assert rounds.count("moves") < 25


def brute_components(texts, words, percent):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered(t))
        sets[i] = {tuple(w[k : k + words]) for k in range(max(len(w) - words + 1, min(len(w), 1)))}
    label = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                both = len(sets[a] & sets[b])
                if both and label[b] < label[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                    label[a], changed = label[b], True
                elif both and label[a] < label[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                    label[b], changed = label[a], True
    return {i: (len(sets[i]), label[i]) for i in texts}


def family(rng, words, n, edits):
    base = [rng.choice(words) for _ in range(n)]
    for _ in range(rng.randint(2, 25)):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(n)] = rng.choice(words)
        yield " ".join(copy)


@pytest.mark.parametrize("words,percent,frequent", [(3, 90, 1_000_000), (5, 80, 1_000_000), (2, 85, 40), (3, 90, 10)])
def test_near_copies(spark, texts, words, percent, frequent):
    """Also with nearly all tokens frequent, so that token pairs are what is indexed."""
    rng = random.Random(words)
    vocabulary = [f"v{i}" for i in range(300)]
    many = [t for n in (4, 9, 30, 80, 200, 333) for t in family(rng, vocabulary, n, max(1, n // 40))]
    given = dict(enumerate([*texts.values(), *many]))
    frame = spark.createDataFrame(list(given.items()), "doc_id long, text string")
    found = jaccard.near_components(frame, words, percent, frequent=frequent)
    assert {r.doc_id: (r.n_shingles, r.component) for r in found.collect()} == brute_components(given, words, percent)


def test_blocks_and_matrix_find_the_same(spark, monkeypatch):
    rng = random.Random(1)
    given = dict(enumerate(t for _ in range(4) for t in family(rng, [f"v{i}" for i in range(90)], 60, 3)))
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 5)
    frame = spark.createDataFrame(list(given.items()), "doc_id long, text string")
    found = {r.doc_id: r.component for r in jaccard.near_components(frame, 3, 80).collect()}
    assert found == {i: c for i, (_, c) in brute_components(given, 3, 80).items()}
    owner = np.repeat(np.arange(30), 20)
    token = np.array([rng.randrange(100) for _ in owner])
    pairs = np.unique(np.stack([owner, token], 1), axis=0)
    sparse = list(zip(*jaccard.overlaps(pairs[:, 0], pairs[:, 1], 30)))
    monkeypatch.setattr(jaccard, "DENSE", 1)
    dense = list(zip(*jaccard.overlaps(pairs[:, 0], pairs[:, 1], 30)))
    assert sorted(map(tuple, sparse)) == sorted(map(tuple, dense))


def test_near_copies_keep_columns_and_take_nothing(docs, no_docs):
    kept = jaccard.without_near_copies(docs)
    assert kept.schema == docs.schema
    assert kept.where(F.col("doc_id").isin(9, 10)).count() == 1
    assert jaccard.without_near_copies(no_docs).count() == 0


def test_digest_column(spark):
    rows = spark.createDataFrame([(1, "a \t b")], "doc_id long, text string")
    shown = rows.select(F.sha2(exact.normalised(F.col("text")), 256)).first()[0]
    assert shown == hashlib.sha256(b"a b").hexdigest()
