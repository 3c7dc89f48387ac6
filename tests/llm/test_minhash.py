"""MinHash near copies against plain Python."""

import random
import re

import numpy as np
import pytest

from landfall.llm import minhash
from landfall.llm.jaccard import distinct_sets

from .conftest import DOCUMENTS, lowered


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    return {tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, min(len(words), 1)))}


def plain_components(texts, words, percent):
    sets = {i: shingles(t, words) for i, t in texts.items()}
    place = {i: i for i in texts}

    def top(i):
        while place[i] != i:
            i = place[i]
        return i

    keys = sorted(i for i in texts if sets[i])
    for a in keys:
        for b in keys:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                p, q = top(a), top(b)
                place[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), top(i)) for i in texts}


def frame(spark, texts):
    rows = [(i, t, None, "s", None, None, 1, "r", "c", None) for i, t in texts.items()]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(4)


def changed(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**9)}"
    return " ".join(words)


def families(rng):
    """Originals with variants further apart from one another than from it, chains, a passage many share."""
    texts = []
    for size in (30, 8, 3):
        original = [f"o{size}-{i}" for i in range(150)]
        texts += [changed(rng, original, 2) for _ in range(size)] + [" ".join(original)]
    step = [f"c{i}" for i in range(120)]
    for _ in range(12):
        texts.append(" ".join(step))
        step = changed(rng, step, 2).split(" ")
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{' '.join(f'q{rng.randrange(10**9)}' for _ in range(25))} {passage}" for _ in range(40)]
    texts += ["a b c d e f g h i j k", "a b c d e f g h i j", "A B C D E F G H I J", "a b", "a b c", "a  b", ""]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("percent,words", [(85, 5), (80, 5), (95, 2)])
def test_components_equal_all_pairs(spark, texts, percent, words):
    given = dict(texts) | {1000 + i: t for i, t in enumerate(families(random.Random(8)))}
    found = minhash.minhash_components(frame(spark, given), words, percent).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == plain_components(given, words, percent)
    assert len(found) == len(given)


def test_small_blocks_and_kept_rows(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 3)
    given = dict(enumerate(families(random.Random(9))))
    docs = frame(spark, given)
    want = plain_components(given, 5, 85)
    kept = minhash.without_minhash_copies(docs)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if c == i)


def test_null_keys_repeats_and_nothing(spark, no_docs):
    assert minhash.minhash_components(no_docs).count() == 0
    assert minhash.without_minhash_copies(no_docs).count() == 0
    text = "one two three four five six seven eight nine"
    rows = [(None, text), (None, None), (4, text), (4, text), (2, text), (9, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((tuple(r) for r in minhash.minhash_components(docs).collect()), key=repr)
    assert found == sorted([(None, 5, None), (None, 0, None), (4, 5, 2), (4, 5, 2), (2, 5, 2), (9, 0, 9), (9, 0, 9)], key=repr)
    assert minhash.without_minhash_copies(docs).count() == 5


def test_a_large_family_is_not_paired(spark):
    """Variants around one original: rows that tasks get grow with the family, not with its square."""
    rng = random.Random(2)
    made = []
    across = minhash.across

    def counted(askers, members, *rest):
        made.append((askers.count(), members.count()))
        return across(askers, members, *rest)

    original = [f"w{i}" for i in range(100)]
    texts = {i: changed(rng, original, 1) for i in range(1, 2001)} | {5000: " ".join(original)}
    minhash.across, was = counted, across
    try:
        found = minhash.minhash_components(frame(spark, texts)).collect()
    finally:
        minhash.across = was
    assert {r[2] for r in found} == {1}
    last_askers, last_members = made[-1]
    assert last_askers * last_members < 100 * len(texts)


def test_star_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(220)]
    links += [(1000, i) for i in range(1001, 1100)] + [(5, 5)]
    above = {x: x for pair in links for x in pair}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in links:
        p, q = top(a), top(b)
        above[max(p, q)] = min(p, q)
    found = minhash.star_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r[0]: r[1] for r in found} == {x: top(x) for x in above if x != 5 or top(5) != 5}
    assert len(found) == len({r[0] for r in found})
    assert minhash.star_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_the_chance_of_missing_a_link():
    for percent in (80, 85, 95):
        floor = minhash.least_agreement(percent)
        rng = np.random.default_rng(0)
        agree = rng.binomial(minhash.HASHES, percent / 100, 1_000_000)
        assert 0.5 * minhash.HASHES < floor < agree.min()
    assert (1 - 0.85**minhash.ROWS) ** minhash.BANDS < 1e-8


def test_minima_estimate_similarity(texts):
    import pyarrow as pa

    rng = random.Random(1)
    base = [f"w{i}" for i in range(400)]
    pair = [" ".join(base), changed(rng, base, 6)]
    sets = list(distinct_sets(pa.array(pair), 5))
    both = len(np.intersect1d(*sets))
    similarity = both / (len(sets[0]) + len(sets[1]) - both)
    least = minhash.minima(np.concatenate(sets), np.array([0, len(sets[0])]))
    assert abs((least[0] == least[1]).mean() - similarity) < 0.12
