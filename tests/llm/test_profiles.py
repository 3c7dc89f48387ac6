"""The screen of the n-gram join: no similar pair may be lost, and far ones should go."""

import random

import numpy as np
import pytest

from landfall.llm.jaccard import TOP, folded, profile, profile_pairs


def tokens_of(rng, n):
    return {rng.getrandbits(63) for _ in range(n)}


def variant(rng, tokens, changed):
    kept = rng.sample(sorted(tokens), len(tokens) - changed)
    return set(kept) | tokens_of(rng, rng.randint(0, changed))


def arrays(sets):
    return [np.array(sorted(s), np.uint64) for s in sets]


@pytest.mark.parametrize("percent", [30, 80, 90, 100])
def test_no_similar_pair_is_lost(percent):
    """Sets of 2 to 5,000 tokens, also where the number of ranges changes and with more than 255 in a range."""
    rng = random.Random(percent)
    sets = []
    for n in (2, 9, 63, 64, 127, 128, 511, 512, 5000):
        base = tokens_of(rng, n)
        sets += [base, set(base), *(variant(rng, base, k) for k in {0, 1, n // 20, n // 10, n // 3})]
    crowded = {5 + k for k in range(900)}  # all in the first range
    sets += [crowded, {5 + k for k in range(880)}, {20 + k for k in range(930)}]
    tokens = arrays(sets)
    n = np.array([len(t) for t in tokens], np.int64)
    a, b = profile_pairs(n, [profile(t) for t in tokens], percent)
    found = {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist())}
    similar = {
        (i, j)
        for i in range(len(sets))
        for j in range(i + 1, len(sets))
        if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    }
    assert similar <= found
    assert all(i != j for i, j in found)


def test_unlike_sets_are_screened_out():
    rng = random.Random(7)
    tokens = arrays([tokens_of(rng, 200 + k % 7) for k in range(300)])
    a, _ = profile_pairs(np.array([len(t) for t in tokens]), [profile(t) for t in tokens], 90)
    assert len(a) == 0


def test_comparing_in_parts_changes_nothing(monkeypatch):
    rng = random.Random(8)
    base = tokens_of(rng, 130)
    tokens = arrays([variant(rng, base, rng.randint(0, 14)) for _ in range(60)])
    given = np.array([len(t) for t in tokens]), [profile(t) for t in tokens], 80
    whole = set(zip(*(x.tolist() for x in profile_pairs(*given))))
    monkeypatch.setattr("landfall.llm.jaccard.COMPARED", 50)
    assert set(zip(*(x.tolist() for x in profile_pairs(*given)))) == whole
    assert whole


def test_folding_equals_the_narrower_profile():
    rng = random.Random(9)
    tokens = np.array(sorted(tokens_of(rng, 4000) | {3 + k for k in range(400)}), np.uint64)
    assert tokens.max() < TOP
    wide = np.frombuffer(profile(tokens), np.uint8)
    for width in (len(wide), len(wide) // 2, 16):
        counts = np.bincount((tokens >> np.uint64(63 - (width.bit_length() - 1))).astype(np.int64), minlength=width)
        assert (folded([wide.tobytes()], width)[0] == np.minimum(counts, 255)).all()
