"""Quantisation and hard negatives against plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from landfall.llm import gridcodes, negatives
from landfall.llm.vectors import extent

SCHEMA = "vec_id long, embedding array<float>, label int, key string, id int, size int, rank string, part int"


def vectors(n=150, width=12, seed=4):
    """Clusters, ties, repeated vectors and everything that takes no part."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        label = None if i % 29 == 3 else rng.randrange(4) - 1
        v = [float(np.float32((label or 0) / 3 + rng.gauss(0, 0.4))) for _ in range(width)]
        if i % 10 == 4:
            v = rows[i // 2][1]
        rows.append((i, v, label))
    odd = [None, [float("nan")] * width, [None, *[0.5] * (width - 1)], [float("inf")] * width, [], [0.25] * (width - 3)]
    rows += [(1000 + i, v, 1) for i, v in enumerate(odd)] + [(None, [0.5] * width, 2)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, "r", 3) for r in rows], SCHEMA).repartition(5)


def usable(row):
    return row[1] is not None and all(x is not None and math.isfinite(x) for x in row[1])


def integers(v, scale, width):
    return [math.floor(float(x) * scale) for x in v] + [0] * (width - len(v))


def quantised(rows, parts, entries, rounds, scale):
    rows = [r for r in rows if usable(r)]
    width = -(-max((len(r[1]) for r in rows), default=0) // parts)
    held = [(r[0], r[2], integers(r[1], scale, parts * width)) for r in rows]
    held.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    books = [[r[2][p * width : (p + 1) * width] for r in held[:entries]] for p in range(parts)]

    def assign(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for r in held:
                v = r[2][p * width : (p + 1) * width]
                members.setdefault(assign(v, books[p])[1], []).append(v)
            for k, vs in members.items():
                books[p][k] = [sum(column) // len(vs) for column in zip(*vs)]
    out = []
    for key, label, v in held:
        best = [assign(v[p * width : (p + 1) * width], books[p]) for p in range(parts)]
        out.append((key, label, [k for _, k in best], sum(d for d, _ in best)))
    return out, books


@pytest.mark.parametrize("parts,entries,cell", [(4, 8, 16), (4, 8, 300), (3, 500, 1), (5, 16, 64)])
def test_grid_codes_equal_plain_quantisation(spark, parts, entries, cell):
    rows = vectors()
    rows.append(rows[7])  # a repeated row counts twice
    coded, books = gridcodes.grid_codes(frame(spark, rows), parts, entries, rounds=3, cell=cell)
    want, want_books = quantised(rows, parts, entries, 3, 1024)
    assert books.tolist() == want_books
    found = [tuple(r) for r in coded.collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    text = ",".join(str(x) for book in want_books for entry in book for x in entry)
    assert gridcodes.sha256_of(books) == hashlib.sha256(text.encode()).hexdigest()
    back = gridcodes.decoded([r[2] for r in found], books)
    given = {r[0]: integers(r[1], 1024, back.shape[1]) for r in rows if usable(r)}
    for row, vector in zip(found, back.tolist()):
        assert sum((a - b) ** 2 for a, b in zip(given[row[0]], vector)) == row[3]


def test_a_small_cache_changes_nothing(spark, monkeypatch):
    rng = np.random.default_rng(2)
    entries, parts = rng.integers(-400, 400, (40, 5)), rng.integers(-400, 400, (3000, 5))
    parts[:200] = entries[rng.integers(0, 40, 200)]
    apart = ((parts[:, None] - entries[None]) ** 2).sum(2)
    for cached, cell in ((0, 64), (100, 64), (1 << 15, 7), (1 << 15, 10_000)):
        monkeypatch.setattr(gridcodes, "CACHED", cached)
        book = gridcodes.GridCodebook(entries, cell)
        for _ in range(2):
            index, distance = book.nearest(parts)
            assert (index == apart.argmin(1)).all() and (distance == apart.min(1)).all()
        assert len(book.cached) <= cached


def test_vectors_out_of_range_and_none(spark):
    none, books = gridcodes.grid_codes(frame(spark, []).limit(0))
    assert none.count() == 0 and books.size == 0
    assert negatives.hard_negatives(frame(spark, []).limit(0), F.col("vec_id") >= 0).count() == 0
    huge = frame(spark, [(0, [1e30], 1), (1, [1.0], 1)])
    for work in (gridcodes.grid_codes, lambda v: negatives.hard_negatives(v, F.col("vec_id") == 0)):
        with pytest.raises(OverflowError):
            work(huge)
    only_empty, _ = gridcodes.grid_codes(frame(spark, [(0, [], 1), (1, [], None)]))
    assert sorted(r["error"] for r in only_empty.collect()) == [0, 0]
    assert extent(spark.createDataFrame([], "values array<long>")) == (0, 0)


def mined(rows, anchors, positives, wanted, low, high):
    held = {}
    for r in rows:
        if r[0] is not None and r[2] is not None and usable(r):
            one = (r[2], integers(r[1], 256, 0))
            held[r[0]] = min(one, held.get(r[0], one))
    out = []

    def score(a, b):
        return sum(x * y for x, y in zip(held[a][1], held[b][1]))

    for a in filter(anchors, held):
        order = sorted((i for i in held if i != a), key=lambda i: (-score(a, i), i))
        for p in [i for i in order if held[i][0] == held[a][0]][:positives]:
            s = score(a, p)
            fits = [i for i in order if held[i][0] != held[a][0] and low * s <= 100 * score(a, i) <= high * s]
            out += [(a, p, k, i, s, score(a, i)) for k, i in enumerate(fits[:wanted], 1)]
    return sorted(out)


@pytest.mark.parametrize("positives,wanted,low,high", [(5, 3, 50, 95), (2, 4, -30, 100), (400, 1, 0, 50)])
def test_hard_negatives_equal_plain_search(spark, monkeypatch, positives, wanted, low, high):
    monkeypatch.setattr(negatives, "ANCHORS", 4)
    monkeypatch.setattr(negatives, "CANDIDATES", 16)
    rows = vectors()
    rows += [rows[7], (8, rows[20][1], rows[20][2])]  # repeated keys
    found = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 6 == 0, positives, wanted, low, high)
    got = sorted(tuple(r) for r in found.collect())
    assert got == mined(rows, lambda i: i % 6 == 0, positives, wanted, low, high) and len(got) > 30


@pytest.mark.parametrize("width,largest,kind", [(3, 1, np.int32), (64, 300, np.int32), (20, 1 << 27, np.int64)])
def test_scores_from_tables_are_inner_products(width, largest, kind):
    rng = np.random.default_rng(1)
    a, b = (rng.integers(-largest, largest, (n, width), endpoint=True) for n in (7, 90))
    b[0], a[0] = -largest, -largest
    packed = negatives.bit_planes(b, int(largest).bit_length() + 1)
    assert (negatives.scores(negatives.subset_sums(a, kind), packed) == b @ a.T).all()


def test_one_label_and_ties(spark):
    rows = [(i, [1.0, 1.0], 0) for i in range(30)]
    assert negatives.hard_negatives(frame(spark, rows), F.col("vec_id") < 3).count() == 0
    rows += [(100 + i, [0.5, 1.0], 1) for i in range(20)]
    found = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") == 2)
    assert sorted(tuple(r)[:4] for r in found.collect()) == [
        (2, p, k, 99 + k) for p in (0, 1, 3, 4, 5) for k in (1, 2, 3)
    ]
