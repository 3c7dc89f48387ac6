"""Leaks, packing, chunks, lines and quotes against plain Python."""

import bisect
import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from landfall.llm import chunks, leaks, linejoin, packing, quotes

from .conftest import lowered

ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def test_suffix_order_search_and_locate():
    rng = np.random.default_rng(1)
    for _ in range(100):
        n, letters = rng.integers(1, 70), rng.integers(1, 4)
        text = rng.integers(0, letters + 1, n)
        text[-1] = 0
        order = [(0, q) if x == 0 else (x, 0) for q, x in enumerate(text)]
        assert list(leaks.suffix_array(text, letters)) == sorted(range(n), key=lambda p: order[p:])
        index = leaks.FMIndex(text, letters, 4)
        for m in (1, 2, 3):
            phrases, lengths = rng.integers(1, letters + 1, (6, 3)), np.full(6, m)
            phrases[:, m:] = 0
            which, rows = leaks.spread(*index.search(phrases, lengths))
            places = index.locate(rows)
            for k in range(6):
                want = [i for i in range(n - m + 1) if list(text[i : i + m]) == list(phrases[k, :m])]
                assert sorted(places[which == k]) == want


def test_suffix_order_of_one_repeated_word():
    text = np.array([1] * 3000 + [0])
    assert list(leaks.suffix_array(text, 1)) == list(range(3000, -1, -1))


def brute_leaks(texts, items, window):
    windows = {}
    for item, t in items:
        w = re.findall(ALNUM, lowered(t))
        for k in range(max(len(w) - window + 1, min(len(w), 1))):
            windows.setdefault(tuple(w[k : k + window]), set()).add(item)
    found = {}
    for i, t in texts.items():
        w = re.findall(ALNUM, lowered(t))
        hit, seen = set(), set()
        for phrase, of in windows.items():
            for k in range(len(w) - len(phrase) + 1):
                if tuple(w[k : k + len(phrase)]) == phrase:
                    hit.update(range(k, k + len(phrase)))
                    seen |= of
        found[i] = (len(w), hit, sorted((x for x in seen if x is not None), key=str))
    return found


@pytest.mark.parametrize("limit", [leaks.PHRASE_WORDS, 150])
def test_leaks(spark, docs, texts, limit):
    words = re.findall(ALNUM, lowered(texts[14]))
    items = [(1, " ".join(words[5:30])), (2, "Two, words!"), (10, None), (11, "..."), (12, " ".join(words[20:40]).upper()),
             (None, " ".join(words[900:911])), (12, "one"), (13, "not there at all")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = leaks.find_leaks(docs, benchmark, limit=limit).collect()
    got = {r.doc_id: (r.n_words, {k for s in r.spans for k in range(s["first"], s["end"])}, list(r["items"])) for r in found}
    want = brute_leaks(texts, items, 10)
    assert got == want
    for r in found:  # merged: apart from each other
        assert all(a["end"] < b["first"] for a, b in zip(r.spans, r.spans[1:]))
    clean = leaks.decontaminated(docs, benchmark, limit=limit)
    assert clean.schema == docs.schema
    assert {r.doc_id for r in clean.collect()} == {i for i, (_, hit, _) in want.items() if not hit}


def test_no_leaks_without_items(spark, docs, no_docs, texts):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert leaks.decontaminated(docs, nothing).count() == len(texts)
    assert leaks.find_leaks(no_docs, nothing).count() == 0


def test_ids_are_the_tokenizers(texts):
    from tokenizers import Tokenizer

    path = packing.public_vocabulary()
    odd = [t or "" for t in texts.values()] + ["It's <|endoftext|>, x", "ΑΣ Σας ΣΑΣ. ΟΔΟΣ", "g's don't 're", "İstanbul, ÇA. ªº µ,", "f!?, e..., ,a ;"]
    whole = Tokenizer.from_file(path).encode_batch(odd, add_special_tokens=False)
    mine = packing.WordTokenizer(path).ids(odd)
    assert [np.frombuffer(x, "<u4").tolist() for x in mine] == [e.ids for e in whole]


def test_ids_of_every_kind_of_character():
    """Each character alone, within a word, in capitals and before a sign; special tokens in both cases."""
    from tokenizers import Tokenizer

    path = packing.public_vocabulary()
    points = [*range(1, 0x3000), *range(0x3000, 0x110000, 97)]
    kinds = [chr(c) for c in points if not 0xD800 <= c < 0xE000]
    texts = [form.replace("_", c) for c in kinds for form in ("_", "a_b", "A_", "_.", "x _ _y, z", "_stanbul")]
    for token in ("<|endoftext|>", "<|startoftext|>"):
        for word in (token, token.upper(), token.title(), token[:-1]):
            texts += [word, f"A {word} B", f"A{word}B.", f"É{word}", f"İ {word}"]
    whole = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    mine = packing.WordTokenizer(path)
    for at in range(0, len(texts), 500):
        for text, ids, want in zip(texts[at : at + 500], mine.ids(texts[at : at + 500]), whole[at : at + 500]):
            assert np.frombuffer(ids, "<u4").tolist() == want.ids, repr(text)


def test_each_word_is_looked_up_once():
    """Repeated words, in capitals or with signs after them, cost no further look into the memory."""
    from tokenizers import Tokenizer

    looks = []

    class Memory(dict):
        def get(self, word, *default):
            looks.append(word)
            return super().get(word, *default)

    path = packing.public_vocabulary()
    words = [f"{a}{b}" for a in "bdfgk" for b in ("al", "el", "il", "ön", "un")]
    texts = [" ".join(f"{w}{sign} {w.title()}{sign}" for w in words) for sign in ("", ".", "$$$", "###", "-", "'", ")")] * 9
    mine = packing.WordTokenizer(path)
    mine.known = Memory(mine.known)
    whole = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in mine.ids(texts)] == [e.ids for e in whole]
    assert 0 < len(looks) < 150  # of 3,150 words


def test_ids_when_the_memory_is_emptied(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "CACHE", 6)
    path = packing.public_vocabulary()
    texts = ["", "one two Three, four", " one\ttwo\x0b", "five six seven.eight <|endoftext|> ÉA b|c d's"] * 2
    whole = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    mine = packing.WordTokenizer(path)
    assert [np.frombuffer(mine.ids([t])[0], "<u4").tolist() for t in texts] == [e.ids for e in whole]
    assert mine.ids([]) == []


@pytest.mark.parametrize("size", [1, 7, 64, 4096])
def test_best_fit_is_best_fit_decreasing(size):
    rng = random.Random(size)
    lengths = [rng.randint(1, size) for _ in range(900)]
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan, used = packing.best_fit(counts, size)
    room, plain = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(room, n)
        if at == len(room):
            plain, left = plain + 1, size - n
        else:
            left = room.pop(at) - n
        bisect.insort(room, left)
    assert used == plain
    fill, placed = {}, {n: set() for n in counts}
    for n, rank, pieces, first, each, offset in plan:
        for k in range(pieces):
            placed[n].add(rank + k)
            fill.setdefault(first + k // each, []).append((offset + k % each * n, n))
    assert {n: len(p) for n, p in placed.items()} == counts
    for parts in fill.values():
        parts.sort()
        assert parts[0][0] == 0 and sum(parts[-1]) <= size
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))


def test_packing_documents(docs, no_docs, texts):
    path, size = packing.public_vocabulary(), 64
    found = packing.pack_documents(docs, path, size).collect()
    ids = packing.WordTokenizer(path).ids([t or "" for t in texts.values()])
    pieces, bins = {}, {}
    for r in found:
        pieces.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids)
    for i, raw in zip(texts, ids):
        mine = sorted(pieces[i], key=lambda r: r.piece)
        assert [x for r in mine for x in r.ids] == [*np.frombuffer(raw, "<u4").tolist(), 1]
        assert [r.start for r in mine] == [size * k for k in range(len(mine))]
    for parts in bins.values():
        parts.sort()
        assert parts[0][0] == 0 and sum(parts[-1]) <= size
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
    assert packing.pack_documents(no_docs, path, size).count() == 0


def test_chunks_join_again_and_fall_into_step():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh é日") for _ in range(6000))

    def cut(t):
        raw = np.frombuffer(t.encode(), np.uint8)
        ends = chunks.chunk_ends(chunks.cut_points(raw).tolist(), 0, len(raw), raw)
        return [raw[a:b].tobytes() for a, b in zip([0, *ends], ends)]

    whole = cut(text)
    assert b"".join(whole).decode() == text and all(part.decode() for part in whole)
    assert all(chunks.LEAST <= len(p) <= chunks.MOST + 3 for p in whole[:-1])
    assert len(set(whole) & set(cut("moved" + text))) > 0.9 * len(whole)


def test_repeated_passages(spark, docs, texts, no_docs):
    passage = " ".join(f"passage{i * 7919 % 1000}" for i in range(60))
    more = {900 + k: f"{k} " * (k + 3) + passage + f" tail {k}" for k in range(4)}
    frame = spark.createDataFrame(list(more.items()), "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    found = {r.doc_id: r for r in chunks.repeated_passages(frame).collect()}
    assert found.keys() == more.keys() | texts.keys()
    first, parts, data = {}, {}, {}
    for i, t in sorted({**more, **texts}.items()):
        raw = np.frombuffer((t or "").encode(), np.uint8)
        ends = chunks.chunk_ends(chunks.cut_points(raw).tolist(), 0, len(raw), raw) if len(raw) else []
        parts[i], data[i] = list(zip([0, *ends], ends)), raw
        for a, b in parts[i]:
            first.setdefault(raw[a:b].tobytes(), (i, a))
    for i, r in found.items():
        runs = []
        again = [(a, b) for a, b in parts[i] if first[data[i][a:b].tobytes()] != (i, a)]
        for a, b in again:
            if runs and runs[-1][1] == a:
                runs[-1] = (runs[-1][0], b)
            else:
                runs.append((a, b))
        runs = [(a, b) for a, b in runs if b - a >= chunks.RUN]
        assert (r.n_chunks, r.n_repeated) == (len(parts[i]), len(again))
        assert [(s["start"], s["end"]) for s in r.spans] == runs
        assert r.repeated_bytes == sum(b - a for a, b in runs)
    assert not found[900].spans and all(found[k].repeated_bytes > 300 for k in (901, 902, 903))
    assert len(chunks.without_spans(more[901], found[901].spans).encode()) == len(more[901].encode()) - found[901].repeated_bytes
    assert chunks.repeated_passages(no_docs).count() == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, text, n):
    for _ in range(n):
        k = rng.randrange(len(text))
        text = rng.choice([text[:k] + text[k + 1 :], text[:k] + "#" + text[k:], text[:k] + "#" + text[k + 1 :]])
    return text


def classes_of(links, names):
    place = {n: n for n in names}

    def top(x):
        while place[x] != x:
            x = place[x]
        return x

    for a, b in links:
        p, q = sorted((top(a), top(b)))
        place[q] = p
    return {n: top(n) for n in names}


@pytest.mark.parametrize("errors,few", [(1, 16), (1, 1), (1, 3), (2, 16), (3, 16)])
def test_edit_join(spark, monkeypatch, errors, few):
    monkeypatch.setattr(linejoin, "FEW", few)
    rng = random.Random(errors)
    bases = ["".join(rng.choice("ab cdé") for _ in range(n)).strip() or "x" for n in (8, 24, 25, 31, 40)]
    lines = {" ".join(edited(rng, b, rng.randint(0, errors + 1)).split()) for b in bases for _ in range(12)}
    if errors == 1:
        lines |= {"a", "b", "ab", "ba", "abc", "ac", "\U0001f600\U0001f601x", "\U0001f600\U0001f602x", "\U0001f600x"}
        lines |= {f"one common beginning of all {k:03d}" for k in range(0, 200, 7)}
    lines = sorted(lines)
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    found, links = linejoin.similar_lines(frame, errors=errors)
    names = {r.line: r["first"]["key"] for r in found.collect()}
    got = {tuple(sorted((names[r.a], names[r.b]))) for r in links.collect()}
    want = {(i, j) for i, x in enumerate(lines) for j, y in enumerate(lines) if i < j and min(len(x), len(y)) > errors and edit_distance(x, y) <= errors}
    assert got <= want
    assert classes_of(got, range(len(lines))) == classes_of(want, range(len(lines)))


def test_lines_of_one_beginning_are_not_paired(spark, monkeypatch):
    """A bounded number of candidates a line, whether or not the lines of an entry are similar."""
    made = []
    verify = linejoin.verified_windows

    def counted(pairs):
        made.append(pairs.count())
        return verify(pairs)

    monkeypatch.setattr(linejoin, "verified_windows", counted)
    rng = random.Random(4)
    common = "the same long beginning of each of these lines, then "
    far = [common + "".join(rng.choice("abcdefgh") for _ in range(50)) for _ in range(1500)]
    near = [f"entry {k:05d} of the list" for k in range(1500)]
    texts = [(i, x) for i, x in enumerate(far + near)]
    found, links = linejoin.similar_lines(spark.createDataFrame(texts, "doc_id long, text string"))
    names = {r.line: r["first"]["key"] for r in found.collect()}
    classes = classes_of([(names[r.a], names[r.b]) for r in links.collect()], range(len(texts)))
    assert len(set(classes.values())) == len(far) + 1
    assert sum(made) < 40 * len(texts)


def test_very_long_lines(spark):
    line = "".join(random.Random(1).choice("abc de") for _ in range(60_000)).strip()
    rows = [(1, line), (2, line[:30_000] + "#" + line[30_000:]), (3, line[:100] + line[102:]), (4, line[:-1] + "#")]
    found = linejoin.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_kept for r in found} == {1: 1, 2: 0, 3: 1, 4: 0}


def test_line_dedup(spark, no_docs):
    long = "a line that is long enough to be compared"
    rows = [(1, f"{long}\n\n  short  \n{long}"), (2, f"short\n{long}!\r\nother"), (3, None), (4, " \n "), (5, f"{long[:-1]}\nlonger: {long}")]
    found = linejoin.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_lines, r.n_kept, list(r.kept)) for r in found} == {
        1: (3, 2, [0, 2]), 2: (3, 1, [2]), 3: (0, 0, []), 4: (0, 0, []), 5: (2, 1, [1])
    }
    assert linejoin.line_dedup(no_docs).count() == 0


def plain_links(rows):
    """(parent, n_linked) of each (conv, turn) by the first writer of each passage and line."""
    def units(text):
        lines = [re.match(r"((?:[ \t]*>)*)(?:(?<=>)[ \t])?(.*)", x, re.S).groups() for x in re.split("\r\n|\r|\n", text or "")]
        lines = [(marks.count(">"), content) for marks, content in lines]
        found = set(lines)
        for level, run in itertools.groupby(lines, key=lambda x: x[0]):
            found.add((level, "\n".join(content for _, content in run)))
        plain = [(level, re.sub(r"[\x20\x09-\x0D]+", " ", content).strip(" ").lower()) for level, content in found]
        return [u for u in plain if u[1]]

    said, out = {}, {}
    for conv, turn, _, text in rows:
        for level, content in units(text):
            if level == 0:
                said[conv, content] = min(turn, said.get((conv, content), turn))
    for conv, turn, _, text in rows:
        weight, n = collections.Counter(), 0
        for level, content in units(text):
            source = said.get((conv, content), turn)
            if level and source < turn:
                n += 1
                weight[source] += len(content) if level == 1 else 0
        best = max(((c, s) for s, c in weight.items() if c), default=(0, None))
        out[conv, turn] = (best[1], n)
    return out


def test_quotes_equal_plain_search(spark):
    rng = random.Random(6)
    words = ["Yes", "no", "maybe  so", "a longer word", "x", "", ">"]
    rows = []
    for conv in range(4):
        texts = []
        for turn in range(30):
            lines = []
            for _ in range(rng.randint(0, 3)):
                if texts and rng.random() < 0.7:
                    for line in rng.choice(texts).split("\n")[: rng.randint(1, 4)]:
                        lines.append(rng.choice([">", "> ", ">> ", " > >"]) + line)
                lines.append(" ".join(rng.choice([*words, f"word {rng.randrange(90)}"]) for _ in range(rng.randint(0, 4))))
            texts.append("\n".join(lines))
            rows.append((conv, turn, "u", texts[-1]))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    found = {(r.conv_id, r.turn): r for r in quotes.linked(frame).collect()}
    want = plain_links(rows)
    assert {k: (r.parent, r.n_linked) for k, r in found.items()} == want
    assert sum(parent is not None for parent, _ in want.values()) > 20
    for (conv, turn), r in found.items():
        thread, depth = turn, 0
        while want[conv, thread][0] is not None:
            thread, depth = want[conv, thread][0], depth + 1
        assert (r.thread, r.depth) == (thread, depth)


def test_quotes(spark):
    rows = [
        (1, 0, "user", "Hello there, how is the weather?\nI wonder about it."),
        (1, 1, "a", "> Hello there, how is the weather?\nIt is sunny and warm today."),
        (1, 2, "user", "On Monday X wrote:\n>> Hello there,  how is the weather?\n> It is Sunny and warm today.\nGreat, thank you very much."),
        (1, 3, "a", "Unrelated statement in this thread."),
        (1, 4, "u", "> > It is sunny and warm today.\n> Great, thank you very much.\n\nYou are welcome, friend."),
        (2, 0, None, None), (None, 1, "x", "> hi"), (2, 1, "a", "> Hello there, how is the weather?"), (2, 1, "a", ""),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = quotes.formatted(frame.withColumn("parent", F.lit(7))).collect()
    assert [(r.conv_id, r.turn, r.parent, r.thread, r.depth) for r in found][:8] == [
        (None, 1, None, 1, 0), (1, 0, None, 0, 0), (1, 1, 0, 0, 1), (1, 2, 1, 0, 2), (1, 4, 2, 0, 3),
        (1, 3, None, 3, 0), (2, 0, None, 0, 0), (2, 1, None, 1, 0),
    ]
    assert len(found) == len(rows)
    bodies = {(r.conv_id, r.turn): r.body for r in found}
    assert bodies[1, 2] == "Great, thank you very much." and bodies[1, 4] == "You are welcome, friend."
    assert quotes.formatted(frame.limit(0)).count() == 0


def test_long_chain_of_quotes(spark):
    rows = [(1, 0, "u", "This is statement number 0.")]
    rows += [(1, k, "u", f"> This is statement number {k - 1}.\nThis is statement number {k}.") for k in range(1, 21)]
    found = quotes.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert [(r.turn, r.depth, r.thread) for r in found] == [(k, k, 0) for k in range(21)]
