"""Near-duplicate lines by a segment-partition edit join, in built-in functions only.

Two lines within edit distance t, cut into t+1 segments, share one of the shorter's segments at
nearly the same place: every line indexes its segments by (its length, number, text) and probes
the substrings where a line of the same or up to t fewer characters could have them. Candidates
are verified by a banded bit-parallel automaton: one mask of 2t+1 diagonals per number of errors.

With one error, an entry fixes all of a line but a window (the other segment). Lines of an entry that many
share are not paired: their windows are cut into two segments again, one of which must be shared as
well, and so on. Lines that share all but a single character are a chain of links to the first of them.
So the work for an entry grows with the number of its lines times the logarithm of their length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import saved
from landfall.llm.components import components

ERRORS = 1
FEW = 16  # lines of an entry that are compared in pairs
#: A run of white space that is not one plain space already, so most words need no replacement.
UNEVEN_SPACE = r"[\x20\x09-\x0D](?:[\x20\x09-\x0D]+|(?<!\x20))"


def raw_lines(text):
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def line_rows(docs: DataFrame, key="doc_id", text="text") -> DataFrame:
    """(key, pos, line): lines trimmed and with white space squeezed; blank ones left out."""
    plain = F.trim(F.regexp_replace("raw", UNEVEN_SPACE, " ")).alias("line")
    return docs.select(F.col(key).alias("key"), F.posexplode(raw_lines(text)).alias("pos", "raw")).select("key", "pos", plain).where("line <> ''")


def _segment(n, number, errors):
    """Start and width of a segment of a line of n characters; the last ones take the remainder."""
    parts = errors + 1
    width, rest = F.floor(n / parts), n % parts
    extra = F.greatest(F.lit(number) - (F.lit(parts) - rest), F.lit(0))
    longer = (F.lit(number) >= F.lit(parts) - rest).cast("int")
    return (F.lit(number) * width + extra).cast("int"), (width + longer).cast("int")


def index_entries(line, errors):
    n = F.length(line)
    found = []
    for number in range(errors + 1):
        start, width = _segment(n, number, errors)
        found.append(F.xxhash64(F.lit(number), n, F.substring(line, start + 1, width)))
    return F.array(*found)


def probe_entries(line, errors):
    """Substrings to look up, by the multi-match-aware choice of starts."""
    found = []
    for shorter in range(errors + 1):
        n = F.length(line) - shorter
        for number in range(errors + 1):
            start, width = _segment(n, number, errors)
            low = max(-number, shorter - (errors - number))
            high = min(number, shorter + errors - number)
            for move in range(low, high + 1):
                found.append(F.xxhash64(F.lit(number), n, F.substring(line, start + move + 1, width)))
    return F.array(*found)


def characters(line):
    return F.split(line, "")


def within_distance(chars_a, chars_b, errors):
    """Whether the edit distance of two strings, given as stored arrays of characters, is at most ``errors``.

    Bit d of mask e: after j characters of b, j + d - errors of a can be reached with at most e errors.
    """
    band = (1 << 2 * errors + 1) - 1

    def step(state, j):
        match = F.lit(0)
        for d in range(2 * errors + 1):
            same = F.get(chars_a, j + (d - errors)) == F.get(chars_b, j)
            match = match.bitwiseOR(F.when(same, F.lit(1 << d)).otherwise(F.lit(0)))
        masks = []
        for e in range(errors + 1):
            mask = state[f"e{e}"].bitwiseAND(match)
            if e:
                less = state[f"e{e - 1}"]
                mask = mask.bitwiseOR(less).bitwiseOR(F.shiftright(less, 1)).bitwiseOR(F.shiftleft(masks[e - 1], 1))
            masks.append(mask.bitwiseAND(F.lit(band)))
        return F.struct(*(mask.alias(f"e{e}") for e, mask in enumerate(masks)))

    begin, masks = 1 << errors, []
    for e in range(errors + 1):
        masks.append(begin if not e else (masks[-1] | masks[-1] << 1) & band)
    start = F.struct(*(F.lit(mask).alias(f"e{e}") for e, mask in enumerate(masks)))
    last = F.aggregate(F.sequence(F.lit(0), F.size(chars_b) - 1), start, step)[f"e{errors}"]
    apart = F.size(chars_a) - F.size(chars_b)
    reached = F.element_at(
        F.array(*(last.bitwiseAND(F.lit(1 << d)) for d in range(2 * errors + 1))),
        F.greatest(F.least(apart, F.lit(errors)), F.lit(-errors)) + (errors + 1),
    )
    return (F.abs(apart) <= errors) & (reached > 0)


def entries_of_one(lines: DataFrame) -> DataFrame:
    """(entry, line, start, width, base) of the two segments of each line, for partners as long and one shorter.

    The rest of the line is a window of ``width`` characters from ``start`` on; ``base`` is its width in
    the shorter of the two lines, so a row with base = width is of a line that may be the shorter one.
    """
    n = F.length("text")

    def entry(number, longer):
        base = n - longer
        half = F.floor(base / 2).cast("int")
        if number == 0:
            kept, start, width, rest = F.substring("text", 1, half), half, n - half, base - half
        else:
            kept, start, width, rest = F.substring("text", half + 1 + longer, base - half), F.lit(0), half + longer, half
        return F.struct(
            F.xxhash64(F.lit(number), base, kept).alias("entry"),
            start.alias("start"), width.alias("width"), rest.alias("base"),
        )

    own, longer = ([entry(number, more) for number in (0, 1)] for more in (0, 1))
    found = F.when(n > 2, F.array(*own, *longer)).otherwise(F.array(*own))
    return lines.where(n > 1).select("line", F.explode(found).alias("e")).select("line", "e.*")


def entries_within(rows: DataFrame) -> DataFrame:
    """The same for the two segments of each row's window; rows keep their text."""
    half = F.floor(F.col("base") / 2).cast("int")
    more = F.col("width") - F.col("base")
    first = F.struct(
        F.xxhash64("entry", F.lit(0), F.substring("text", F.col("start") + 1, half)).alias("entry"),
        (F.col("start") + half).alias("start"), (F.col("width") - half).alias("width"), (F.col("base") - half).alias("base"),
    )
    kept = F.substring("text", F.col("start") + half + more + 1, F.col("base") - half)
    second = F.struct(
        F.xxhash64("entry", F.lit(1), kept).alias("entry"), F.col("start"), (half + more).alias("width"), half.alias("base")
    )
    return rows.select("line", "text", F.explode(F.array(first, second)).alias("e")).select("line", "text", "e.*")


def with_texts(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(lines.select(F.col("line").alias(side), F.col("text").alias(f"{side}_text")), side)
    return pairs


def verified_windows(pairs: DataFrame) -> DataFrame:
    """Links (a, b) of those pairs that agree outside their windows and are one edit apart within."""
    def window(side):
        return characters(F.substring(f"{side}_text", F.col("start") + 1, F.col(f"{side}_width")))

    def outside(side):
        text, end = F.col(f"{side}_text"), F.col("start") + F.col(f"{side}_width")
        return F.struct(F.substring(text, F.lit(1), F.col("start")), F.substring(text, end + 1, F.length(text)))

    return compared(pairs.where(outside("a") == outside("b")), window("a"), window("b"), 1)


def compared(pairs: DataFrame, chars_a, chars_b, errors: int) -> DataFrame:
    """Those of the pairs (a, b) that are within distance; characters are stored first, as each step looks them up."""
    stored = saved(pairs.select("a", "b", chars_a.alias("a_chars"), chars_b.alias("b_chars")), "line-candidates")
    return stored.where(within_distance(F.col("a_chars"), F.col("b_chars"), errors)).select("a", "b")


PAIR = ["start", "a", "a_text", "a_width", "b", "b_text", "b_width"]


def side(rows: DataFrame, name: str, *more: str) -> DataFrame:
    named = [F.col("line").alias(name), F.col("text").alias(f"{name}_text"), F.col("width").alias(f"{name}_width")]
    return rows.select("entry", *named, *more)


def pairs_of_few(rows: DataFrame) -> DataFrame:
    """All pairs of lines that share an entry, the shorter line as a."""
    once = (F.col("b_width") > F.col("a_width")) | (F.col("a") < F.col("b"))
    shorter = side(rows.where("width = base"), "a", "start")
    return shorter.join(side(rows, "b"), "entry").where(once).select(*PAIR)


def pairs_of_single_characters(rows: DataFrame) -> DataFrame:
    """Lines that share all but a window of one character, or two in the longer of them, each with the first such line."""
    rows = rows.withColumn("sign", F.explode(characters(F.substring("text", F.col("start") + 1, F.col("width")))))
    short, least = rows.where("width = 1"), F.min(F.struct("line", "text", "width")).alias("least")

    def of_least(groups):
        return groups.select("entry", *[F.col(f"least.{n}").alias(f"{n}") for n in ("line", "text", "width")], *groups.columns[1:-1])

    first = side(of_least(short.groupBy("entry").agg(least)), "a")
    by_sign = side(of_least(short.groupBy("entry", "sign").agg(least)), "a", "sign")
    as_long = first.join(side(short, "b", "start"), "entry")
    longer = by_sign.join(side(rows.where("width = 2"), "b", "start", "sign"), ["entry", "sign"])
    return as_long.select(*PAIR).unionByName(longer.select(*PAIR)).where("a <> b")


def links_of_one(lines: DataFrame) -> DataFrame:
    """Links that connect the lines (line, text) with those one edit away; a forest suffices where many agree."""
    level, links = entries_of_one(lines), []
    while True:
        shorter = F.col("width") == F.col("base")
        shared = level.groupBy("entry").agg(F.count_if(shorter).alias("short"), F.count(F.lit(1)).alias("size"))
        shared = saved(shared.where("short > 0 AND size > 1").select("entry", "size"), "shared-entries")
        rows = level.join(shared, "entry")
        if not links:  # only lines that share an entry take their text along
            rows = rows.join(lines, "line")
        rows = saved(rows, "entry-rows")
        few, many = rows.where(F.col("size") <= FEW), rows.where(F.col("size") > FEW)
        pairs = pairs_of_few(few).unionByName(pairs_of_single_characters(many.where("base = 1")))
        links.append(saved(verified_windows(pairs), "line-links"))
        many = many.where("base > 1")
        if many.isEmpty():
            return reduce(DataFrame.unionByName, links)
        level = saved(entries_within(many), "entries")


def links_of_pairs(lines: DataFrame, errors: int) -> DataFrame:
    """Links (a, b) between all lines (line, text) within ``errors`` edits, by pairs that share an entry."""
    n = F.length("text")
    lines = lines.where(n > errors)
    index = lines.select(F.explode(index_entries(F.col("text"), errors)).alias("entry"), F.col("line").alias("a"), n.alias("a_n"))
    probe = lines.select(F.explode(probe_entries(F.col("text"), errors)).alias("entry"), F.col("line").alias("b"), n.alias("b_n"))
    shorter = (F.col("a_n") < F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & (F.col("a") < F.col("b")))
    pairs = index.join(probe.hint("merge"), "entry").where(shorter).select("a", "b").distinct()
    near = compared(with_texts(pairs, lines), characters(F.col("a_text")), characters(F.col("b_text")), errors)
    return saved(near, "line-links")


def similar_lines(docs: DataFrame, key="doc_id", text="text", errors=ERRORS, least=0):
    """Distinct lines (line, first, n) and links (a, b) that connect those within ``errors`` edits.

    A line goes by a 128-bit digest; ``first`` is its first place (key, pos). Equal lines are summed
    before anything is compared, so a line that is everywhere is one row. Lines of fewer than ``least``
    characters, or of no more than ``errors``, are compared for equality only.
    """
    rows = line_rows(docs, key, text)
    digest = F.struct(F.xxhash64("line").alias("one"), F.xxhash64(F.lit(1), "line").alias("two"))
    lines = saved(
        rows.select(digest.alias("digest"), F.struct("key", "pos").alias("first"), "line")
        .groupBy("digest")
        .agg(F.min("first").alias("first"), F.first("line").alias("text"))
        .withColumnRenamed("digest", "line"),
        "lines",
    )
    n = F.length("text")
    texts = lines.where(n >= least).select("line", "text")
    links = links_of_one(texts) if errors == 1 else links_of_pairs(texts, errors)
    return lines.select("line", "first", n.alias("n")), links


def line_dedup(docs: DataFrame, key="doc_id", text="text", errors=ERRORS, least=0) -> DataFrame:
    """(key, n_lines, n_kept, kept) of every row: ``kept`` has the places of the lines that stay.

    Of each class of lines linked by at most ``errors`` edits, the first by key and place stays. Blank
    lines are not counted; a null or blank text has none. Rows with equal keys share their counts.
    """
    lines, links = similar_lines(docs, key, text, errors, least)
    found = components(links).withColumnRenamed("key", "line")
    first = (
        lines.join(found, "line", "left")
        .groupBy(F.coalesce("component", "line").alias("line"))
        .agg(F.min("first").alias("first"))
    )
    kept = first.groupBy(F.col("first.key").alias("key")).agg(
        F.count(F.lit(1)).alias("n_kept"), F.array_sort(F.collect_list("first.pos")).alias("kept")
    )
    filled = F.size(F.filter(raw_lines(text), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    counts = docs.groupBy(F.col(key).alias("key")).agg(F.sum(filled).alias("n_lines"))
    return (
        docs.select(F.col(key).alias("key"))
        .join(counts, "key", "left")
        .join(kept, "key", "left")
        .select(
            F.col("key").alias(key),
            F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce("n_kept", F.lit(0)).cast("long").alias("n_kept"),
            F.coalesce("kept", F.expr("cast(array() as array<int>)")).alias("kept"),
        )
    )


def op6_line_dedup(spark, sf_dir):
    return line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


# near: one character of b left out, and one of a where both are as long; levenshtein() would count bytes
OP6_SQL = r"""
WITH RECURSIVE s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
o AS (SELECT doc_id, i - 1 AS pos, trim(regexp_replace(ls[i], '[\x20\x09-\x0D]+', ' ', 'g')) AS line
      FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM s)),
occurrences AS (SELECT doc_id, CAST(pos AS INTEGER) AS pos, line FROM o WHERE line <> ''),
lines AS (SELECT line, min({'d': doc_id, 'p': pos}) AS first FROM occurrences GROUP BY 1),
long_lines AS (SELECT line, length(line) AS n,
                      unnest([left(line, length(line) // 2), left(line, (length(line) - 1) // 2),
                              right(line, length(line) // 2), right(line, (length(line) - 1) // 2)]) AS half
               FROM lines WHERE length(line) >= 2),
pairs AS (SELECT DISTINCT a.line AS a, b.line AS b, b.n AS n, b.n - a.n AS more
          FROM long_lines a JOIN long_lines b USING (half)
          WHERE b.n - a.n = 1 OR b.n = a.n AND a.line < b.line),
near AS (SELECT a, b FROM pairs WHERE len([i for i in range(1, n + 1) if left(a, i - 1) = left(b, i - 1)
           AND substr(a, i + 1 - more) = substr(b, i + 1)]) > 0),
links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach(line, other) AS (SELECT a, b FROM links UNION SELECT r.line, l.b FROM reach r JOIN links l ON l.a = r.other),
classes AS (SELECT line, min(least(line, other)) AS class FROM reach GROUP BY 1),
firsts AS (SELECT coalesce(class, lines.line) AS class, min(first) AS first
           FROM lines LEFT JOIN classes USING (line) GROUP BY 1),
kept AS (SELECT first.d AS doc_id, count(*) AS n_kept, list_sort(list(first.p)) AS kept FROM firsts GROUP BY 1),
counts AS (SELECT doc_id, count(*) AS n_lines FROM occurrences GROUP BY 1)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_kept, 0) AS n_kept,
       coalesce(kept, CAST([] AS INTEGER[])) AS kept
FROM documents d LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)"""
