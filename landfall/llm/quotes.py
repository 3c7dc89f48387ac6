"""Conversations from messages that quote each other.

Lines that begin with ``>`` marks are quotes, nested as deep as their marks. Runs of lines of one
level are passages; passages and their lines, lower-cased and with white space squeezed, are
hashed and joined to the first message of the conversation that wrote the same. The message
with the most quoted text is the parent; bodies keep only what a message itself says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import saved


def _plain(line):
    return F.lower(F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")))


def parsed(messages: DataFrame) -> DataFrame:
    """Adds ``lines``: (level, content) of every line; a null text has none."""
    marks = r"^(?:[ \t]*>)+"
    lines = F.split(F.regexp_replace(F.coalesce("text", F.lit("")), "\r\n?", "\n"), "\n")
    return messages.withColumn(
        "lines",
        F.transform(
            lines,
            lambda line: F.struct(
                F.length(F.regexp_replace(F.regexp_extract(line, marks, 0), "[ \t]", "")).alias("level"),
                F.regexp_replace(line, marks + "[ \t]?", "").alias("content"),
            ),
        ),
    )


def passages(lines):
    """(level, content) of the runs of consecutive lines of one level."""
    empty = F.expr("cast(array() as array<struct<level: int, content: string>>)")
    starts = F.filter(
        F.sequence(F.lit(0), F.size(lines) - 1),
        lambda i: (i == 0) | (F.get(lines, i - 1)["level"] != F.get(lines, i)["level"]),
    )
    runs = F.transform(
        starts,
        lambda i, k: F.struct(
            F.get(lines, i)["level"].alias("level"),
            F.array_join(
                F.transform(
                    F.slice(lines, i + 1, F.coalesce(F.get(starts, k + 1), F.size(lines)) - i), lambda x: x["content"]
                ),
                "\n",
            ).alias("content"),
        ),
    )
    return F.when(F.size(lines) > 0, runs).otherwise(empty)


def linked(messages: DataFrame, conversation="conv_id", turn="turn", role="role", text="text", least=1) -> DataFrame:
    """(conversation, turn, role, parent, thread, depth, n_quotes, n_linked, body) of every message.

    ``parent`` is the earlier turn of the same conversation whose words make up most of the first-level
    quotes (ties: the later turn), null where there is none. Passages and lines of fewer than ``least``
    characters are not linked; 1 leaves out blank ones only. ``thread`` and ``depth`` are
    the first turn of the chain of parents and the steps to it. Sorting by conversation,
    thread, depth and turn puts every message after what it answers. A null text has an empty
    body; messages with a null conversation or turn are kept and linked with nothing; of repeated
    turns each is kept, and they share their links. Sums by hash are partial sums, so one busy
    conversation is spread over tasks.
    """
    given = parsed(
        messages.select(
            F.col(conversation).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
        )
    ).withColumn("runs", passages(F.col("lines")))
    lines = F.transform("lines", lambda x: F.struct(x["level"], x["content"]))
    units = (
        given.where("conv IS NOT NULL AND turn IS NOT NULL")
        .select("conv", "turn", F.explode(F.array_distinct(F.concat("runs", lines))).alias("unit"))
        .select("conv", "turn", F.col("unit.level").alias("level"), _plain(F.col("unit.content")).alias("content"))
        .where(F.length("content") >= least)
        .select("conv", "turn", "level", F.length("content").alias("chars"), F.sha2("content", 256).alias("hash"))
    )
    first = saved(
        units.where("level = 0").groupBy("conv", "hash").agg(F.min("turn").alias("source")), "quotable"
    )
    links = saved(
        units.where("level > 0")
        .join(first.hint("merge"), ["conv", "hash"])
        .where("source < turn")
        .groupBy("conv", "turn", "source")
        .agg(F.sum(F.when(F.col("level") == 1, F.col("chars"))).alias("chars"), F.count(F.lit(1)).alias("n_linked")),
        "quote-links",
    )
    parents = saved(
        links.groupBy("conv", "turn").agg(
            F.max(F.when(F.col("chars") > 0, F.struct("chars", "source")))["source"].alias("parent"),
            F.sum("n_linked").alias("n_linked"),
        ),
        "parents",
    )
    # chains of parents by pointer doubling: each round doubles the steps taken
    chains = parents.where("parent IS NOT NULL").select(
        "conv", "turn", F.col("parent").alias("thread"), F.lit(1).cast("long").alias("depth")
    )
    chains = saved(chains, "chains")
    while True:
        on = chains.select("conv", F.col("turn").alias("thread"), F.col("thread").alias("further"), F.col("depth").alias("more"))
        longer = saved(
            chains.join(on, ["conv", "thread"], "left").select(
                "conv", "turn", F.coalesce("further", "thread").alias("thread"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("more").isNotNull().alias("moved"),
            ),
            "chains",
        )
        chains = longer.drop("moved")
        if longer.where("moved").isEmpty():
            break
    own = F.filter("lines", lambda x: x["level"] == 0)
    body = F.array_join(F.transform(own, lambda x: x["content"]), "\n")
    body = F.regexp_replace(body, r"(?m)^On .+ wrote:[ \t]*$\n?", "")
    body = F.regexp_replace(body, r"^\s+|\s+$", "")
    quotes = F.size(F.filter("runs", lambda x: x["level"] > 0))
    # without quotes a line "On ... wrote:" is ordinary text
    body = F.when(quotes > 0, body).otherwise(F.coalesce("text", F.lit("")))
    return (
        given.select("conv", "turn", "role", quotes.cast("long").alias("n_quotes"), body.alias("body"))
        .join(parents, ["conv", "turn"], "left")
        .join(chains, ["conv", "turn"], "left")
        .select(
            F.col("conv").alias(conversation),
            F.col("turn").alias(turn),
            F.col("role").alias(role),
            "parent",
            F.coalesce("thread", "turn").alias("thread"),
            F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
            "n_quotes",
            F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
            "body",
        )
    )


def formatted(messages: DataFrame, **columns) -> DataFrame:
    """Messages in reply order as chat lines: a sort by conversation, thread, depth and turn.

    The sort is by ranges, so a long conversation may span several files, in order.
    """
    found = linked(messages, **columns)
    rendered = F.concat(F.lit("<|"), F.coalesce(found.columns[2], F.lit("user")), F.lit("|>\n"), F.col("body"), F.lit("\n"))
    return found.withColumn("rendered", rendered).orderBy(found.columns[0], "thread", "depth", found.columns[1])


def quoting(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) where each message quotes the two turns before it, as mail programs do."""
    turns = messages.select("conv_id", "turn", "role", "text")
    marked = turns
    for back, marks in ((1, "> "), (2, ">> ")):
        earlier = messages.select(
            F.col("conv_id").alias("of"), (F.col("turn") + back).alias("at"), F.col("text").alias(f"text_{back}")
        )
        marked = marked.join(earlier, (F.col("conv_id") == F.col("of")) & (F.col("turn") == F.col("at")), "left").drop("of", "at")
        lines = F.regexp_replace(f"text_{back}", r"\r\n?", "\n")
        marked = marked.withColumn(f"text_{back}", F.concat(F.lit(marks), F.replace(lines, F.lit("\n"), F.lit(f"\n{marks}"))))
    return marked.select("conv_id", "turn", "role", F.concat_ws("\n", "text_2", "text_1", "text").alias("text"))


def op5_quotation_linking(spark, sf_dir):
    return formatted(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def quotation_chains(spark, sf_dir):
    """The conversations with every message quoting the two before it."""
    return formatted(quoting(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


OP5_SQL = r"""
WITH RECURSIVE m AS MATERIALIZED (SELECT row_number() OVER () AS r, conv_id, turn, role, text FROM {source}),
l0 AS (SELECT r, conv_id, turn, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos
       FROM (SELECT *, string_split(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM m)),
l AS (SELECT r, conv_id, turn, pos, regexp_replace(line, '^(?:[ \t]*>)+[ \t]?', '') AS content,
             length(regexp_replace(regexp_extract(line, '^(?:[ \t]*>)+'), '[ \t]', '', 'g')) AS level FROM l0),
i AS (SELECT *, sum(CAST(new AS INTEGER)) OVER (PARTITION BY r ORDER BY pos) AS island FROM (
        SELECT *, level IS DISTINCT FROM lag(level) OVER (PARTITION BY r ORDER BY pos) AS new FROM l)),
runs AS (SELECT r, conv_id, turn, level, string_agg(content, chr(10) ORDER BY pos) AS content
         FROM i GROUP BY r, conv_id, turn, level, island),
units AS (SELECT r, conv_id, turn, level, lower(trim(regexp_replace(content, '[\x20\x09-\x0D]+', ' ', 'g'))) AS content
          FROM (SELECT r, conv_id, turn, level, content FROM runs UNION SELECT r, conv_id, turn, level, content FROM l)
          WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
said AS (SELECT conv_id, content, min(turn) AS source FROM units WHERE level = 0 AND content <> '' GROUP BY 1, 2),
links AS (SELECT conv_id, turn, source, sum(length(content)) FILTER (WHERE level = 1) AS chars, count(*) AS n
          FROM units JOIN said USING (conv_id, content) WHERE level > 0 AND source < turn GROUP BY 1, 2, 3),
parents AS (SELECT conv_id, turn, (max({{'c': chars, 's': source}}) FILTER (WHERE chars > 0)).s AS parent,
                   CAST(sum(n) AS BIGINT) AS n_linked FROM links GROUP BY 1, 2),
chains(conv_id, turn, thread, depth) AS (
  SELECT conv_id, turn, parent, 1::BIGINT FROM parents WHERE parent IS NOT NULL
  UNION ALL SELECT c.conv_id, c.turn, p.parent, c.depth + 1 FROM chains c
            JOIN parents p ON p.conv_id = c.conv_id AND p.turn = c.thread WHERE p.parent IS NOT NULL),
tops AS (SELECT conv_id, turn, arg_max(thread, depth) AS thread, max(depth) AS depth FROM chains GROUP BY 1, 2),
quoted AS (SELECT r, count(*) AS n_quotes FROM runs WHERE level > 0 GROUP BY 1),
own AS (SELECT r, trim(regexp_replace(string_agg(content, chr(10) ORDER BY pos), '(?m)^On .+ wrote:[ \t]*$\n?', '', 'g'),
                       chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM l WHERE level = 0 GROUP BY 1),
b AS (SELECT m.*, coalesce(n_quotes, 0) AS n_quotes,
             CASE WHEN n_quotes > 0 THEN coalesce(own.body, '') ELSE coalesce(text, '') END AS body
      FROM m LEFT JOIN quoted USING (r) LEFT JOIN own USING (r))
SELECT b.conv_id, b.turn, role, parent, coalesce(thread, b.turn) AS thread, coalesce(depth, 0) AS depth, n_quotes,
       coalesce(n_linked, 0) AS n_linked, body,
       '<|' || coalesce(role, 'user') || '|>' || chr(10) || body || chr(10) AS rendered
FROM b LEFT JOIN parents p ON p.conv_id = b.conv_id AND p.turn = b.turn
LEFT JOIN tops t ON t.conv_id = b.conv_id AND t.turn = b.turn"""
_MARKED = r"""'{0}' || replace(regexp_replace({1}.text, '\r\n?', chr(10), 'g'), chr(10), chr(10) || '{0}')"""
CHAINS_SQL = OP5_SQL.format(
    source=f"""(SELECT c.conv_id, c.turn, c.role,
         concat_ws(chr(10), {_MARKED.format(">> ", "q")}, {_MARKED.format("> ", "p")}, c.text) AS text
  FROM conversations c LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1
  LEFT JOIN conversations q ON q.conv_id = c.conv_id AND q.turn = c.turn - 2)"""
)
OP5_SQL = OP5_SQL.format(source="conversations")
