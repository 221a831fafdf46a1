"""Quotation linking: conversations in reply order, without quotes.

A line that begins with one or more ``>`` is quoted at that level. Quoted lines are
normalised and hashed, and each is joined to the latest earlier message of its
conversation that has the same line as its own; a quoted passage (lines of one
level that follow one another) links to the message that most of its
characters point to. A message replies to the original of its least level's
longest passage. Replies form threads; threads stand in the order of their
first messages, and messages within a thread in theirs, so a reply always
follows what it quotes. Column expressions, joins and windows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingframe.session import materialise

#: Turns of one block of the two-step search for the latest earlier line.
BLOCK = 256
_PREFIX = r"^[ \t]*(>[ \t]*)+"


def _level(line: Column) -> Column:
    """How deep a line is quoted; 0 for a message's own lines."""
    prefix = F.regexp_extract(line, _PREFIX, 0)
    return F.length(prefix) - F.length(F.translate(prefix, ">", ""))


def _normal(line: Column) -> Column:
    own = F.regexp_replace(line, _PREFIX, "")
    return F.lower(F.btrim(F.regexp_replace(own, r"\s+", " ")))


def _lines(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, text_hash, no, level, line`` of lines with words; ``line`` is normalised."""
    hashed = messages.select("conv_id", "turn", "text", F.xxhash64("text").alias("text_hash"))
    raw = hashed.select("conv_id", "turn", "text_hash", F.posexplode(F.split("text", "\n")).alias("no", "raw"))
    return raw.select(
        "conv_id", "turn", "text_hash", "no", _level(F.col("raw")).alias("level"), _normal(F.col("raw")).alias("line")
    ).filter("line != ''")


def _origins(lines: DataFrame) -> DataFrame:
    """For each quoted line (``conv_id, turn, no``) the latest earlier turn that has it as its own.

    Turns are cut into blocks: the latest own line of the blocks before is a maximum
    over one row a block, the latest within the block a window of few turns. So a
    line that most messages share is spread over as many tasks as it has blocks.
    """
    keyed = lines.select(
        "conv_id",
        "turn",
        F.xxhash64("line").alias("h"),
        F.floor(F.col("turn") / BLOCK).alias("block"),
        F.when(F.col("level") == 0, F.col("turn")).alias("own"),
    ).distinct()
    quoted = lines.filter("level > 0").select(F.xxhash64("line").alias("h")).distinct()
    # only lines that somebody quotes are compared
    keyed = keyed.join(quoted, "h", "left_semi")
    blocks = Window.partitionBy("conv_id", "h").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        keyed.groupBy("conv_id", "h", "block")
        .agg(F.max("own").alias("own"))
        .select("conv_id", "h", "block", F.max("own").over(blocks).alias("earlier"))
    )
    inside = Window.partitionBy("conv_id", "h", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    latest = keyed.withColumn("near", F.max("own").over(inside)).filter("own is null")
    return latest.join(before, ["conv_id", "h", "block"]).select(
        "conv_id", "turn", "h", F.coalesce("near", "earlier").alias("origin")
    )


def links(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, level, no, reply_to``: quoted passages and the messages they come from.

    ``no`` is the passage's first line. Of messages that equally many characters point
    to, the latest is taken. Passages whose lines nobody wrote before are left out.
    Rows without conversation or turn, or with null text, take no part.
    """
    lines = _lines(messages.filter("conv_id is not null and turn is not null and text is not null"))
    message = Window.partitionBy("conv_id", "turn", "text_hash").orderBy("no")
    passages = (
        lines.withColumn("new", (F.col("level") != F.coalesce(F.lag("level").over(message), F.lit(-1))).cast("int"))
        .withColumn("passage", F.sum("new").over(message.rowsBetween(Window.unboundedPreceding, 0)))
        .filter("level > 0")
        .withColumn("h", F.xxhash64("line"))
    )
    votes = (
        passages.join(_origins(lines), ["conv_id", "turn", "h"])
        .filter("origin is not null")
        .groupBy("conv_id", "turn", "text_hash", "level", "passage", "origin")
        .agg(F.sum(F.length("line")).alias("chars"), F.min("no").alias("no"))
    )
    return (
        votes.groupBy("conv_id", "turn", "text_hash", "level", "passage")
        .agg(F.max(F.struct("chars", "origin")).alias("best"), F.min("no").alias("no"))
        .select("conv_id", "turn", "level", "no", F.col("best.origin").alias("reply_to"), F.col("best.chars").alias("chars"))
    )


def _threads(replies: DataFrame) -> DataFrame:
    """``conv_id, turn, thread, depth``: first turn of each reply's thread, by pointer doubling."""
    current = materialise(
        replies.select("conv_id", "turn", F.col("reply_to").alias("thread"), F.lit(1).cast("long").alias("depth")), "threads"
    )
    while True:
        up = current.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("above"), F.col("depth").alias("more"))
        joined = current.join(up, ["conv_id", "thread"], "left")
        if not joined.filter("above is not null").limit(1).count():
            return current
        current = materialise(
            joined.select(
                "conv_id",
                "turn",
                F.coalesce("above", "thread").alias("thread"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            ),
            "threads",
            replaces=current,
        )


def reply_ordered(messages: DataFrame) -> DataFrame:
    """``conv_id, thread, depth, turn, reply_to, role, text`` of every message.

    ``text`` has the message's own lines alone, without blank lines at its ends; ``reply_to``
    is null where nothing is quoted that was written before, ``thread`` is the turn
    that the thread begins with, and ``depth`` the number of replies from there. Reading
    a conversation by (thread, turn) gives its reply order. Null texts stay null; messages of one
    conversation and turn are read apart, each keeps its row, and they share the best link of them all.
    No messages give no rows, and other columns are not looked at.
    """
    found = links(messages.select("conv_id", "turn", "text"))
    # the least level is what the message answers; its longest passage, then the latest original
    best = F.min(F.struct("level", (-F.col("chars")).alias("chars"), (-F.col("reply_to")).alias("to"))).alias("best")
    replies = materialise(
        found.groupBy("conv_id", "turn").agg(best).select("conv_id", "turn", (-F.col("best.to")).alias("reply_to")), "replies"
    )
    known = replies.join(_threads(replies), ["conv_id", "turn"])
    known = known.select([F.col(c).alias(f"_{c}") for c in known.columns])
    own = F.array_join(F.filter(F.split("text", "\n"), lambda line: _level(line) == 0), "\n")
    trimmed = F.regexp_replace(own, r"^\s+|\s+$", "")
    rows = messages.select("conv_id", "turn", "role", "text")
    joined = rows.join(known, (rows.conv_id == known._conv_id) & (rows.turn == known._turn), "left")
    return joined.select(
        "conv_id",
        F.coalesce("_thread", "turn").alias("thread"),
        F.coalesce("_depth", F.lit(0)).cast("long").alias("depth"),
        "turn",
        F.col("_reply_to").alias("reply_to"),
        "role",
        trimmed.alias("text"),
    )


#: DuckDB twin over table ``conversations``.
SQL = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, role, text, unnest(string_split(text, chr(10))) AS raw,
    unnest(range(len(string_split(text, chr(10))))) AS no
  FROM conversations
), lines AS (
  SELECT conv_id, turn, no, raw,
    len(regexp_extract(raw, '^[ \t]*(>[ \t]*)+', 0)) - len(replace(regexp_extract(raw, '^[ \t]*(>[ \t]*)+', 0), '>', '')) AS level,
    lower(trim(regexp_replace(regexp_replace(raw, '^[ \t]*(>[ \t]*)+', ''), '\s+', ' ', 'g'))) AS line
  FROM raw
), worded AS (
  SELECT DISTINCT * EXCLUDE raw FROM lines WHERE line != '' AND conv_id IS NOT NULL AND turn IS NOT NULL
), begun AS (
  SELECT *, CASE WHEN level IS DISTINCT FROM lag(level) OVER (PARTITION BY conv_id, turn ORDER BY no) THEN 1 ELSE 0 END AS new
  FROM worded
), passages AS (
  SELECT *, sum(new) OVER (PARTITION BY conv_id, turn ORDER BY no) AS passage FROM begun
), origins AS (
  SELECT q.conv_id, q.turn, q.level, q.passage, q.no, q.line, max(o.turn) AS origin
  FROM passages q JOIN worded o ON q.conv_id = o.conv_id AND q.line = o.line AND o.level = 0 AND o.turn < q.turn
  WHERE q.level > 0 GROUP BY ALL
), votes AS (
  SELECT conv_id, turn, level, passage, origin, sum(len(line)) AS chars FROM origins GROUP BY ALL
), links AS (
  SELECT conv_id, turn, level, passage, max((chars, origin)) AS best FROM votes GROUP BY ALL
), replies AS (
  SELECT conv_id, turn, arg_min(best[2], (level, -best[1], -best[2])) AS reply_to FROM links GROUP BY ALL
), threads AS (
  SELECT conv_id, turn, reply_to AS thread, 1 AS depth FROM replies
  UNION ALL
  SELECT t.conv_id, t.turn, r.reply_to, t.depth + 1 FROM threads t JOIN replies r ON t.conv_id = r.conv_id AND t.thread = r.turn
), first AS (
  SELECT conv_id, turn, arg_max(thread, depth) AS thread, max(depth) AS depth FROM threads GROUP BY ALL
), bodies AS (
  SELECT conv_id, turn, regexp_replace(string_agg(raw, chr(10) ORDER BY no) FILTER (level = 0), '^\s+|\s+$', '', 'g') AS body
  FROM (SELECT DISTINCT * FROM lines) GROUP BY conv_id, turn
)
SELECT c.conv_id, coalesce(f.thread, c.turn) AS thread, CAST(coalesce(f.depth, 0) AS BIGINT) AS depth, c.turn, r.reply_to, c.role,
  CASE WHEN c.text IS NOT NULL THEN coalesce(b.body, '') END AS text
FROM conversations c
LEFT JOIN first f ON c.conv_id = f.conv_id AND c.turn = f.turn
LEFT JOIN replies r ON c.conv_id = r.conv_id AND c.turn = r.turn
LEFT JOIN bodies b ON c.conv_id = b.conv_id AND c.turn = b.turn
"""
