"""Deletion of repeated runs of lines, found by winnowing over line hashes.

A run is a sequence of lines with words, of MIN_WORDS words or more together. A
window is the shortest run from a line forwards, or from a line backwards. The
least line hash of each window is its fingerprint, so equal windows have equal
fingerprints; only windows whose fingerprint occurs at two positions or more
are joined by their content to its first position. Windows that overlap extend
a match both ways: every run that occurred before, in an earlier document or
earlier in the same one, is the union of its forward and backward windows.
Column expressions and windows only; no pair of positions is ever listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingframe.llm.common import fresh
from filingframe.session import materialise

MIN_WORDS = 50
_BLANK = " \t\r\f\v"
_KEY = ["doc_id", "text_hash"]


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, no, h, g, words`` of every line that has words; repeated rows count once."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    lines = keyed.select(*_KEY, F.posexplode(F.split("text", "\n")).alias("no", "line"))
    line = F.btrim(F.col("line"), F.lit(_BLANK))
    return (
        lines.select(*_KEY, "no", line.alias("line"))
        .select(
            *_KEY,
            "no",
            F.xxhash64("line").alias("h"),
            F.xxhash64("line", F.lit(1)).alias("g"),
            F.regexp_count("line", F.lit(r"\S+")).alias("words"),
        )
        .filter("words > 0")
        .repartition(*[F.col(c) for c in _KEY])
        .dropDuplicates([*_KEY, "no"])
    )


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """Every shortest run of ``min_words`` words, forwards and backwards from each line.

    ``no_from, no_to`` are its lines, ``a, b`` two hashes of its content, ``fp`` and
    ``fp_no`` the least line hash in it and the first line that has it.
    """
    document = Window.partitionBy(*_KEY)
    sized = lines.withColumn(
        "finish", F.sum("words").over(document.orderBy("no").rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("start", F.col("finish") - F.col("words"))
    ahead = document.orderBy("start").rangeBetween(0, min_words - 1)
    behind = document.orderBy("finish").rangeBetween(1 - min_words, 0)

    def run(frame) -> Column:  # noqa: ANN001
        return F.struct(
            F.min("no").over(frame).alias("no_from"),
            F.max("no").over(frame).alias("no_to"),
            F.collect_list(F.struct("h", "g")).over(frame).alias("content"),
            F.min(F.struct("h", "no")).over(frame).alias("least"),
        )

    both = (
        sized.withColumn("ahead", run(ahead))
        .withColumn("behind", run(behind))
        .withColumn("total", F.max("finish").over(document))
    )
    complete = F.array_compact(
        F.array(
            F.when(F.col("total") - F.col("start") >= min_words, F.col("ahead")),
            F.when(F.col("finish") >= min_words, F.col("behind")),
        )
    )
    return both.select(*_KEY, F.explode(complete).alias("w")).select(
        *_KEY,
        "w.no_from",
        "w.no_to",
        F.col("w.least.h").alias("fp"),
        F.col("w.least.no").alias("fp_no"),
        F.xxhash64("w.content").alias("a"),
        F.xxhash64("w.content", F.lit(1)).alias("b"),
    )


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, text_hash, no_from, no_to``: runs of lines (from 0) that occurred before.

    Positions are ordered by doc_id, the hash of the text, and the line. Lines are
    compared without white space at their ends; lines without words are passed over,
    and stay where they stand between two runs. Null and empty texts have no run.
    """
    windows = materialise(_windows(_lines(docs.select("doc_id", "text")), min_words), "windows")
    place = F.xxhash64(*_KEY, "fp_no")
    twice = (
        windows.groupBy("fp")
        .agg(F.min(place).alias("low"), F.max(place).alias("high"))
        .filter("low != high")
        .select("fp")
    )
    candidates = windows.join(twice, "fp", "left_semi").select(
        "a", "b", F.struct(*_KEY, "no_from").alias("at"), "no_to"
    )
    first = (
        candidates.groupBy("a", "b")
        .agg(F.min("at").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("a", "b", "first")
    )
    later = candidates.join(first, ["a", "b"]).filter("at > first").select("at.*", "no_to")
    document = Window.partitionBy(*_KEY).orderBy("no_from", "no_to")
    reach = F.max("no_to").over(document.rowsBetween(Window.unboundedPreceding, -1))
    return (
        later.withColumn("new", F.coalesce((F.col("no_from") > reach + 1).cast("int"), F.lit(1)))
        .withColumn("run", F.sum("new").over(document.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*_KEY, "run")
        .agg(F.min("no_from").alias("no_from"), F.max("no_to").alias("no_to"))
        .drop("run")
    )


def remove_repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the runs of lines that occurred before; ``removed_lines`` says how many.

    All other columns stay as they are, but a ``removed_lines`` is replaced, and ``n_chars``, where there is one, is
    counted again for texts that lost lines. No row is dropped: a text of nothing
    but repeated runs becomes empty. Null texts stay null; rows that repeat in
    doc_id and text count as one document and lose the same lines.
    """
    own_id, own_hash, own_runs = fresh(docs, "_doc_id", "_text_hash", "_runs")
    runs = (
        repeated_runs(docs, min_words)
        .groupBy(*_KEY)
        .agg(F.collect_list(F.struct("no_from", "no_to")).alias(own_runs))
        .select(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash), own_runs)
    )
    joined = docs.join(
        runs, docs["doc_id"].eqNullSafe(F.col(own_id)) & (F.xxhash64(docs["text"]) == F.col(own_hash)), "left"
    )
    lines = F.split(docs["text"], "\n")

    def kept(_: Column, i: Column) -> Column:
        return ~F.exists(own_runs, lambda r: i.between(r["no_from"], r["no_to"]))

    text = F.when(F.col(own_runs).isNull(), docs["text"]).otherwise(F.array_join(F.filter(lines, kept), "\n"))
    removed = F.coalesce(
        F.aggregate(own_runs, F.lit(0), lambda n, r: n + r["no_to"] - r["no_from"] + 1), F.lit(0)
    )
    # a column that the documents bring along under this name gives way
    columns = [text.alias("text") if c == "text" else docs[c] for c in docs.columns if c.lower() != "removed_lines"]
    out = joined.select(*columns, removed.alias("removed_lines"))
    if "n_chars" in docs.columns:
        counted = F.when(F.col("removed_lines") > 0, F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", counted.cast(docs.schema["n_chars"].dataType))
    return out


#: DuckDB twin over table ``documents``: lines that stay, by document.
SQL = f"""
WITH parts AS (
  SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, unnest(range(len(lines))) AS no, trim(unnest(lines), ' ' || chr(9) || chr(13) || chr(12) || chr(11)) AS line
  FROM parts
), worded AS (
  SELECT *, len(regexp_extract_all(line, '\\S+')) AS words FROM lines WHERE regexp_matches(line, '\\S')
), sized AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY no) AS finish, sum(words) OVER (PARTITION BY doc_id) AS total
  FROM worded
), framed AS (
  SELECT doc_id, total, finish, finish - words AS start,
    list(line) OVER ahead AS after_lines, min(no) OVER ahead AS after_from, max(no) OVER ahead AS after_to,
    list(line) OVER behind AS before_lines, min(no) OVER behind AS before_from, max(no) OVER behind AS before_to
  FROM sized
  WINDOW ahead AS (PARTITION BY doc_id ORDER BY finish - words RANGE BETWEEN CURRENT ROW AND {MIN_WORDS - 1} FOLLOWING),
         behind AS (PARTITION BY doc_id ORDER BY finish RANGE BETWEEN {MIN_WORDS - 1} PRECEDING AND CURRENT ROW)
), windows AS (
  SELECT doc_id, after_from AS f, after_to AS t, after_lines AS content FROM framed WHERE total - start >= {MIN_WORDS}
  UNION
  SELECT doc_id, before_from, before_to, before_lines FROM framed WHERE finish >= {MIN_WORDS}
), firsts AS (
  SELECT content, min((doc_id, f)) AS first FROM windows GROUP BY content HAVING count(*) > 1
), later AS (
  SELECT DISTINCT w.doc_id, unnest(range(w.f, w.t + 1)) AS no
  FROM windows w JOIN firsts USING (content) WHERE (w.doc_id, w.f) > first
), removed AS (
  SELECT doc_id, list(no) AS gone FROM later GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(len(gone), 0) AS INTEGER) AS removed_lines,
  sha256(array_to_string(list_filter(lines, lambda x, i: NOT list_contains(coalesce(gone, []), i - 1)), chr(10))) AS text_sha256
FROM parts LEFT JOIN removed USING (doc_id)
"""
