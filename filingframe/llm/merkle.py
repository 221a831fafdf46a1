"""Merkle manifest of a table by incremental witnesses.

Every row is a leaf, every group of rows (a source) a tree of runs of three, and
the groups' roots are the leaves of one more tree. Rows get their positions from
a range partitioning, and a group is cut into blocks aligned to whole subtrees.
Inside a block leaves are appended one after the other: a leaf starts with an
empty witness, and each run that a later sibling completes hands its members the
digests beside them. The roots of blocks are appended to the next round's blocks
in the same way, until one node a group is left, so no task ever holds more than
a block, however large a group is.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingframe.session import materialise

ARITY = 3
#: Levels of a block: it holds ARITY ** LEVELS nodes at most.
LEVELS = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_ROW_BITS = 33


def height(nodes: int, most: int = LEVELS) -> int:
    """Levels until one node is left, ``most`` at most."""
    levels = 0
    while nodes > 1 and levels < most:
        nodes, levels = -(-nodes // ARITY), levels + 1
    return levels


class Appends:
    """A tree that grows by appends; its nodes' witnesses grow with it.

    ``before[i], after[i]`` are the joined digests left and right of the way up
    from leaf ``i``, one entry for each level that is complete so far.
    """

    def __init__(self, levels: int) -> None:
        self.levels = levels
        self.before: list[list[str]] = []
        self.after: list[list[str]] = []
        self._open: list[list[tuple[str, range]]] = [[] for _ in range(levels + 1)]

    def append(self, digest: str) -> None:
        here = len(self.before)
        self.before.append([])
        self.after.append([])
        self._add(0, digest, range(here, here + 1))

    def _add(self, level: int, digest: str, leaves: range) -> None:
        self._open[level].append((digest, leaves))
        if level < self.levels and len(self._open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self._open[level] = self._open[level], []
        digests = [digest for digest, _ in run]
        for i, (_, leaves) in enumerate(run):
            left, right = "".join(digests[:i]), "".join(digests[i + 1 :])
            for leaf in leaves:
                self.before[leaf].append(left)
                self.after[leaf].append(right)
        whole = range(run[0][1].start, run[-1][1].stop)
        self._add(level + 1, sha256("".join(digests).encode()).hexdigest(), whole)

    def close(self) -> str:
        """Complete the runs that are still open; the digest of the top."""
        for level in range(self.levels):
            if self._open[level]:
                self._complete(level)
        return self._open[self.levels][0][0]


def _block(levels: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos", ignore_index=True)
        tree = Appends(height(int(rows["n"].iloc[0]), levels))
        for digest in rows["node"]:
            tree.append(digest)
        return rows.drop(columns="n").assign(top=tree.close(), before=tree.before, after=tree.after)

    return grow


def _placed(nodes: DataFrame) -> DataFrame:
    """``grp, node, pos, n`` and the other columns: place in the group (from 0) and the group's size.

    Rows are range-partitioned by group and key. Only one row for each partition and
    group is summed up, and a row meets the sum of its own partition and group alone.
    """
    keys = [F.col("grp"), F.col("key"), F.col("node")]
    ranged = materialise(
        nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()),
        "leaves",
    ).withColumn("part", F.shiftright("at", _ROW_BITS))
    parts = ranged.groupBy("grp", "part").agg(F.min("at").alias("least"), F.count("*").alias("size"))
    group = Window.partitionBy("grp")
    earlier = F.sum("size").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(
        F.col("grp").alias("own"),
        F.col("part").alias("in_part"),
        (F.coalesce(earlier, F.lit(0)) - F.col("least")).alias("shift"),
        F.sum("size").over(group).alias("n"),
    )
    met = ranged.join(parts, F.col("grp").eqNullSafe(F.col("own")) & (F.col("part") == F.col("in_part")))
    return met.withColumn("pos", F.col("at") + F.col("shift")).drop("key", "at", "part", "own", "in_part", "shift")


def _rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Per round of blocks: ``grp, pos, block, node, top, before, after``; the last has one row a group."""
    rounds: list[DataFrame] = []
    size = ARITY**levels
    nodes = _placed(nodes)
    while True:
        blocks = nodes.withColumn("block", F.expr(f"pos div {size}"))
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.drop("n").schema.fields)
        grown = blocks.groupBy("grp", "block").applyInPandas(
            _block(levels), f"{kinds}, top string, before array<string>, after array<string>"
        )
        rounds.append(materialise(grown, "witnesses"))
        tops = rounds[-1].filter(f"pos % {size} = 0").select("grp", F.col("block").alias("pos"), F.col("top").alias("node"))
        n = F.count("*").over(Window.partitionBy("grp"))
        nodes = tops.withColumn("n", n)
        if not rounds[-1].filter("block > 0").limit(1).count():
            rounds.append(tops.select("grp", "pos", "node"))
            return rounds


def witnesses(
    nodes: DataFrame, levels: int = LEVELS, above: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Every node of ``grp, key, node`` (and other columns) with its way to the group's root.

    ``before, after`` hold the digests beside the way, one entry a level; ``root`` is
    the group's root. Nodes ascend by ``key``, then by ``node``; nulls come first, and
    null is a group as any other. ``above`` takes ``grp, node`` of the groups' roots
    and gives ``grp, before, after, root`` of a tree over them, which extends every way.
    """
    *rounds, tops = _rounds(nodes, levels)
    if above:
        on = above(tops.select("grp", "node")).withColumnRenamed("grp", "own")
        tops = tops.join(on, F.col("grp").eqNullSafe(F.col("own"))).drop("own")
    else:
        none = F.array().cast("array<string>")
        tops = tops.select("*", none.alias("before"), none.alias("after"), F.col("node").alias("root"))
    way = tops
    for level in reversed(rounds):
        up = way.select(
            F.col("grp").alias("own"),
            F.col("pos").alias("up"),
            F.col("before").alias("more_before"),
            F.col("after").alias("more_after"),
            "root",
            *([F.col("node").alias("group_root")] if level is rounds[-1] else ["group_root"]),
        )
        met = level.join(up, F.col("grp").eqNullSafe(F.col("own")) & (F.col("block") == F.col("up")))
        way = met.withColumns(
            {"before": F.concat("before", "more_before"), "after": F.concat("after", "more_after")}
        ).drop("own", "up", "more_before", "more_after", "block", "top")
    return way


def _field(value: Column) -> Column:
    written = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Digest of a row: each value by its UTF-8 byte count and itself, null as ``-``."""
    return F.sha2(F.concat(*map(_field, values)), 256)


def folded(start: Column, before: Column, after: Column) -> Column:
    """The root that follows from a leaf and the digests beside its way."""
    return F.aggregate(
        F.arrays_zip(before.alias("l"), after.alias("r")),
        start,
        lambda digest, beside: F.sha2(F.concat(beside["l"], digest, beside["r"]), 256),
    )


def proof(before: Column, after: Column) -> Column:
    """Digest of all siblings on the way, level by level, left to right."""
    return F.sha2(F.array_join(F.zip_with(before, after, lambda left, right: F.concat(left, right)), ""), 256)


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, tampered, subroot, root, before, after`` of every row of ``docs``.

    ``tampered`` is the leaf of the row without line feeds in its text, where 2 divides the
    checksum of its doc_id, else the leaf itself. Only FIELDS are read, whatever other
    columns there are. A null value counts as null, not as empty; a row without id is never tampered with
    and stands before all others of its source. Rows that repeat are leaves of their own
    beside each other; rows of one id ascend by their digests. An empty table gives no rows.
    """
    values = {name: F.col(name) for name in FIELDS}
    cut = values | {"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    own = docs.select(
        F.col("source").alias("grp"),
        F.col("doc_id").alias("key"),
        "doc_id",
        leaf(*values.values()).alias("node"),
        F.when(even, leaf(*cut.values())).alias("changed"),
    )

    def sources(tops: DataFrame) -> DataFrame:
        over = tops.select(F.lit("").alias("grp"), F.col("grp").alias("key"), F.col("grp").alias("source"), "node")
        return witnesses(over, levels).select(F.col("source").alias("grp"), "before", "after", "root")

    return witnesses(own, levels, sources).select(
        "doc_id",
        F.col("node").alias("leaf"),
        F.coalesce("changed", "node").alias("tampered"),
        F.col("group_root").alias("subroot"),
        "root",
        "before",
        "after",
    )


def verified(found: DataFrame) -> DataFrame:
    """Rows of a manifest with their proof's digest, the root folded from ``tampered``, and whether it holds."""
    before, after = F.col("before"), F.col("after")
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof(before, after).alias("proof_sha256"),
        folded(F.col("tampered"), before, after).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


#: DuckDB twin over table ``documents``. The checksum is the usual one, bit by bit.
SQL = f"""
WITH RECURSIVE crc_bits AS (
  SELECT range AS byte, range AS x, 0 AS k FROM range(256)
  UNION ALL
  SELECT byte, CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, k + 1 FROM crc_bits WHERE k < 8
), crc_table AS (
  SELECT byte, x FROM crc_bits WHERE k = 8
), ids AS (
  SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL
), crc_run AS (
  SELECT doc_id, s, 4294967295 AS c, 0 AS i FROM ids
  UNION ALL
  SELECT doc_id, s, xor(c // 256, x), i + 1
  FROM crc_run JOIN crc_table ON byte = xor(c % 256, CAST(ascii(s[i + 1]) AS BIGINT)) WHERE i < len(s)
), crcs AS (
  SELECT doc_id, xor(c, 4294967295) AS crc FROM crc_run WHERE i = len(s)
), fields AS (
  SELECT d.doc_id, source, text, crc,
    {" || ".join(f"coalesce(strlen(CAST({'d.' if c == 'doc_id' else ''}{c} AS VARCHAR)) || ':' || CAST({'d.' if c == 'doc_id' else ''}{c} AS VARCHAR), '-')" for c in FIELDS[:-1])} AS head,
    replace(text, chr(10), '') AS cut
  FROM documents d LEFT JOIN crcs ON d.doc_id = crcs.doc_id
), leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN crc % 2 = 0 THEN sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) END AS changed
  FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS row_no
  FROM leaves
), tree AS (
  SELECT source, CAST(0 AS BIGINT) AS level, CAST(pos AS BIGINT) AS pos, leaf AS node, CAST(n AS BIGINT) AS n FROM placed
  UNION ALL
  SELECT source, level + 1, pos // {ARITY}, sha256(string_agg(node, '' ORDER BY pos)), (n + {ARITY - 1}) // {ARITY}
  FROM tree WHERE n > 1 GROUP BY source, level, pos // {ARITY}, n
), tops AS (
  SELECT source, level AS height, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM tree WHERE n = 1
), over_tree AS (
  SELECT CAST(0 AS BIGINT) AS level, CAST(pos AS BIGINT) AS pos, node, CAST(n AS BIGINT) AS n FROM tops
  UNION ALL
  SELECT level + 1, pos // {ARITY}, sha256(string_agg(node, '' ORDER BY pos)), (n + {ARITY - 1}) // {ARITY}
  FROM over_tree WHERE n > 1 GROUP BY level, pos // {ARITY}, n
), powers AS (
  SELECT range AS level, CAST({ARITY} ** range AS BIGINT) AS size FROM range(30)
), beside AS (
  SELECT p.row_no, t.level, t.pos, t.node, t.pos < p.pos // size AS is_left
  FROM placed p JOIN powers w ON true JOIN tree t
    ON t.source IS NOT DISTINCT FROM p.source AND t.level = w.level AND t.pos // {ARITY} = p.pos // size // {ARITY} AND t.pos <> p.pos // size
  WHERE t.n > 1
  UNION ALL
  SELECT p.row_no, s.height + t.level, t.pos, t.node, t.pos < s.pos // size
  FROM placed p JOIN tops s ON s.source IS NOT DISTINCT FROM p.source JOIN powers w ON true JOIN over_tree t
    ON t.level = w.level AND t.pos // {ARITY} = s.pos // size // {ARITY} AND t.pos <> s.pos // size
  WHERE t.n > 1
), sides AS (
  SELECT row_no, level, coalesce(string_agg(node, '' ORDER BY pos) FILTER (is_left), '') AS l,
    coalesce(string_agg(node, '' ORDER BY pos) FILTER (NOT is_left), '') AS r
  FROM beside GROUP BY row_no, level
), proofs AS (
  SELECT row_no, sha256(string_agg(l || r, '' ORDER BY level)) AS proof FROM sides GROUP BY row_no
), whole AS (
  SELECT max(level) AS height FROM over_tree
), fold AS (
  SELECT row_no, CAST(0 AS BIGINT) AS level, coalesce(changed, leaf) AS digest, s.height + whole.height AS height
  FROM placed p JOIN tops s ON s.source IS NOT DISTINCT FROM p.source CROSS JOIN whole
  UNION ALL
  SELECT f.row_no, f.level + 1, sha256(coalesce(l, '') || digest || coalesce(r, '')), height
  FROM fold f LEFT JOIN sides s ON s.row_no = f.row_no AND s.level = f.level WHERE f.level < height
)
SELECT p.doc_id, leaf, s.node AS subroot, o.node AS root, coalesce(proof, sha256('')) AS proof_sha256,
  f.digest AS folded_root, f.digest = o.node AS verified
FROM placed p JOIN tops s ON s.source IS NOT DISTINCT FROM p.source
JOIN fold f ON f.row_no = p.row_no AND f.level = f.height LEFT JOIN proofs q ON q.row_no = p.row_no
JOIN (SELECT node FROM over_tree WHERE n = 1) o ON true
"""
