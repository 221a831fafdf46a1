"""Compare named queries with their SQL twins in DuckDB.

Run as a script: ``python tests/oracle.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(path: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet'")
    return con


def _cell(value: object) -> object:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return f"f{value:.9g}"
    if hasattr(value, "as_py"):
        return value.as_py()
    return value


_KINDS = {"int64": "long", "int32": "int", "double": "double", "bool": "bool"}


def _kind(arrow_type: object) -> str:
    name = str(arrow_type)
    if "string" in name or "utf8" in name:
        return "string"
    return _KINDS.get(name, name)


def compare(spark, con, fn, sql: str, path: str) -> str | None:
    """None when equal, else what differs."""
    ours = fn(spark, path).toArrow()
    theirs = con.execute(sql).to_arrow_table()
    names = sorted(ours.column_names)
    if names != sorted(theirs.column_names):
        return f"columns {names} vs {sorted(theirs.column_names)}"
    kinds = [
        (n, _kind(ours.schema.field(n).type), _kind(theirs.schema.field(n).type)) for n in names
    ]
    wrong = [k for k in kinds if k[1] != k[2]]
    if wrong:
        return f"types {wrong}"

    def rows(table) -> Counter:
        columns = [table.column(n).to_pylist() for n in names]
        return Counter(tuple(map(_cell, row)) for row in zip(*columns, strict=True))

    a, b = rows(ours), rows(theirs)
    if a != b:
        only_a, only_b = list((a - b).items())[:3], list((b - a).items())[:3]
        return f"rows {ours.num_rows} vs {theirs.num_rows}\n  spark: {only_a}\n  sql:   {only_b}"
    if ours.num_rows == 0:
        return "both empty"
    return None


def main() -> int:
    import __spark_entry__ as entry

    from filingframe.session import get_session

    path = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = get_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(path)
    bad = 0
    sqls = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if only and not any(o in name for o in only):
            continue
        started = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, fn, sqls[name], path)
            else:
                problem = None if fn(spark, path).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        mark = "ok" if problem is None else "BAD"
        kind = "sql" if name in sqls else "rows"
        print(f"{mark:4}{kind:5}{time.time() - started:6.1f}s {name} {problem or ''}", flush=True)
        bad += problem is not None
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    raise SystemExit(1 if main() else 0)
