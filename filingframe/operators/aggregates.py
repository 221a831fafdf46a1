"""Grouping, counting and summaries."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from filingframe.operators.frame import Names, first_present, present, union_letters
from filingframe.operators.quantiles import exact_quantiles

# Where the year of a letter is read from, in this order.
YEAR_COLUMNS = ("publish_date_time", "publish_date", "sent_date_time", "date")


def symbol_year(
    df: DataFrame, order: Names = ("publish_date_time", "tracing_no")
) -> DataFrame:
    """Per symbol and Jalali year: count, first company name, letter codes by appearance.

    Rows are first reduced per code, map-side, so even a symbol that holds a
    third of all letters reaches the second grouping as a handful of rows.
    """
    date = first_present(df, YEAR_COLUMNS)
    if date is None or "symbol" not in df.columns:
        return df
    when = F.struct(*[F.col(c) for c in present(df, order)])
    parts = [F.count(F.lit(1)).alias("n"), F.min(when).alias("seen")]
    out = [F.sum("n").alias("announcement_count")]
    keys = [F.col("symbol"), F.substring(date, 1, 4).alias("year")]
    if "company_name" in df.columns:
        named = F.when(F.col("company_name").isNotNull(), F.struct(when, F.col("company_name")))
        parts.append(F.min(named).alias("named"))
        out.append(F.min("named")["company_name"].alias("company_name"))
    if "letter_code" in df.columns:
        keys.append(F.col("letter_code"))
        by_appearance = F.array_sort(F.collect_list(F.struct("seen", "letter_code")))
        out.append(by_appearance["letter_code"].alias("letter_code"))
    per_code = df.where(F.col("symbol").isNotNull()).groupBy(*keys).agg(*parts)
    return per_code.groupBy("symbol", "year").agg(*out)


@dataclass(frozen=True)
class MergeableAggregate:
    """A user aggregate in two steps, so that no task ever holds a whole group.

    ``partial`` reduces any chunk of a group to one row of ``state``; ``merge``
    reduces a frame of such rows to one row of the same state; ``finish`` turns
    the state columns into the result.
    """

    partial: Callable[[pd.DataFrame], dict]
    merge: Callable[[pd.DataFrame], dict]
    finish: Callable[[], Column]
    state: str


def _chunk_states(
    df: DataFrame, keys: list[str], column: str, spec: MergeableAggregate
) -> DataFrame:
    """One state row per group and Arrow batch, before any exchange."""
    key_types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)

    def reduce_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                {**dict(zip(keys, key, strict=True)), **spec.partial(part)}
                for key, part in batch.groupby(keys, dropna=True)
            ]
            if rows:
                yield pd.DataFrame(rows)

    rows = df.select(*keys, column).na.drop(subset=keys)
    return rows.mapInPandas(reduce_batches, f"{key_types}, {spec.state}")


def merge_aggregate(
    df: DataFrame, keys: list[str], column: str, spec: MergeableAggregate, name: str, fan_in: int = 64
) -> DataFrame:
    """Reduce chunk states through a salted level, then per group."""
    states = _chunk_states(df, keys, column, spec)
    fields = [c for c in states.columns if c not in keys]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in states.schema)

    def merged(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{**dict(zip(keys, key, strict=False)), **spec.merge(part[fields])}])

    salt = F.pmod(F.spark_partition_id(), F.lit(fan_in)).alias("_salt")
    salted = states.groupBy(*keys, salt).applyInPandas(merged, schema)
    final = salted.groupBy(*keys).applyInPandas(merged, schema)
    return final.select(*keys, spec.finish().alias(name))


class OversizedGroup(ValueError):
    """A group that an arbitrary function would have to hold in one task, and that is too large for it."""


@dataclass(frozen=True)
class GroupFunction:
    """Any function of all values of a group, as one pandas Series, in the order of ``order``.

    ``returns`` is the type of its result. Groups are measured first, and a group beyond
    ``max_rows`` or ``max_bytes`` is refused by name, before any task holds one; such data
    needs a :class:`MergeableAggregate`. Rows that tie in ``order`` stand in order of their values.
    """

    fn: Callable[[pd.Series], object]
    returns: str
    order: Names = ()
    max_rows: int = 1_000_000
    max_bytes: int = 256 << 20


def apply_group_function(
    df: DataFrame, keys: list[str], column: str, spec: GroupFunction, name: str
) -> DataFrame:
    """``keys, name``: the function's result for every group without a null key. Runs one job when called."""
    order = present(df, spec.order)
    rows = df.na.drop(subset=keys).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
        F.col(column).alias("_value"),
    )
    own = [f"_k{i}" for i in range(len(keys))]
    by = [*(f"_o{i}" for i in range(len(order))), "_value"]
    weight = F.octet_length(F.col("_value").cast("string"))
    sizes = rows.groupBy(*own).agg(
        F.count(F.lit(1)).alias("_rows"), F.coalesce(F.sum(weight), F.lit(0)).alias("_bytes")
    )
    large = sizes.filter((F.col("_rows") > spec.max_rows) | (F.col("_bytes") > spec.max_bytes))
    worst = large.orderBy(F.desc("_rows"), *own).first()
    if worst:
        named = ", ".join(f"{k}={worst[o]!r}" for k, o in zip(keys, own, strict=True))
        raise OversizedGroup(
            f"group {named} has {worst['_rows']} rows and {worst['_bytes']} bytes of {column!r};"
            f" a function of whole groups takes {spec.max_rows} rows and {spec.max_bytes} bytes"
        )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*own).schema)
    schema = f"{kinds}, _out {spec.returns}"
    returns = rows.sparkSession.createDataFrame([], schema).schema["_out"].dataType
    if isinstance(rows.schema["_value"].dataType, _PLAIN) and isinstance(returns, _PLAIN):
        out = _apply_in_order(rows, own, by, column, spec, schema, to_arrow_type(returns))
    else:

        def apply(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            values = part.sort_values(by, ignore_index=True)["_value"].rename(column)
            return pd.DataFrame([{**dict(zip(own, key, strict=True)), "_out": spec.fn(values)}])

        out = rows.groupBy(*own).applyInPandas(apply, schema)
    return out.select(*[F.col(o).alias(k) for k, o in zip(keys, own, strict=True)], F.col("_out").alias(name))


# Types whose values Arrow and pandas exchange as they are.
_PLAIN = (T.IntegralType, T.FloatType, T.DoubleType, T.BooleanType, T.StringType, T.DecimalType)


def _apply_in_order(
    rows: DataFrame, own: list[str], by: list[str], column: str, spec: GroupFunction, schema: str, returns: pa.DataType
) -> DataFrame:
    """The function of each group, of rows that Spark has sorted: a batch holds many groups, a large group many batches."""

    def ordered(c: str) -> Column:
        kind = rows.schema[c].dataType
        number = isinstance(kind, T.FloatType | T.DoubleType)
        # as pandas sorts: what is missing or not a number comes last
        return (F.when(~F.isnan(c), F.col(c)) if number else F.col(c)).asc_nulls_last()

    def results(found: list[object]) -> pa.Array:
        def of(values: list[object]) -> pa.Array:
            one = pd.Series(values, dtype=object) if len(values) > 1 else pd.Series(values)
            return pa.Array.from_pandas(one, mask=one.isnull(), type=returns, safe=False)

        try:
            return of(found)
        except (pa.ArrowInvalid, pa.ArrowTypeError):
            return pa.concat_arrays([of([value]) for value in found])

    def groups(batch: pa.RecordBatch) -> list[int]:
        """Where groups begin, and the end."""
        new = np.zeros(max(batch.num_rows - 1, 0), bool)
        for k in range(len(own)):
            keys = batch.column(k)
            new |= pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
        return [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the group that the last batch ended with: its key, and its values in pieces
        last: list | None = None
        pieces: list[pa.Array] = []

        def result(values: pa.Array) -> object:
            return spec.fn(values.to_pandas().rename(column))

        for batch in batches:
            if not batch.num_rows:
                continue
            starts = groups(batch)
            values = batch.column(batch.num_columns - 1)
            whole = None if values.null_count else values.to_pandas().array
            first = [batch.column(k)[0] for k in range(len(own))]
            done: list[list] = []
            found: list[object] = []
            at = 0
            if last is not None:
                if all(a == b for a, b in zip(first, last, strict=True)):
                    pieces.append(values[: starts[1]])
                    at = 1
                if at == 0 or len(starts) > 2:
                    done.append(last)
                    found.append(result(pa.concat_arrays(pieces)))
                    last = None
            for start, end in zip(starts[at:-2], starts[at + 1 : -1], strict=True):
                if whole is None:
                    found.append(result(values[start:end]))
                else:
                    found.append(spec.fn(pd.Series(whole[start:end], name=column)))
            inner = starts[at:-2]
            if last is None:
                last, pieces = [batch.column(k)[starts[-2]] for k in range(len(own))], [values[starts[-2] :]]
            if found:
                columns = [
                    pa.concat_arrays([pa.array([d[k] for d in done], batch.column(k).type), batch.column(k).take(pa.array(inner, pa.int64()))])
                    for k in range(len(own))
                ]
                yield pa.RecordBatch.from_arrays([*columns, results(found)], names=[*own, "_out"])
        if last is not None:
            keys = [pa.array([value], value.type) for value in last]
            yield pa.RecordBatch.from_arrays([*keys, results([result(pa.concat_arrays(pieces))])], names=[*own, "_out"])

    placed = rows.repartition(*own).sortWithinPartitions(*own, *map(ordered, by))
    return placed.select(*own, "_value").mapInArrow(run, schema)


def _built_in(name: str, column: str, order: Names | None) -> Column:
    c = F.col(column)
    if name in ("first", "last"):
        if order is None:
            raise ValueError("first/last need an explicit order")
        keys = [order] if isinstance(order, str) else list(order)
        row = F.when(c.isNotNull(), F.struct(*[F.col(k) for k in keys], c.alias("_value")))
        return (F.min(row) if name == "first" else F.max(row))["_value"]
    functions = {
        "sum": F.sum,
        "mean": F.avg,
        "avg": F.avg,
        "min": F.min,
        "max": F.max,
        "count": F.count,
        "size": lambda _: F.count(F.lit(1)),
        "nunique": F.count_distinct,
        "std": F.stddev_samp,
        "var": F.var_samp,
    }
    if name not in functions:
        raise ValueError(f"unknown aggregation: {name}")
    return functions[name](c)


Aggregation = str | Callable[[Column], Column] | MergeableAggregate | GroupFunction


def group_by(
    df: DataFrame,
    columns: Names,
    aggregations: Mapping[str, Aggregation],
    order: Names | None = None,
) -> DataFrame:
    """Group and aggregate; results keep the source column's name.

    An aggregation is a function name, a Column function, a :class:`MergeableAggregate`,
    or a :class:`GroupFunction`. Null keys are dropped; with no valid column
    the frame is returned unchanged.
    """
    keys = present(df, columns)
    wanted = {c: f for c, f in aggregations.items() if c in df.columns}
    if not keys or not wanted:
        return df
    rows = df.na.drop(subset=keys)
    plain: dict[str, Column] = {}
    joined: list[DataFrame] = []
    medians: list[str] = []
    for column, how in wanted.items():
        if isinstance(how, MergeableAggregate):
            joined.append(merge_aggregate(rows, keys, column, how, column))
        elif isinstance(how, GroupFunction):
            joined.append(apply_group_function(rows, keys, column, how, column))
        elif how == "median":
            medians.append(column)
        else:
            plain[column] = how(F.col(column)) if callable(how) else _built_in(how, column, order)
    simple = [c.alias(n) for n, c in plain.items()] or [F.count(F.lit(1)).alias("_rows")]
    if medians:
        # the first median's pass takes the simple aggregates too
        out = exact_quantiles(rows, keys, medians[0], [0.5], also=simple).withColumnRenamed("q0", medians[0])
        joined += [exact_quantiles(rows, keys, c, [0.5]).withColumnRenamed("q0", c) for c in medians[1:]]
    else:
        out = rows.groupBy(*keys).agg(*simple)
    for part in joined:
        out = out.join(part, keys, "left")
    return out.select(*keys, *wanted)


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Frequency of each non-null value."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))
    )


def top_values(df: DataFrame, column: str, k: int = 10, name: str = "count") -> DataFrame:
    """The ``k`` most frequent values, ties by value."""
    return value_counts(df, column, name).orderBy(F.desc(name), F.asc(column)).limit(k)


def distinct_count(df: DataFrame, columns: Names, approximate: bool = False) -> DataFrame:
    names = present(df, columns)
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(n).alias(n) for n in names])


def board_summary(
    members: DataFrame, errors: DataFrame | None = None, urls: DataFrame | None = None
) -> DataFrame:
    """Ten ``(metric, value)`` rows about a board load."""
    # all three tables go through one aggregate, told apart by their origin
    parts = [members.withColumn("_of", F.lit("member"))]
    if errors is not None:
        parts.append(errors.select("url", F.lit("error").alias("_of")))
    if urls is not None:
        parts.append(urls.select("url", F.lit("url").alias("_of")))
    kept = ["_of", "url", "company", "new_member", "date", "is_independent", "has_multiple_executive"]

    def urls_of(origin: str) -> Column:
        return F.count_distinct(F.when(F.col("_of") == origin, F.col("url")))

    one = union_letters(*[p.select(*present(p, kept)) for p in parts]).agg(
        F.count_if(F.col("_of") == "member").alias("records"),
        F.count_distinct("company").alias("companies"),
        F.count_distinct("new_member").alias("members"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
        F.count_if("is_independent").alias("independent"),
        F.count_if("has_multiple_executive").alias("multi"),
        urls_of("member").alias("succeeded"),
        F.count_if(F.col("_of") == "error").alias("errors"),
        urls_of("error").alias("failed"),
        urls_of("url").alias("listed"),
    )
    listed = F.col("listed") if urls is not None else F.col("succeeded") + F.col("failed")
    one = one.withColumn("processed", listed)

    def line(metric: str, value: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), value.cast("string").alias("value"))

    span = F.when(F.col("records") > 0, F.concat_ws(" - ", "first", "last")).otherwise("")
    lines = [
        line("Total Records", F.col("records")),
        line("Unique Companies", F.col("companies")),
        line("Unique Board Members", F.col("members")),
        line("Date Range", span),
        line("Independent Members", F.col("independent")),
        line("Members with Multiple Executive Roles", F.col("multi")),
        line("URLs Processed", F.col("processed")),
        line("URLs Succeeded", F.col("succeeded")),
        line("URLs Failed", F.col("failed")),
        line("Error Count", F.col("errors")),
    ]
    return one.select(F.inline(F.array(*lines)))


def error_summary(errors: DataFrame) -> DataFrame:
    """Errors and recoverable errors per type, with a grand total row."""
    counts = [
        F.count(F.lit(1)).alias("errors"),
        F.count_if("recoverable").alias("recoverable"),
    ]
    per_type = errors.groupBy("error_type").agg(*counts)
    total = per_type.agg(
        F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"),
        F.coalesce(F.sum("recoverable"), F.lit(0)).alias("recoverable"),
    ).select(F.lit("total").alias("error_type"), "errors", "recoverable")
    return per_type.unionByName(total)


def failed_urls(errors: DataFrame) -> DataFrame:
    """URLs of all errors, as rows: the list is as long as the error log."""
    return errors.select("url", "error_type")


def fetch_metrics(log: DataFrame, by: Names = ()) -> DataFrame:
    """Success rate, cache hit rate, duration and items of a fetch run.

    ``log`` has ``status`` (ok/failed), ``from_cache``, ``items``, ``started``.
    """
    keys = [by] if isinstance(by, str) else list(by)
    fetched = F.count(F.lit(1))
    failed = F.count_if(F.col("status") == "failed")
    hits = F.count_if(F.col("from_cache"))
    seconds = F.max(F.unix_micros("started")) - F.min(F.unix_micros("started"))

    def percent(part: Column) -> Column:
        return F.round(part / F.greatest(fetched, F.lit(1)) * 100, 2)

    return log.groupBy(*keys).agg(
        fetched.alias("pages_fetched"),
        failed.alias("pages_failed"),
        F.coalesce(F.sum("items"), F.lit(0)).alias("items"),
        percent(fetched - failed).alias("success_rate"),
        percent(hits).alias("cache_hit_rate"),
        F.floor(seconds / 1_000_000).cast("bigint").alias("duration_seconds"),
    )
