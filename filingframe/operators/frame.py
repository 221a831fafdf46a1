"""Row and column operators over any DataFrame.

Columns that do not exist are ignored, which is decided from metadata alone.
Whatever depends on row position takes an explicit ``order``; ties are broken
by the remaining columns, so results do not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingframe import dims
from filingframe.functions.text import norm_text
from filingframe.functions.urls import DEFAULT_BASE_URL, full_url, is_http, letter_url
from filingframe.session import ensure_checkpoint_dir

Names = str | Sequence[str]

# Where a date is looked for, in this order.
DATE_COLUMNS = ("publish_date", "sent_date_time", "sent_date", "date")


def _list(names: Names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def present(df: DataFrame, names: Names | None) -> list[str]:
    return [n for n in _list(names or []) if n in df.columns]


def first_present(df: DataFrame, names: Iterable[str]) -> str | None:
    return next((n for n in names if n in df.columns), None)


def total_order(df: DataFrame, order: Names) -> list[Column]:
    """The given order, then every other sortable column as tie-breaker."""
    head = _list(order)
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in head and not isinstance(f.dataType, T.MapType | T.VariantType)
    ]
    return [F.col(n) for n in head + rest]


# ---------------------------------------------------------------- projections


def select_columns(df: DataFrame, columns: Names) -> DataFrame:
    """Columns in the caller's order; unchanged when none exists."""
    found = present(df, columns)
    return df.select(*found) if found else df


def drop_columns(df: DataFrame, columns: Names) -> DataFrame:
    return df.drop(*_list(columns))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def add_column(
    df: DataFrame, name: str, value: object | Column | Callable[[DataFrame], Column]
) -> DataFrame:
    """Constant, Column, or a function of the frame returning a Column."""
    if callable(value) and not isinstance(value, Column):
        value = value(df)
    return df.withColumn(name, value if isinstance(value, Column) else F.lit(value))


def apply_to_column(
    df: DataFrame,
    column: str,
    func: Callable[[Column], Column],
    new_column: str | None = None,
) -> DataFrame:
    """Overwrite a column, or add one; a missing column leaves the frame as it is.

    ``func`` maps a Column to a Column; a ``pandas_udf`` is such a function too.
    """
    if column not in df.columns:
        return df
    return df.withColumn(new_column or column, func(F.col(column)))


def fill_na(df: DataFrame, value: object = "", columns: Names | None = None) -> DataFrame:
    """Fill nulls. Named columns take the value's type if theirs cannot hold it."""
    if columns is None:
        return df.fillna(value)
    literal = F.lit(value)
    kinds = dict(df.dtypes)
    as_text = isinstance(value, str)
    filled = {
        n: F.coalesce(
            F.col(n).cast("string") if as_text and kinds[n] != "string" else F.col(n), literal
        )
        for n in present(df, columns)
    }
    return df.withColumns(filled) if filled else df


def add_letter_descriptions(df: DataFrame) -> DataFrame:
    """Left join with the 41-row code table (fixed size, so always broadcast)."""
    if "letter_code" not in df.columns:
        return df
    codes = F.broadcast(dims.letter_codes(df.sparkSession))
    return df.join(codes, "letter_code", "left").select(*df.columns, "letter_description")


def add_letter_codes(df: DataFrame, description: str = "letter_description") -> DataFrame:
    """Reverse lookup: code of a description."""
    codes = dims.letter_codes(df.sparkSession).withColumnRenamed("letter_description", description)
    return df.join(F.broadcast(codes), description, "left").select(*df.columns, "letter_code")


def add_company_type(df: DataFrame, alias: str) -> DataFrame:
    types = dims.company_types(df.sparkSession).withColumnRenamed("alias", alias)
    return df.join(F.broadcast(types), alias, "left").select(*df.columns, "company_type")


def letter_urls(letters: DataFrame, base_url: str = DEFAULT_BASE_URL) -> DataFrame:
    """URL table of letters; letters that yield no URL are left out."""

    def field(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) if name in letters.columns else F.lit("")

    return letters.select(
        letter_url("url", "tracing_no", base_url).alias("url"),
        field("symbol").alias("symbol"),
        field("company_name").alias("company_name"),
        field("tracing_no").alias("tracing_no"),
        field("letter_code").alias("letter_code"),
        field("sent_date_time").alias("sent_date"),
        field("publish_date_time").alias("publish_date"),
    ).where(F.col("url").isNotNull())


# -------------------------------------------------------------------- filters


def filter_by_letter_code(df: DataFrame, codes: Names) -> DataFrame:
    return df.where(F.col("letter_code").isin(_list(codes))) if "letter_code" in df.columns else df


def filter_by_date_range(
    df: DataFrame,
    start: str | None = None,
    end: str | None = None,
    date_column: str | None = None,
    end_of_day: bool = False,
) -> DataFrame:
    """Inclusive text comparison of Jalali dates; null dates never pass.

    A bare end date excludes later times on that day unless ``end_of_day``.
    With a ``jalali_year`` column the range also prunes partitions.
    """
    name = first_present(df, [c for c in (date_column, "publish_date_time", *DATE_COLUMNS) if c])
    if name is None:
        return df
    value = F.col(name)
    tests = []
    if start:
        tests.append(value >= start)
    if end:
        tests.append((F.substring(value, 1, 10) if end_of_day else value) <= end)
    if "jalali_year" in df.columns:
        year = F.col("jalali_year")
        tests += [year >= int(start[:4])] if start else []
        tests += [year <= int(end[:4])] if end else []
    return df.where(reduce(Column.__and__, tests)) if tests else df


def filter_by_symbols(df: DataFrame, symbols: Names | DataFrame, key: str = "symbol") -> DataFrame:
    """Rows whose normalised symbol is listed; the list may be a DataFrame."""
    if key not in df.columns:
        return df
    if isinstance(symbols, DataFrame):
        wanted = symbols.select(norm_text(key).alias("_wanted")).distinct()
        return df.join(wanted, norm_text(df[key]) == F.col("_wanted"), "left_semi")
    return df.where(norm_text(key).isin([norm_text(F.lit(s)) for s in _list(symbols)]))


def filter_by_condition(
    df: DataFrame, condition: Column | Callable[[DataFrame], Column]
) -> DataFrame:
    return df.where(condition if isinstance(condition, Column) else condition(df))


def filter_valid_urls(df: DataFrame, url_column: str = "url") -> DataFrame:
    if url_column not in df.columns:
        raise ValueError(f"column '{url_column}' not found")
    return df.where(is_http(url_column))


def filter_year_between(df: DataFrame, first: int, last: int, column: str = "year") -> DataFrame:
    """Numeric year in range; non-numeric years are dropped."""
    return df.where(F.col(column).try_cast("double").between(first, last))


def filter_non_empty(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.size(column) > 0)


# --------------------------------------------------------- duplicates and sets


def drop_duplicates(
    df: DataFrame,
    subset: Names | None = None,
    keep: str | bool = "last",
    order: Names | None = None,
) -> DataFrame:
    """One row per key (``first``/``last`` by ``order``, or ``any``) or, with
    ``keep=False``, only keys that occur once. Null keys are equal.

    ``row_number() = 1`` is limited per key before the exchange, so a key that
    holds much of the table sends one row per task, not its whole group.
    """
    keys = present(df, subset) if subset is not None else df.columns
    if not keys:
        return df
    rest = [c for c in df.columns if c not in keys]
    if keep is False:
        rows = [F.any_value(c).alias(c) for c in rest]
        once = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *rows)
        return once.where("_n = 1").select(*df.columns)
    if not rest or keep == "any":
        return df.dropDuplicates(keys)
    if keep not in ("first", "last") or order is None:
        raise ValueError("keep='first' or 'last' needs an explicit order")
    sort = [c.asc() if keep == "first" else c.desc() for c in total_order(df, order)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*sort)))
    return ranked.where("_rank = 1").drop("_rank")


def anti_join(df: DataFrame, done: DataFrame, key: str = "url") -> DataFrame:
    """Rows whose trimmed, non-null key is not yet in ``done``."""
    left = df.where(F.col(key).isNotNull())
    seen = done.where(F.col(key).isNotNull()).select(F.trim(key).alias("_seen"))
    return left.join(seen, F.trim(left[key]) == F.col("_seen"), "left_anti")


def page_outcomes(pages: DataFrame, query: str) -> DataFrame:
    """Per query: whether its first page came (``started``), pages that failed, pages collected."""
    ok = F.col("ok")
    counted = pages.groupBy(query).agg(
        F.bool_or((F.col("page") == 1) & ok).alias("started"),
        F.count_if(~ok).alias("failed"),
        F.count_if(ok).alias("_ok"),
    )
    collected = F.when(F.col("started"), F.col("_ok")).otherwise(F.lit(0).cast("bigint"))
    return counted.select(query, "started", "failed", collected.alias("collected"))


def collect_pages(pages: DataFrame, query: str) -> DataFrame:
    """Pages of a paged collection (``query, page, ok, ...``) that can be used.

    Failed pages are skipped. A query whose first page failed or never came is empty.
    """
    started = pages.where("page = 1 and ok").select(query).distinct()
    return pages.where("ok").join(started, query, "left_semi").drop("ok")


def union_letters(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tagged_union(frames: Mapping[str, DataFrame], tag: str) -> DataFrame:
    return union_letters(*[f.withColumn(tag, F.lit(name)) for name, f in frames.items()])


# -------------------------------------------------------- order, pages, batches


def sort_by(df: DataFrame, columns: Names, ascending: bool | Sequence[bool] = True) -> DataFrame:
    """Sort by several keys, nulls last in both directions."""
    names = _list(columns)
    flags = [ascending] * len(names) if isinstance(ascending, bool) else list(ascending)
    keys = [
        F.col(n).asc_nulls_last() if up else F.col(n).desc_nulls_last()
        for n, up in zip(names, flags, strict=True)
        if n in df.columns
    ]
    return df.orderBy(*keys) if keys else df


def head(df: DataFrame, n: int, order: Names) -> DataFrame:
    return df.orderBy(*total_order(df, order)).limit(n)


def tail(df: DataFrame, n: int, order: Names) -> DataFrame:
    return df.orderBy(*[c.desc() for c in total_order(df, order)]).limit(n)


def sample_rows(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """``n`` random rows (all rows if there are fewer).

    The order is a hash of the row, so the sample does not depend on partitioning.
    """
    return df.orderBy(F.xxhash64(F.lit(seed), *df.columns), *df.columns).limit(n)


def page_of(df: DataFrame, order: Names, page: int, size: int = 10) -> DataFrame:
    """One page by offset; use :func:`page_after` or :func:`row_numbers` for deep pages."""
    return df.orderBy(*total_order(df, order)).offset((page - 1) * size).limit(size)


def page_after(df: DataFrame, key: str, last_seen: object, size: int = 10) -> DataFrame:
    """The page that follows a unique key: the bound is pushed into the scan."""
    return df.where(F.col(key) > F.lit(last_seen)).orderBy(key).limit(size)


def pagination(df: DataFrame, page: int = 1, size: int = 10) -> DataFrame:
    """Totals of a result set and whether the page has neighbours."""
    pages = F.ceil(F.col("total_results") / F.lit(float(size))).cast("bigint")
    return (
        df.agg(F.count(F.lit(1)).alias("total_results"))
        .select(F.lit(page).alias("current_page"), pages.alias("total_pages"), "total_results")
        .withColumn("has_next", F.col("current_page") < F.col("total_pages"))
        .withColumn("has_previous", F.col("current_page") > 1)
    )


def row_numbers(
    df: DataFrame, order: Names, name: str = "row_no", partitions: int | None = None
) -> DataFrame:
    """Consecutive numbers from 1 in a global order, without a single-task window.

    Rows are range-partitioned and sorted, then written to the checkpoint folder
    with their position inside the partition; only one count per partition is
    summed up to turn these into global numbers. The checkpoint also keeps the
    numbers stable when an executor is lost. Runs one job when called.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    keys = total_order(df, order)
    # without a number, adaptive execution sizes the ranges by what they hold
    count = [partitions] if partitions else []
    placed = (
        df.repartitionByRange(*count, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
        .checkpoint()
        # the id holds the partition above bit 33 and the row within it below
        .withColumn("_part", F.shiftright("_at", 33))
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    # one row per range partition, so this window is as small as the partition count
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    number = F.col("_offset") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(F.broadcast(offsets), "_part").select(*df.columns, number.alias(name))


def assign_batches(
    df: DataFrame, size: int, order: Names, name: str = "batch", partitions: int | None = None
) -> DataFrame:
    """Fixed-size batches from 0 in a global order."""
    numbered = row_numbers(df, order, "_row", partitions)
    return numbered.withColumn(name, F.expr(f"(_row - 1) div {int(size)}")).drop("_row")


def paginate(df: DataFrame, order: Names, size: int = 10) -> DataFrame:
    """Every row with its 1-based page number."""
    return assign_batches(df, size, order, "page").withColumn("page", F.col("page") + 1)


def download_manifest(
    letters: DataFrame,
    order: Names = ("publish_date_time", "tracing_no"),
    max_files: int | None = None,
    base_url: str = DEFAULT_BASE_URL,
) -> DataFrame:
    """Spreadsheets to fetch with their planned file names, numbered in order."""
    files = letters.where(F.coalesce(F.col("excel_url"), F.lit("")) != "")
    if max_files is None:
        numbered = row_numbers(files, order, "n")
    else:
        # at most max_files rows reach this window
        numbered = head(files, max_files, order).withColumn(
            "n", F.row_number().over(Window.orderBy(*total_order(files, order))).cast("bigint")
        )
    day = F.substring(F.replace(F.coalesce("publish_date_time", F.lit("")), F.lit("/"), F.lit("-")), 1, 10)
    plain = F.concat_ws(
        "_", F.coalesce("symbol", F.lit("Unknown")), day, F.concat(F.col("n"), F.lit(".xls"))
    )
    return numbered.select(
        "n",
        "tracing_no",
        full_url("excel_url", base_url).alias("excel_url"),
        F.regexp_replace(plain, r'[<>:"/\\|?*]', "_").alias("filename"),
    )


# -------------------------------------------------------------------- metrics


def observed(df: DataFrame, step: str) -> tuple[DataFrame, Observation]:
    """Row count of a step, collected while the plan runs anyway."""
    watch = Observation(step)
    return df.observe(watch, F.count(F.lit(1)).alias("rows")), watch


class Steps:
    """A chain of operators that notes ``step: before -> after`` row counts.

    Counts are observed while the final frame runs; :meth:`log` waits for that.
    """

    def __init__(self, df: DataFrame):
        self.df, first = observed(df, "start")
        self._names: list[str] = []
        self._watches = [first]

    def then(self, operator: Callable[..., DataFrame], *args: object, **options: object) -> Steps:
        name = getattr(operator, "__name__", "step")
        self.df, watch = observed(self.df.transform(operator, *args, **options), name)
        self._names.append(name)
        self._watches.append(watch)
        return self

    def log(self) -> list[str]:
        counts = [watch.get["rows"] for watch in self._watches]
        return [f"{n}: {a} -> {b}" for n, a, b in zip(self._names, counts[:-1], counts[1:], strict=True)]
