"""Writers. Every sink is a folder written in parallel."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingframe.operators.frame import letter_urls

BOM = "\ufeff"


def write_parquet(
    df: DataFrame,
    path: str,
    compression: str = "snappy",
    partition_by: str | None = None,
    mode: str = "overwrite",
) -> None:
    """Parquet, optionally partitioned; rebalancing splits a hot partition value."""
    if partition_by:
        df = df.hint("rebalance", partition_by)
    writer = df.write.mode(mode).option("compression", compression)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def _flat(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, times as text."""

    def plain(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
            return F.to_json(field.name).alias(field.name)
        return F.col(field.name)

    return df.select(*map(plain, df.schema.fields))


def write_csv(df: DataFrame, path: str, bom: bool = True, mode: str = "overwrite") -> None:
    """CSV with a header; the mark before it makes spreadsheets read UTF-8."""
    flat = _flat(df)
    if bom:
        flat = flat.withColumnRenamed(flat.columns[0], BOM + flat.columns[0])
    flat.write.mode(mode).option("header", True).option("encoding", "UTF-8").csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, times as text, letters unescaped."""
    times = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType | T.DateType)
    ]
    df = df.withColumns({n: F.col(n).cast("string") for n in times}) if times else df
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_letter_urls(letters: DataFrame, path: str, **options: str) -> None:
    write_csv(letter_urls(letters, **options), path)


def export_errors(errors: DataFrame, path: str) -> None:
    """Append to the error log."""
    write_json(errors, path, mode="append")


def append_rows(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Append a chunk. A CSV target keeps one header per file."""
    if file_format == "csv":
        write_csv(df, path, bom=False, mode="append")
    else:
        df.write.mode("append").format(file_format).save(path)


def write_report(tables: Mapping[str, DataFrame], path: str, file_format: str = "parquet") -> None:
    """One folder per table: data, summary, column_info, network_stats, errors."""
    for name, table in tables.items():
        target = f"{path}/{name}"
        if file_format == "csv":
            write_csv(table, target)
        else:
            write_parquet(table, target)
