"""Scans of landed data and ingest normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingframe.functions.naming import snake_case, snake_case_columns
from filingframe.functions.text import norm_text
from filingframe.schemas import API_RESPONSE, JSON_ENVELOPE, LETTER_RAW

# Text columns that are normalised on ingest.
TEXT_COLUMNS = ("symbol", "company_name", "title", "subject", "company", "name", "description")


def normalise(df: DataFrame, columns: bool = True, text: bool = True) -> DataFrame:
    """snake_case names and clean text columns, as one projection."""
    if columns:
        df = snake_case_columns(df)
    if not text:
        return df
    kinds = dict(df.dtypes)
    return df.select(
        *[
            norm_text(c).alias(c) if c in TEXT_COLUMNS and kinds[c] == "string" else F.col(c)
            for c in df.columns
        ]
    )


def jalali_text_columns(df: DataFrame) -> list[str]:
    """Text columns that hold Jalali dates: every filled value starts ``dddd/``.

    One aggregate over the candidate columns; nothing depends on the first row.
    """
    # Words that mark a date column by its name.
    words = ("date", "تاریخ", "datetime", "time")
    names = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and any(w in f.name.lower() for w in words)
    ]
    if not names:
        return []
    row = df.agg(*[F.every(F.col(n).rlike("^[0-9]{4}/")).alias(n) for n in names]).first()
    return [n for n in names if row[n]]


def parse_dates(df: DataFrame, keep: list[str]) -> DataFrame:
    """Date-named text columns other than ``keep`` become timestamps; bad text is null."""
    words = ("date", "تاریخ", "datetime", "time")
    names = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType)
        and f.name not in keep
        and any(w in f.name.lower() for w in words)
    ]
    return df.withColumns({n: F.try_to_timestamp(F.col(n)) for n in names}) if names else df


def read_letters_json(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """Landed JSON documents as raw letters.

    A document is a bare array, or holds its letters in ``Letters``, ``data`` or
    per page in ``pages``; the first of these that is present counts.
    """
    docs = spark.read.schema(JSON_ENVELOPE).option("multiLine", True).option("mode", mode).json(path)
    pages = F.flatten(F.filter(F.map_values("pages"), lambda v: v.isNotNull()))
    bare = F.array(F.struct(*[F.col(f.name) for f in LETTER_RAW.fields]))
    letters = F.coalesce(F.col("Letters"), F.col("data"), pages, bare)
    is_letter: Column = F.col("TracingNo").isNotNull() | F.col("Url").isNotNull()
    envelope = F.col("Letters").isNotNull() | F.col("data").isNotNull() | F.col("pages").isNotNull()
    good = docs.where(F.col("_corrupt_record").isNull() & (envelope | is_letter | _any_field()))
    return good.select(F.inline(letters))


def _any_field() -> Column:
    return F.coalesce(*[F.col(f.name).cast("string") for f in LETTER_RAW.fields]).isNotNull()


def corrupt_documents(spark: SparkSession, path: str) -> DataFrame:
    """Landed documents that are no JSON: file name and text, for quarantine."""
    docs = spark.read.schema(JSON_ENVELOPE).option("multiLine", True).json(path)
    # Spark wants a second column read along with the corrupt text
    letters = F.coalesce(F.size("Letters"), F.lit(0))
    marked = docs.select(F.input_file_name().alias("file"), "_corrupt_record", letters.alias("n"))
    return marked.where("_corrupt_record is not null and n >= -1").select("file", "_corrupt_record")


def parse_responses(df: DataFrame, column: str = "value") -> DataFrame:
    """API replies held as text -> one normalised row per letter."""
    reply = F.from_json(F.col(column), API_RESPONSE)
    return normalise(df.select(F.inline(reply["Letters"])))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, encoding: str = "utf-8"
) -> DataFrame:
    """CSV with a header. Without a schema every column is text."""
    reader = spark.read.option("header", True).option("encoding", encoding)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_url_csv(spark: SparkSession, path: str, url_column: str = "url") -> DataFrame:
    """Only the URL column when there is one, otherwise everything."""
    df = read_csv(spark, path)
    return df.select(url_column) if url_column in df.columns else df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def harmonise(df: DataFrame, synonyms: dict[str, tuple[str, ...]]) -> DataFrame:
    """Columns renamed to canonical names by header synonyms; absent ones are null.

    Headers are compared without spaces and underscores, in lower case. Of
    several matching headers the last one counts.
    """
    found: dict[str, str] = {}
    for column in df.columns:
        header = column.replace(" ", "").replace("_", "").lower()
        found.update({target: column for target, known in synonyms.items() if header in known})
    return df.select(
        *[
            df[f"`{found[t]}`"].alias(t) if t in found else F.lit(None).cast("string").alias(t)
            for t in synonyms
        ]
    )


# Header synonyms of a shareholder table.
HOLDER_SYNONYMS = {
    "shareHolderName": (
        "shareholdername",
        "سهامداردارنده",
        "سهامدار/دارنده",
        "holdername",
        "name",
    ),
    "perOfShares": ("perofshares", "percent", "درصدسهام", "درصدسهم"),
    "shareHolderShareID": ("shareholdershareid", "idcisin", "id"),
}


def normalise_holders(df: DataFrame) -> DataFrame:
    return harmonise(df, HOLDER_SYNONYMS)


def letter_schema() -> T.StructType:
    """Normalised letter schema, for CSV and streaming scans."""
    return T.StructType(
        [T.StructField(snake_case(f.name), f.dataType, True) for f in LETTER_RAW.fields]
    )
