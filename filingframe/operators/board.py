"""Board-member rows and the person behind each of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingframe.functions.calendar import datetime_to_num
from filingframe.functions.text import (
    WHITESPACE,
    as_col,
    clean_str,
    is_non_executive,
    is_yes,
    latin_digits,
    norm_cells,
    norm_text,
    person_id,
    strip,
)
from filingframe.schemas import BOARD_MEMBER

# Cell positions shared by both row layouts.
CELLS = {
    "prev_member": 0,
    "new_member": 1,
    "member_id": 2,
    "prev_representative": 3,
    "new_representative": 4,
    "national_id": 5,
    "position": 6,
    "duty": 7,
    "degree": 8,
    "major": 9,
}
# What follows in rows of 12-15 cells and of 16 or more cells.
SHORT_LAYOUT = {"has_multiple_executive": 10, "has_multiple_non_executive": 11}
LONG_LAYOUT = {
    "experience": 10,
    "has_multiple_executive": 11,
    "has_multiple_non_executive": 12,
    "has_corporate_declaration": 13,
    "has_position_acceptance": 14,
    "verification_status": 15,
}
MIN_CELLS, LONG_CELLS = 12, 16
NO_REPRESENTATIVE = "فاقد نماینده"
UNKNOWN_COMPANY = "Unknown"


def parse_rows(df: DataFrame, row_text: str = "row_text") -> DataFrame:
    """Typed member columns of each TAB-separated row.

    Empty cells at the end do not count; rows with fewer than 12 cells are skipped.
    """
    row = F.rtrim(as_col(row_text), F.lit(WHITESPACE))
    wide = df.withColumn("_row", row).withColumn(
        "_size", F.length("_row") - F.length(F.replace(F.col("_row"), F.lit("\t"), F.lit(""))) + 1
    )
    cells = wide.where(F.col("_size") >= MIN_CELLS).withColumns(
        {"_cells": norm_cells("_row"), "_raw": F.split("_row", "\t")}
    )
    long_row = F.col("_size") >= LONG_CELLS

    def cell(i: int, source: str = "_cells") -> Column:
        return F.get(source, F.lit(i))

    def flag(name: str) -> Column:
        short = is_yes(cell(SHORT_LAYOUT[name])) if name in SHORT_LAYOUT else F.lit(False)
        return F.coalesce(F.when(long_row, is_yes(cell(LONG_LAYOUT[name]))).otherwise(short), F.lit(False))

    def late(name: str) -> Column:
        return F.when(long_row, F.coalesce(cell(LONG_LAYOUT[name]), F.lit(""))).otherwise("")

    ids = ("member_id", "national_id")
    fields = {n: cell(i) for n, i in CELLS.items() if n not in ("duty", *ids)}
    fields |= {n: latin_digits(strip(cell(CELLS[n], "_raw"))) for n in ids}
    fields |= {n: late(n) for n in ("experience", "verification_status")}
    fields |= {n: flag(n) for n in LONG_LAYOUT if n.startswith("has_")}
    fields["is_independent"] = is_non_executive(cell(CELLS["duty"]))
    return cells.withColumns(fields).drop("_row", "_size", "_cells", "_raw")


def derive_fields(df: DataFrame, labels: str = "labels") -> DataFrame:
    """Columns taken from the page labels: company, dates and chief executive."""

    def label(name: str) -> Column:
        return F.coalesce(as_col(labels)[name], F.lit(""))

    # digits are unified first, so dates in Persian digits keep their year
    number = datetime_to_num(latin_digits(label("date"))).cast("string")
    date = F.coalesce(F.substring(number, 1, 8), F.lit(""))
    company = F.coalesce(F.nullif(norm_text(label("company")), F.lit("")), F.lit(UNKNOWN_COMPANY))
    return df.withColumns(
        {
            "date": date,
            "year": F.substring(date, 1, 4),
            "month": F.substring(date, 5, 2),
            "assembly_date": F.replace(latin_digits(label("assembly_date")), F.lit("/"), F.lit("")),
            "company": company,
            "ceo_name": norm_text(label("ceo_name")),
            "ceo_national_id": latin_digits(strip(label("ceo_national_id"))),
            "ceo_degree": norm_text(label("ceo_degree")),
            "ceo_major": norm_text(label("ceo_major")),
        }
    )


def board_records(rows: DataFrame) -> DataFrame:
    """Full records from ``url, labels, has_previous, has_next, row_text`` rows."""
    parsed = rows.transform(parse_rows).transform(derive_fields)
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if "scrape_timestamp" not in parsed.columns:
        parsed = parsed.withColumn("scrape_timestamp", stamp)
    return parsed.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in BOARD_MEMBER.fields],
        *[c for c in ("row_no",) if c in rows.columns],
    )


def representatives(df: DataFrame) -> DataFrame:
    """Add ``rep_name, rep_id, rep_key, rep_is_person`` to board rows.

    A ten-digit member or national id marks a person; the name is the
    representative unless there is none.
    """
    ids = [person_id(F.col(c).cast("string")) for c in ("member_id", "national_id")]
    named = F.nullif(clean_str("new_representative"), F.lit(NO_REPRESENTATIVE))
    name = [F.nullif(c, F.lit("")) for c in (named, clean_str("new_member"))]
    # staged, so that each text is cleaned once; a person always has an id,
    # which therefore is the grouping key as well
    staged = df.withColumns({"rep_id": F.coalesce(*ids), "rep_name": F.coalesce(*name)})
    staged = staged.withColumn("rep_name", F.when(F.col("rep_id").isNotNull(), F.col("rep_name")))
    return staged.withColumns(
        {"rep_key": F.col("rep_id"), "rep_is_person": F.col("rep_name").isNotNull()}
    )
