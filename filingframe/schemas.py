"""Declared schemas for landed data.

Field names and order are fixed values of the data model.
"""

from __future__ import annotations

from pyspark.sql import types as T

from filingframe.functions.naming import snake_case

_B, _I, _L, _S = T.BooleanType(), T.IntegerType(), T.LongType(), T.StringType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Fields of a letter as delivered by the search service.
LETTER_RAW = _struct(
    ("Url", _S),
    ("TracingNo", _S),
    ("Symbol", _S),
    ("CompanyName", _S),
    ("Title", _S),
    ("LetterCode", _S),
    ("SentDateTime", _S),
    ("PublishDateTime", _S),
    ("HasExcel", _B),
    ("ExcelUrl", _S),
    ("HasHtml", _B),
    ("HtmlUrl", _S),
    ("HasPdf", _B),
    ("PdfUrl", _S),
    ("HasXbrl", _B),
    ("XbrlUrl", _S),
    ("HasAttachment", _B),
    ("AttachmentUrl", _S),
    ("IsEstimate", _B),
    ("Audited", _B),
    ("Consolidated", _B),
    ("CompanyState", _I),
    ("CompanyType", _I),
)

LETTER = T.StructType(
    [T.StructField(snake_case(f.name), f.dataType, True) for f in LETTER_RAW]
)

API_RESPONSE = _struct(
    ("Letters", T.ArrayType(LETTER_RAW)),
    ("Total", _L),
    ("Page", _L),
    ("IsSuccess", _B),
)

# Every envelope shape a landed JSON document can have, read with one schema.
JSON_ENVELOPE = T.StructType(
    LETTER_RAW.fields
    + [
        T.StructField("Letters", T.ArrayType(LETTER_RAW), True),
        T.StructField("data", T.ArrayType(LETTER_RAW), True),
        T.StructField("pages", T.MapType(_S, T.ArrayType(LETTER_RAW)), True),
        T.StructField("_corrupt_record", _S, True),
    ]
)

# Fields of one board-member record, in export order.
BOARD_MEMBER = _struct(
    ("year", _S),
    ("date", _S),
    ("month", _S),
    ("assembly_date", _S),
    ("company", _S),
    ("has_previous", _B),
    ("has_next", _B),
    ("url", _S),
    ("prev_member", _S),
    ("new_member", _S),
    ("member_id", _S),
    ("prev_representative", _S),
    ("new_representative", _S),
    ("national_id", _S),
    ("position", _S),
    ("is_independent", _B),
    ("degree", _S),
    ("major", _S),
    ("experience", _S),
    ("has_multiple_executive", _B),
    ("has_multiple_non_executive", _B),
    ("has_corporate_declaration", _B),
    ("has_position_acceptance", _B),
    ("verification_status", _S),
    ("ceo_name", _S),
    ("ceo_national_id", _S),
    ("ceo_degree", _S),
    ("ceo_major", _S),
    ("scrape_timestamp", _S),
)

FETCH_ERROR = _struct(
    ("url", _S),
    ("error_type", _S),
    ("message", _S),
    ("timestamp", T.TimestampType()),
    ("recoverable", _B),
    ("attempt", _I),
)

FETCH_LOG = _struct(
    ("url", _S),
    ("params", T.MapType(_S, _S)),
    ("created_at", T.TimestampType()),
    ("ttl_seconds", _I),
    ("status", _S),
    ("message", _S),
)

HOLDERS = _struct(
    ("ins_code", _S),
    ("d_even", _I),
    ("shareHolderName", _S),
    ("perOfShares", T.DoubleType()),
    ("shareHolderShareID", _S),
)

PRICES = _struct(
    ("ins_code", _S),
    ("d_even", _I),
    ("pClosing", T.DoubleType()),
    ("pc", T.DoubleType()),
)
