"""URLs, tracing numbers and request fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from filingframe.functions.text import ColumnOrName, as_col, strip

# The portal address is deployment configuration; callers pass their own.
DEFAULT_BASE_URL = "https://portal.example"

# Where a tracing number sits in a URL, by priority, and the
# report page that shows a letter.
TRACING_PATTERNS = (r"LetterSerial=([0-9]+)", r"TracingNo=([0-9]+)", r"/([0-9]+)$")
REPORT_PATH = "/Reports/Decision.aspx?LetterSerial="


def full_url(path: ColumnOrName, base_url: str = DEFAULT_BASE_URL) -> Column:
    p = as_col(path)
    return (
        F.when(p.isNull() | (p == ""), "")
        .when(p.startswith("http://") | p.startswith("https://"), p)
        .when(p.startswith("/"), F.concat(F.lit(base_url), p))
        .otherwise(F.concat(F.lit(base_url + "/"), p))
    )


def letter_url(
    url: ColumnOrName, tracing_no: ColumnOrName, base_url: str = DEFAULT_BASE_URL
) -> Column:
    """Absolute letter URL, built from the tracing number when there is none."""
    given = F.nullif(as_col(url), F.lit(""))
    serial = F.nullif(as_col(tracing_no), F.lit(""))
    return F.when(given.isNotNull(), full_url(given, base_url)).otherwise(
        F.concat(F.lit(base_url + REPORT_PATH), serial)
    )


def tracing_no_from_url(url: ColumnOrName) -> Column:
    found = [
        F.nullif(F.regexp_extract(as_col(url), pattern, 1), F.lit(""))
        for pattern in TRACING_PATTERNS
    ]
    return F.coalesce(*found)


def is_http(url: ColumnOrName) -> Column:
    return F.coalesce(strip(url).startswith("http"), F.lit(False))


def drop_unset(params: ColumnOrName) -> Column:
    """Map without entries that are null or -1; zero is a value and stays."""
    return F.map_filter(as_col(params), lambda _, v: v.isNotNull() & (v.cast("string") != "-1"))


def query_string(params: ColumnOrName) -> Column:
    """Percent-encoded ``k=v`` pairs of a string map, sorted by key."""
    entries = F.array_sort(F.map_entries(drop_unset(params)))
    return F.array_join(
        F.transform(
            entries,
            lambda e: F.concat(F.url_encode(e["key"]), F.lit("="), F.url_encode(e["value"])),
        ),
        "&",
    )


def query_url(params: ColumnOrName, endpoint: str, api: bool = True) -> Column:
    """Search URL: the API form ends in ``&search=true``, the web form starts with ``search``."""
    query = query_string(params)
    if api:
        return F.concat(F.lit(endpoint + "?"), query, F.lit("&search=true"))
    return F.concat(F.lit(endpoint + "?search&"), query)


def fingerprint(url: ColumnOrName, params: ColumnOrName | None = None) -> Column:
    """Stable request key: md5 of the URL and its sorted parameters."""
    if params is None:
        return F.md5(as_col(url))
    sorted_params = F.map_from_entries(F.array_sort(F.map_entries(as_col(params))))
    return F.md5(F.concat(as_col(url), F.coalesce(F.to_json(sorted_params), F.lit(""))))
