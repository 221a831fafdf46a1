"""Links and board grids from landed HTML pages.

Only tokenising runs in Python, one Arrow batch at a time; matching, URL
building and typing are Column expressions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import lru_cache, reduce
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingframe.functions.text import strip
from filingframe.functions.urls import DEFAULT_BASE_URL, full_url
from filingframe.operators.frame import drop_duplicates, filter_valid_urls

# What marks a spreadsheet link.
SPREADSHEET_LINK = (r"\.xlsx$", r"\.xls$", "excel")
SPREADSHEET_SOURCE = r"\.xlsx?$"

# Element ids and row classes of the board page.
GRID_ID = "dgAssemblyBoardMember"
ROW_CLASSES = ("GridItem", "GridAlternating")
HEADER_CLASS = "GridHeader"
LABEL_IDS = {
    "company": "lblCompany",
    "ceo_name": "lblDMBoardMemberList",
    "ceo_national_id": "lblDMBoardMemberNationalCode",
    "ceo_degree": "lblDMBoardMemberDegreeLevel",
    "ceo_major": "lblDMBoardMemberEducationField",
    "date": "txbSessionDate",
    "assembly_date": "lblAssemblyDate",
}
PREVIOUS_ID = "ucNavigateToNextPrevLetter_hlPrevVersion"
NEXT_ID = "ucNavigateToNextPrevLetter_hlNewVersion"

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)


# Regular markup, of which HTMLParser and one pattern make the same tags and texts: opening tag, attributes,
# text, and if its own closing tag is next, that one and the text behind; or a closing tag and the text behind;
# any other sign that opens something is a group of its own.
# Whatever else a page holds (raw text elements, declarations, stray signs) is left to HTMLParser.
_ATTRIBUTE = r"""([A-Za-z][A-Za-z0-9_:-]*)(?:=(?:"([^"<>]*)"|'([^'<>]*)'|([A-Za-z0-9_.#-]+)))?"""
_ATTRIBUTES = r"""(?:[ \t\r\n]+[A-Za-z][A-Za-z0-9_:-]*+(?:=(?:"[^"<>]*"|'[^'<>]*'|[A-Za-z0-9_.#-]++))?+)*+"""
_TOKENS = re.compile(
    rf"<(?:([A-Za-z][A-Za-z0-9]*+)({_ATTRIBUTES})[ \t\r\n]*+>([^<]*+)(?:(</\1>)([^<]*+))?+"
    r"|/([A-Za-z][A-Za-z0-9]*+)>([^<]*+))|(<)"
)
_RAW = tuple(
    f"<{tag}"
    for tag in "script style textarea title plaintext xmp iframe noembed noframes noscript svg math".split()
)
_ATTRIBUTE_OF = re.compile(_ATTRIBUTE)


@lru_cache(4096)
def _element(attributes: str) -> dict[str, str]:
    """Attributes by name, the first of a name counts; to be read only."""
    found = {}
    for name, double, single, plain in reversed(_ATTRIBUTE_OF.findall(attributes)):
        found[name.lower()] = unescape(double or single or plain)
    return found


_NONE: dict[str, str] = {}
_NESTED = frozenset(("tr", "td", "th"))


class _Scanner(HTMLParser):
    """Keeps the stack of open elements; unclosed ones end with their parent.

    ``open`` has the tags, ``held`` what ``enter`` gave for each, and ``sinks`` the lists that take the
    texts inside open elements; ``marks`` says how many of those stood before each element.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.held: list[object] = []
        self.marks: list[int] = []
        self.sinks: list[list[str]] = []

    def read(self, page: str) -> None:
        """All tags and texts of a page, in order; texts that are white space alone are passed over."""
        lower = page.lower()
        tokens = None if any(tag in lower for tag in _RAW) else _TOKENS.findall(page)
        if tokens is None or any(token[-1] for token in tokens):
            self.feed(page)
            self.close()
            return
        head = page.partition("<")[0]
        if head:
            self.handle_data(unescape(head))
        tags, held, marks, sinks = self.open, self.held, self.marks, self.sinks
        for opened, attributes, text, ended, behind, closed, last, _ in tokens:
            if not opened:
                if tags and tags[-1] == closed:
                    tags.pop()
                    held.pop()
                    del sinks[marks.pop() :]
                else:
                    self.handle_endtag(closed.lower())
                text = last
            else:
                tag = opened.lower()
                element = _element(attributes) if attributes else _NONE
                if ended and tag not in _VOID:
                    # nothing but text is inside, so the element need not be kept open
                    if tag in _NESTED:
                        self._nest(tag)
                    before = len(sinks)
                    self.enter(tag, element)
                    if sinks and text and not text.isspace():
                        self.handle_data(unescape(text))
                    del sinks[before:]
                    text = behind
                else:
                    self._open(tag, element)
                    if ended:
                        self.handle_data(unescape(text))
                        self.handle_endtag(tag)
                        text = behind
            if sinks and text and not text.isspace():
                self.handle_data(unescape(text))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._open(tag, {k: v or "" for k, v in reversed(attrs)})

    def _open(self, tag: str, element: dict[str, str]) -> None:
        if tag in _NESTED:
            self._nest(tag)
        before = len(self.sinks)
        held = self.enter(tag, element)
        if tag in _VOID:
            del self.sinks[before:]
        else:
            self.open.append(tag)
            self.held.append(held)
            self.marks.append(before)

    def _nest(self, tag: str) -> None:
        """A row ends the row before it, a cell the cell before it."""
        if tag == "tr":
            self._close_until(("tr",), stop="table")
        elif self.open and self.open[-1] != "tr":
            self._close_until(("td", "th"), stop="tr")

    def _close(self, i: int) -> None:
        del self.sinks[self.marks[i] :], self.open[i:], self.held[i:], self.marks[i:]

    def _close_until(self, tags: tuple[str, ...], stop: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i] in tags:
                self._close(i)
                return
            if self.open[i] == stop:
                return

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i] == tag:
                self._close(i)
                return

    def handle_data(self, data: str) -> None:
        for sink in self.sinks:
            sink.append(data)

    def enter(self, tag: str, element: dict) -> object:
        raise NotImplementedError


class _Links(_Scanner):
    def __init__(self) -> None:
        super().__init__()
        self.links: list[tuple[str, str, list[str]]] = []

    @property
    def found(self) -> list[dict]:
        return [{"tag": t, "href": h, "text": "".join(p.strip() for p in pieces)} for t, h, pieces in self.links]

    def enter(self, tag: str, element: dict) -> None:
        if tag == "a" and "href" in element:
            pieces: list[str] = []
            self.links.append((tag, element["href"], pieces))
            self.sinks.append(pieces)
        elif tag in ("iframe", "embed") and element.get("src"):
            self.links.append((tag, element["src"], []))


class _Board(_Scanner):
    def __init__(self) -> None:
        super().__init__()
        self.ids: dict[str, list[str]] = {}
        self.rows: list[list[list[str]]] = []

    def enter(self, tag: str, element: dict) -> object:
        """The id of a table, the cells of a wanted row."""
        name = element.get("id")
        if name and name not in self.ids:
            self.ids[name] = label = []
            self.sinks.append(label)
        if tag == "td" or tag == "th":
            at = len(self.open) - 1
            while at >= 0 and self.open[at] != "tr":
                at -= 1
            if at >= 0 and self.held[at] is not None:
                cell: list[str] = []
                self.held[at].append(cell)
                self.sinks.append(cell)
        elif tag == "table":
            return name
        elif tag == "tr":
            tables = [held for t, held in zip(self.open, self.held, strict=True) if t == "table"]
            if GRID_ID in tables and self._wanted(element, tables[-1] == GRID_ID):
                row: list[list[str]] = []
                self.rows.append(row)
                return row
        return None

    @staticmethod
    def _wanted(row: dict, direct: bool) -> bool:
        classes = row.get("class", "").split()
        return any(c in ROW_CLASSES for c in classes) or (direct and HEADER_CLASS not in classes)


def _squeezed(pieces: list[str]) -> str:
    return " ".join(" ".join(pieces).split())


def _links_of(html: str | None) -> dict:
    """Links of a page; of a page that breaks off, those found until then."""
    scanner, broken = _Links(), False
    try:
        scanner.read(html or "")
    except (AssertionError, ValueError):
        broken = True
    return {"links": scanner.found, "broken": broken}


def _board_of(html: str | None) -> dict:
    blank = {**dict.fromkeys(LABEL_IDS, ""), "has_previous": False, "has_next": False, "rows": []}
    if html is None:
        return {**blank, "status": "navigation"}
    if GRID_ID not in html:
        return {**blank, "status": "selector_not_found"}
    scanner = _Board()
    try:
        scanner.read(html)
    except (AssertionError, ValueError):
        # one broken page is one error row
        return {**blank, "status": "parsing"}
    labels = {name: _squeezed(scanner.ids.get(i, [])) for name, i in LABEL_IDS.items()}
    rows = ["\t".join(map(_squeezed, cells)) for cells in scanner.rows]
    return {
        **labels,
        "has_previous": PREVIOUS_ID in scanner.ids,
        "has_next": NEXT_ID in scanner.ids,
        "rows": rows,
        "status": "ok" if rows else "selector_not_found",
    }


def _scan_links(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_links_of(h) for h in html], columns=["links", "broken"])


def _scan_boards(html: pd.Series) -> pd.DataFrame:
    pages = [_board_of(h) for h in html]
    # columns of objects, so that nothing is guessed
    return pd.DataFrame({f: pd.Series([p[f] for p in pages], dtype=object) for f in _BOARD_FIELDS})


def _once(function, kind: str):
    """A scan that later filters and projections may not repeat."""
    return F.pandas_udf(function, kind).asNondeterministic()


_LINKS_TYPE = "links array<struct<tag string, href string, text string>>, broken boolean"
_BOARD_FIELDS = [*LABEL_IDS, "has_previous", "has_next", "rows", "status"]
_BOARD_TYPE = (
    ", ".join(f"{n} string" for n in LABEL_IDS)
    + ", has_previous boolean, has_next boolean, rows array<string>, status string"
)


def extract_links(
    pages: DataFrame,
    patterns: Sequence[str] = SPREADSHEET_LINK,
    source_pattern: str = SPREADSHEET_SOURCE,
    base_url: str = DEFAULT_BASE_URL,
) -> DataFrame:
    """One row per matching link: page columns without ``html``, plus url, filename, text.

    An anchor matches by address or text, ignoring case; frames and embeds by source.
    """
    scan = _once(_scan_links, _LINKS_TYPE)
    kept = [c for c in pages.columns if c not in ("html", "url")]
    page_url = [F.col("url").alias("page_url")] if "url" in pages.columns else []
    scanned = pages.select(*kept, *page_url, scan("html").alias("_scan"))
    found = scanned.select(*kept, *[c for c in ("page_url",) if page_url], F.explode("_scan.links").alias("l"))
    href, text = F.col("l.href"), F.col("l.text")

    def matches(c: Column) -> Column:
        return reduce(Column.__or__, [c.rlike(f"(?i){p}") for p in patterns])

    anchor = (F.col("l.tag") == "a") & (matches(href) | matches(text))
    frame = (F.col("l.tag") != "a") & href.rlike(f"(?i){source_pattern}")
    last = F.element_at(F.split(href, "/"), -1)
    return found.where(anchor | frame).select(
        *kept,
        *[c for c in ("page_url",) if page_url],
        full_url(href, base_url).alias("url"),
        F.coalesce(F.nullif(last, F.lit("")), F.substring(text, 1, 50)).alias("filename"),
        text.alias("text"),
    )


def link_errors(pages: DataFrame) -> DataFrame:
    """One recoverable error per page that could not be scanned to its end."""
    scan = _once(_scan_links, _LINKS_TYPE)
    broken = pages.select("url", scan("html").alias("_scan")).where("_scan.broken")
    return page_errors(broken.select("url", F.lit("parsing").alias("status")))


def parse_board_pages(pages: DataFrame) -> DataFrame:
    """``url, labels, has_previous, has_next, rows, status`` of each page."""
    scan = _once(_scan_boards, _BOARD_TYPE)
    parsed = pages.select("url", scan("html").alias("p"))
    return parsed.select(
        "url",
        F.struct(*[F.col(f"p.{n}").alias(n) for n in LABEL_IDS]).alias("labels"),
        "p.has_previous",
        "p.has_next",
        "p.rows",
        "p.status",
    )


def board_rows(parsed: DataFrame) -> DataFrame:
    """One row per grid row, numbered within its page."""
    return parsed.where("status = 'ok'").select(
        "url",
        "labels",
        "has_previous",
        "has_next",
        F.posexplode("rows").alias("row_no", "row_text"),
    )


# Message of each page failure.
MESSAGES = {
    "selector_not_found": "board member grid not found",
    "parsing": "page could not be parsed",
    "navigation": "page is not among the landed pages",
}


def page_errors(parsed: DataFrame) -> DataFrame:
    """One recoverable error per page that gave no rows."""
    message = F.lit("")
    for status, text in MESSAGES.items():
        message = F.when(F.col("status") == status, text).otherwise(message)
    return parsed.where("status != 'ok'").select(
        "url",
        F.col("status").alias("error_type"),
        message.alias("message"),
        F.current_timestamp().alias("timestamp"),
        F.lit(True).alias("recoverable"),
        F.lit(1).alias("attempt"),
    )


def pages_of_urls(
    urls: DataFrame, pages: DataFrame, url_column: str = "url", landed: str | None = None
) -> DataFrame:
    """The landed page of each distinct valid URL; ``html`` is null when not landed.

    Landed pages are cut down to the wanted URLs before any page is shuffled. Of
    several landings of a URL the newest by ``landed`` counts (without such a
    column the one that sorts last).
    """
    wanted = filter_valid_urls(urls, url_column).select(strip(url_column).alias("url")).distinct()
    order = [landed] if landed else []
    found = pages.select("url", "html", *order).join(wanted, "url", "left_semi")
    newest = drop_duplicates(found, ["url"], "last", [*order, "html"]).select("url", "html")
    return wanted.join(newest, "url", "left")
