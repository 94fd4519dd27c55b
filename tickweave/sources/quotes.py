"""Daily quote pages (S9): staged HTML pages -> clean bars.

Fetching is outside the engine; pages are a table (code, page, html).  Each
task parses its pages with the standard-library HTML parser inside
``mapInPandas`` (one Arrow batch at a time); everything after the parse —
page cap, dropna, number and date cleaning — is built-in column work.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import after_last_equals, dotted_to_date, parse_int_text
from ..schemas import PAGER_CLASS, QUOTE_HEADERS

RAW_SCHEMA = ("code string, page int, date string, close string, diff string, open string, "
              "high string, low string, volume string, last_page string")


class _QuotePage(HTMLParser):
    """Collects the rows of the first <table> and the href of the pager cell."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[str]] = []
        self.header: list[str] = []
        self._cell: list[str] | None = None
        self._row: list[str] | None = None
        self._row_is_header = False
        self._in_pager = False
        self.pager_href: str | None = None
        self._tables = 0
        self._depth = 0

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "table":
            self._tables += 1
            self._depth += 1
        elif tag == "tr" and self._depth and self._tables == 1:
            self._row, self._row_is_header = [], False
        elif tag in ("td", "th") and self._row is not None:
            self._cell = []
            self._row_is_header |= tag == "th"
            if PAGER_CLASS in (a.get("class") or "").split():
                self._in_pager = True
        elif tag == "td" and PAGER_CLASS in (a.get("class") or "").split():
            self._in_pager = True
        elif tag == "a" and self._in_pager and self.pager_href is None:
            self.pager_href = a.get("href")

    def handle_endtag(self, tag):
        if tag == "table":
            self._depth = max(0, self._depth - 1)
        elif tag in ("td", "th") and self._cell is not None and self._row is not None:
            self._row.append("".join(self._cell).strip())
            self._cell = None
            self._in_pager = False
        elif tag == "td":
            self._in_pager = False
        elif tag == "tr" and self._row is not None:
            if self._row_is_header and not self.header:
                self.header = self._row
            elif not self._row_is_header:
                self.rows.append(self._row)
            self._row = None

    def handle_data(self, data):
        if self._cell is not None:
            self._cell.append(data)


def _parse_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = list(QUOTE_HEADERS.values())
    for pdf in batches:
        out = []
        for code, page, html in zip(pdf["code"], pdf["page"], pdf["html"]):
            p = _QuotePage()
            p.feed(html or "")
            cols = [QUOTE_HEADERS.get(h, h) for h in p.header]
            for r in p.rows:
                if len(r) != len(cols):
                    continue          # separator / blank rows
                rec = dict(zip(cols, r))
                out.append([code, int(page)] + [rec.get(n) for n in names] + [p.pager_href])
        yield pd.DataFrame(out, columns=["code", "page", *names, "last_page"])


def parse_quote_pages(pages: DataFrame) -> DataFrame:
    """Raw quote rows (text cells) with the pager link of their page."""
    return pages.select("code", "page", "html").mapInPandas(_parse_pages, RAW_SCHEMA)


def extract_quotes(pages: DataFrame, pages_to_fetch: int | None = None) -> DataFrame:
    """S9 clean bars from quote pages.

    last page = text after the last '=' of the pager link (F10); a page without
    a pager gives nothing; pages beyond min(last page, ``pages_to_fetch``) are
    ignored (T4; by default every staged page up to the last counts); rows with
    any missing cell drop (P7); numbers lose their thousands separators and
    become integers (F11); 'yyyy.MM.dd' dates become dates (D6).
    """
    if pages_to_fetch is not None:
        pages = pages.filter(F.col("page") <= pages_to_fetch)  # before any page is parsed
    raw = parse_quote_pages(pages)
    # every page of a code carries the same pager link
    last = after_last_equals(F.col("last_page")).try_cast("int")
    kept = raw.filter(last.isNotNull() & (F.col("page") <= last))
    cleaned = kept.select(
        "code", dotted_to_date("date").alias("date"),
        *[parse_int_text(c).alias(c) for c in ("open", "high", "low", "close", "diff", "volume")])
    cleaned = cleaned.dropna(how="any")
    return cleaned.select("code", "date", F.date_format("date", "yyyyMMdd").alias("ymd"),
                          "open", "high", "low", "close", "diff", "volume")


def ingest_quotes(current: DataFrame, pages: DataFrame, master: DataFrame, pages_to_fetch: int | None = None) -> DataFrame:
    """K8 the quote pages of the master's codes, replacing whole bars by (code, date) (K3, ``diff`` included).

    Only pages of the master's codes are parsed.  The parsed batch is written
    once; the replace then reads it as often as it has to.  ``current`` is
    partitioned by ``year``.
    """
    from ..operators.upsert import SEQ, upsert_incremental
    from ..session import materialize
    batch = extract_quotes(pages.join(master.select("code").distinct(), "code", "left_semi"), pages_to_fetch)
    batch = materialize(batch.withColumn("year", F.year("date")), "quotes")
    missing = [c for c in current.columns if c not in batch.columns]
    batch = batch.select("*", *[F.lit(None).cast(current.schema[c].dataType).alias(c) for c in missing], F.lit(0).alias(SEQ))
    return upsert_incremental(current, batch, ["code", "date"], ["year"])
