"""Company financial statements.

A scraped statement is a grid: measures down, periods across.  Staged as
cells (code, gb, period_header, pos, measure, text), it becomes one row per
(code, period, gb) with the 28 measures as columns through a pivot whose
column list is fixed (no extra job to discover values).  Statement pages
in HTML are turned into cells inside ``mapInPandas`` with the standard
library parser.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import (clean_measure, empty_to_zero, is_estimate, measure_name,
                                period_to_ym)
from ..schemas import MEASURES, STATEMENT_CLASS, STATEMENT_SUMMARY

CELL_SCHEMA = "code string, gb string, period_header string, pos int, measure string, text string"


def cells_to_rows(cells: DataFrame) -> DataFrame:
    """J9 cells -> one row per (code, ym, gb) with the 28 measures as DOUBLE.

    ym = digits and slashes of the period header, '/' -> '-' (F6); the '(E)'
    estimate marker is kept as ``is_estimate`` (D12); row headers lose
    no-break spaces (F7) and map to canonical names; empty cells read 0 (F8);
    'N/A'-like text reads 0 and thousands separators go (F9).

    Two statements of one ym (an actual and an estimate) never mix: the one
    further right on the page (largest ``pos``) is the row, the other is gone.
    """
    c = cells.select(
        "code", "gb", period_to_ym("period_header").alias("ym"), "pos",
        is_estimate("period_header").alias("_est"),
        measure_name("measure").alias("_m"),
        clean_measure(empty_to_zero(F.coalesce(F.col("text"), F.lit("")))).alias("_v"))
    c = c.filter(F.col("_m").isNotNull())
    # the pivot written out: a statement is one column of the page, 28 maxima of plain doubles
    cells_of = [F.max(F.when(F.col("_m") == m, F.col("_v"))).alias(m) for m in MEASURES]
    columns = c.groupBy("code", "ym", "gb", "pos").agg(F.max("_est").alias("is_estimate"), *cells_of)
    last = F.max("pos").over(Window.partitionBy("code", "ym", "gb"))
    return columns.withColumn("_last", last).where(F.col("pos") == F.col("_last")).select("code", "ym", "gb", "is_estimate", *MEASURES)


def with_year(rows: DataFrame) -> DataFrame:
    """``year`` of ``ym`` (0 where it has none): the partition column of stored fundamentals."""
    return rows.withColumn("year", F.coalesce(F.substring("ym", 1, 4).try_cast("int"), F.lit(0)))


def quarantine(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K9 error isolation: (good cells, bad cells).  A cell is bad when its row
    header is not a known measure or its text is not a number after cleaning;
    bad cells are kept aside instead of failing the whole batch."""
    v = clean_measure(empty_to_zero(F.coalesce(F.col("text"), F.lit(""))))
    ok = measure_name("measure").isNotNull() & v.isNotNull()
    flagged = cells.withColumn("_ok", ok)
    return flagged.filter("_ok").drop("_ok"), flagged.filter(~F.col("_ok")).drop("_ok")


def ingest_fundamentals(cells: DataFrame, active: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K9 Y and Q statements of every active code in one job -> (rows, quarantined cells)."""
    mine = cells.join(active.select("code"), "code", "left_semi")
    good, bad = quarantine(mine)
    return cells_to_rows(good), bad


def with_audit(rows: DataFrame, ts: str, user: str = "sys") -> DataFrame:
    """P12 literal audit columns of a fundamentals batch."""
    t = F.lit(ts).cast("timestamp")
    return rows.select("*", F.lit(user).alias("reg_id"), F.lit(user).alias("upd_id"),
                       t.alias("reg_dt"), t.alias("upd_dt"))


class _Statement(HTMLParser):
    """Header periods (second header row) and body rows (th = measure, td = values) of the
    statement table: the first one of its class and summary; other tables are passed over."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.section = None
        self._table: list[bool] = []
        self._found = False
        self.head_rows: list[list[str]] = []
        self.body: list[tuple[str, list[str]]] = []
        self._row = None
        self._th = None
        self._cell = None
        self._kind = None

    def _inside(self) -> bool:
        return bool(self._table) and self._table[-1]

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            a = dict(attrs)
            mine = not self._found and a.get("class") == STATEMENT_CLASS and a.get("summary") == STATEMENT_SUMMARY
            self._found |= mine
            self._table.append(mine)
        elif not self._inside():
            return
        elif tag in ("thead", "tbody"):
            self.section = tag
        elif tag == "tr":
            self._row, self._th = [], None
        elif tag in ("th", "td") and self._row is not None:
            self._cell, self._kind = [], tag

    def handle_endtag(self, tag):
        if tag == "table" and self._table:
            self._table.pop()
        elif tag in ("th", "td") and self._cell is not None:
            text = "".join(self._cell)
            if self.section == "tbody" and self._kind == "th":
                self._th = text
            else:
                self._row.append(text)
            self._cell = None
        elif tag == "tr" and self._row is not None:
            if self.section == "thead":
                self.head_rows.append([t.strip() for t in self._row])
            elif self.section == "tbody":
                self.body.append((self._th or "", self._row))
            self._row = None

    def handle_data(self, data):
        if self._cell is not None:
            self._cell.append(data)


def _statement_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for code, gb, html in zip(pdf["code"], pdf["gb"], pdf["html"]):
            p = _Statement()
            p.feed(html or "")
            periods = p.head_rows[1] if len(p.head_rows) > 1 else (p.head_rows[0] if p.head_rows else [])
            for measure, values in p.body:
                for pos, (period, text) in enumerate(zip(periods, values)):
                    out.append([code, gb, period, pos, measure, text])
        yield pd.DataFrame(out, columns=["code", "gb", "period_header", "pos", "measure", "text"])


def extract_statement_cells(pages: DataFrame) -> DataFrame:
    """S13 statement pages (code, gb, html) -> cells."""
    return pages.select("code", "gb", "html").mapInPandas(_statement_cells, CELL_SCHEMA)


def extract_fundamentals(pages: DataFrame) -> DataFrame:
    """S13 + J9 statement pages -> fundamentals rows."""
    return cells_to_rows(extract_statement_cells(pages))
