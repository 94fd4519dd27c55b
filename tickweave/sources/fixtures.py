"""Market tables derived from the driver's TPC-H-like parquet tables.

The driver data carries no prices, so bars are built from ``lineitem ⋈ part``:
code = ``p_brand``; one bar per (code, week) or (code, day) of ``l_shipdate``;
price = ``floor(l_extendedprice)``.  Inside a bar the first/last trade is the
min/max of (l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
l_extendedprice) — the full tuple, since (orderkey, linenumber) repeats.

Everything here is a distributed aggregation: one partial+final hash
aggregate per table, the ``part`` dimension joined by whatever strategy the
optimizer picks from its size (broadcast under the threshold, otherwise a
shuffle join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MEASURE_HEADERS, PAGER_CLASS, QUOTE_HEADERS, STATEMENT_CLASS, STATEMENT_SUMMARY


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", "l_shipdate")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return li.join(part, li.l_partkey == part.p_partkey, "inner")


def bar_date(freq: str) -> Column:
    if freq == "week":
        return F.to_date(F.date_trunc("week", "l_shipdate"))
    if freq == "day":
        return F.to_date("l_shipdate")
    raise ValueError(f"unknown bar frequency {freq!r}")


def bars(spark: SparkSession, sf_dir: str, freq: str = "week") -> DataFrame:
    """Canonical bars (without audit columns): code, date, ymd, OHLC, diff, volume."""
    price = F.floor("l_extendedprice").cast("bigint")
    seq = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
                   "l_suppkey", "l_extendedprice")
    out = (_trades(spark, sf_dir)
           .groupBy(F.col("p_brand").alias("code"), bar_date(freq).alias("date"))
           .agg(F.min_by(price, seq).alias("open"),
                F.max(price).alias("high"),
                F.min(price).alias("low"),
                F.max_by(price, seq).alias("close"),
                F.sum(F.floor("l_quantity")).cast("bigint").alias("volume")))
    return out.select("code", "date", F.date_format("date", "yyyyMMdd").alias("ymd"),
                      "open", "high", "low", "close", F.lit(None).cast("bigint").alias("diff"),
                      "volume")


_STORED: dict[tuple, DataFrame] = {}


def stored_fin_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fin_cells`` written once per session and data folder (the staged-cells table)."""
    from ..session import materialize
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), "fin_cells")
    if key not in _STORED:
        _STORED[key] = materialize(fin_cells(spark, sf_dir), "fin_cells")
    return _STORED[key]


def _stored(spark: SparkSession, sf_dir: str, name: str, build, **written) -> DataFrame:
    """A table written once per session and data folder."""
    from ..session import materialize
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _STORED:
        _STORED[key] = materialize(build(), name, **written)
    return _STORED[key]


def stored_fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fundamentals of all cells as the stored table they are in production: partitioned by the year of ``ym``."""
    from .fundamentals import cells_to_rows, with_year
    return _stored(spark, sf_dir, "fundamentals", lambda: with_year(cells_to_rows(stored_fin_cells(spark, sf_dir))).repartition("year"), partition_by=["year"])


def replay_upserts(spark: SparkSession, current: DataFrame, batches: list[DataFrame], keys=("code", "date"),
                   ts: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stage ``batches`` as files, in arrival order, and stream them into ``current``, which is partitioned by ``year``."""
    from ..session import scratch_path
    from ..streaming.bar_stream import stream_upsert_bars
    root = scratch_path(spark, "stream")
    current.write.partitionBy("year").parquet(f"{root}/initial")
    for b in batches:
        b.write.mode("append").parquet(f"{root}/incoming")
    schema = spark.read.parquet(f"{root}/incoming").schema
    return stream_upsert_bars(spark, f"{root}/incoming", schema, f"{root}/initial", f"{root}/bars", f"{root}/checkpoint", keys,
                              ts=ts, max_files_per_trigger=max_files_per_trigger)


def stored_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The security master as the stored table it is in production."""
    return _stored(spark, sf_dir, "items", lambda: items(spark, sf_dir))


def stored_quote_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged quote pages of the weekly bars."""
    return _stored(spark, sf_dir, "quote_pages", lambda: render_quote_pages(stored_bars(spark, sf_dir)))


def stored_statement_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged statement pages of the cells."""
    return _stored(spark, sf_dir, "statement_pages", lambda: render_statement_pages(stored_fin_cells(spark, sf_dir)))


def stored_bars(spark: SparkSession, sf_dir: str, freq: str = "week") -> DataFrame:
    """``bars`` written once per session and data folder as a year-partitioned
    Parquet table (sorted by code, date) in the shared checkpoint folder — the
    form the bars table has in production — and read back from there."""
    from ..session import materialize
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), freq)
    if key not in _STORED:
        b = bars(spark, sf_dir, freq).withColumn("year", F.year("date"))
        # range slices of (year, code): every task writes about one file holding a
        # narrow code range (min/max statistics then skip files on code
        # predicates); one code-year is at most 366 daily bars, so a hot code is
        # split across tasks
        stored = materialize(b.repartitionByRange("year", "code"), "bars", freq,
                             partition_by=["year"], sort_by=["code", "date"])
        # ``year`` stays: filters on it prune whole partition folders
        _STORED[key] = stored.select(*[c for c in stored.columns if c != "year"], "year")
    return _STORED[key]


def bucketed_bars(spark: SparkSession, rows: DataFrame, buckets: int = 8):
    """``rows`` (bars with a ``year``) as a new stored table bucketed by (code, date)."""
    from ..session import scratch_path
    from .bucketed import BucketedTable
    path = scratch_path(spark, "bars_bucketed")
    stored = BucketedTable(spark, f"bars_{path.rsplit('/', 1)[1]}", path, rows.schema, buckets=buckets)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    stored.load(rows)
    return stored


def stored_bucketed_bars(spark: SparkSession, sf_dir: str, cut: str, build):
    """``bucketed_bars`` of the rows that ``build`` gives, written once per session, data folder and cut."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), "bars_bucketed", cut)
    if key not in _STORED:
        _STORED[key] = bucketed_bars(spark, build())
    return _STORED[key]


def brand_number(code: Column) -> Column:
    return F.regexp_extract(code, r"#(\d+)$", 1).try_cast("int")


def items(spark: SparkSession, sf_dir: str, ymd: str = "20210201") -> DataFrame:
    """Security master: one row per brand.

    name = 'CO BRAND#<n>' (brands 24 and 25 share a name, so name lookup has
    to pick the first code); status 'Y' for odd brand numbers.
    """
    part = read(spark, sf_dir, "part").select("p_brand", "p_type", "p_name")
    g = part.groupBy(F.col("p_brand").alias("code")).agg(
        F.min("p_type").alias("sector"), F.min("p_name").alias("products"))
    n = brand_number(F.col("code"))
    return g.select(
        "code", F.lit(ymd).alias("ymd"),
        F.when(n % 2 == 1, "Y").otherwise("N").alias("status"),
        F.concat(F.lit("CO BRAND#"), F.least(n, F.lit(24)).cast("string")).alias("name"),
        "sector", "products",
        F.lit(None).cast("string").alias("listing_day"),
        F.lit(None).cast("string").alias("fiscal_month"),
        F.lit(None).cast("string").alias("ceo"),
        F.lit(None).cast("string").alias("homepage"),
        F.lit(None).cast("string").alias("region"),
        F.lit(None).cast("timestamp").alias("reg_dt"),
        F.lit(None).cast("timestamp").alias("upd_dt"))


def listing_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staged listing download: unpadded integer codes, descriptive text."""
    part = read(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("code"),
        F.col("p_name").alias("company"),
        F.col("p_type").alias("sector"),
        F.col("p_brand").alias("products"),
        F.lit(None).cast("string").alias("listing_day"),
        F.col("p_size").cast("string").alias("fiscal_month"),
        F.lit(None).cast("string").alias("ceo"),
        F.lit(None).cast("string").alias("homepage"),
        F.lit(None).cast("string").alias("region"),
        F.col("p_size").alias("size"))


def listing_code(code: str) -> Column:
    """A brand as a listed code: its number, padded."""
    from ..functions.scalar import pad_code
    return pad_code(brand_number(F.col(code)))


def brand_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staged listing of the brands, whose codes the bars have (``listing_code``); ``size`` is the number."""
    n = brand_number(F.col("p_brand"))
    part = read(spark, sf_dir, "part").groupBy(n.alias("code")).agg(F.min("p_type").alias("sector"), F.min("p_name").alias("products"))
    none = [F.lit(None).cast("string").alias(c) for c in ("listing_day", "fiscal_month", "ceo", "homepage", "region")]
    return part.select("code", F.concat(F.lit("Company "), F.col("code").cast("string")).alias("company"), "sector", "products", *none, F.col("code").alias("size"))


def measure_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraped-looking measure text: thousands separators, 'N/A', empty cells."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    k = F.col("c_custkey") % 10
    text = (F.when(k == 0, F.lit("N/A"))
             .when(k == 1, F.lit(""))
             .otherwise(F.format_number("c_acctbal", 2)))
    return c.select(F.col("c_custkey").alias("key"), text.alias("text"))


def fin_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statement cells (code, gb, period_header, pos, measure, text).

    Quarterly ('Q') and yearly ('Y') periods of l_shipdate; l_linenumber and
    l_partkey pick one of the 28 measures; text is the thousands-separated sum
    of l_quantity.  Periods of 2001 carry the '(E)' estimate marker, and a
    third of the trades of 1998 do, so 1998 has an actual and an estimate of
    the same period; ``pos`` is the period's place on the page.  Yearly row
    headers carry a leading no-break space, as scraped pages do.  Sums that end
    in 13 are written with a stray letter: cells that no number can be read from.
    """
    t = _trades(spark, sf_dir)
    headers = F.array(*[F.lit(h) for h in MEASURE_HEADERS])
    measure = F.element_at(headers, ((F.col("l_linenumber") - 1) * 4 + F.col("l_partkey") % 4 + 1).cast("int"))
    year = F.year("l_shipdate")
    guess = (year >= 2001) | ((year == 1998) & (F.col("l_suppkey") % 3 == 0))
    est = F.when(guess, F.lit("(E)")).otherwise(F.lit(""))
    month = F.quarter("l_shipdate") * 3
    place = (lambda m: ((year * 100 + m) * 2 + guess.cast("int")).cast("int").alias("pos"))
    # one scan: every trade feeds its quarterly and its yearly cell
    variants = F.array(
        F.struct(F.lit("Q").alias("gb"), F.concat(year.cast("string"), F.lit("/"), F.lpad(month.cast("string"), 2, "0"), est).alias("p"),
                 place(month), measure.alias("m")),
        F.struct(F.lit("Y").alias("gb"), F.concat(year.cast("string"), F.lit("/12"), est).alias("p"),
                 place(F.lit(12)), F.concat(F.lit("\u00a0"), measure).alias("m")))
    v = t.select(F.col("p_brand").alias("code"), "l_quantity", F.explode(variants).alias("v"))
    total = F.sum("l_quantity")
    stray = F.when(total.cast("bigint") % 100 == 13, F.lit("x")).otherwise(F.lit(""))
    return (v.groupBy(F.col("code"), F.col("v.gb").alias("gb"), F.col("v.p").alias("period_header"),
                      F.col("v.pos").alias("pos"), F.col("v.m").alias("measure"))
             .agg(F.concat(F.format_number(total, 0), stray).alias("text")))


def upsert_pair(b: DataFrame, cut: str = "1999-01-04",
                overlap_weeks: int = 4) -> tuple[DataFrame, DataFrame]:
    """(current, batch) for the upsert operators.

    current = bars before ``cut``; batch = bars from ``overlap_weeks`` before
    the cut onwards with close + 1 (overlap = restated, rest = new), plus the
    bars of the cut week a second time with close + 2 and a later ``_seq``.
    """
    current = b.filter(F.col("date") < F.lit(cut).cast("date"))
    start = F.date_sub(F.lit(cut).cast("date"), 7 * overlap_weeks)
    restated = (b.filter(F.col("date") >= start)
                 .withColumn("close", F.col("close") + 1)
                 .withColumn("_seq", F.lit(1)))
    again = (b.filter(F.col("date") == F.lit(cut).cast("date"))
              .withColumn("close", F.col("close") + 2)
              .withColumn("_seq", F.lit(2)))
    return current, restated.unionByName(again)


def company_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simple master (code, company, last_update) from the listing: last_update is
    2021-01-01 plus the part size in days."""
    from ..functions.scalar import pad_code
    p = read(spark, sf_dir, "part")
    return p.select(pad_code("p_partkey").alias("code"), F.col("p_name").alias("company"),
                    F.date_add(F.lit("2021-01-01").cast("date"), F.col("p_size")).alias("last_update"),
                    F.col("p_size").alias("size"))


def render_quote_pages(bars: DataFrame, rows_per_page: int = 10) -> DataFrame:
    """Staged quote pages in the quote-site layout, built from bars (newest
    first, ``rows_per_page`` rows per page, a pager link to the last page)."""
    from ..functions import series as S
    s = S.open_series(bars.select("code", "date", "open", "high", "low", "close", "volume"))
    prev = S.lag("close")
    s = s.withColumn("diff", F.coalesce(F.col("close") - prev, F.lit(0)))
    s = S.finish(s.withColumn("_pos", S.row_position()))
    counts = s.groupBy("code").agg(F.count(F.lit(1)).alias("_n"))
    s = s.join(counts, "code").withColumn(
        "page", (F.expr(f"(_n - 1 - _pos) DIV {rows_per_page}") + 1).cast("int"))
    n_pages = F.expr(f"CAST((_n - 1) DIV {rows_per_page} + 1 AS INT)")
    heads = "".join(f"<th>{h}</th>" for h in QUOTE_HEADERS)
    num = lambda c: F.format_number(F.col(c).cast("double"), 0)
    row = F.concat(F.lit("<tr><td>"), F.date_format("date", "yyyy.MM.dd"), F.lit("</td><td>"),
                   num("close"), F.lit("</td><td>"), num("diff"), F.lit("</td><td>"),
                   num("open"), F.lit("</td><td>"), num("high"), F.lit("</td><td>"),
                   num("low"), F.lit("</td><td>"), num("volume"), F.lit("</td></tr>"))
    g = (s.groupBy("code", "page", n_pages.alias("_pages"))
          .agg(F.sort_array(F.collect_list(F.struct(F.col("date"), row.alias("r"))), asc=False).alias("_rows")))
    body = F.array_join(F.transform("_rows", lambda e: e["r"]), '<tr><td colspan="7"></td></tr>')
    html = F.concat(F.lit(f'<table class="quotes"><tr>{heads}</tr><tr><td colspan="7"></td></tr>'),
                    body, F.lit(f'</table><table class="pager"><tr><td class="{PAGER_CLASS}"><a href="/quotes?code='),
                    F.col("code"), F.lit("&amp;page="), F.col("_pages").cast("string"),
                    F.lit('">last</a></td></tr></table>'))
    return g.select("code", "page", html.alias("html"))


def render_statement_pages(cells: DataFrame) -> DataFrame:
    """Statement pages in the source layout from cells (periods across, measures down).

    One page per (code, gb); its periods and measures are bounded by the
    statement layout (a few years or quarters, 28 rows).
    """
    periods = (cells.groupBy("code", "gb")
                    .agg(F.sort_array(F.collect_set(F.struct("pos", "period_header"))).getField("period_header").alias("_p")))
    rows = (cells.groupBy("code", "gb", "measure")
                 .agg(F.map_from_entries(F.collect_list(F.struct("period_header", "text"))).alias("_v")))
    j = rows.join(periods, ["code", "gb"])
    tds = F.array_join(F.transform("_p", lambda p: F.concat(
        F.lit("<td>"), F.coalesce(F.element_at(F.col("_v"), p), F.lit("")), F.lit("</td>"))), "")
    tr = F.concat(F.lit("<tr><th>"), F.col("measure"), F.lit("</th>"), tds, F.lit("</tr>"))
    page = (j.groupBy("code", "gb", "_p")
             .agg(F.array_join(F.sort_array(F.collect_list(F.struct("measure", tr.alias("r"))))
                               .getField("r"), "").alias("_body")))
    head = F.concat(F.lit('<table class="menu"><thead><tr><th>x</th></tr><tr><th>1999/01</th></tr></thead><tbody><tr><th>CAPEX</th><td>77</td></tr></tbody></table>'
                         f'<table class="{STATEMENT_CLASS}" summary="{STATEMENT_SUMMARY}"><thead><tr><th>main</th></tr><tr>'),
                    F.array_join(F.transform("_p", lambda p: F.concat(F.lit("<th>"), p, F.lit("</th>"))), ""),
                    F.lit("</tr></thead><tbody>"), F.col("_body"), F.lit("</tbody></table>"))
    return page.select("code", "gb", head.alias("html"))
