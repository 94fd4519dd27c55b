"""Table schemas and fixed vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T

BARS = T.StructType([
    T.StructField("code", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("ymd", T.StringType(), True),
    T.StructField("open", T.LongType(), True),
    T.StructField("high", T.LongType(), True),
    T.StructField("low", T.LongType(), True),
    T.StructField("close", T.LongType(), True),
    T.StructField("diff", T.LongType(), True),
    T.StructField("volume", T.LongType(), True),
    T.StructField("reg_dt", T.TimestampType(), True),
    T.StructField("upd_dt", T.TimestampType(), True),
])
BAR_KEY = ["code", "date"]
PRICE_COLS = ["open", "high", "low", "close", "volume"]

COMPANY_INFO = T.StructType([
    T.StructField("code", T.StringType(), False),
    T.StructField("company", T.StringType(), True),
    T.StructField("last_update", T.DateType(), True),
])

ITEM_ATTRS = ["name", "sector", "products", "listing_day", "fiscal_month", "ceo", "homepage", "region"]
ITEMS = T.StructType(
    [T.StructField("code", T.StringType(), False),
     T.StructField("ymd", T.StringType(), True),
     T.StructField("status", T.StringType(), True)]
    + [T.StructField(c, T.StringType(), True) for c in ITEM_ATTRS]
    + [T.StructField("reg_dt", T.TimestampType(), True),
       T.StructField("upd_dt", T.TimestampType(), True)])

# --- fixed values: must equal the source system's vocabulary -------------------
# The 28 fundamentals measures, in statement order.
MEASURES = [
    "SALES", "PROFIT", "SJ_PROFIT", "DANGGI", "ASSET", "DEBT", "TOT_CAP", "CAP",
    "SALE_CF", "INV_CF", "FIN_CF", "CAPEX", "FCF", "ACC_DEBT", "SALE_PROFIT_RT",
    "NET_PROFIT_RT", "ROE", "ROA", "DEBT_RT", "CAP_RES_RT", "EPS", "PER", "BPS",
    "PBR", "DPS", "CASH_DIV_RT", "CASH_DIV_TEND", "ISSUED_STOCK",
]
# Statement row headers as they appear on the scraped page, in the same order.
MEASURE_HEADERS = [
    "매출액", "영업이익", "세전계속사업이익", "당기순이익", "자산총계", "부채총계", "자본총계", "자본금",
    "영업활동현금흐름", "투자활동현금흐름", "재무활동현금흐름", "CAPEX", "FCF", "이자발생부채", "영업이익률",
    "순이익률", "ROE(%)", "ROA(%)", "부채비율", "자본유보율", "EPS(원)", "PER(배)", "BPS(원)",
    "PBR(배)", "현금DPS(원)", "현금배당수익률", "현금배당성향(%)", "발행주식수(보통주)",
]
# Listing download headers -> canonical item columns.
LISTING_HEADERS = {
    "회사명": "name", "종목코드": "code", "업종": "sector", "주요제품": "products",
    "상장일": "listing_day", "결산월": "fiscal_month", "대표자명": "ceo",
    "홈페이지": "homepage", "지역": "region",
}
# CSS class of the pager cell whose link ends in '=<last page>' on quote pages.
PAGER_CLASS = "pgRR"
# Class and summary of the statement table among the tables of its page.
STATEMENT_CLASS = "gHead01 all-width"
STATEMENT_SUMMARY = "주요재무정보를 제공합니다."
# Daily quote table headers -> canonical bar columns.
QUOTE_HEADERS = {
    "날짜": "date", "종가": "close", "전일비": "diff", "시가": "open",
    "고가": "high", "저가": "low", "거래량": "volume",
}
# -----------------------------------------------------------------------------

MEASURE_OF_HEADER = dict(zip(MEASURE_HEADERS, MEASURES))

FUNDAMENTALS = T.StructType(
    [T.StructField("code", T.StringType(), False),
     T.StructField("ym", T.StringType(), False),
     T.StructField("gb", T.StringType(), False),
     T.StructField("is_estimate", T.BooleanType(), True)]
    + [T.StructField(m, T.DoubleType(), True) for m in MEASURES]
    + [T.StructField("reg_id", T.StringType(), True),
       T.StructField("upd_id", T.StringType(), True),
       T.StructField("reg_dt", T.TimestampType(), True),
       T.StructField("upd_dt", T.TimestampType(), True)])

FIN_CELLS = T.StructType([
    T.StructField("code", T.StringType(), False),
    T.StructField("gb", T.StringType(), False),
    T.StructField("period_header", T.StringType(), True),
    T.StructField("measure", T.StringType(), True),
    T.StructField("text", T.StringType(), True),
])

QUOTE_PAGES = T.StructType([
    T.StructField("code", T.StringType(), False),
    T.StructField("page", T.IntegerType(), False),
    T.StructField("html", T.StringType(), True),
])

QUOTES_RAW = T.StructType([
    T.StructField("code", T.StringType(), False),
    T.StructField("page", T.IntegerType(), False),
    T.StructField("date", T.StringType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("diff", T.DoubleType(), True),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("volume", T.DoubleType(), True),
    T.StructField("last_page", T.IntegerType(), True),
])
