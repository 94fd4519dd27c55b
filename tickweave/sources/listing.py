"""Staged listing downloads (S7, S8) and vendor bar files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import pad_code
from ..schemas import ITEM_ATTRS, LISTING_HEADERS


def rename_listing(raw: DataFrame) -> DataFrame:
    """P2 source headers of a listing download -> canonical column names."""
    return raw.withColumnsRenamed({k: v for k, v in LISTING_HEADERS.items() if k in raw.columns})


def read_listing(raw: DataFrame, full: bool = True) -> DataFrame:
    """S7/S8 listing -> (code, name[, 7 descriptive columns]); code zero-padded to 6.

    Missing values stay NULL (never the text 'nan').  ``raw`` may carry the
    source headers or canonical names (``company`` is accepted for ``name``).
    """
    df = rename_listing(raw)
    if "company" in df.columns and "name" not in df.columns:
        df = df.withColumnRenamed("company", "name")
    cols = [pad_code("code").alias("code"), F.col("name").cast("string").alias("name")]
    if full:
        cols += [(F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c)
                 for c in ITEM_ATTRS if c != "name"]
    return df.select(*cols)


def listing_to_items(listing: DataFrame, ymd: str, status: str = "Y") -> DataFrame:
    """A listing as a batch for the item master (K4): every listed code is active."""
    return listing.select("code", F.lit(ymd).alias("ymd"), F.lit(status).alias("status"),
                          *[F.col(c) for c in ITEM_ATTRS])


VENDOR_SCHEMA = T.StructType([
    T.StructField("code", T.StringType()), T.StructField("Date", T.DateType()),
    T.StructField("Open", T.DoubleType()), T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()), T.StructField("Close", T.DoubleType()),
    T.StructField("Adj Close", T.DoubleType()), T.StructField("Volume", T.DoubleType()),
])


def read_vendor_bars(spark: SparkSession, path: str, since: str, fmt: str = "parquet",
                     adj: bool = False) -> DataFrame:
    """S11/S12 staged vendor OHLCV files since a date -> canonical bars
    (``adj_close`` kept when asked).  The schema is given, never inferred."""
    reader = spark.read.schema(VENDOR_SCHEMA)
    raw = reader.option("header", "true").csv(path) if fmt == "csv" else reader.parquet(path)
    raw = raw.filter(F.col("Date") >= F.lit(since).cast("date"))
    return vendor_to_bars(raw, adj)


def vendor_to_bars(raw: DataFrame, adj: bool = False) -> DataFrame:
    cols = [F.col("code"), F.col("Date").alias("date"),
            F.date_format("Date", "yyyyMMdd").alias("ymd")]
    cols += [F.col(a).cast("bigint").alias(b) for a, b in
             (("Open", "open"), ("High", "high"), ("Low", "low"), ("Close", "close"))]
    cols += [F.lit(None).cast("bigint").alias("diff"), F.col("Volume").cast("bigint").alias("volume")]
    if adj:
        cols.append(F.col("Adj Close").alias("adj_close"))
    return raw.select(*cols)
