"""Set-based upserts.

The source issues one MERGE / REPLACE per row with a commit each.  Here a
batch is merged with one aggregation (U1) or one full outer join (U2) on the
key; the result is written as a new snapshot folder (the input snapshot is
never overwritten while it is read).  Re-running the same batch gives the
same table (idempotent).

Both operators shuffle once on the key; a key group holds the current row
plus the batch rows for that key, so no group can grow with the data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, path_exists

SEQ = "_seq"
CURRENT_SEQ = -1  # the stored table is older than any batch row


def latest_per_key(df: DataFrame, keys: Sequence[str], seq: str = SEQ) -> DataFrame:
    """Keep the row with the largest ``seq`` per key (an aggregate: partial
    ``max_by`` per task, so duplicates are combined before the shuffle)."""
    others = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in others]), F.col(seq)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])


def upsert(current: DataFrame, batch: DataFrame, keys: Sequence[str], seq: str = SEQ) -> DataFrame:
    """U1/K3 last write wins: full-row replace by key (``REPLACE INTO``).

    ``batch`` carries ``seq`` (batch id and arrival order folded into one
    increasing number); the stored rows count as older than any batch row.
    """
    cols = current.columns
    cur = current.withColumn(seq, F.lit(CURRENT_SEQ).cast("bigint"))
    new = batch.select(*cols, F.col(seq).cast("bigint").alias(seq))
    return latest_per_key(cur.unionByName(new), keys, seq).select(*cols)


def merge(current: DataFrame, batch: DataFrame, keys: Sequence[str],
          on_match: Mapping[str, Column] | None = None,
          on_insert: Mapping[str, Column] | None = None,
          keep_on_match: Sequence[str] = (), seq: str | None = SEQ) -> DataFrame:
    """U2 ``MERGE``: matched keys take the batch values (except ``keep_on_match``
    columns, which stay) plus ``on_match`` expressions; new keys take the batch
    values plus ``on_insert`` expressions; keys only in ``current`` stay as is.

    ``on_match`` / ``on_insert`` values are Columns: literals such as audit
    stamps, or ``F.col("b_<name>")`` / ``F.col("c_<name>")`` for the batch /
    stored value.  Output has the columns of ``current``.
    """
    on_match, on_insert = dict(on_match or {}), dict(on_insert or {})
    if seq and seq in batch.columns:
        batch = latest_per_key(batch, keys, seq).drop(seq)
    cols = current.columns
    b_cols = set(batch.columns)
    c = current.select(*[F.col(x).alias(f"c_{x}") for x in cols], F.lit(True).alias("_in_c"))
    b = batch.select(*[F.col(x).alias(f"b_{x}") for x in batch.columns], F.lit(True).alias("_in_b"))
    cond = [F.col(f"c_{k}") == F.col(f"b_{k}") for k in keys]
    j = c.join(b, on=cond[0] if len(cond) == 1 else _and(cond), how="full_outer")
    in_c, in_b = F.col("_in_c").isNotNull(), F.col("_in_b").isNotNull()
    out = []
    for x in cols:
        cur = F.col(f"c_{x}")
        new = F.col(f"b_{x}") if x in b_cols else F.lit(None).cast(current.schema[x].dataType)
        if x in keys:
            val = F.coalesce(cur, new)
        else:
            matched = cur if x in keep_on_match else new
            if x in on_match:
                matched = on_match[x]
            inserted = on_insert.get(x, new)
            val = (F.when(in_c & in_b, matched)
                    .when(in_b, inserted)
                    .otherwise(cur))
        out.append(val.cast(current.schema[x].dataType).alias(x))
    return j.select(*out)


def _and(conds):
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def touched(current: DataFrame, batch: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Rows of ``current`` in the storage partitions (e.g. ``year``) a batch touches.

    A semi join on the partition columns: with a partitioned Parquet table,
    Spark prunes the untouched partitions at runtime (dynamic partition
    pruning), so a daily batch reads one or two years, not the history.
    """
    keys = batch.select(*partition_cols).distinct()
    return current.join(keys, list(partition_cols), "left_semi").select(*current.columns)


def write_partitions(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """Replace only the partitions present in ``df`` (dynamic partition overwrite).

    Write the merge of ``touched(...)`` to a new snapshot folder first when
    the target is also being read (Spark refuses to overwrite a path it reads).
    """
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols).parquet(path))


def upsert_partitions(current: DataFrame, batch: DataFrame, keys: Sequence[str],
                      partition_cols: Sequence[str], seq: str = SEQ) -> DataFrame:
    """U1 restricted to the partitions the batch touches (the rows to rewrite)."""
    return upsert(touched(current, batch, partition_cols), batch, keys, seq)


def untouched(current: DataFrame, batch: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Rows of ``current`` outside the partitions a batch touches (pass through unshuffled)."""
    keys = batch.select(*partition_cols).distinct()
    return current.join(keys, list(partition_cols), "left_anti").select(*current.columns)


def upsert_incremental(current: DataFrame, batch: DataFrame, keys: Sequence[str],
                       partition_cols: Sequence[str], seq: str = SEQ) -> DataFrame:
    """U1 over a partitioned table: the whole new table, but only the touched
    partitions go through the key shuffle; the rest streams through an anti join
    against the (small) set of touched partition values.  The partition columns
    must be functions of the key (``year`` of ``date`` for bars)."""
    return untouched(current, batch, partition_cols).unionByName(
        upsert_partitions(current, batch, keys, partition_cols, seq))


def merge_incremental(current: DataFrame, batch: DataFrame, partition_cols: Sequence[str],
                      merge_fn, *args) -> DataFrame:
    """U2 counterpart of ``upsert_incremental``: ``merge_fn(touched, batch, *args)``."""
    return untouched(current, batch, partition_cols).unionByName(
        merge_fn(touched(current, batch, partition_cols), batch, *args))


def ensure_table(spark, path: str, schema) -> DataFrame:
    """K1 ``CREATE TABLE IF NOT EXISTS``: an empty Parquet table with the
    given schema on first use; keys are enforced by the merges, not the store."""
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def stamp(ts: str | dt.datetime) -> Column:
    """An audit timestamp passed in by the caller (never ``now()`` inside a
    merge: a re-run must give the same table)."""
    return F.lit(str(ts)).cast("timestamp")


def merge_bars(current: DataFrame, batch: DataFrame, ts: str) -> DataFrame:
    """K5 by (code, date): matched -> OHLCV + upd_dt; new -> reg_dt = upd_dt = ts."""
    return merge(current, batch, ["code", "date"],
                 on_match={"upd_dt": stamp(ts)},
                 on_insert={"reg_dt": stamp(ts), "upd_dt": stamp(ts)},
                 keep_on_match=["reg_dt", "ymd", "diff"])


def replace_bars(current: DataFrame, batch: DataFrame) -> DataFrame:
    """K3 by (code, date) as a join: whole rows of the batch replace stored ones.  The join keeps a
    stored side that is bucketed by the key where it is, which the union of ``upsert`` does not."""
    return merge(current, batch, ["code", "date"])


def merge_items(current: DataFrame, batch: DataFrame, ts: str) -> DataFrame:
    """K4 by code: matched -> attributes + upd_dt (reg_dt kept); new -> reg_dt, upd_dt NULL."""
    return merge(current, batch, ["code"],
                 on_match={"upd_dt": stamp(ts)},
                 on_insert={"reg_dt": stamp(ts), "upd_dt": F.lit(None).cast("timestamp")},
                 keep_on_match=["reg_dt"])


def merge_fundamentals(current: DataFrame, batch: DataFrame, ts: str, user: str = "sys") -> DataFrame:
    """K6 by (code, ym, gb): every column overwritten on match, reg_dt included."""
    audit = {"reg_id": F.lit(user), "upd_id": F.lit(user), "reg_dt": stamp(ts), "upd_dt": stamp(ts)}
    return merge(current, batch, ["code", "ym", "gb"], on_match=audit, on_insert=audit)


def store_fundamentals(path: str, stored: DataFrame, batch: DataFrame, ts: str, user: str = "sys") -> DataFrame:
    """K6 over the stored table at ``path``, partitioned by ``year``: the years
    of the batch are read, merged and replaced (dynamic partition overwrite);
    the other years are neither read nor written.  Returns the table."""
    spark = stored.sparkSession
    merged = materialize(merge_fundamentals(touched(stored, batch, ["year"]), batch, ts, user), "fundamentals")
    write_partitions(merged, path, ["year"])
    return spark.read.schema(stored.schema).parquet(path)


def needs_refresh(company_info: DataFrame, today: str) -> DataFrame:
    """A7 stale when the table is empty or max(last_update) is before ``today``."""
    last = F.max("last_update")
    return company_info.agg(last.alias("last_update"),
                            (last.isNull() | (last < F.lit(today).cast("date"))).alias("needs_refresh"))


def replace_company_info(current: DataFrame, listing: DataFrame, today: str) -> DataFrame:
    """K2 full-row replace of (code, company) with last_update = today."""
    batch = listing.select("code", F.col("name").alias("company"),
                           F.lit(today).cast("date").alias("last_update"),
                           F.lit(0).cast("bigint").alias(SEQ))
    return upsert(current.select("code", "company", "last_update"), batch, ["code"])


def refresh_company_info(current: DataFrame, listing: DataFrame, today: str) -> tuple[DataFrame, bool]:
    """K2 with its gate: replace from the listing only when the master is stale
    (A7).  The gate is one driver-side decision read from a one-row aggregate;
    returns (table, refreshed)."""
    stale = needs_refresh(current, today).first()["needs_refresh"]
    if not stale:
        return current.select("code", "company", "last_update"), False
    return replace_company_info(current, listing, today), True


def ingest_for_listing(current: DataFrame, staged: DataFrame, listing: DataFrame,
                       since: str, ts: str) -> DataFrame:
    """K7 bars since a date for the codes of a (fresh) listing, merged by K5.

    On year-partitioned bars only the touched years go through the merge.
    """
    picked = (staged.filter(F.col("date") >= F.lit(since).cast("date"))
                    .join(listing.select("code"), "code", "left_semi"))
    if "year" in current.columns:
        return merge_incremental(current, picked, ["year"], merge_bars, ts)
    return merge_bars(current, picked, ts)


def ingest_listing_then_bars(items: DataFrame, raw_listing: DataFrame, current: DataFrame, staged: DataFrame,
                             ymd: str, since: str, ts: str) -> tuple[DataFrame, DataFrame]:
    """K7 the whole chain: the listing refreshes the item master (K4), then bars
    since a date arrive for the codes of that listing -> (items, bars)."""
    from ..sources.listing import listing_to_items, read_listing
    listing = read_listing(raw_listing)
    return (merge_items(items, listing_to_items(listing, ymd), ts),
            ingest_for_listing(current, staged, listing, since, ts))


def commit_listing_then_bars(versions, batch_id: int, items: DataFrame, raw_listing: DataFrame, bars: DataFrame, staged: DataFrame,
                             ymd: str, since: str, ts: str) -> tuple[DataFrame, DataFrame]:
    """K7 as one commit: the new master and the touched years of the bars are
    written as version ``batch_id`` under ``versions`` (``sources.versions``)
    and become visible together -> (items, bars) as they are then.

    ``items`` and ``bars`` (partitioned by ``year``) are the tables before any
    commit.  A batch that is committed changes nothing when it runs again; a
    batch that died before its commit is not seen and runs from the same state.
    """
    from ..sources.listing import listing_to_items, read_listing
    tables = (lambda before=None: (versions.table(items, "items", before=before), versions.table(bars, "bars", ["year"], before=before)))
    if batch_id not in versions.batches():
        master, stored = tables(batch_id)
        listing = read_listing(raw_listing)
        merge_items(master, listing_to_items(listing, ymd), ts).write.mode("overwrite").parquet(versions.folder(batch_id, "items"))
        picked = staged.filter(F.col("date") >= F.lit(since).cast("date")).join(listing.select("code"), "code", "left_semi")
        merge_bars(touched(stored, picked, ["year"]), picked, ts).write.mode("overwrite").partitionBy("year").parquet(versions.folder(batch_id, "bars"))
        versions.commit(batch_id, {"items": [""], "bars": versions.written(batch_id, "bars")})
    return tables()
