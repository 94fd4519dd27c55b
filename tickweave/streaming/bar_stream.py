"""R1 continuous bar upserts with Structured Streaming.

Staged bar files arrive in a folder; each micro-batch is merged into the
bars table by key, however old the bar (no lateness cut-off, as the daily
re-runs of the source behave): with audit columns a matched bar keeps
``reg_dt`` and gets ``upd_dt`` (U2), without them the last write wins (U1).

A batch writes the partitions it touches as a new version and commits them with
a manifest (``sources.versions``): what a batch writes follows the batch, not
the table, and a batch that dies half-way is never read.  The table is, for each
partition, the version that the newest manifest names, and the initial table
where there is none.  A batch that comes again after its commit changes nothing;
one that died before it runs again from the same state, so the sink is
idempotent by batch id.  Old versions go with ``Versions.vacuum``.

Row windows (lag, rolling frames) are not allowed on a streaming frame;
indicators for the touched codes are recomputed from the table with the batch
operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.upsert import SEQ, latest_per_key, merge_bars, touched, upsert
from ..sources.versions import Versions


def table_now(spark: SparkSession, initial_table: str, table_root: str, partition_cols: Sequence[str] = ("year",),
              before: int | None = None) -> DataFrame:
    """The table after all batches (or those below ``before``)."""
    return Versions(spark, table_root).table(spark.read.parquet(initial_table), "", list(partition_cols), before)


def stream_upsert_bars(spark: SparkSession, source_dir: str, schema: T.StructType, initial_table: str, table_root: str,
                       checkpoint: str, keys: Sequence[str] = ("code", "date"), partition_cols: Sequence[str] = ("year",),
                       ts: str | None = None, max_files_per_trigger: int | None = None, on_snapshot=None, vacuum_keep: int | None = None) -> DataFrame:
    """Drain ``source_dir`` into the table under ``table_root``; returns the table.

    ``schema`` is the staged file schema (a ``_seq`` arrival number included);
    the file source never infers it.  ``checkpoint`` is the caller's and stays
    from run to run: it knows which files have been taken.  ``partition_cols``
    are functions of the key (``year`` of ``date``).  With ``ts``, batches merge
    with audit stamps.  All files at hand make one batch unless
    ``max_files_per_trigger`` says otherwise.  ``on_snapshot(table, touched_codes,
    batch_id)`` runs after each batch (e.g. ``refresh_for_codes`` + a write).
    ``vacuum_keep`` drops versions that the newest so many manifests do not name.
    """
    parts, versions = list(partition_cols), Versions(spark, table_root)

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch_id not in versions.batches():
            current = table_now(spark, initial_table, table_root, parts, before=batch_id)
            old = touched(current, batch, parts)
            if ts is not None:
                rows = latest_per_key(batch.select(*[c for c in current.columns if c in batch.columns], SEQ), keys).drop(SEQ)
                merged = merge_bars(old, rows, ts)
            else:
                merged = upsert(old, batch.select(*current.columns, SEQ), list(keys))
            merged.write.mode("overwrite").partitionBy(*parts).parquet(versions.folder(batch_id))
            versions.commit(batch_id, {"": versions.written(batch_id, depth=len(parts))})
            if vacuum_keep is not None:
                versions.vacuum(vacuum_keep)
        if on_snapshot is not None:
            on_snapshot(table_now(spark, initial_table, table_root, parts), touched_codes(batch), batch_id)

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    q = (reader.parquet(source_dir).writeStream.foreachBatch(apply)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return table_now(spark, initial_table, table_root, parts)


def touched_codes(batch: DataFrame) -> DataFrame:
    return batch.select("code").distinct()


def refresh_for_codes(snapshot: DataFrame, codes: DataFrame, indicator) -> DataFrame:
    """Recompute a (batch) indicator for the codes a micro-batch touched.

    EWMs depend on the whole history of a code, so the touched codes are
    recomputed whole from the new snapshot; other codes keep their values.
    """
    return indicator(snapshot.join(codes, "code", "left_semi"))
