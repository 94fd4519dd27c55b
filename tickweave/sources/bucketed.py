"""Stored tables bucketed by their key: a merge shuffles the batch and never the table.

The table is Parquet, one folder per value of ``partition_col`` and in it one
file per bucket of the key.  A merge by that key reads the touched partitions
bucket by bucket, so only the batch is exchanged, into the same buckets, and the
merged rows are written from the tasks that hold them.  Buckets hash the whole
key (code and date, not the code), so no code can fill one.

A partition is replaced through a journal beside the table: the new folders are
written there whole, and only then moved in one by one.  A writer that dies
while it writes leaves a journal without ``_SUCCESS``, which the next one
discards; one that dies while it moves leaves folders that the next one moves.
A batch that runs again gives the same table.  There is one writer at a time, as
with any overwrite of files; a reader during the moves may meet a partition
between its two states (``sources.versions`` commits several at once, unbucketed).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import SEQ, latest_per_key

JOURNAL = "_journal"


class BucketedTable:
    """The table ``name`` of the session's catalog, with its files at ``path``.

    ``partition_col`` is a function of ``keys`` (``year`` of ``date``) and the last
    column of ``schema``.  ``buckets`` is fixed when the table is made: choose it for
    buckets of some 128 MB in the partitions that a batch touches.  Key columns are not null.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, schema: T.StructType, keys: Sequence[str] = ("code", "date"),
                 partition_col: str = "year", buckets: int = 64):
        self.spark, self.name, self.path = spark, name, path.rstrip("/")
        self.keys, self.partition_col, self.buckets = list(keys), partition_col, buckets
        self.schema = T.StructType([f for f in schema if f.name != partition_col] + [schema[partition_col]])
        fs = spark._jvm.org.apache.hadoop.fs
        self._at = fs.Path
        self._fs = fs.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._at(self.path))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        by, quoted = ", ".join(f"`{k}`" for k in self.keys), self.path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (`{partition_col}`) "
                  f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{quoted}'")
        self._finish()

    def _partitions(self, path: str) -> list[str]:
        at = self._at(path)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at) if "=" in s.getPath().getName()) if self._fs.exists(at) else []

    def table(self) -> DataFrame:
        """The whole table as it is now."""
        return self.spark.table(self.name)

    def _values(self, batch: DataFrame) -> list:
        """The partition values of a batch: one small aggregate, as many values as the table has partitions at most."""
        return [r[0] for r in batch.select(self.partition_col).distinct().collect()]

    def _split(self, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The table's touched and untouched partitions, pruned when the plan is made."""
        table, col, values = self.table(), F.col(self.partition_col), self._values(batch)
        hit = F.lit(False)
        for v in values:
            hit = hit | (col.isNull() if v is None else col.eqNullSafe(F.lit(v)))
        return table.where(hit), table.where(~hit)

    def _dealt(self, batch: DataFrame, seq: str) -> DataFrame:
        """The batch's last row of each key, in the table's buckets (combined map-side first, so a key sent often is no hot bucket)."""
        rows = latest_per_key(batch, self.keys, seq).drop(seq) if seq in batch.columns else batch
        kind = {f.name: f.dataType for f in self.schema}
        rows = rows.select(*[F.col(c).cast(kind[c]).alias(c) if c in kind else F.col(c) for c in rows.columns])
        return rows.repartition(self.buckets, *self.keys)

    def merged(self, batch: DataFrame, merge_fn: Callable[..., DataFrame], *args, seq: str = SEQ) -> DataFrame:
        """The touched partitions after ``merge_fn(stored rows, batch rows, *args)``; the table is not changed."""
        return merge_fn(self._split(batch)[0], self._dealt(batch, seq), *args)

    def after(self, batch: DataFrame, merge_fn: Callable[..., DataFrame], *args, seq: str = SEQ) -> DataFrame:
        """The whole table as ``apply`` would leave it, without writing it."""
        old, rest = self._split(batch)
        return rest.unionByName(merge_fn(old, self._dealt(batch, seq), *args))

    def apply(self, batch: DataFrame, merge_fn: Callable[..., DataFrame], *args, seq: str = SEQ) -> DataFrame:
        """Merge the batch into the stored table; returns the table."""
        return self.replace(self.merged(batch, merge_fn, *args, seq=seq))

    def replace(self, rows: DataFrame) -> DataFrame:
        """Put ``rows`` in place of the partitions that they lie in, whole; returns the table.

        Rows that come from ``merged`` are in their buckets; others (the first
        load) are dealt by ``load``.
        """
        self._write(rows)
        self._finish()
        return self.table()

    def load(self, rows: DataFrame) -> DataFrame:
        """The first load, or whole partitions from elsewhere: one shuffle into the buckets."""
        return self.replace(rows.repartition(self.buckets, *self.keys))

    def _write(self, rows: DataFrame) -> None:
        """The new partitions, whole, in the journal."""
        writer = rows.select(*self.schema.names).write.mode("overwrite").format("parquet").partitionBy(self.partition_col)
        journal = f"{self.name}_journal"
        self.spark.sql(f"DROP TABLE IF EXISTS {journal}")
        writer.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", f"{self.path}/{JOURNAL}").saveAsTable(journal)
        self.spark.sql(f"DROP TABLE {journal}")     # an entry over a path: the files stay

    def _finish(self) -> None:
        """Move what a complete journal holds into the table; discard an incomplete one; list the table's partitions."""
        journal = f"{self.path}/{JOURNAL}"
        if self._fs.exists(self._at(f"{journal}/_SUCCESS")):
            for folder in self._partitions(journal):
                new, old = self._at(f"{journal}/{folder}"), self._at(f"{self.path}/{folder}")
                self._fs.delete(old, True)
                if not self._fs.rename(new, old):
                    raise OSError(f"{folder} of {self.path} could not be replaced")
        self._fs.delete(self._at(journal), True)
        self.spark.catalog.recoverPartitions(self.name)
        self.spark.catalog.refreshTable(self.name)
