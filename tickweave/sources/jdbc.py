"""JDBC connector for the relational stores the source used.

Reads are split into ``num_partitions`` range scans on a numeric or date
column so no single task reads the whole table; filters and column
selections are pushed into the database query by Spark's JDBC source.
Writes append to a staging table; the key-wise merge then runs in the
database (or through ``operators.upsert`` on the DataFrame side).

Not exercised by the tests: no database is reachable from this build.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, *, user: str | None = None,
               password: str | None = None, partition_column: str | None = None,
               lower_bound=None, upper_bound=None, num_partitions: int = 8,
               fetch_size: int = 10000, driver: str | None = None) -> DataFrame:
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("fetchsize", str(fetch_size)))
    if user is not None:
        r = r.option("user", user)
    if password is not None:
        r = r.option("password", password)
    if driver:
        r = r.option("driver", driver)
    if partition_column:
        r = (r.option("partitionColumn", partition_column)
              .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
              .option("numPartitions", str(num_partitions)))
    return r.load()


def write_table(df: DataFrame, url: str, table: str, *, user: str | None = None,
                password: str | None = None, mode: str = "append", batch_size: int = 10000,
                num_partitions: int | None = None, driver: str | None = None) -> None:
    if num_partitions:
        df = df.coalesce(num_partitions)
    w = (df.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", str(batch_size)).mode(mode))
    if user is not None:
        w = w.option("user", user)
    if password is not None:
        w = w.option("password", password)
    if driver:
        w = w.option("driver", driver)
    w.save()
