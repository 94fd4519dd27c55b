"""Session helpers: builder defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "tickweave",
              shuffle_partitions: int | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A cluster names it.  Where it is unset, a local session (unit tests, a
    laptop) gets a scratch folder; any other session is refused, as executors
    would not see the driver's folders.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tickweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder name under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return "/".join([root, "tickweave", *parts, uuid.uuid4().hex])


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for the few places that need os paths (tests)."""
    return path[5:] if path.startswith("file:") else path


def exists_local(path: str) -> bool:
    return os.path.exists(local_path(path))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``, in any file system that Spark reaches."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def materialize(df, *name: str, partition_by: list[str] | None = None,
                sort_by: list[str] | None = None):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage (later branches and scalar subqueries read the files instead
    of recomputing the plan) and survives executor loss, unlike a cache or a
    local checkpoint.  The folder goes when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, *name)
    w = df
    if sort_by:
        w = w.sortWithinPartitions(*sort_by)
    writer = w.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tickweave`` importable in Python workers (``mapInPandas`` tasks).

    Zips the package once per application and registers it with
    ``addPyFile``; Spark serves the zip to every executor, so workers do not
    depend on the driver's working directory or ``sys.path``.
    """
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="tickweave-pkg-"), "tickweave.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
