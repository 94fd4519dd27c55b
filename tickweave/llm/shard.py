"""Sharding by extendible hashing.

A shard is a bucket of documents whose hash starts with the same bits.  The
directory is indexed by hash-prefix bits; a bucket over the byte limit splits
on one more bit, the others stay.  Bytes are summed once per fine prefix (a
histogram); each bucket's depth is the least one at which its bytes fit.
Prefixes that are still too large at the histogram's depth get a deeper
histogram of their own documents only.

Defined results: a null text has no bytes; documents are hashed by id
(31 bits of md5; a null id as the empty text), so rows with equal ids share a
bucket; a bucket whose rows all have one hash cannot be split by bits and is
cut by running bytes into numbered parts (``part``), each under the limit
unless a row alone holds half of it; an empty table gives no rows.  Columns
of the input stay as they are, except for clashing names, which give way to
those added here.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.session import materialize

HASH_BITS = 31


def id_hash(col: str = "doc_id") -> Column:
    """31 hash bits of an id, the same in any SQL engine that has md5."""
    return F.expr(f"conv(substr(md5(coalesce(cast(`{col}` as string), '')), 1, 8), 16, 10)").cast("long").bitwiseAND((1 << HASH_BITS) - 1)


def _prefix(h: Column, depth) -> Column:
    return F.floor(h / F.pow(F.lit(2.0), F.lit(HASH_BITS) - depth)).cast("long")


def directory(sizes: DataFrame, limit: int, first_bits: int | None = None) -> DataFrame:
    """(depth, prefix, shard_bytes, n_docs) of every bucket, from rows (h, n_bytes).

    One histogram per round over the prefixes that are still open; a round
    adds ``step`` bits, and the last ends at all hash bits.
    """
    total = sizes.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("b")).first()["b"]
    bits = first_bits if first_bits is not None else min(HASH_BITS, max(4, math.ceil(math.log2(max(1, total / limit)) + 5)))
    done, open_prefix, low = None, None, 0
    while True:
        rows = sizes if open_prefix is None else sizes.join(open_prefix, _prefix(F.col("h"), low) == F.col("prefix"), "left_semi")
        fine = rows.groupBy(_prefix(F.col("h"), bits).alias("fine")).agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n"))
        fine = materialize(fine, "shard")
        # every bucket that a fine prefix could belong to, from coarse to fine
        depths = F.explode(F.sequence(F.lit(low), F.lit(bits))).alias("depth")
        nodes = fine.select("fine", "b", "n", depths).withColumn("prefix", F.floor(F.col("fine") / F.pow(F.lit(2.0), F.lit(bits) - F.col("depth"))).cast("long"))
        nodes = nodes.groupBy("depth", "prefix").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("n_docs"))
        fits = (F.col("shard_bytes") <= limit) | ((F.col("depth") == bits) & F.lit(bits == HASH_BITS))
        parent = F.col("p.prefix") == F.floor(F.col("n.prefix") / 2)
        over = nodes.where(F.col("shard_bytes") > limit).select((F.col("depth") + 1).alias("depth"), "prefix")
        leaves = nodes.alias("n").join(over.alias("p"), (F.col("n.depth") == F.col("p.depth")) & parent, "left_semi").where(fits)
        if low == 0:
            leaves = leaves.unionByName(nodes.where((F.col("depth") == 0) & fits))
        done = leaves if done is None else done.unionByName(leaves)
        deeper = nodes.where((F.col("depth") == bits) & ~fits)
        if bits == HASH_BITS or deeper.isEmpty():
            return materialize(done, "shard")
        open_prefix, low, bits = materialize(deeper.select("prefix"), "shard"), bits, min(HASH_BITS, bits + 8)


def _numbered_parts(rows: DataFrame, limit: int) -> DataFrame:
    """Cut buckets of one hash at half the limit of running bytes.

    Two-pass sums: totals per bucket and task, then the running sum inside
    each task, so no bucket meets in one task.
    """
    rows = materialize(rows, "shard").withColumns({"task": F.spark_partition_id(), "row": F.monotonically_increasing_id()})
    rows = materialize(rows, "shard")  # the numbers stay as they are from here on
    before = Window.partitionBy("h").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("h", "task").agg(F.sum("n_bytes").alias("b")).select("h", "task", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("h", "task").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("base") + F.coalesce(F.sum("n_bytes").over(inside), F.lit(0))
    rows = rows.join(bases, ["h", "task"]).withColumn("part", F.floor(at / (limit / 2)).cast("long"))
    sums = rows.groupBy("h", "part").agg(F.sum("n_bytes").alias("part_bytes"))
    return rows.join(sums, ["h", "part"]).withColumn("shard_bytes", F.col("part_bytes"))


def shards(docs: DataFrame, limit: int, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents with their ``shard`` (the prefix bits as text), ``part``, ``depth``, ``n_bytes`` and ``shard_bytes``."""
    own = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row_in"), id_hash(id_col).alias("h"),
                       F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long").alias("n_bytes"))
    tree = directory(rows.select("h", "n_bytes"), limit)
    depths = sorted(r["depth"] for r in tree.select("depth").distinct().collect()) or [0]  # at most 32 values
    at = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), _prefix(F.col("h"), F.lit(d)).alias("prefix")) for d in depths]))
    # buckets are disjoint, so a document meets exactly one; hash prefixes are even, so no key is hot
    placed = rows.withColumn("at", at).select("row_in", "h", "n_bytes", "at.*").join(tree, ["depth", "prefix"])
    names = ["row_in", "h", "n_bytes", "depth", "prefix", "shard_bytes"]
    placed = placed.select(*names, F.lit(0).cast("long").alias("part"))
    if not tree.where(F.col("shard_bytes") > limit).isEmpty():
        cut = _numbered_parts(placed.where(F.col("shard_bytes") > limit).select(*names), limit)
        placed = placed.where(F.col("shard_bytes") <= limit).unionByName(cut.select(*names, "part"))
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr(f"substr(lpad(bin(prefix << ({HASH_BITS} - depth)), {HASH_BITS}, '0'), 1, depth)"))
    return placed.select(*[F.col(f"row_in.`{c}`") for c in own if c.lower() not in ("shard", "part", "depth", "n_bytes", "shard_bytes")],
                         bits.alias("shard"), "part", "depth", "n_bytes", "shard_bytes")


def write_shards(docs: DataFrame, path: str, limit: int, text_col: str = "text", id_col: str = "doc_id") -> None:
    """Write one folder of Parquet files per shard and part."""
    placed = shards(docs, limit, text_col, id_col)
    placed.repartition("shard", "part").write.partitionBy("shard", "part").parquet(path)
