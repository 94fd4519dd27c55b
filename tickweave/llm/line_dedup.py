"""Line dedup by overlapping three-line windows, in DataFrame functions only.

Every three consecutive lines of a document are hashed (128 bits).  A window
that occurs more than once has a first occurrence, the least (doc_id, line
number); all lines that any later occurrence covers are removed, and covered
lines of overlapping windows merge.  Occurrences are judged on the input, not
on what is left.

Defined results: a null text stays null and has no lines; texts of fewer than
three lines have no window and stay whole; windows of blank lines alone never
count; a null id sorts after all others; rows equal in id and text are one
document (each keeps the same lines); an empty table gives no rows; other
columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines of a window.
WINDOW = 3


def _windows(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(id, digest of the text, pos, h1, h2) of each window."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("digest"),
                       F.split(F.col(f"`{text_col}`"), "\n").alias("lines")).where(F.size("lines") >= WINDOW)

    def window(i):
        part = [F.get("lines", i + k) for k in range(WINDOW)]
        blank = F.trim(F.concat(*part)) == ""
        return F.struct(i.alias("pos"), F.xxhash64(*part).alias("h1"), F.xxhash64(*reversed(part), F.lit(WINDOW)).alias("h2"), blank.alias("blank"))

    each = F.explode(F.transform(F.sequence(F.lit(0), F.size("lines") - WINDOW), window))
    return rows.select("id", "digest", each.alias("w")).select("id", "digest", "w.*").where(~F.col("blank")).drop("blank")


def _place(prefix: str = ""):
    """Sort key of an occurrence: null ids last."""
    return F.struct(F.col(f"{prefix}id").isNull().alias("last"), F.col(f"{prefix}id").alias("id"), F.col(f"{prefix}digest").alias("digest"), F.col(f"{prefix}pos").alias("pos"))


def covered_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, digest, covered): the line numbers that later occurrences cover, per document."""
    windows = _windows(docs, text_col, id_col)
    # partial minima per task come before the shuffle, so a hot window is a few rows per task
    first = windows.groupBy("h1", "h2").agg(F.min(_place()).alias("first"), F.max(_place()).alias("final")).where(F.col("first") != F.col("final"))
    later = windows.join(first.select("h1", "h2", "first"), ["h1", "h2"]).where(_place() != F.col("first"))
    return later.groupBy("id", "digest").agg(F.array_distinct(F.flatten(F.collect_set(F.sequence("pos", F.col("pos") + (WINDOW - 1))))).alias("covered"))


def dedup_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents with the text that is left, ``n_lines`` and ``n_removed``."""
    own = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row_in"), F.col(f"`{id_col}`").alias("id"),
                       F.xxhash64(F.col(f"`{text_col}`")).alias("digest"))
    gone = covered_lines(docs, text_col, id_col).withColumnsRenamed({"id": "gone_id", "digest": "gone_digest"})
    rows = rows.join(gone, rows["id"].eqNullSafe(gone["gone_id"]) & (rows["digest"] == gone["gone_digest"]), "left")
    text = F.col(f"row_in.`{text_col}`")
    rows = rows.withColumn("lines", F.when(F.col("covered").isNotNull(), F.split(text, "\n")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("covered"))
    left = F.when(F.col("covered").isNull(), text).otherwise(F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
    n_lines = F.when(text.isNull(), 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)
    return rows.select(*[left.alias(c) if c == text_col else F.col(f"row_in.`{c}`") for c in own if c.lower() not in ("n_lines", "n_removed") or c in (text_col, id_col)],
                       n_lines.cast("long").alias("n_lines"), F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"))
