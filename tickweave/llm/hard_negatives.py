"""Hard-negative mining by slot-decomposed selection.

A positive's window takes scores from ``low * s / 100`` up to its own score
``s``.  The distinct upper limits of an anchor's positives cut the scores into
disjoint slots, highest first.  Tasks score blocks of anchors against slices
of the rows and keep the best few rows of each (anchor, slot); Spark merges
those to the best few of each slot over all rows.  A window's rows then are
the first of its own slot and the slots below it, in order: one descending
suffix of the slots answers every window, however the windows overlap, and
the lower limit only cuts the end off.

Anchors come in blocks of bounded bytes, rows in slices of bounded rows; every
block meets every slice in a task of its own, so tasks stay the same size
however many anchors, rows, equal vectors or equal labels there are.

Defined results: rows with a null label, a null vector, or any null or
non-finite component take no part; of rows with equal ids the least (vector,
label) counts once; vectors of another length than the anchor's have no score
with it; components beyond the range of long integers are its ends, and so
are products; an anchor with no positive, or a window with no row, gives no
rows; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickweave.llm.exchange import by_group
from tickweave.session import materialize

#: Bytes of the vectors of a block of anchors, and rows of a slice: what a task holds at once.
ANCHOR_BYTES = 8 << 20
SLICE_ROWS = 1 << 16
#: Scores computed at a time within a task.
SCORES = 1 << 21

_LEAST = -(1 << 63)
_MOST = (1 << 63) - 1


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices, as long integers (its ends beyond)."""
    most = (np.abs(a.astype(np.float64)).max(initial=0) + 1) * (np.abs(b.astype(np.float64)).max(initial=0) + 1) * max(a.shape[1], 1)
    if most < 2.0**52:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2.0**62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, _LEAST, _MOST).astype(np.int64)


def _least_first(group: np.ndarray, score: np.ndarray, vec_id: np.ndarray, keep: int) -> np.ndarray:
    """Places of the first ``keep`` of each group: higher scores first, ties by smaller id."""
    order = np.lexsort((vec_id, np.invert(score), group))
    g = group[order]
    start = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1]))) if len(g) else np.zeros(0, np.int64)
    nth = np.arange(len(g)) - np.repeat(start, np.diff(np.append(start, len(g))))
    return order[nth < keep]


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, vec, label) of the rows that take part, one for each id."""
    vec = F.col(f"`{vector_col}`")
    odd = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = rows.where(vec.isNotNull() & F.col(f"`{label_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull() & ~odd)
    rows = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vec.alias("vec"), F.col(f"`{label_col}`").alias("label"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("vec", "label")).alias("least")).select("vec_id", "least.vec", "least.label")


def scaled(vec: Column, factor: int) -> Column:
    """floor(factor * x) of each component, x as double."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * F.lit(float(factor))).cast("long"))


def _facing(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, width: int) -> DataFrame:
    """Every block of anchors beside every slice of rows, keyed by (block, slice)."""
    blocks = max(1, -(-n_anchors * (width + 2) * 8 // ANCHOR_BYTES))
    slices = max(1, -(-n_rows // SLICE_ROWS), min(n_rows // 2048, 16))
    mine = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    own = anchors.select(mine.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
                         F.lit(0).alias("kind"), "vec_id", "vec", "label", "limits")
    given = rows.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(slices)).cast("int").alias("slice"),
                        F.lit(1).alias("kind"), "vec_id", "vec", "label", F.lit(None).cast("array<bigint>").alias("limits"))
    return own.unionByName(given)


def _matrices(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, pa.ListArray]]:
    """By vector length: ids, vectors, labels and limits of the rows."""
    table = table.combine_chunks()
    if not table.num_rows:
        return {}
    vecs, limits = (table.column(c).chunk(0) for c in ("vec", "limits"))
    ids, labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))
    values, off = vecs.flatten().to_numpy(), np.diff(vecs.offsets.to_numpy())
    out, ends = {}, np.cumsum(off)
    for width in np.unique(off).tolist():
        at = np.flatnonzero(off == width)
        cells = (ends[at] - width)[:, None] + np.arange(width)
        out[width] = (ids[at], values[cells], labels[at], limits.take(pa.array(at)))
    return out


def _scan(keep: int, low: int, positives: bool):
    """The task: the first ``keep`` rows of each (anchor, slot) of its slice; of the same label for the positives' one slot, else of other labels."""
    def run(_key: tuple, table: pa.Table) -> Iterator[pa.RecordBatch]:
        kind = table.column("kind").to_numpy()
        anchors, rows = _matrices(table.filter(pa.array(kind == 0))), _matrices(table.filter(pa.array(kind == 1)))
        for width, (a_id, a_vec, a_label, a_limits) in anchors.items():
            if width not in rows:
                continue
            r_id, r_vec, r_label, _ = rows[width]
            if not positives:
                tops = a_limits.to_pylist()
                most = max(map(len, tops))
                upper = np.array([t + [_LEAST] * (most - len(t)) for t in tops], np.int64)
                floor = np.array([-(-low * t[-1] // 100) if t[-1] > 0 else t[-1] for t in tops], np.int64)
            step = max(1, SCORES // len(a_id))
            held = [np.zeros(0, np.int64)] * 4
            for i in range(0, len(r_id), step):
                ids, score = r_id[i:i + step], products(a_vec, r_vec[i:i + step])
                same = a_label[:, None] == r_label[None, i:i + step]
                if positives:
                    fits = same & (a_id[:, None] != ids[None, :])
                    if score.shape[1] > 4 * keep:
                        # below an anchor's keep-th best score nothing counts; ties stay
                        edge = np.partition(np.where(fits, score, _LEAST), -keep, axis=1)[:, -keep]
                        fits &= score >= edge[:, None]
                else:
                    fits = ~same & (score <= upper[:, :1]) & (score >= floor[:, None])
                a, r = np.nonzero(fits)
                s = score[a, r]
                slot = np.zeros(len(a), np.int64) if positives else (s[:, None] <= upper[a]).sum(1) - 1
                part = [np.concatenate(x) for x in zip(held, (a, slot, s, ids[r]))]
                first = _least_first(part[0] * 64 + part[1], part[2], part[3], keep)
                held = [x[first] for x in part]
            yield pa.RecordBatch.from_arrays([pa.array(a_id[held[0]]), pa.array(held[1].astype(np.int32)), pa.array(held[2]), pa.array(held[3])],
                                             names=["anchor_id", "slot", "score", "found_id"])
    return run


def _best(rows: DataFrame, anchors: DataFrame, sizes: tuple[int, int, int], keep: int, low: int, positives: bool) -> DataFrame:
    """(anchor_id, slot, score, found_id, rank): the first ``keep`` rows of each slot over all slices."""
    found = by_group(_facing(rows, anchors, *sizes), ["block", "slice"], ["kind", "vec_id"], _scan(keep, low, positives),
                     "anchor_id bigint, slot int, score bigint, found_id bigint")
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "vec", label_col: str = "label",
         n_positives: int = 5, n_negatives: int = 5, low: int = 80) -> DataFrame:
    """Hard negatives of each anchor and positive.

    ``rows`` holds integer vectors (see ``scaled``); ``is_anchor`` is a
    predicate on ``vec_id``.  Returns anchor_id, positive_id, rank, negative_id,
    positive_score and negative_score for the first ``n_negatives`` rows of
    another label with ``low * positive_score <= 100 * negative_score <= 100 *
    positive_score``.
    """
    if not 0 < n_positives < 64:
        raise ValueError("n_positives must lie between 1 and 63")
    kept = materialize(rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<bigint>").alias("vec"),
                                   F.xxhash64(F.col(f"`{label_col}`")).alias("label")), "hard_negatives")
    anchors = kept.where(is_anchor).withColumn("limits", F.lit(None).cast("array<bigint>"))
    n_rows, width = kept.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    sizes = (n_rows, anchors.count(), width)
    positives = materialize(_best(kept, anchors, sizes, n_positives, low, True).select(
        "anchor_id", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")), "hard_negatives")
    limits = positives.groupBy("anchor_id").agg(F.sort_array(F.collect_set("positive_score"), asc=False).alias("limits"))
    limited = anchors.drop("limits").join(limits, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    best = _best(kept, limited, sizes, n_negatives, low, False)
    # each anchor's slots, highest scores first: at most n_positives * n_negatives rows
    inner = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("slot", "rank", "score", "found_id"))).alias("slots"))
    upper = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"))
    windows = positives.withColumn("own_slot", F.dense_rank().over(upper) - 1).join(inner, "anchor_id")
    suffix = F.slice(F.filter("slots", lambda x: x["slot"] >= F.col("own_slot")), 1, n_negatives)
    s = F.col("positive_score").cast("decimal(38,0)")
    taken = F.filter(suffix, lambda x: x["score"].cast("decimal(38,0)") * 100 >= s * low)
    out = windows.select("anchor_id", "positive_id", "positive_score", F.posexplode(taken).alias("i", "x"))
    return out.select("anchor_id", "positive_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("x.found_id").alias("negative_id"),
                      "positive_score", F.col("x.score").alias("negative_score"))
