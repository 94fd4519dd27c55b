"""Approximate nearest neighbours: a forest of random-projection trees.

Trees are fitted on a bounded sample (``sample_rows``, by hash order): each
node splits at the median of the projection on the difference of two random
rows.  Every row of the table is then filed in one leaf of each tree.  A query
searches all trees through one shared priority queue, ordered by the sum of
squared margins crossed on the way, until the leaves taken hold
``search_share`` of all rows (``search_least`` rows at least).  The leaves'
rows are reranked by their exact inner products in double precision.

Equal vectors are one class in the index, so copies neither fill a leaf nor
cost twice; the answers list the class's rows by id.  Large leaves are cut
into blocks, so a leaf never meets in one task.

Defined results: vectors that are null, zero, of another length than the
table's most frequent one, or that hold null or non-finite components take no
part; of rows with equal ids the least vector stands; ties go to the smaller
id; with fewer candidates than ``k`` all are returned; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm.exchange import by_group
from tickweave.session import materialize, ship_package

#: Rows of a leaf that one block holds at most, on average.
BLOCK_ROWS = 2048


class Tree:
    """Normals and thresholds of the inner nodes; children below zero are leaves -1, -2, ..."""

    def __init__(self, sample: np.ndarray, leaf_rows: int, seed: int):
        rng = np.random.default_rng(seed)
        normals, thresholds, children, self.leaves = [], [], [], 0
        todo = [(np.arange(len(sample)), None, 0)]
        self.root = -1
        while todo:
            rows, parent, side = todo.pop()
            split = self._split(sample[rows], rng) if len(rows) > leaf_rows else None
            if split is None:
                self.leaves += 1
                at = -self.leaves
            else:
                normal, threshold, low = split
                at = len(normals)
                normals.append(normal)
                thresholds.append(threshold)
                children.append([0, 0])
                todo += [(rows[low], at, 0), (rows[~low], at, 1)]
            if parent is None:
                self.root = at
            else:
                children[parent][side] = at
        self.normals = np.array(normals, np.float32).reshape(-1, sample.shape[1])
        self.thresholds = np.array(thresholds, np.float32)
        self.children = np.array(children, np.int64).reshape(-1, 2)

    @staticmethod
    def _split(rows: np.ndarray, rng: np.random.Generator):
        for _ in range(8):
            a, b = rows[rng.choice(len(rows), 2, replace=False)]
            normal = a - b
            size = np.linalg.norm(normal)
            if not size:
                continue
            normal = normal / size
            value = rows @ normal
            threshold = np.float32(np.median(value))
            low = value < threshold
            if 0.05 < low.mean() < 0.95:
                return normal, threshold, low
        return None

    def leaf(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf number of each vector."""
        at = np.full(len(vectors), self.root, np.int64)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            high = np.einsum("ij,ij->i", vectors[inner], self.normals[node]) >= self.thresholds[node]
            at[inner] = self.children[node, high.astype(np.int64)]
        return -at - 1


def search(trees: list[Tree], sizes: dict[tuple[int, int], int], vector: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """The (tree, leaf) pairs to read, nearest first, from all trees' shared queue."""
    margins = [t.normals @ vector - t.thresholds for t in trees]
    queue = [(0.0, k, t.root) for k, t in enumerate(trees)]
    taken, rows = [], 0
    while queue and rows < enough:
        cost, k, at = heapq.heappop(queue)
        if at < 0:
            n = sizes.get((k, -at - 1), 0)
            if n:
                taken.append((k, -at - 1))
                rows += n
            continue
        margin = float(margins[k][at])
        low, high = trees[k].children[at]
        near, far = (high, low) if margin >= 0 else (low, high)
        heapq.heappush(queue, (cost, k, int(near)))
        heapq.heappush(queue, (cost + margin * margin, k, int(far)))
    return taken


def vector_classes(table: DataFrame, keep: int, is_query, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame]:
    """(classes, queries): each distinct usable vector once with its ``keep`` least ids, and the query rows' classes."""
    v = F.col("vec")
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("vec"))
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(usable, F.lit(False)))
    rows = rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    rows = materialize(rows, "ann")
    length = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).first()
    rows = rows.where(F.size("vec") == F.lit(length["n"] if length else 0))
    # the window's limit is applied in each task before the shuffle
    nth = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    first = rows.withColumn("nth", nth).where(F.col("nth") <= keep)
    classes = first.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("cls"), "vec", "ids")
    classes = materialize(classes, "ann")
    queries = rows.where(is_query(F.col("vec_id"))).join(classes.select("cls", "vec"), "vec").select(F.col("vec_id").alias("query_id"), "cls")
    return classes, materialize(queries, "ann")


def _matrix(column, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    if len(ids) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= edge)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def nearest(table: DataFrame, k: int = 20, is_query=lambda i: i % 20 == 0, n_trees: int = 16, leaf_rows: int = 256,
            sample_rows: int = 20_000, search_share: float = 0.6, search_least: int = 4_000, seed: int = 7,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's ``k`` nearest found by inner product."""
    spark = table.sparkSession
    ship_package(spark)
    schema = "query_id long, rank int, vec_id long, score double"
    classes, queries = vector_classes(table, k + 1, is_query, id_col, vector_col)
    total = classes.count()
    if not total:
        return spark.createDataFrame([], schema)
    sample = classes.orderBy(F.xxhash64("cls"), "cls").limit(sample_rows).select("vec").toArrow()  # bounded by sample_rows
    dim = len(sample.column(0)[0])
    points = _matrix(sample.column(0), dim).astype(np.float32)
    least = max(8, round(leaf_rows * len(points) / total))
    trees = [Tree(points, least, seed + i) for i in range(n_trees)]
    forest = spark.sparkContext.broadcast(trees)  # at most n_trees * sample_rows / 4 nodes
    kind = classes.schema["vec"].dataType.simpleString()

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(1), dim).astype(np.float32)
            for t, tree in enumerate(forest.value):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(vectors), t, np.int32)), pa.array(tree.leaf(vectors).astype(np.int32)), batch.column(0), batch.column(1)],
                    names=["tree", "leaf", "cls", "vec"])

    members = classes.select("cls", "vec").mapInArrow(file, f"tree int, leaf int, cls long, vec {kind}")
    sizes = {(r["tree"], r["leaf"]): r["count"] for r in members.groupBy("tree", "leaf").count().collect()}  # one row per leaf
    leaf_sizes = spark.sparkContext.broadcast(sizes)
    enough = max(search_least, round(search_share * total))
    n_blocks = spark.createDataFrame([(t, leaf, -(-n // BLOCK_ROWS)) for (t, leaf), n in sizes.items()], "tree int, leaf int, blocks int")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(1), dim).astype(np.float32)
            rows, tree, leaf = [], [], []
            for i, vector in enumerate(vectors):
                taken = search(forest.value, leaf_sizes.value, vector, enough)
                rows += [i] * len(taken)
                tree += [t for t, _ in taken]
                leaf += [x for _, x in taken]
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(tree, pa.int32()), pa.array(leaf, pa.int32()), batch.column(0).take(at), batch.column(1).take(at)],
                                             names=["tree", "leaf", "cls", "vec"])

    asked = classes.join(queries.select("cls").distinct(), "cls", "left_semi").select("cls", "vec")
    probes = asked.mapInArrow(probe, f"tree int, leaf int, cls long, vec {kind}")
    blocks = F.broadcast(n_blocks)  # one row per leaf, as sizes
    members = members.join(blocks, ["tree", "leaf"]).withColumns({"block": F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"), "asks": F.lit(0)})
    probes = probes.join(blocks, ["tree", "leaf"]).withColumns({"block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "asks": F.lit(1)})
    names = ["tree", "leaf", "block", "asks", "cls", "vec"]

    def rerank(key: tuple, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        asks = rows.column("asks").to_numpy()
        cut = int(np.searchsorted(asks, 1))
        if cut == 0 or cut == len(asks):
            return
        ids = rows.column("cls").to_numpy()
        vectors = _matrix(rows.column("vec"), dim).astype(np.float64)
        held, held_ids = vectors[:cut].T, ids[:cut]
        for i in range(cut, len(asks), 256):
            scores = vectors[i:i + 256] @ held
            best = [_best(held_ids, s, k + 1) for s in scores]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[i:i + 256]), pa.array([held_ids[b] for b in best], pa.list_(pa.int64())), pa.array([s[b] for s, b in zip(scores, best)], pa.list_(pa.float64()))],
                names=["cls", "found", "scores"])

    found = by_group(members.select(*names).unionByName(probes.select(*names)), ["tree", "leaf", "block"], ["asks"], rerank,
                     "cls long, found array<long>, scores array<double>")

    def merge(key: tuple, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        ids = rows.column("found").combine_chunks().flatten().to_numpy()
        scores = rows.column("scores").combine_chunks().flatten().to_numpy()
        ids, first = np.unique(ids, return_index=True)
        best = _best(ids, scores[first], k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best), key[0])), pa.array(ids[best]), pa.array(scores[first][best])],
                                         names=["asking", "cls", "score"])

    top = by_group(found, ["cls"], [], merge, "asking long, cls long, score double")
    order = [F.desc("score"), F.col("vec_id")]
    rows = top.join(classes.select("cls", "ids"), "cls").select("asking", "score", F.explode("ids").alias("vec_id"))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("asking").orderBy(*order))).where(F.col("nth") <= k + 1)
    rows = rows.join(queries.withColumnRenamed("cls", "asking"), "asking").where(F.col("vec_id") != F.col("query_id"))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)
    return rows.select("query_id", "rank", "vec_id", "score")
