"""Keyed groups of rows inside Arrow tasks.

Rows are shuffled by key and sorted within their partitions by Spark; a task
then reads its groups one after another, each as one table, and never holds
more than one.  Callers bound a group's size (salts, blocks, per-task
pre-aggregation).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def give_back() -> None:
    """At a task's end: memory that Arrow keeps for itself goes back, as workers outlive their tasks."""
    pa.default_memory_pool().release_unused()


def groups(batches: Iterator[pa.RecordBatch], keys: int = 1) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, rows) for each run of equal values in the first ``keys`` columns (integers, not null)."""
    held: list[pa.RecordBatch] = []
    current: tuple | None = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        edge = np.zeros(n, bool)
        edge[0] = True
        for c in columns:
            edge[1:] |= c[1:] != c[:-1]
        cuts = [*np.flatnonzero(edge).tolist(), n]
        for i, j in zip(cuts, cuts[1:]):
            key = tuple(c[i].item() for c in columns)
            if key != current and held:
                yield current, pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(i, j - i))
    if held:
        yield current, pa.Table.from_batches(held)


def by_group(rows: DataFrame, keys: list[str], order: list[str], run: Callable[[tuple, pa.Table], Iterator[pa.RecordBatch]],
             schema: str, partitions: int | None = None) -> DataFrame:
    """Apply ``run`` to each group of ``keys``; rows of a group come in ``order``."""
    rest = [c for c in rows.columns if c not in keys]
    rows = rows.select(*keys, *rest)
    dealt = rows.repartition(partitions, *keys) if partitions else rows.repartition(*keys)
    n = len(keys)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, table in groups(batches, n):
            yield from run(key, table)
        give_back()

    return dealt.sortWithinPartitions(*keys, *order).mapInArrow(task, schema)
