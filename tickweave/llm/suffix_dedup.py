"""Repeated-substring removal by anchor fingerprints.

This replaces prefix doubling: there is no sort of (rank at i, rank at i+h)
pairs with growing offsets.  Anchors (the least hash of the windows of a string)
are fingerprinted instead, as ranking every position would shuffle many times
the input (see the README).

Every byte that a ``LENGTH``-byte string covers is removed if that string also
starts in a document with a smaller id.  Positions are ranked by the string
that starts there, at growing lengths: first ``HALF`` bytes, then the
surrounding stretch, then twice ``HALF``.  After each ranking, positions whose
string no other document holds drop out, so only true repeats reach the full
length.  A rank is the string's fingerprint: equal ranks, equal strings.

Not every position has to be ranked.  Of the ``HALF``-byte strings inside a
``LENGTH``-byte string, the least by hash (leftmost at ties) is its anchor;
equal strings have equal anchors at equal distances, so it is enough to rank
anchors, about one position in thirteen:

1. Rank (string at the anchor, stretch): the stretch holds all strings of
   ``LENGTH`` bytes that share the anchor.  If a smaller document has the same
   stretch, all of it repeats there.  If no other document has the anchor,
   nothing does.  What is left are anchors with different stretches.
2. For those, each string of ``LENGTH`` bytes is ranked on its own.

Documents are gathered in chunks.  A chunk sends each rank once, with its
least document, to the bucket of the rank's hash; the bucket answers what the
chunk has to know, in the order of the request, and the chunk goes on.  So a
string costs one entry per chunk however often it occurs.  An anchor with very
many different stretches in one chunk is sent as one entry, and all its
strings are ranked in step 2.

Defined results: a null text counts as empty; a null id is larger than all
others, and rows with equal ids do not remove each other's strings; texts
under ``LENGTH`` bytes stay whole; an empty table gives no rows; columns that
clash with those added give way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tickweave.llm.exchange import by_group, give_back
from tickweave.llm.textops import column_bytes, mix, pack_bytes, powers, prefix_hash, row_of, row_sums, slices, span_hash, unpack_bytes
from tickweave.session import ship_package

LENGTH = 50
HALF = LENGTH // 2
#: HALF-byte strings inside a LENGTH-byte string.
SPAN = LENGTH - HALF + 1
CHUNK = 8 << 20
STEP = 1 << 18
#: Different stretches of one anchor that a chunk sends one by one.
MANY = 256
CLEAN, REPEATED, OPEN = 0, 1, 2
LAST_ID = (1 << 63) - 1
_PLACE = np.uint64((1 << 24) - 1)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, low, high, name, stretch): strings starting at low..high share an anchor, whose name is a 64-bit hash."""
    out: list[tuple] = []
    for i, j in slices(offsets, STEP):
        part, off = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        if len(part) < LENGTH:
            continue
        # a long text goes by in overlapping steps, each with its own string starts
        for a in range(0, len(part) - LENGTH + 1, STEP):
            b = min(len(part), a + STEP + LENGTH - 1) if j == i + 1 else len(part)
            out.append(_anchors(part[a:b], np.clip(off - a, 0, b - a), i, int(offsets[i]) + a))
            if b == len(part):
                break
    if not out:
        return (*(np.zeros(0, np.int64),) * 3, *(np.zeros(0, np.uint64),) * 2)
    return tuple(np.concatenate(x) for x in zip(*out))


def _anchors(data: np.ndarray, offsets: np.ndarray, first_row: int, base: int) -> tuple:
    prefix = prefix_hash(data)
    n = len(data) - HALF + 1
    _, down = powers(len(data) + 1)
    name = mix((prefix[HALF:] - prefix[:-HALF]) * down[:n])
    least = (name & ~_PLACE) | np.arange(n, dtype=np.uint64)  # the place in the low bits: the leftmost wins
    width = 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < SPAN:
        rest = SPAN - width
        least = np.minimum(least[:-rest], least[rest:])
    at = (least & _PLACE).astype(np.int64)  # of the string that starts at each position
    row = row_of(offsets)
    start = np.flatnonzero(row[:len(at)] == row[LENGTH - 1:LENGTH - 1 + len(at)])
    anchor, owner = at[start], row[start]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    low, high, anchor = start[head], start[np.append(head[1:], len(start)) - 1] if len(head) else start[head], anchor[head]
    stretch = mix(span_hash(prefix, low, high + LENGTH) + (anchor - low).astype(np.uint64))
    return owner[head] + first_row, low + base, high + base, name[anchor], stretch


class Chunk:
    """Documents side by side, with the requests that follow from them and what the answers mean."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, offsets: np.ndarray):
        self.ids, self.data, self.offsets = ids, data, offsets
        self.known, self.rank = np.unique(ids, return_inverse=True)

    def first_ranks(self, buckets: int) -> None:
        """Distinct (bucket, name, stretch), each with its least document, in that order."""
        self.row, self.low, self.high, name, stretch = anchors(self.data, self.offsets)
        bucket = ((name >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint32)
        name = (mix(name) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        stretch = stretch & np.uint64((1 << 48) - 1)
        doc = self.rank[self.row]
        place = (bucket.astype(np.uint64) << np.uint64(32)) | name
        # anchors with very many stretches: one entry, of a stretch that is none
        order = np.lexsort((stretch, place))
        new = _changes(place[order], stretch[order])
        group = np.cumsum(_changes(place[order])) - 1
        many = np.bincount(group[new], minlength=1) > MANY if len(group) else np.zeros(1, bool)
        stretch = stretch.copy()
        stretch[order[many[group]]] = np.uint64((1 << 48) - 1) if len(group) else 0
        order = np.lexsort((doc, stretch, place))
        new = _changes(place[order], stretch[order])
        head = order[new]
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.entry_doc = doc[head]
        self.entry_open = stretch[head] == np.uint64((1 << 48) - 1)
        self.doc = doc
        self.request = bucket[head], name[head], stretch[head]

    def second_ranks(self, status: np.ndarray, buckets: int) -> None:
        """From the answers: stretches known to repeat, and the strings still to be ranked."""
        state = status[self.entry]
        many = self.entry_open[self.entry]
        own = self.doc == self.entry_doc[self.entry]
        repeated = ~many & (~own | (state == REPEATED))
        self.spans = np.stack((self.low[repeated], self.high[repeated] + LENGTH))
        ask = np.flatnonzero((state == OPEN) & (own | many))
        count = self.high[ask] - self.low[ask] + 1
        start = np.repeat(self.low[ask] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        doc = np.repeat(self.doc[ask], count)
        hashes = np.zeros(len(start), np.uint64)
        order = np.argsort(start)
        for i, j in slices(self.offsets, 4 * STEP):
            a, b = np.searchsorted(start[order], (self.offsets[i], self.offsets[j]))
            if a < b:
                mine, base = order[a:b], self.offsets[i]
                prefix = prefix_hash(self.data[base:self.offsets[j]])
                hashes[mine] = span_hash(prefix, start[mine] - base, start[mine] - base + HALF) + mix(span_hash(prefix, start[mine] - base + HALF, start[mine] - base + LENGTH))
        bucket = ((mix(hashes) >> np.uint64(20)) % np.uint64(buckets)).astype(np.uint32)
        order = np.lexsort((doc, hashes, bucket))
        new = _changes(bucket[order], hashes[order])
        head = order[new]
        self.string = np.empty(len(order), np.int64)
        self.string[order] = np.cumsum(new) - 1
        self.string_doc, self.start, self.start_doc = doc[head], start, doc
        self.request = bucket[head], hashes[head]

    def removed(self, repeated: np.ndarray) -> np.ndarray:
        """Whether each byte goes."""
        gone = (self.start_doc > self.string_doc[self.string]) | repeated[self.string]
        edge = np.zeros(len(self.data) + 1, np.int32)
        for low, high in (self.spans, (self.start[gone], self.start[gone] + LENGTH)):
            np.add.at(edge, low, 1)
            np.add.at(edge, high, -1)
        return np.cumsum(edge[:-1]) > 0


def _changes(*columns: np.ndarray) -> np.ndarray:
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _numbered(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(chunk number, rows): numbered by task and turn, the same whenever the scan is repeated."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        _, offsets = column_bytes(batch.column(text_at))
        for i, j in slices(offsets, CHUNK):
            yield number, batch.slice(i, j - i)
            number += 1
    give_back()


def _chunk(rows: pa.RecordBatch, id_at: int, text_at: int) -> Chunk:
    ids = rows.column(id_at).cast(pa.int64())
    return Chunk(np.array(ids.fill_null(LAST_ID)), *column_bytes(rows.column(text_at)))


def _dealt(number: int, bucket: np.ndarray, doc: np.ndarray, known: np.ndarray, columns: list[tuple[np.ndarray, bool]]) -> pa.RecordBatch:
    """One row per bucket: the chunk's entries there, as compressed arrays."""
    cuts = np.searchsorted(bucket, np.arange(int(bucket[-1]) + 2)) if len(bucket) else np.zeros(1, np.int64)
    some = np.flatnonzero(np.diff(cuts)).tolist()
    blobs: list[list[bytes]] = [[] for _ in range(2 + len(columns))]
    for b in some:
        mine = slice(cuts[b], cuts[b + 1])
        used, at = np.unique(doc[mine], return_inverse=True)
        blobs[0].append(pack_bytes(known[used], ascending=True))
        blobs[1].append(pack_bytes(at.astype(np.uint16 if len(used) < 1 << 16 else np.uint32)))
        for out, (values, ascending) in zip(blobs[2:], columns):
            out.append(pack_bytes(values[mine], ascending))
    arrays = [pa.array(some, pa.int32()), pa.array(np.full(len(some), number)), *[pa.array(b, pa.binary()) for b in blobs]]
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", "chunk", "known", "doc", *[f"c{i}" for i in range(len(columns))]])


def _documents_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(document id of each entry, entries per chunk) over a bucket's requests."""
    docs, sizes = [], []
    for known, doc in zip(table.column("known"), table.column("doc")):
        ids, blob = unpack_bytes(known.as_py(), np.int64, True), doc.as_py()
        docs.append(ids[unpack_bytes(blob, np.uint16 if len(ids) < 1 << 16 else np.uint32)])
        sizes.append(len(docs[-1]))
    return np.concatenate(docs), np.array(sizes)


def _joined(table: pa.Table, column: str, kind, ascending: bool) -> np.ndarray:
    return np.concatenate([unpack_bytes(x.as_py(), kind, ascending) for x in table.column(column)])


def _replies(key: tuple, table: pa.Table, sizes: np.ndarray, status: np.ndarray) -> pa.RecordBatch:
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    blobs = [pack_bytes(status[i:j].astype(np.uint8)) for i, j in zip(cuts, cuts[1:])]
    n = len(blobs)
    return pa.RecordBatch.from_arrays([table.column("chunk").combine_chunks(), pa.array(np.full(n, key[0], np.int32)), pa.array(blobs, pa.binary())], names=["chunk", "place", "blob"])


def _answer_first(key: tuple, table: pa.Table) -> Iterator[pa.RecordBatch]:
    """State of each (name, stretch) of a bucket."""
    doc, sizes = _documents_of(table)
    name, stretch = _joined(table, "c0", np.uint32, False), _joined(table, "c1", np.uint64, False)
    many = np.uint64((1 << 48) - 1)
    order = np.lexsort((doc, stretch, name))
    n, s, d = name[order], stretch[order], doc[order]
    by_name, by_stretch = _changes(n), _changes(n, s)
    group, kind = np.cumsum(by_name) - 1, np.cumsum(by_stretch) - 1
    least = d[by_stretch][kind]  # the least document of each stretch
    heads = np.flatnonzero(by_name)
    low, high = np.minimum.reduceat(d, heads), np.maximum.reduceat(d, heads)
    kinds = np.add.reduceat(by_stretch | (s == many), heads, dtype=np.int64)
    contested = ((kinds > 1) & (low < high))[group] | ((s == many) & True)
    state = np.where((s != many) & (least < d), REPEATED, np.where(contested, OPEN, CLEAN))
    status = np.empty(len(order), np.uint8)
    status[order] = state
    yield _replies(key, table, sizes, status)


def _answer_second(key: tuple, table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Whether a smaller document than the chunk's least has the string."""
    doc, sizes = _documents_of(table)
    string = _joined(table, "c0", np.uint64, True)
    order = np.lexsort((doc, string))
    new = _changes(string[order])
    least = doc[order][new][np.cumsum(new) - 1]
    status = np.empty(len(order), np.uint8)
    status[order] = least < doc[order]
    yield _replies(key, table, sizes, status)


def _statuses(table: pa.Table) -> np.ndarray:
    """A chunk's answers, which come by bucket, in the order of its request."""
    parts = [unpack_bytes(blob.as_py(), np.uint8) for place, blob in zip(table.column("place").to_pylist(), table.column("blob")) if place >= 0]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint8)


def _rows_in(table: pa.Table) -> pa.RecordBatch:
    place = table.column("place").to_pylist()
    with pa.ipc.open_stream(table.column("blob")[place.index(-1)].as_buffer()) as stream:
        return stream.read_all().combine_chunks().to_batches()[0]


def _ipc(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def dedup(docs: DataFrame, finish: Callable, schema: StructType, text_col: str, id_col: str) -> DataFrame:
    """``finish(rows, chunk, removed)`` of every chunk, as one frame of ``schema``."""
    spark = docs.sparkSession
    ship_package(spark)
    id_at, text_at = docs.columns.index(id_col), docs.columns.index(text_col)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed_schema = "chunk long, place int, blob binary"

    def request_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in _numbered(batches, text_at):
            chunk = _chunk(rows, id_at, text_at)
            chunk.first_ranks(buckets)
            bucket, name, stretch = chunk.request
            yield _dealt(number, bucket, chunk.entry_doc, chunk.known, [(name, False), (stretch, False)])

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in _numbered(batches, text_at):
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([-1], pa.int32()), pa.array([_ipc(rows)], pa.binary())], names=["chunk", "place", "blob"])

    def opened(table: pa.Table) -> tuple[pa.RecordBatch, Chunk]:
        rows = _rows_in(table)
        chunk = _chunk(rows, id_at, text_at)
        chunk.first_ranks(buckets)
        chunk.second_ranks(_statuses(table), buckets)
        return rows, chunk

    def request_second(key: tuple, table: pa.Table) -> Iterator[pa.RecordBatch]:
        _, chunk = opened(table)
        bucket, string = chunk.request
        yield _dealt(key[0], bucket, chunk.string_doc, chunk.known, [(string, True)])

    def carry_on(key: tuple, table: pa.Table) -> Iterator[pa.RecordBatch]:
        rows, chunk = opened(table)
        arrays = (chunk.spans.ravel(), chunk.start, chunk.start_doc, chunk.string, chunk.string_doc)
        blobs = [_ipc(rows), *[pack_bytes(np.ascontiguousarray(a.astype(np.int64))) for a in arrays]]
        yield pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([-1], pa.int32()), pa.array([_ipc(pa.record_batch({"b": pa.array(blobs, pa.binary())}))], pa.binary())],
                                         names=["chunk", "place", "blob"])

    def close(key: tuple, table: pa.Table) -> Iterator[pa.RecordBatch]:
        blobs = [b.as_py() for b in _rows_in(table).column(0)]
        with pa.ipc.open_stream(blobs[0]) as stream:
            rows = stream.read_all().combine_chunks().to_batches()[0]
        chunk = _chunk(rows, id_at, text_at)
        spans, chunk.start, chunk.start_doc, chunk.string, chunk.string_doc = (unpack_bytes(b, np.int64) for b in blobs[1:])
        chunk.spans = spans.reshape(2, -1)
        yield from finish(rows, chunk, chunk.removed(_statuses(table) > 0))

    entries = docs.mapInArrow(request_first, "bucket int, chunk long, known binary, doc binary, c0 binary, c1 binary")
    first = by_group(entries, ["bucket"], ["chunk"], _answer_first, packed_schema)
    gathered = docs.mapInArrow(carry, packed_schema).unionByName(first)
    strings = by_group(gathered, ["chunk"], ["place"], request_second, "bucket int, chunk long, known binary, doc binary, c0 binary")
    second = by_group(strings, ["bucket"], ["chunk"], _answer_second, packed_schema)
    carried = by_group(gathered, ["chunk"], ["place"], carry_on, packed_schema)
    return by_group(carried.unionByName(second), ["chunk"], ["place"], close, schema)


def _sums(chunk: Chunk, removed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, bytes removed, runs removed) of each text."""
    begins = removed.copy()
    begins[1:] &= ~removed[:-1]
    inner = chunk.offsets[:-1][chunk.offsets[:-1] < len(removed)]
    begins[inner] = removed[inner]
    return np.diff(chunk.offsets), row_sums(removed, chunk.offsets), row_sums(begins, chunk.offsets)


def digests(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def finish(rows: pa.RecordBatch, chunk: Chunk, removed: np.ndarray) -> Iterator[pa.RecordBatch]:
        size, gone, runs = _sums(chunk, removed)
        left = chunk.data[~removed].tobytes()
        ends = np.cumsum(size - gone).tolist()
        shas = [hashlib.sha256(left[i:j]).hexdigest() for i, j in zip([0, *ends], ends)]
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(size), pa.array(gone), pa.array(runs), pa.array(shas, pa.string())],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    schema = StructType([StructField("doc_id", LongType()), *[StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")], StructField("kept_sha256", StringType())])
    return dedup(rows, finish, schema, "text", "doc_id")


def remove_repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents with what is left of their texts, ``n_removed`` and ``n_spans``.

    Bytes of a character that is cut in two are dropped with it.
    """
    own = [c for c in docs.columns if c.lower() not in ("n_removed", "n_spans") or c in (text_col, id_col)]
    rows = docs.select(*[F.col(f"`{c}`") for c in own])
    text_at = own.index(text_col)

    def finish(rows: pa.RecordBatch, chunk: Chunk, removed: np.ndarray) -> Iterator[pa.RecordBatch]:
        size, gone, runs = _sums(chunk, removed)
        left = chunk.data[~removed].tobytes()
        ends = np.cumsum(size - gone).tolist()
        null = rows.column(text_at).is_null().to_pylist()
        texts = [None if x else left[i:j].decode("utf-8", "ignore") for x, i, j in zip(null, [0, *ends], ends)]
        columns = [pa.array(texts, pa.string()) if k == text_at else c for k, c in enumerate(rows.columns)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(gone), pa.array(runs)], names=[*own, "n_removed", "n_spans"])

    schema = StructType([*[StructField(f.name, StringType() if f.name == text_col else f.dataType) for f in rows.schema.fields], StructField("n_removed", LongType()), StructField("n_spans", LongType())])
    return dedup(rows, finish, schema, text_col, id_col)
