"""Byte-level BPE encoding and decoding through a global distinct-word shuffle.

Texts are split by the pre-token pattern.  A task gathers documents into
chunks; a chunk keeps its distinct words once and, for each document, the
words' numbers by position.  The chunks' words are dealt out by hash, so that
equal words of all chunks meet, and each distinct word is merged once by the
vocabulary's ranks.  The ids go back to the chunks that asked, and documents
are reassembled by position.  Decoding looks ids up in the token-byte table,
whose size is the vocabulary's.

A word crosses the shuffle once per chunk however often it occurs, so frequent
words are not hot.  Chunks are numbered by task and turn, which is the same
whenever the scan is repeated.

Defined results: a null text counts as empty: no ids, the digests of nothing;
repeated rows are encoded each; an empty table gives no rows; columns other
than the id and the text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.exchange import by_group
from tickweave.llm.textops import pack_bytes, unpack_bytes
from tickweave.session import ship_package

#: Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK = 16 << 20
#: Words longer than this are merged with a queue instead of scans.
LONG_WORD = 48


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def pre_token_pattern(pattern: str):
    """The pattern with white space as Unicode has it, as the vocabulary's own splitter reads ``\\s``."""
    pattern = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"[^\p{White_Space}]").replace(r"\s", r"\p{White_Space}")
    return regex.compile(pattern)


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the adjacent pair of least rank is merged until none is left (leftmost first)."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > LONG_WORD:
        return _merge_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    pairs = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
    while pairs:
        least = min(pairs)
        if least == 1 << 60:
            break
        i = pairs.index(least)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a queue over a linked list: n log n for words of n bytes."""
    n = len(word)
    part: list[bytes | None] = [word[i:i + 1] for i in range(n)]
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    queue = [(r, i, word[i:i + 2]) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(queue)
    while queue:
        _, i, joined = heapq.heappop(queue)
        j = after[i] if part[i] is not None else -1
        if j < 0 or part[i] + part[j] != joined or len(part[i]) + len(part[j]) != len(joined):
            continue
        part[i], part[j] = joined, None
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for a in (before[i], i):
            b = after[a] if a >= 0 else -1
            if b >= 0 and (r := ranks.get(part[a] + part[b])) is not None:
                heapq.heappush(queue, (r, a, part[a] + part[b]))
    return [ranks[p] for p in part if p is not None]


class _Chunk:
    """Documents of one chunk as word numbers, and the words in order of first sight."""

    def __init__(self, number: int):
        self.number, self.size, self.rows = number, 0, 0
        self.words: defaultdict = defaultdict()
        self.words.default_factory = self.words.__len__
        self.ids: list = []
        self.positions: list[bytes] = []

    def add(self, doc_id, text: str | None, pattern, words_only: bool) -> None:
        found = pattern.findall(text) if text else []
        if words_only:
            for word in dict.fromkeys(found):
                self.words[word]
            return
        numbers = np.fromiter(map(self.words.__getitem__, found), np.uint32, len(found))
        planes = numbers.view(np.uint8).reshape(-1, 4).T  # little end first; the planes compress well
        self.ids.append(doc_id)
        self.positions.append(np.ascontiguousarray(planes).tobytes())


def _chunks(batches: Iterator[pa.RecordBatch], pattern, words_only: bool = False) -> Iterator[_Chunk]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    chunk = _Chunk(number)
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
        for doc_id, text, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), sizes):
            if chunk.size and chunk.size + size > CHUNK:
                yield chunk
                number += 1
                chunk = _Chunk(number)
            chunk.add(doc_id, text, pattern, words_only)
            chunk.rows += 1
            chunk.size += size
    if chunk.rows:
        yield chunk


def _word_requests(pattern_text: str, buckets: int):
    """Task function: each chunk's distinct words, dealt to buckets."""
    from zlib import crc32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, pre_token_pattern(pattern_text), words_only=True):
            raw = [w.encode() for w in chunk.words]
            bucket = np.fromiter((crc32(w) % buckets for w in raw), np.int32, len(raw))
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            some = np.flatnonzero(np.diff(cuts))
            out = [[], [], []]
            for b in some.tolist():
                at = order[cuts[b]:cuts[b + 1]]
                mine = [raw[i] for i in at.tolist()]
                out[0].append(pack_bytes(at.astype(np.uint32), ascending=True))
                out[1].append(pack_bytes(np.fromiter(map(len, mine), np.uint32, len(mine))))
                out[2].append(pack_bytes(np.frombuffer(b"".join(mine), np.uint8)))
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(np.full(len(some), chunk.number)), *[pa.array(o, pa.binary()) for o in out]],
                                             names=["bucket", "chunk", "numbers", "sizes", "words"])
    return run


def _positions(pattern_text: str):
    """Task function: each document's word numbers by position, compressed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, pre_token_pattern(pattern_text)):
            for i in range(0, len(chunk.ids), 1000):
                plain = chunk.positions[i:i + 1000]
                packed = [pa.compress(p, "zstd", asbytes=True) for p in plain]
                n = len(plain)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, chunk.number)), pa.array(np.full(n, 1, np.int32)), pa.array(chunk.ids[i:i + 1000], pa.int64()),
                     pa.array([len(p) for p in plain], pa.int64()), pa.array(packed, pa.binary()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())],
                    names=["chunk", "kind", "doc_id", "n_bytes", "positions", "counts", "ids"])
    return run


def encode(docs: DataFrame, ranks_file: str, pattern: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, ids, decoded): token ids as little-endian 32-bit integers, and the bytes they decode to."""
    return _encoded(docs, ranks_file, pattern, text_col, id_col, False)


def digests(docs: DataFrame, ranks_file: str, pattern: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the encoding and its round trip in digest form."""
    return _encoded(docs, ranks_file, pattern, text_col, id_col, True)


def _encoded(docs: DataFrame, ranks_file: str, pattern: str, text_col: str, id_col: str, digest: bool) -> DataFrame:
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    vocabulary = spark.sparkContext.broadcast(read_ranks(ranks_file))  # bounded: the vocabulary file
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = rows.mapInArrow(_word_requests(pattern, buckets), "bucket int, chunk long, numbers binary, sizes binary, words binary")

    def answer(key: tuple, table: pa.Table) -> Iterator[pa.RecordBatch]:
        ranks, known = vocabulary.value, {}
        for batch in table.to_batches():
            for chunk, numbers, sizes, words in zip(batch.column("chunk").to_pylist(), batch.column("numbers"), batch.column("sizes"), batch.column("words")):
                raw = unpack_bytes(words.as_py(), np.uint8).tobytes()
                ends = np.cumsum(unpack_bytes(sizes.as_py(), np.uint32), dtype=np.int64).tolist()
                found = []
                for i, j in zip([0, *ends], ends):
                    word = raw[i:j]
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = merge_word(word, ranks)
                    found.append(ids)
                flat = np.fromiter((x for ids in found for x in ids), np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk]), pa.array([0], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([numbers.as_py()], pa.binary()),
                     pa.array([pack_bytes(np.fromiter(map(len, found), np.uint32, len(found)))], pa.binary()), pa.array([pack_bytes(flat)], pa.binary())],
                    names=["chunk", "kind", "doc_id", "n_bytes", "positions", "counts", "ids"])

    shape = "chunk long, kind int, doc_id long, n_bytes long, positions binary, counts binary, ids binary"
    answers = by_group(asked, ["bucket"], ["chunk"], answer, shape)
    placed = rows.mapInArrow(_positions(pattern), shape)

    def reassemble(key: tuple, table: pa.Table) -> Iterator[pa.RecordBatch]:
        token_bytes = {i: t for t, i in vocabulary.value.items()}
        names: dict[int, list[int]] = {}
        done = None
        for batch in table.to_batches(max_chunksize=256):
            out: list[list] = [[], [], [], []]
            for kind, doc_id, size, positions, counts, ids in zip(*[batch.column(c) for c in ("kind", "doc_id", "n_bytes", "positions", "counts", "ids")]):
                if kind.as_py() == 0:
                    ends = np.cumsum(unpack_bytes(counts.as_py(), np.uint32), dtype=np.int64).tolist()
                    flat = unpack_bytes(ids.as_py(), np.uint32).tolist()
                    names.update(zip(unpack_bytes(positions.as_py(), np.uint32, True).tolist(), (flat[i:j] for i, j in zip([0, *ends], ends))))
                    continue
                if done is None:
                    order = range(len(names))
                    lengths = np.fromiter((len(names[i]) for i in order), np.int64, len(names))
                    written = [" ".join(map(str, names[i])).encode() for i in order] if digest else [np.array(names[i], "<u4").tobytes() for i in order]
                    decoded = [b"".join(map(token_bytes.__getitem__, names[i])) for i in order]
                    done = True
                plain = np.frombuffer(pa.decompress(positions.as_buffer(), size.as_py(), "zstd"), np.uint8)
                at = np.ascontiguousarray(plain.reshape(4, -1).T).view(np.uint32).ravel() if len(plain) else np.zeros(0, np.uint32)
                numbers = at.tolist()
                ids_out = (b" " if digest else b"").join(map(written.__getitem__, numbers))
                text = b"".join(map(decoded.__getitem__, numbers))
                out[0].append(doc_id.as_py())
                out[1].append(int(lengths[at].sum()) if len(at) else 0)
                out[2].append(hashlib.sha256(ids_out).hexdigest() if digest else ids_out)
                out[3].append(hashlib.sha256(text).hexdigest() if digest else text)
            kind = pa.string() if digest else pa.binary()
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], kind), pa.array(out[3], kind)],
                                                 names=["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"])])

    schema = "doc_id long, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digest else "ids binary, decoded binary")
    return by_group(placed.unionByName(answers), ["chunk"], ["kind"], reassemble, schema)


def decode(encoded: DataFrame, ranks_file: str, ids_col: str = "ids") -> DataFrame:
    """The input with ``decoded``: the bytes of its ids (little-endian 32-bit) from the token-byte table."""
    ship_package(encoded.sparkSession)
    table = encoded.sparkSession.sparkContext.broadcast({i: t for t, i in read_ranks(ranks_file).items()})  # bounded: the vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(ids_col)
            out = [None if x is None else b"".join(map(table.value.__getitem__, np.frombuffer(x, "<u4").tolist())) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    kept = encoded.drop("decoded")
    return kept.mapInArrow(run, ", ".join([*(f"`{n}` {t}" for n, t in kept.dtypes), "decoded binary"]))
