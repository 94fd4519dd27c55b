"""Vectorised text helpers for Arrow batches (numpy only, no Spark).

Strings of a batch are handled as one byte array plus row offsets; words,
shingles and windows become arrays over it, so no Python loop runs per word.
Hashes are 64-bit polynomials over a fixed random byte table, finished with a
mixing step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Multiplier of the polynomial, its inverse mod 2**64, the mixing constants.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)

BYTE_CODE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= MIX_A
    h ^= h >> np.uint64(27)
    h *= MIX_B
    h ^= h >> np.uint64(31)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i below n, kept between calls."""
    if len(_powers["up"]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial: the hash of data[i:j] is (H[j] - H[i]) * BASE**-i."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * up[:-1], out=out[1:], dtype=np.uint64)
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hash of data[start:end] for each pair, its length included."""
    _, down = powers(len(prefix))
    raw = (prefix[end] - prefix[start]) * down[start]
    return mix(raw + (end - start).astype(np.uint64) * MIX_A)


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) \
        if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, limit: int):
    """Row ranges (i, j) of at most ``limit`` bytes, or of one row if that is longer."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word offsets per row) of the words ``[^\\x20\\x09-\\x0D]+``; none crosses a row."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    text = ~IS_SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = text[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = text[1:]
    starts = np.flatnonzero(text & (~before | first[:-1]))
    ends = np.flatnonzero(text & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def row_of(offsets: np.ndarray) -> np.ndarray:
    """The row that each element belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each row's elements."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def pack_bytes(values: np.ndarray, ascending: bool = False) -> bytes:
    """Numbers as compressed byte planes; ascending ones as differences."""
    if ascending and len(values):
        values = np.concatenate((values[:1], values[1:] - values[:-1]))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpack_bytes(blob: bytes, kind, ascending: bool = False) -> np.ndarray:
    n, width = int.from_bytes(blob[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(blob[8:], n * width, "zstd", asbytes=True), np.uint8)
    values = np.ascontiguousarray(planes.reshape(width, n).T).view(kind).ravel()
    return np.cumsum(values, dtype=kind) if ascending and n else values
