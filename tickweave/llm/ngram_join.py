"""Similarity join of word n-gram sets by Jaccard, with set-relation skipping.

Equal sets are one class.  A class's shingles are put in one global order, rare
ones first (frequencies from a count sketch of fixed size; any order is exact,
a good one is quick), and its prefix goes into inverted lists.  Two sets that
reach the threshold share a shingle in their prefixes.

Lists are sorted by set size and position and cut into blocks.  Scanning a list
stops at the first block whose sets are too large, and a block whose least
position leaves too little room for the needed overlap is skipped whole.  Short
lists give the pairs of the remaining blocks at once.  In long
lists — the copies of large groups — a few pivot sets at a time are compared
with the whole list.  From the overlaps with a list's first pivot, the answers
of the other sets follow without comparing them: x and y overlap in at least
|x∩q| + |y∩q| - |q| shingles, and in at most min(|x∩q|, |y∩q|) +
min(|x|-|x∩q|, |y|-|y∩q|).  Pairs that are already in one component are not
compared either; all others are, so no link between different groups is lost.

Links are counted whole: where both sets of a pair are in long lists, the sets
of a component are dealt to blocks, and each two blocks meet once.  There the
answers of a set, its overlaps with all sets of the other block, are derived
from those of a highly similar set: only the shingles in which the two differ
are looked up, added for those gained and taken away for those lost.

Defined results: a text without words (or null) has no shingles and links with
nothing; fewer words than ``k`` are one shingle; repeated rows have equal sets
and so one component; a null id never names a component unless all ids of a
component are null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm.components import components
from tickweave.llm.exchange import by_group
from tickweave.llm.textops import LOWER, column_bytes, mix, prefix_hash, row_of, row_sums, slices, span_hash, words
from tickweave.session import materialize, ship_package

CHUNK = 1 << 20
#: Counters of the frequency sketch (fixed: 8 MB, whatever the input), and the pieces that it is summed in.
SKETCH = 1 << 21
PIECES = 64
#: Bits of the filter for documents whose sets are wanted (fixed: 4 MB); what it lets through too much is never asked for.
FILTER_BITS = 1 << 25
#: Lists up to this length give all their pairs at once.
SHORT_LIST = 64
#: Entries of a block of a sorted list.
LIST_BLOCK = 8
#: Entries whose blocks are looked at together, and bytes of a bucket of lists, on average.
SCAN_STEP, BUCKET_BYTES = 1 << 18, 64 << 20
#: Sets of one comparison group at most, on average.
GROUP_SETS = 256
#: Sets of a counting block, and members of all its sets, at most on average.
BLOCK_SETS, BLOCK_MEMBERS = 512, 1 << 20
#: Pivots of long lists by round; the last round takes what is left.
PIVOTS = (1, 16, 256)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes, offsets per text)."""
    data = LOWER[data]
    starts, ends, rows = words(data, offsets)
    token = span_hash(prefix_hash(data), starts, ends)
    of, n_words = row_of(rows), np.diff(rows)
    first = np.flatnonzero(of[:len(of) - k + 1] == of[k - 1:]) if len(of) >= k else np.zeros(0, np.int64)
    shingle = np.zeros(len(first), np.uint64)
    for i in range(k):
        shingle = mix(shingle + token[first + i] + np.uint64(1))
    few = np.flatnonzero((n_words > 0) & (n_words < k))
    whole = np.zeros(len(few), np.uint64)
    for i in range(k - 1):
        has = n_words[few] > i
        whole[has] = mix(whole[has] + token[rows[few][has] + i] + np.uint64(1))
    key, owner = np.concatenate((shingle, mix(whole))), np.concatenate((of[first], few))
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    key, owner = key[new], owner[new]
    return key, np.searchsorted(owner, np.arange(len(offsets)))


def set_ids(key: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set, whatever the order of its members."""
    def total(values):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
        return sums[offsets[1:]] - sums[offsets[:-1]]
    return mix(total(key) + np.diff(offsets).astype(np.uint64)), mix(total(mix(key + np.uint64(0x5EED))))


def _parts(batch: pa.RecordBatch, at: int, k: int):
    """(first row, last row, set members, set offsets) for bounded stretches of a batch."""
    data, offsets = column_bytes(batch.column(at))
    for i, j in slices(offsets, CHUNK):
        yield i, j, *shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k)


def _measure(k: int):
    """Task function: set sizes and digests, and the task's part of the frequency sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.uint32)
        names = ["piece", "doc_id", "digest", "n", "sid", "check", "counters"]
        for batch in batches:
            for i, j, key, off in _parts(batch, 2, k):
                sid, check = set_ids(key, off)
                np.add.at(sketch, (key & np.uint64(SKETCH - 1)).astype(np.int64), np.uint32(1))
                yield pa.RecordBatch.from_arrays([pa.nulls(j - i, pa.int32()), batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(np.diff(off).astype(np.int64)),
                                                  pa.array(sid.view(np.int64)), pa.array(check.view(np.int64)), pa.nulls(j - i, pa.binary())], names=names)
        if sketch.any():
            n, empty = PIECES, pa.nulls(PIECES, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), empty, empty, empty, empty, empty, _pieces(sketch)], names=names)
    return run


def _gathered(parts: DataFrame, kind, size: int, combine) -> np.ndarray:
    """Per-task arrays of ``size`` numbers, sent as PIECES compressed pieces, combined into one."""
    n_bytes = size // PIECES * np.dtype(kind).itemsize

    def add(key: tuple, table: pa.Table) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size // PIECES, kind)
        for blob in table.column("counters"):
            combine(total, np.frombuffer(pa.decompress(blob.as_buffer(), n_bytes, "zstd"), kind), out=total)
        yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["piece", "counters"])

    out = np.zeros((PIECES, size // PIECES), kind)
    for r in by_group(parts.select("piece", "counters"), ["piece"], [], add, "piece int, counters binary").collect():  # always ``size`` numbers
        out[r["piece"]] = np.frombuffer(r["counters"], kind)
    return out.ravel()


def _pieces(values: np.ndarray) -> pa.Array:
    return pa.array([pa.compress(p.tobytes(), "zstd", asbytes=True) for p in values.reshape(PIECES, -1)], pa.binary())


def _document_bits(doc_id: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """The filter bit of each document."""
    return (mix(mix(doc_id.view(np.uint64)) + digest.view(np.uint64)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def _filter_bits(wanted: DataFrame) -> np.ndarray:
    """Packed bits of the wanted keys, the first two columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            bits[_document_bits(*_keys(batch))] = True
        if bits.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(PIECES, dtype=np.int32)), _pieces(np.packbits(bits))], names=["piece", "counters"])

    return _gathered(wanted.mapInArrow(run, "piece int, counters binary"), np.uint8, FILTER_BITS // 8, np.bitwise_or)


def _passes(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the packed bits at these numbers are set."""
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & np.uint8(1)).astype(bool)


def _asked_for(sets: DataFrame, sid: DataFrame) -> DataFrame:
    """The rows of ``sets`` that may be among ``sid``, so that a join does not shuffle the others."""
    asked = sid.toDF("sid")
    bits = sets.sparkSession.sparkContext.broadcast(_filter_bits(asked.select("sid", F.col("sid").alias("again"))))  # FILTER_BITS bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array(batch.column(0), np.int64)
            yield batch.filter(pa.array(_passes(bits.value, _document_bits(own, own))))

    return sets.mapInArrow(run, "sid long, text binary")


def _shrunk(text: bytes) -> bytes:
    """A text as it is shuffled: less than half the bytes of its shingles' hashes, which the receiver computes."""
    return len(text).to_bytes(8, "little") + pa.compress(text, "zstd", asbytes=True)


def _sets_of(texts: list[bytes], k: int) -> list[np.ndarray]:
    """The sorted shingles of each shrunk text."""
    sizes = np.concatenate(([0], np.cumsum([int.from_bytes(t[:8], "little") for t in texts]))).astype(np.int64)
    out = []
    for i, j in slices(sizes, CHUNK):
        whole = b"".join(pa.decompress(t[8:], int(n), "zstd", asbytes=True) for t, n in zip(texts[i:j], np.diff(sizes[i:j + 1])))
        key, off = shingle_sets(np.frombuffer(whole, np.uint8), sizes[i:j + 1] - sizes[i], k)
        out.extend(key[x:y] for x, y in zip(off, off[1:]))
    return out


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids (a null one as the least) and digests, the first two columns."""
    return np.array(batch.column(0).fill_null(-(1 << 63)), np.int64), np.array(batch.column(1), np.int64)


def _needed(n, m, num: int, den: int):
    """Least overlap at which sets of n and m members reach the threshold num/den."""
    return -(-num * (n + m) // (num + den))


def _fits(n, i, m, j, num: int, den: int):
    """Whether sets sharing a member at positions i and j may still reach the threshold."""
    return (np.minimum(n, m) * den >= np.maximum(n, m) * num) & (1 + np.minimum(n - i - 1, m - j - 1) >= _needed(n, m, num, den))


def _prefixes(sketch, k: int, num: int, den: int, buckets: int):
    """Task function: each set's prefix in the global order, dealt to buckets by shingle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = sketch.value
        for batch in batches:
            for _, _, key, off in _parts(batch, 0, k):
                sid, _ = set_ids(key, off)
                owner = row_of(off)
                order = np.lexsort((key, counters[(key & np.uint64(SKETCH - 1)).astype(np.int64)], owner))
                n = np.diff(off)
                position = np.arange(len(key)) - off[:-1][owner]
                keep = position < (n + (-num * n // den) + 1)[owner]
                token, owner, position = key[order][keep], owner[keep], position[keep]
                bucket = (token >> np.uint64(40)).astype(np.int64) % buckets
                sort = np.lexsort((sid[owner], token, bucket))
                token, owner, position, bucket = token[sort], owner[sort], position[sort], bucket[sort]
                new = np.ones(len(token), bool)  # copies within the stretch
                new[1:] = (token[1:] != token[:-1]) | (sid[owner][1:] != sid[owner][:-1])
                token, owner, position, bucket = token[new], owner[new], position[new], bucket[new]
                cuts = np.searchsorted(bucket, np.arange(buckets + 1))
                some = np.flatnonzero(np.diff(cuts)).tolist()

                def blobs(values):
                    return pa.array([values[cuts[b]:cuts[b + 1]].tobytes() for b in some], pa.binary())

                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), blobs(token), blobs(sid[owner]), blobs(n[owner].astype(np.uint32)), blobs(position.astype(np.uint32))],
                                                 names=["bucket", "token", "sid", "n", "position"])
    return run


def _list_pairs(at: np.ndarray, starts: np.ndarray, sid: np.ndarray, n: np.ndarray, position: np.ndarray, num: int, den: int) -> np.ndarray:
    """Pairs (less, greater) of the entries ``at`` with later ones of their lists; blocks that cannot hold a partner are skipped."""
    ends = np.append(starts[1:], len(sid))
    blocks = -(-(ends - starts) // LIST_BLOCK)
    before = np.cumsum(blocks) - blocks  # the first block of each list
    of = np.repeat(np.arange(len(starts)), blocks)
    low = starts[of] + (np.arange(len(of)) - before[of]) * LIST_BLOCK
    high = np.minimum(low + LIST_BLOCK, ends[of])
    smallest, largest, earliest = n[low], n[high - 1], np.minimum.reduceat(position, low)
    own = np.searchsorted(low, at, "right") - 1
    in_list = of[own]
    out = [np.zeros((2, 0), np.int64)]
    while len(at):
        # sizes ascend, so a block of sets that are all too large ends the scan of the list for good
        go = np.flatnonzero(n[at] * den >= smallest[own] * num)
        at, own, in_list = at[go], own[go], in_list[go]
        room = 1 + np.minimum(n[at] - position[at] - 1, largest[own] - earliest[own] - 1)
        may = np.flatnonzero(room >= _needed(n[at], smallest[own], num, den))
        x = np.repeat(at[may], LIST_BLOCK)
        y = (low[own[may]][:, None] + np.arange(LIST_BLOCK)).ravel()
        inside = (y < np.repeat(high[own[may]], LIST_BLOCK)) & (y > x)
        x, y = x[inside], y[inside]
        ok = _fits(n[x], position[x], n[y], position[y], num, den)
        x, y = sid[x[ok]], sid[y[ok]]
        out.append(np.stack((np.minimum(x, y), np.maximum(x, y))))
        own = own + 1
        more = np.flatnonzero((own < len(of)) & (of[np.minimum(own, len(of) - 1)] == in_list))
        at, own, in_list = at[more], own[more], in_list[more]
    return np.unique(np.concatenate(out, axis=1), axis=1)


def _scan_lists(num: int, den: int):
    """Group function: the pairs of short lists, and the members of long ones."""
    names = ["token", "a", "b", "n", "position"]

    def run(key: tuple, table: pa.Table) -> Iterator[pa.RecordBatch]:
        token, sid, n, position = (np.concatenate([np.frombuffer(x.as_buffer(), t) for x in table.column(c)])
                                   for c, t in (("token", np.uint64), ("sid", np.uint64), ("n", np.uint32), ("position", np.uint32)))
        n, position = n.astype(np.int64), position.astype(np.int64)
        order = np.lexsort((sid, position, n, token))
        token, sid, n, position = token[order], sid[order], n[order], position[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])
        token, sid, n, position = token[new], sid[new], n[new], position[new]
        starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        length = np.repeat(np.diff(np.append(starts, len(token))), np.diff(np.append(starts, len(token))))
        long = np.flatnonzero(length > SHORT_LIST)
        if len(long):
            yield pa.RecordBatch.from_arrays([pa.array(token[long].view(np.int64)), pa.array(sid[long].view(np.int64)), pa.nulls(len(long), pa.int64()),
                                              pa.array(n[long]), pa.array(position[long])], names=names)
        at = np.flatnonzero((length > 1) & (length <= SHORT_LIST))
        found = [_list_pairs(at[i:i + SCAN_STEP], starts, sid.view(np.int64), n, position, num, den) for i in range(0, len(at), SCAN_STEP)]
        if found:
            pairs = np.unique(np.concatenate(found, axis=1), axis=1)
            empty = pa.nulls(pairs.shape[1], pa.int64())
            yield pa.RecordBatch.from_arrays([empty, pa.array(pairs[0]), pa.array(pairs[1]), empty, empty], names=names)
    return run


def _overlaps(pairs: DataFrame, sets: DataFrame, k: int) -> DataFrame:
    """(a, b, n_a, n_b, overlap) of each pair: one set of a group is compared with up to GROUP_SETS others."""
    sets = sets.hint("merge")  # neither side has a bound: the same plan at every size
    groups = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP_SETS).cast("int").alias("parts"))
    held = groups.join(sets, groups["a"] == sets["sid"]).select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("b"), "text")
    asked = pairs.join(groups, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    asked = asked.join(sets, asked["b"] == sets["sid"]).select("a", "part", F.lit(1).alias("kind"), "b", "text")

    def compare(key: tuple, table: pa.Table) -> Iterator[pa.RecordBatch]:
        texts = table.column("text")
        held = table.column("kind").to_pylist().count(0)  # more than one if copies of the set came along
        if held in (0, len(texts)):
            return
        b, once = np.unique(table.column("b").slice(held).to_numpy(), return_index=True)  # copies of the others
        mine, *others = _sets_of([texts[i].as_py() for i in (0, *(held + once).tolist())], k)
        size = np.array([len(o) for o in others])
        flat = np.concatenate(others)
        at = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
        both = row_sums(mine[at] == flat, np.concatenate(([0], np.cumsum(size))))
        n = len(others)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, key[0])), pa.array(b), pa.array(np.full(n, len(mine))), pa.array(size), pa.array(both)],
                                         names=["a", "b", "n_a", "n_b", "overlap"])

    return by_group(held.unionByName(asked), ["a", "part"], ["kind"], compare, "a long, b long, n_a long, n_b long, overlap long")


def _answers(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Overlaps of each of the ``left`` sets with each of the ``right`` ones.

    Sets that share their least shingles follow one another, and a set's
    answers come from those of the set before it by the shingles in which they
    differ; only a set that differs in more than it holds is looked up whole.
    """
    token = np.unique(np.concatenate([sets[i] for i in right]))
    owner = np.repeat(np.arange(len(right)), [len(sets[i]) for i in right])
    at = np.searchsorted(token, np.concatenate([sets[i] for i in right]))
    order = np.argsort(at, kind="stable")
    rows, begin = owner[order], np.searchsorted(at[order], np.arange(len(token) + 1))

    def look_up(members: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(token, members), len(token) - 1)
        at = at[token[at] == members]
        size = begin[at + 1] - begin[at]
        entry = np.arange(size.sum()) + np.repeat(begin[at] - (np.cumsum(size) - size), size)
        return np.bincount(rows[entry], minlength=len(right))

    least = np.zeros((4, len(left)), np.uint64)
    for column, i in enumerate(left):
        some = sets[i][:4]
        least[:len(some), column] = some
    both = np.zeros((len(left), len(right)), np.int64)
    like = answer = None
    for row in np.lexsort(least[::-1]).tolist():
        own = sets[left[row]]
        if like is not None:
            gained, lost = np.setdiff1d(own, like, assume_unique=True), np.setdiff1d(like, own, assume_unique=True)
        if like is None or len(gained) + len(lost) > len(own):
            answer = look_up(own)
        else:
            answer = answer + look_up(gained) - look_up(lost)
        both[row], like = answer, own
    return both


def _block_links(dealt: DataFrame, sets: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(sid, n_links): links of each set of (sid, component, n) with the others of its component there."""
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_SETS, F.sum("n") / BLOCK_MEMBERS)).cast("int").alias("parts")
    large = dealt.groupBy("component").agg(parts).where(F.col("parts") > 1)
    dealt = dealt.join(large, "component", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int")).drop("n")
    rows = dealt.join(_asked_for(sets, dealt.select("sid")).hint("merge"), "sid").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "sid", "text")

    def count(key: tuple, table: pa.Table) -> Iterator[pa.RecordBatch]:
        sid, once = np.unique(table.column("sid").to_numpy(), return_index=True)  # copies of a set came along
        block = table.column("block").to_numpy()[once]
        sets = _sets_of([table.column("text")[i].as_py() for i in once.tolist()], k)
        size = np.array([len(s) for s in sets], np.int64)
        _, i, j = key
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        if not len(left) or not len(right):  # a block without sets
            return
        linked = _answers(sets, left, right) >= _needed(size[left][:, None], size[right], num, den)
        n_links = np.zeros(len(sid), np.int64)
        if i == j:
            np.fill_diagonal(linked, False)
            n_links[left] = linked.sum(axis=1)
        else:
            n_links[left], n_links[right] = linked.sum(axis=1), linked.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(sid), pa.array(n_links)], names=["sid", "n_links"])

    return by_group(rows, ["component", "i", "j"], [], count, "sid long, n_links long").groupBy("sid").agg(F.sum("n_links").alias("n_links"))


def link_classes(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, n_links, component_id): links are counted between different sets."""
    return _linked(docs, k, num, den, text_col, id_col, count=True).drop("digest", "group")


def keep_one(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents without all but one of each component: the one of the least id (null ids last, then by digest).

    Texts without words all stay.  Rows equal in id and text are one document.
    """
    linked = materialize(_linked(docs, k, num, den, text_col, id_col, count=False), "join")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")).alias("first")
    chosen = linked.where(F.col("group").isNotNull()).groupBy("group").agg(first).select("first.doc_id", "first.digest")
    chosen = chosen.unionByName(linked.where(F.col("group").isNull()).select("doc_id", "digest"))
    chosen = chosen.select(F.col("doc_id").alias("chosen_id"), F.col("digest").alias("chosen_digest")).distinct()
    own = [F.col(f"row_in.`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_in"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), _digest(text_col))
    rows = rows.join(chosen, F.col("doc_id").eqNullSafe(F.col("chosen_id")) & (F.col("digest") == F.col("chosen_digest")))
    nth = F.row_number().over(Window.partitionBy("doc_id", "digest").orderBy(F.lit(0)))
    return rows.withColumn("nth", nth).where(F.col("nth") == 1).select(*own)


def _digest(text_col: str):
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("digest")


def _linked(docs: DataFrame, k: int, num: int, den: int, text_col: str, id_col: str, count: bool) -> DataFrame:
    """One row per document, with its digest, its component's least set id as ``group`` (null without words), its id, and with ``count`` its links."""
    spark = docs.sparkSession
    ship_package(spark)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), _digest(text_col), text)
    measured = materialize(rows.mapInArrow(_measure(k), "piece int, doc_id long, digest long, n long, sid long, check long, counters binary"), "join")
    counts = _gathered(measured.where(F.col("piece").isNotNull()), np.uint32, SKETCH, np.add)
    sketch = spark.sparkContext.broadcast(counts)  # SKETCH counters
    sizes = measured.where(F.col("piece").isNull()).select("doc_id", "digest", "n", "sid", "check")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")).alias("least")
    classes = sizes.where(F.col("n") > 0).groupBy("sid", "check", "n").agg(least).select("sid", "check", "n", F.col("least.doc_id").alias("rep"), F.col("least.digest").alias("rep_digest"))
    classes = materialize(classes, "join")

    # a prefix entry is 24 bytes; buckets of one partition are read one after another
    entry = classes.agg(F.sum(F.col("n") - F.ceil(F.col("n") * num / den) + 1)).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-24 * int(entry) // BUCKET_BYTES))
    entries = rows.select("text").mapInArrow(_prefixes(sketch, k, num, den, buckets), "bucket int, token binary, sid binary, n binary, position binary")
    scanned = by_group(entries, ["bucket"], [], _scan_lists(num, den), "token long, a long, b long, n long, position long")
    scanned = materialize(scanned, "join")
    pairs = scanned.where(F.col("token").isNull()).select("a", "b").distinct()
    lists = scanned.where(F.col("token").isNotNull()).select("token", F.col("a").alias("sid"), "n", "position")
    in_long = lists.select(F.col("sid").alias("long_sid")).distinct()

    # the sets to compare, from one document of each class
    wanted = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).unionByName(lists.select("sid")).distinct()
    bits = spark.sparkContext.broadcast(_filter_bits(classes.join(wanted, "sid", "left_semi").select("rep", "rep_digest")))  # FILTER_BITS bits

    def wanted_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = batch.filter(pa.array(_passes(bits.value, _document_bits(*_keys(batch)))))
            for i, j, key, off in _parts(chosen, 2, k):
                sid, _ = set_ids(key, off)
                texts = pa.array([_shrunk(t.as_buffer().to_pybytes()) for t in chosen.column(2).slice(i, j - i)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(sid.view(np.int64)), texts], names=["sid", "text"])

    sets = materialize(rows.mapInArrow(wanted_sets, "sid long, text binary"), "join")

    need = F.ceil(num * (F.col("n_a") + F.col("n_b")) / (num + den))
    linked = F.col("overlap") >= need
    longest = lists.groupBy("token").count().agg(F.max("count").alias("m")).first()["m"] or 0
    first = _pivot_pairs(lists.withColumn("component", F.col("sid")), 0, PIVOTS[0], num, den).select("a", "b")
    overlaps = materialize(_overlaps(pairs.unionByName(first).distinct() if longest else pairs, sets, k), "join")
    links = overlaps.where(linked).select("a", "b")
    # the overlaps with each long list's first pivot
    known = overlaps.select(F.col("a").alias("pivot"), F.col("b").alias("sid"), F.col("n_a").alias("n_pivot"), "overlap")
    low = PIVOTS[0]
    for high in [*PIVOTS[1:], max(longest, 1)]:
        if longest <= low:
            break
        # lists within one component have nothing left to tell
        labels = components(links).withColumnRenamed("node", "sid")
        own = materialize(lists.join(labels, "sid", "left").withColumn("component", F.coalesce("component", "sid")), "join")
        mixed = own.groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("size"))
        mixed = materialize(mixed.where((F.col("least") != F.col("most")) & (F.col("size") > low)), "join")
        longest = mixed.agg(F.max("size").alias("m")).first()["m"] or 0
        if not longest:
            break
        lists = materialize(own.join(mixed.select("token"), "token", "left_semi"), "join")
        found = materialize(_pivot_pairs(lists, low, high, num, den, known), "join")
        lists = lists.drop("component")
        asked = found.where(F.col("open") & ~F.col("sure")).select("a", "b")
        more = _overlaps(asked, _asked_for(sets, asked.select(F.explode(F.array("a", "b")))), k).where(linked).select("a", "b")
        links = materialize(links.unionByName(found.where("sure").select("a", "b")).unionByName(more).distinct(), "join")
        low = high
    links = materialize(links, "join")
    label = materialize(classes.select("sid", "n", "rep").join(components(links).withColumnRenamed("node", "sid"), "sid").select("sid", "component", "rep", "n"), "join")
    return _members(sizes, classes, label, _counted(label, links, in_long, sets, k, num, den) if count else None)


def _pivot_pairs(lists: DataFrame, low: int, high: int, num: int, den: int, known: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of each long list's pivots from rank ``low`` to ``high`` with its later members of other components.

    With ``known`` (overlaps with first pivots), a pair is ``sure`` if they
    prove its link, and not ``open`` if they rule it out.
    """
    nth = F.row_number().over(Window.partitionBy("token").orderBy("sid"))
    ranked = lists.withColumn("nth", nth).where(F.col("nth") <= high)
    ranked = ranked.select("token", F.col("sid").alias("a"), F.col("n").alias("n_a"), F.col("position").alias("i"), F.col("component").alias("c_a"), "nth")
    pivots = ranked.where(F.col("nth") > low)
    own = lists.select("token", F.col("sid").alias("b"), F.col("n").alias("n_b"), F.col("position").alias("j"), F.col("component").alias("c_b"))
    room = 1 + F.least(F.col("n_a") - F.col("i") - 1, F.col("n_b") - F.col("j") - 1)
    need = F.ceil(num * (F.col("n_a") + F.col("n_b")) / (num + den))
    fits = (F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num) & (room >= need) & (F.col("c_a") != F.col("c_b"))
    if known is not None:
        first = ranked.where(F.col("nth") == 1).select("token", F.col("a").alias("pivot"))
        pivots = _with_known(pivots.join(first, "token"), known, "a")
        own = _with_known(own.join(first, "token"), known, "b").drop("pivot", "n_pivot_b")
    pairs = pivots.join(own, "token").where((F.col("a") < F.col("b")) & fits)
    if known is None:
        return pairs.select("a", "b").distinct()
    lower = F.col("overlap_a") + F.col("overlap_b") - F.col("n_pivot_a")
    upper = F.least("overlap_a", "overlap_b") + F.least(F.col("n_a") - F.col("overlap_a"), F.col("n_b") - F.col("overlap_b"))
    pairs = pairs.select("a", "b", F.coalesce(lower >= need, F.lit(False)).alias("sure"), F.coalesce(upper >= need, F.lit(True)).alias("open"))
    return pairs.groupBy("a", "b").agg(F.max("sure").alias("sure"), F.min("open").alias("open"))


def _with_known(rows: DataFrame, known: DataFrame, side: str) -> DataFrame:
    have = known.select(F.col("pivot").alias("kp"), F.col("sid").alias("ks"), F.col("n_pivot").alias(f"n_pivot_{side}"), F.col("overlap").alias(f"overlap_{side}"))
    return rows.join(have, (F.col("pivot") == F.col("kp")) & (F.col(side) == F.col("ks")), "left").drop("kp", "ks")


def _counted(label: DataFrame, links: DataFrame, in_long: DataFrame, sets: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(sid, n_links) from all links: those found, but by blocks where both sets are in long lists, as not all of these pairs were compared."""
    in_long = materialize(in_long, "join")
    a_long, b_long = in_long.withColumnRenamed("long_sid", "a_long"), in_long.withColumnRenamed("long_sid", "b_long")
    found = links.join(a_long, F.col("a") == F.col("a_long"), "left").join(b_long, F.col("b") == F.col("b_long"), "left")
    found = found.where(F.col("a_long").isNull() | F.col("b_long").isNull())
    found = found.select(F.explode(F.array("a", "b")).alias("sid")).groupBy("sid").agg(F.count(F.lit(1)).alias("n_links"))
    dealt = label.join(in_long, F.col("sid") == F.col("long_sid"), "left_semi").select("sid", "component", "n")
    return found.unionByName(_block_links(materialize(dealt, "join"), sets, k, num, den)).groupBy("sid").agg(F.sum("n_links").alias("n_links"))


def _members(sizes: DataFrame, classes: DataFrame, label: DataFrame, degree: DataFrame | None) -> DataFrame:
    """One row per document, from its class's component."""
    least = label.groupBy("component").agg(F.min("rep").alias("component_id"))
    owner = classes.select("sid", "check", "rep").join(label.join(least, "component").select("sid", "component", "component_id"), "sid", "left")
    owner = owner.join(degree, "sid", "left") if degree is not None else owner.withColumn("n_links", F.lit(None).cast("long"))
    owner = owner.select(F.col("sid").alias("s"), F.col("check").alias("c"), F.coalesce("component", "sid").alias("group"), F.coalesce("component_id", "rep").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = sizes.join(owner, (F.col("n") > 0) & (F.col("sid") == F.col("s")) & (F.col("check") == F.col("c")), "left")
    return out.select("doc_id", "digest", "group", F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "doc_id").alias("component_id"))
