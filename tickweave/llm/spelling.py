"""Spelling variants by finite-state composition.

The vocabulary acceptor is composed with a one-edit transducer and the acceptor
again: A o T o A accepts (v, w) where w is v with one code point inserted,
deleted or replaced.  The composed machine is enumerated one initial state at a
time.  An initial state is the state after the part of a word that both sides
share.  Of two words one edit apart, either the first or the last half of the
shorter one is untouched, so a word of m code points goes to the machines of
its first and of its last half (class m), and, as the longer side, to those of
class m - 1.  In such a machine the short and the long remainders are two
minimised acceptors, built over one register of states; the transducer's edit
comes where the words first differ, so every pair is accepted exactly once.

Machines are dealt to tasks in buckets of bounded size.  An initial state with
more words than fit, or with long remainders, is halved again by the same rule:
remainders shrink until their number is bounded, whatever the vocabulary.
No pair leaves a task: it answers with each word's pair count and best partner.

Defined results: a null text has no words; a null id is written as nothing;
repeated rows are documents of their own; an empty table gives no rows; words
of any length are taken whole; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.exchange import by_group, give_back
from tickweave.session import materialize

#: Letters of a run (after lower-casing A-Z), and the deletion rule's divisor.
LETTERS = "a-zÀ-ÿ"
DROP = 199
#: Words of one initial state that a task takes, code points of a remainder, words of a bucket.
STATE_WORDS = 20_000
REST = 32
BUCKET_WORDS = 60_000
#: Distinct words that a task counts before it hands them on.
COUNTED = 250_000


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5, drop: int = DROP) -> DataFrame:
    """(word, n): runs of letters of whole texts, one code point deleted where ``drop`` divides crc32 of '<id>:<run>'."""
    runs = re.compile(f"[{LETTERS}]{{{least_length},}}")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                if not text.is_valid:
                    continue
                seed = zlib.crc32(b"%s:" % (doc.as_py() or "").encode())
                # bytes.lower() changes A-Z alone
                for run, n in Counter(runs.findall(text.as_py().encode().lower().decode())).items():
                    h = zlib.crc32(run.encode(), seed)
                    if h % drop == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                        if len(run) < least_length:
                            continue
                    total[run] += n
                if len(total) > COUNTED:
                    yield out()
        yield out()
        give_back()

    given = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"))
    counted = given.mapInArrow(task, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _halved(rows: DataFrame) -> DataFrame:
    """Each remainder sent to the machines of its first and of its last half."""
    size = F.char_length("rest")
    m = size - F.col("side")
    h = F.floor(m / 2).cast("int")

    def part(name, fixed, rest, at_end):
        return F.struct(F.xxhash64(F.col("k1"), F.lit(name), fixed).alias("k1"), F.xxhash64(fixed, F.lit(name), F.col("k2")).alias("k2"),
                        at_end.alias("no_end"), F.col("side").alias("side"), rest.alias("rest"), F.col("id").alias("id"))

    first = part("first", F.expr("left(rest, cast(floor((char_length(rest) - side) / 2) as int))"), F.substr("rest", h + 1, size), F.col("no_end"))
    last = part("last", F.substr("rest", size - (m - h) + 1, size), F.substr("rest", F.lit(1), size - (m - h)), F.lit(True))
    return rows.select(F.explode(F.array(first, last)).alias("x")).select("x.*")


def _machines(words: DataFrame, least_length: int) -> Iterator[DataFrame]:
    """Tables (k1, k2, no_end, side, rest, id) of complete machines, none over the bounds."""
    size = F.char_length("word")

    def member(side):
        m = size - side
        return F.struct(F.xxhash64(m, F.lit(1)).alias("k1"), F.xxhash64(m, F.lit(2)).alias("k2"), F.lit(False).alias("no_end"),
                        F.lit(side).alias("side"), F.col("word").alias("rest"), F.col("id"))

    both = F.filter(F.array(member(0), member(1)), lambda x: F.char_length(x["rest"]) - x["side"] >= least_length)
    rows = _halved(words.select(F.explode(both).alias("x")).select("x.*"))
    while True:
        rows = materialize(rows, "spelling", "machines")
        big = rows.groupBy("k1", "k2").agg(F.count("*").alias("size"), F.max(F.char_length("rest") - F.col("side")).alias("m")) \
            .where((F.col("m") > 1) & ((F.col("size") > STATE_WORDS) | ((F.col("m") > REST) & (F.col("size") > 1))))
        big = materialize(big.select("k1", "k2"), "spelling", "big")
        if big.isEmpty():
            yield rows
            return
        yield rows.join(big, ["k1", "k2"], "left_anti")
        rows = _halved(rows.join(big, ["k1", "k2"], "left_semi"))


class _Acceptors:
    """Minimised acyclic acceptors over one register: equal right languages are one state."""

    def __init__(self):
        self.register: dict[tuple, int] = {}
        self.final: list[bool] = []
        self.next: list[dict[str, int]] = []
        self.shared: dict[tuple[int, int], list[str]] = {}

    def build(self, words: list[str], i: int, j: int, depth: int) -> int:
        """The state that accepts words[i:j] (sorted, distinct) from ``depth`` on."""
        final = len(words[i]) == depth
        arcs, k = [], i + final
        while k < j:
            c, start = words[k][depth], k
            while k < j and words[k][depth] == c:
                k += 1
            arcs.append((c, self.build(words, start, k, depth + 1)))
        key = (final, tuple(arcs))
        state = self.register.get(key)
        if state is None:
            state = self.register[key] = len(self.final)
            self.final.append(final)
            self.next.append(dict(arcs))
        return state

    def common(self, q: int, r: int) -> list[str]:
        """What both states accept."""
        key = (q, r) if q <= r else (r, q)
        out = self.shared.get(key)
        if out is None:
            out = [""] if self.final[q] and self.final[r] else []
            arcs = self.next[r]
            for c, a in self.next[q].items():
                if c in arcs:
                    out += [c + x for x in self.common(a, arcs[c])]
            self.shared[key] = out
        return out

    def pairs(self, short: dict[str, int], long: dict[str, int], no_end: bool) -> Iterator[tuple[int, int]]:
        """Accepted pairs of A o T o A: replacements within ``short``, insertions from ``short`` to ``long``."""
        words = sorted(short)
        s0 = self.build(words, 0, len(words), 0)
        l0 = None
        if long:
            words = sorted(long)
            l0 = self.build(words, 0, len(words), 0)
        stack = [("", s0, l0)]
        while stack:
            read, s, l = stack.pop()
            arcs = list(self.next[s].items())
            for i, (c, a) in enumerate(arcs):
                for d, b in arcs[i + 1:]:
                    for x in self.common(a, b):
                        yield short[read + c + x], short[read + d + x]
            more = self.next[l] if l is not None else {}
            for c, after in more.items():
                if self.final[s] and self.final[after] and not no_end:
                    yield short[read], long[read + c]
                then = self.next[after]
                for d, a in arcs:
                    if d != c and d in then:
                        for x in self.common(a, then[d]):
                            yield short[read + d + x], long[read + c + d + x]
            stack.extend((read + c, a, more.get(c)) for c, a in arcs)


def _solve(_key: tuple, table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Each word's number of partners and least partner id over the machines of a bucket."""
    k1, k2, side, ids, no_end = (table.column(c).to_numpy() for c in ("k1", "k2", "side", "id", "no_end"))
    edge = np.flatnonzero(np.concatenate(([True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]), [True])))
    several = np.flatnonzero(np.diff(edge) > 1)
    rests, machines = table.column("rest").to_pylist(), _Acceptors()
    side, ids = side.tolist(), ids.tolist()
    a, b = [], []
    for i, j in zip(edge[several].tolist(), edge[several + 1].tolist()):
        short, long = {}, {}
        for k in range(i, j):
            (long if side[k] else short)[rests[k]] = ids[k]
        if short:
            for v, w in machines.pairs(short, long, bool(no_end[i])):
                a.append(v)
                b.append(w)
        if len(machines.shared) > 500_000:
            machines.shared.clear()
    if a:
        own, other = np.array(a + b, np.int64), np.array(b + a, np.int64)
        order = np.lexsort((other, own))
        own, other = own[order], other[order]
        first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        yield pa.RecordBatch.from_arrays([pa.array(own[first]), pa.array(np.diff(np.append(first, len(own))).astype(np.int64)), pa.array(other[first])],
                                         names=["id", "n_near", "best"])


def near_words(words: DataFrame, least_length: int = 1) -> DataFrame:
    """(id, n_near, best): for each word with a partner one edit away, their number and the least partner id."""
    out = None
    for rows in _machines(words, least_length):
        buckets = max(1, -(-rows.count() // BUCKET_WORDS))
        keyed = rows.withColumn("bucket", F.pmod(F.xxhash64("k1", "k2"), F.lit(buckets)).cast("int"))
        found = by_group(keyed, ["bucket"], ["k1", "k2"], _solve, "id bigint, n_near bigint, best bigint")
        out = found if out is None else out.unionByName(found)
    return out.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(edges: DataFrame) -> DataFrame:
    """(id, root): each word's last form; paths double until none grows (forms are ever more frequent, so none turns back)."""
    paths = materialize(edges.select("id", F.col("best").alias("root")), "spelling", "paths")
    while True:
        ahead = paths.select(F.col("id").alias("root"), F.col("root").alias("further"))
        grown = materialize(paths.join(ahead, "root", "left").select("id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("grew")), "spelling", "paths")
        paths = grown.drop("grew")
        if grown.where("grew").isEmpty():
            return paths


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5,
                   ratio: int = 5, drop: int = DROP) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word, the near word that it is a variant of, and the last form."""
    counted = count_words(docs, id_col, text_col, least_length, least_count, drop)
    # ids grow from the most frequent word on, ties in code-point order, so the best partner is the least id
    words = materialize(counted.orderBy(F.desc("n"), "word").withColumn("id", F.monotonically_increasing_id()), "spelling", "words")
    near = near_words(words.select("id", "word"), least_length)
    forms = words.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    out = words.join(near, "id", "left").join(forms, "best", "left")
    variant = F.coalesce(F.col("form_n") >= F.col("n") * ratio, F.lit(False))
    out = materialize(out.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                 *[F.when(variant, F.col(c)).alias(c) for c in ("best", "form", "form_n")]), "spelling", "forms")
    roots = _roots(out.where(F.col("best").isNotNull()))
    names = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    return out.join(roots, "id", "left").join(names, "root", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
