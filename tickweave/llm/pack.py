"""Packing: concatenate and cut.

All token streams are laid end to end; the stream is cut into windows of a
fixed length.  Pass one tokenizes the documents, and each task writes its
documents with their offsets inside the task's own stream.  The tasks' token
totals (one row per task) get prefix sums, which give the tasks' global bases;
pass two adds the base to each document's offset and cuts it where it crosses
a window's edge.  Only the totals meet in one place.  No shuffle of texts or
tokens takes place.

Defined results: a null text counts as empty (its stream is the end id
alone); repeated rows are packed as often as they occur; null ids stay null;
an empty table gives no pieces; columns other than the id and the text are
not read.  The last window may be short; all others are full.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm.exchange import give_back
from tickweave.session import materialize, ship_package

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
#: Distinct words whose ids a task keeps, and those that stay for the worker's next task (the first
#: ones met, so the frequent ones; between tasks they lie in three byte strings, not in a table of
#: objects).  They bound memory, not results.
WORD_TABLE_LIMIT = 800_000
WORDS_KEPT = 400_000
#: Words encoded in one call.
WORDS_AT_ONCE = 2_000
#: A run of ASCII marks that ends a word after a letter or digit is a piece of its own
#: (the last class: Latin-1 letters in UTF-8, without the two signs among them).
_TAIL_MARKS = re.compile(rb"(?:(?<=[a-z0-9])|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))[!-/:-@\[-`{-~]+\Z")
_MARKS = frozenset(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


class WordTable:
    """Ids of distinct words, as little-endian bytes.

    For tokenizers like the public one: text is lower-cased, white space only
    separates, runs of letters and runs of marks are pieces of their own, and
    a piece's last token ends with ``</w>``.  A text's ids are then its words'
    ids in turn, and each word needs encoding once, the marks at its end apart.
    Words of letters are encoded many at a time and told apart by the word ends; should their
    number not agree, and for all other words, each is encoded alone.
    """

    def __init__(self, tokenizer_file: str, id_type: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = True
        self.id_type = id_type
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.kept = (b"", b"", np.zeros(0, np.int64))

    def open(self) -> "WordTable":
        """The table for a task: what the last task packed away."""
        words, ids, ends = self.kept
        ends = ends.tolist()
        self.known = dict(zip(words.split(), [ids[i:j] for i, j in zip([0, *ends], ends)]))
        return self

    def close(self) -> None:
        """Pack the words met first away until the next task; words hold no white space."""
        self.trim()
        ids = list(self.known.values())
        self.kept = (b" ".join(self.known), b"".join(ids), np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))))
        self.known = {}

    def _alone(self, words: list[bytes]) -> None:
        for e, w in zip(self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False), words):
            self.known[w] = np.array(e.ids, self.id_type).tobytes()

    def _learn(self, words: Iterable[bytes]) -> None:
        """Add distinct unknown words to the table."""
        known, new, tails = self.known, {}, []
        for w in words:
            if w[-1] in _MARKS and (m := _TAIL_MARKS.search(w)):
                parts = w[:m.start()], m.group()
                tails.append((w, *parts))
                for p in parts:
                    if p not in known:
                        new[p] = None
            else:
                new[w] = None
        self._encode(list(new))
        known.update((w, known[body] + known[marks]) for w, body, marks in tails)

    def _encode(self, words: list[bytes]) -> None:
        for i in range(0, len(words), WORDS_AT_ONCE):
            texts = [(w, w.decode()) for w in words[i:i + WORDS_AT_ONCE]]
            together = [x for x in texts if x[1].isalpha()]
            if together:
                joined = self.tokenizer.encode_batch_fast([" ".join(t for _, t in together)], add_special_tokens=False)[0].ids
                ids = np.array(joined, self.id_type)
                ends = (np.flatnonzero(self.is_end[ids]) + 1).tolist()
                if len(ends) == len(together) and ends[-1] == len(ids):
                    raw, width = ids.tobytes(), ids.itemsize
                    self.known.update((w, raw[a * width:b * width]) for (w, _), a, b in zip(together, [0, *ends], ends))
                else:
                    self._alone([w for w, _ in together])
            if rest := [w for w, t in texts if not t.isalpha()]:
                self._alone(rest)

    def trim(self) -> None:
        """Keep the words met first."""
        if len(self.known) > WORDS_KEPT:
            self.known = dict(islice(self.known.items(), WORDS_KEPT))

    def ids(self, text: bytes) -> bytes:
        """The ids of a text, its white space as the six ASCII characters or inside words."""
        words = text.lower().split()
        parts = [*map(self.known.get, words)]
        if None in parts:
            if len(self.known) > WORD_TABLE_LIMIT:
                self.trim()
            # only the places of unknown words are looked up again
            gaps = [i for i, p in enumerate(parts) if p is None]
            self._learn({words[i] for i in gaps})
            known = self.known
            for i in gaps:
                parts[i] = known[words[i]]
        return b"".join(parts)


_tables: dict[tuple[str, str], WordTable] = {}


def word_table(tokenizer_file: str, id_type: str) -> WordTable:
    """The worker's table, kept from task to task."""
    key = (tokenizer_file, id_type)
    if key not in _tables:
        _tables[key] = WordTable(tokenizer_file, id_type)
    return _tables[key].open()


def _token_rows(tokenizer_file: str, end_id: int, id_type: str):
    """Task function: (doc_id, ids, n, local_start, task) for each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = word_table(tokenizer_file, id_type)
        task, start = TaskContext.get().partitionId(), 0
        tail = np.array([end_id], id_type).tobytes()
        width = len(tail)
        for batch in batches:
            blobs = [table.ids(t.as_py() or b"") + tail for t in batch.column(1).cast(pa.binary())]
            n = np.fromiter((len(b) // width for b in blobs), np.int64, len(blobs))
            ends = start + np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(blobs, pa.binary()), pa.array(n), pa.array(ends - n),
                 pa.array(np.full(len(n), task, np.int32))],
                names=["doc_id", "ids", "n", "local_start", "task"])
            start = int(ends[-1]) if len(n) else start
        table.close()
        give_back()
    return run


def tokenize(docs: DataFrame, tokenizer_file: str, end_id: int = 1, text_col: str = "text",
             id_col: str = "doc_id", wide_ids: bool = False) -> DataFrame:
    """Pass one, written to the shared folder: ids and offsets within each task's stream.

    Ids are little-endian, 16 bits each (``wide_ids``: 32 bits, for
    vocabularies of 65,536 entries or more).
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    tokens = rows.mapInArrow(_token_rows(tokenizer_file, end_id, "<u4" if wide_ids else "<u2"),
                             "doc_id long, ids binary, n long, local_start long, task int")
    return materialize(tokens, "pack")


def task_bases(tokens: DataFrame) -> DataFrame:
    """Prefix sums over the tasks' totals: one row per task of pass one.

    The totals come from the documents' lengths, one partial sum per task, so
    the ordered window runs over as many rows as pass one had tasks.
    """
    totals = tokens.groupBy("task").agg(F.sum("n").alias("total"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("task", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def _cut(length: int, id_type: str):
    """Task function: the pieces of each document, cut at multiples of ``length``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            starts = batch.column(2).to_numpy(zero_copy_only=False)
            for doc, blob, at in zip(batch.column(0).to_pylist(), batch.column(1), starts.tolist()):
                ids = np.frombuffer(blob.as_buffer(), id_type)
                n, i = len(ids), 0
                while i < n:
                    sequence, offset = divmod(at + i, length)
                    j = min(n, i + length - offset)
                    for column, value in zip(out, (doc, i, j - i, zlib.crc32(ids[i:j].astype("<u4").tobytes()), n, sequence, offset)):
                        column.append(value)
                    i = j
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=[c.split()[0] for c in PIECES.split(", ")])
    return run


def pack(docs: DataFrame, tokenizer_file: str, length: int = 2048, end_id: int = 1,
         text_col: str = "text", id_col: str = "doc_id", wide_ids: bool = False) -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence."""
    tokens = tokenize(docs, tokenizer_file, end_id, text_col, id_col, wide_ids)
    # one row per task of pass one: a few bytes per input split
    placed = tokens.join(F.broadcast(task_bases(tokens)), "task")
    placed = placed.select("doc_id", "ids", (F.col("base") + F.col("local_start")).alias("at"))
    return placed.mapInArrow(_cut(length, "<u4" if wide_ids else "<u2"), PIECES)


def sequences(docs: DataFrame, tokenizer_file: str, length: int = 2048, end_id: int = 1,
              pad_id: int = 0, text_col: str = "text", id_col: str = "doc_id", wide_ids: bool = False) -> DataFrame:
    """The packed sequences themselves: (sequence_id, ids array, n_tokens).

    Boundary records — documents that reach into a further window — are split
    by the same cut; each window gathers its pieces, at most ``length`` ids.
    """
    tokens = tokenize(docs, tokenizer_file, end_id, text_col, id_col, wide_ids)
    kind = "<u4" if wide_ids else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq, off, part = [], [], []
            for blob, at in zip(batch.column(0), batch.column(1).to_pylist()):
                ids, i = np.frombuffer(blob.as_buffer(), kind), 0
                while i < len(ids):
                    sequence, offset = divmod(at + i, length)
                    j = min(len(ids), i + length - offset)
                    seq.append(sequence)
                    off.append(offset)
                    part.append(ids[i:j].astype(np.int32))
                    i = j
            yield pa.RecordBatch.from_arrays([pa.array(seq, pa.int64()), pa.array(off, pa.int64()), pa.array(part, pa.list_(pa.int32()))],
                                             names=["sequence_id", "offset", "ids"])

    placed = tokens.join(F.broadcast(task_bases(tokens)), "task").select("ids", (F.col("base") + F.col("local_start")).alias("at"))
    pieces = placed.mapInArrow(run, "sequence_id long, offset long, ids array<int>")
    whole = pieces.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))
    n = F.size("ids")
    return whole.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(length) - n)).alias("ids"), n.alias("n_tokens"))
