"""Language identification by cross-parsing entropy.

Per language, a suffix automaton is built from labelled text.  A document is
parsed greedily into the longest matches that occur in a language's text; the
phrases counted, times log2 of that text's length, per symbol, estimate the
cross-entropy.  The language with the least estimate wins (ties: the lesser
name).

Texts are lower-cased; runs of non-letters become one space.  The automata
learn from labelled documents of any length, taken whole in hash order until a
language's text reaches ``chars_per_language`` characters (letters, and
one space for each run of others); the last one is cut there, which bounds
the tables that are sent to the tasks.  Texts without a letter teach nothing.  A
text is parsed whole, in stretches of
``STRETCH`` symbols side by side; a phrase ends at a stretch's end.

Defined results: a null text, or one without a letter, is ``und`` with score
0; without labelled rows every text is ``und``; the score is the relative
lead over the second-best language (1 for a single one); repeated rows are
answered alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm.textops import slices
from tickweave.session import ship_package

UNKNOWN = "und"
STRETCH = 512
#: Groups of a language's candidate texts, level by level: a text among the first of all is among the first of its group.
GROUPS = (4096, 64, 1)
#: Symbols parsed side by side at most.
AT_ONCE = 1 << 21
SPACE, UNSEEN = 1, 2
_letters: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    """Whether each code point is a letter or a mark (made once per process)."""
    if not _letters:
        _letters.append(np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def symbols(texts: list[str], code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, starts, sizes): lower-cased letters by ``code``, one SPACE for each run of anything else, none at the ends."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("\n".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    out = code[points]
    kept = np.ones(len(out), bool)
    kept[1:] = (out[1:] != SPACE) | (out[:-1] != SPACE)
    at = np.concatenate(([0], np.cumsum(kept)))
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    first = np.cumsum(sizes + 1) - sizes  # after the separator in front
    starts, ends = at[first], at[first + sizes]
    out = out[kept]
    # a run that began in front of the text belongs to the separator; one at its end goes
    ends = ends - ((ends > starts) & (out[np.maximum(ends - 1, 0)] == SPACE))
    return out, starts, ends - starts


def suffix_automaton(text: list[int], width: int) -> np.ndarray:
    """Transitions of the automaton of all substrings: [state, symbol] -> state, 0 for none; the root is state 1."""
    moves: list[dict[int, int]] = [{}, {}]
    link, length, last = [0, 0], [0, 0], 1
    for c in text:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if not p:
            link[new] = 1
        else:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(moves)
                moves.append(moves[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[new] = clone
                while p and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
        last = new
    table = np.zeros((len(moves), width), np.int32)
    for state, row in enumerate(moves):
        table[state, list(row)] = list(row.values())
    return table


class Parser:
    """The automata of all languages, in one flat table of row offsets."""

    def __init__(self, texts: dict[str, list[str]]):
        learnt = np.unique(np.frombuffer("".join(t.lower() for v in texts.values() for t in v).encode("utf-32-le", "surrogatepass"), np.uint32))
        letter = is_letter()
        self.letters = learnt[letter[learnt]].astype(np.int64)
        self.width = len(self.letters) + 3
        self.names, tables, bits = [], [], []
        for name in sorted(texts):
            seen, starts, sizes = symbols(texts[name], self.code())
            stream = np.concatenate([np.append(seen[i:i + n], SPACE) for i, n in zip(starts, sizes) if n] or [np.zeros(0, np.int64)])
            if len(stream):
                self.names.append(name)
                tables.append(suffix_automaton(stream.tolist(), self.width))
                bits.append(np.log2(max(2, len(stream))))
        self.bits = np.array(bits)
        rows = np.cumsum([0, *map(len, tables)])
        self.table = np.zeros((rows[-1], self.width), np.int64)
        for table, base in zip(tables, rows):
            self.table[base:base + len(table)] = np.where(table, (table + base) * self.width, 0)
        self.table = self.table.astype(np.int32 if self.table.size < 1 << 31 else np.int64).ravel()
        self.roots = ((rows[:-1] + 1) * self.width).astype(self.table.dtype)[:, None]
        # from the root, a symbol that the language never shows leads back to the root and is a phrase of its own
        self.first = self.table[self.roots + np.arange(self.width)] if tables else np.zeros((0, self.width), np.int32)
        self.never = self.first == 0
        self.never[:, 0] = False
        self.first = np.where(self.first == 0, self.roots, self.first)

    def code(self) -> np.ndarray:
        """Symbol of each code point."""
        out = np.where(is_letter(), UNSEEN, SPACE).astype(np.uint16)
        out[self.letters] = np.arange(len(self.letters)) + 3
        return out

    def phrases(self, stretches: np.ndarray, used: np.ndarray) -> np.ndarray:
        """Phrases of each row (its symbols, longest row first) in each language: [language, row]."""
        state = np.repeat(self.roots, len(stretches), axis=1)
        count = np.zeros(state.shape, np.int32)
        live = np.searchsorted(-used, -np.arange(stretches.shape[1]), "left")
        columns = np.ascontiguousarray(stretches.T)
        for i, n in enumerate(live.tolist()):
            if not n:
                break
            symbol = columns[i, :n]
            to = self.table[state[:, :n] + symbol]
            fails = to == 0
            count[:, :n] += fails & (state[:, :n] != self.roots)
            state[:, :n] = np.where(fails, self.first[:, symbol], to)
        count += state != self.roots
        for k, never in enumerate(self.never):
            if never[3:].any() or (stretches == UNSEEN).any():
                count[k] += never[stretches].sum(axis=1)
        return count

    def costs(self, seen: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Estimated bits per symbol: [text, language], for texts of one symbol or more."""
        pieces = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(sizes)), pieces)
        at = starts[owner] + (np.arange(len(owner)) - (np.cumsum(pieces) - pieces)[owner]) * STRETCH
        long = np.minimum(STRETCH, (starts + sizes)[owner] - at)
        total = np.zeros((len(sizes), len(self.names)), np.int64)
        order = np.argsort(-long, kind="stable")
        for i in range(0, len(order), AT_ONCE // STRETCH):
            part = order[i:i + AT_ONCE // STRETCH]
            columns = np.arange(int(long[part[0]]))
            inside = columns < long[part][:, None]
            rows = np.where(inside, seen[np.minimum(at[part][:, None] + columns, len(seen) - 1)], 0)
            for k, c in enumerate(self.phrases(rows, long[part])):
                np.add.at(total[:, k], owner[part], c)
        return total * self.bits / sizes[:, None]


def _first_texts(chars: int):
    """Task function: by language, the task's first texts in hash order until they reach ``chars`` characters, as the learner sees them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = is_letter()
        held: dict[str, list[tuple[int, int, str, bool]]] = {}
        for batch in batches:
            by: dict[str, list[tuple[int, int, str, bool]]] = {}
            for lang, text, h, digest in zip(*(c.to_pylist() for c in batch.columns)):
                by.setdefault(lang, []).append((h, digest, text, False))
            for lang, rows in by.items():
                kept, upto = [], 0
                # what has this many characters before it here has them before it in the whole table
                for h, digest, text, plain in sorted(held.get(lang, []) + rows):
                    if upto >= chars:
                        break
                    text = text if plain else _plain(text, letter)[:chars]
                    if text:
                        kept.append((h, digest, text, True))
                        upto += len(text)
                held[lang] = kept
        for lang, rows in held.items():
            h, digest, text, _ = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(rows), pa.string()), pa.array(text, pa.string()), pa.array(h, pa.int64()), pa.array(digest, pa.int64())], names=["lang", "text", "h", "digest"])
    return run


def _plain(text: str, letter: np.ndarray) -> str:
    """The lower-cased letters, one space for each run of anything else, none at the ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return " ".join(np.where(letter[points], points, 32).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").split())


def taught(labelled: DataFrame, text_col: str, label_col: str, id_col: str, chars_per_language: int) -> dict[str, list[str]]:
    """The texts of each language that its automaton learns from: ``chars_per_language`` characters, or all there are."""
    ship_package(labelled.sparkSession)
    h = F.xxhash64(F.col(f"`{id_col}`").cast("string")).alias("h")
    rows = labelled.select(F.col(f"`{label_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"), h, F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("digest"))
    rows = rows.where(F.col("lang").isNotNull() & (F.length("text") > 0))
    rows = rows.mapInArrow(_first_texts(chars_per_language), "lang string, text string, h long, digest long")
    for groups in GROUPS:       # each task sends its own first texts, so one window a language would grow with the tasks
        turn = Window.partitionBy("lang", F.pmod("digest", F.lit(groups))).orderBy("h", "digest", "text")
        before = F.sum(F.length("text")).over(turn.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.length("text")
        rows = rows.withColumn("before", before).where(F.col("before") < chars_per_language)
    texts: dict[str, list[str]] = {}
    for r in rows.orderBy("lang", "h", "digest", "text").collect():
        texts.setdefault(r["lang"], []).append(r["text"][:chars_per_language - r["before"]])
    return texts


def learn(labelled: DataFrame, text_col: str, label_col: str, id_col: str, chars_per_language: int) -> Parser:
    """Automata from labelled documents in hash order; the driver gets a bounded text per language."""
    return Parser(taught(labelled, text_col, label_col, id_col, chars_per_language))


def _answers(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser: Parser = model.value
        code = parser.code()
        for batch in batches:
            column = batch.column(1)
            lengths = np.array(pa.compute.fill_null(pa.compute.binary_length(column), 0), np.int64)
            for i, j in slices(np.concatenate(([0], np.cumsum(lengths))), 4 << 20):
                seen, starts, sizes = symbols([t or "" for t in column.slice(i, j - i).to_pylist()], code)
                some = np.flatnonzero(sizes)
                lang, score = np.full(j - i, UNKNOWN, object), np.zeros(j - i)
                if len(some) and parser.names:
                    costs = parser.costs(seen, starts[some], sizes[some])
                    lang[some] = np.array(parser.names, object)[costs.argmin(axis=1)]
                    ranked = np.partition(np.column_stack((costs, np.full(len(some), np.inf))), 1, axis=1)
                    score[some] = np.clip(1 - ranked[:, 0] / np.maximum(ranked[:, 1], 1e-12), 0, 1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, labelled: DataFrame, chars_per_language: int = 40_000, text_col: str = "text", label_col: str = "lang",
             id_col: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score) of each document; ``labelled`` rows teach."""
    spark = docs.sparkSession
    ship_package(spark)
    parser = learn(labelled, text_col, label_col, id_col, chars_per_language)
    model = spark.sparkContext.broadcast(parser)  # bounded by languages * chars_per_language * 2 states
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(_answers(model), "doc_id long, lang_pred string, score double")


def fold(id_col: str, parts: int) -> Column:
    """The remainder that deals documents into learning and held-out rows."""
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")), F.lit(parts))
