"""Quality rules with n-gram perplexity bands.

Rules count words (``[^\\x20\\x09-\\x0D]+``), signs, repeated lines and words
in repeated eight-word windows.  The language model is a modified Kneser-Ney
model over characters of the lower-cased text, counted by Spark over all
documents: each task counts its own n-grams, Spark adds them up, and
continuation counts, discounts and interpolated probabilities are DataFrame
aggregations.  A language has two models, each counted from one half of its
documents (by hash of the text, so that copies stay together), and a document
is scored by the half that it is not in: its own counts never speak for it.

The model is stored as sorted arrays of 64-bit hashes.  A seen n-gram holds the
log of its probability over what its context would leave it, a seen context the
log of what it leaves to the next lower order; a symbol's log probability is
then a plain sum over all orders, whatever was seen.  Scoring looks the
distinct n-grams of a chunk of texts up by binary search.  The arrays are
cut into slices of at most ``slice_entries`` entries by hash range; one slice
at a time is sent to the tasks, and documents' partial sums are added up, so
what a task holds stays bounded however large the model becomes.

A language's band is its median log perplexity, widened to both sides by
``band`` times the distance to the quartile on that side, by ``margin``, and, as short
texts vary more, by ``short_margin`` over the root of a text's characters;
documents outside are rejected.

Symbols are code points below 0xF00 and, above, 256 classes of code points;
digits count as one, and any white space as one.

Defined results: a null text has no words and fails the base rules; a null
language is a language of its own; repeated rows are counted and judged each; a
language whose other half holds no text has no perplexity there, and no band rejects;
an empty table gives no rows; columns clashing with those added give way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.textops import column_bytes, mix, prefix_hash, row_of, row_sums, slices, span_hash, words
from tickweave.session import materialize, ship_package

ORDER = 5
BITS = 12
CHUNK = 1 << 20
#: Entries of a task's n-gram counts that it holds before it hands them on.
HELD_COUNTS = 2_000_000
#: Least weight that a context leaves to the lower orders, where its discounts come to nothing.
LEAST_LEFT = 1e-6
#: The signs that count as symbols.
SIGNS = b"#*$%&|<>"
WINDOW_WORDS = 8

_SIGN = np.zeros(256, bool)
_SIGN[list(SIGNS)] = True
_symbols: list[np.ndarray] = []


def symbol_table() -> np.ndarray:
    """Symbol of each code point: 1 for white space, 2 for digits, the point itself, or one of 256 classes."""
    if not _symbols:
        points = np.arange(0x110000, dtype=np.int64)
        table = np.where(points < 0xF00, points, 0xF00 + (mix(points.astype(np.uint64)) & np.uint64(0xFF)).astype(np.int64))
        table[[*range(9, 14), 32, 0x85, 0xA0, 0x2028, 0x2029]] = 1
        table[48:58] = 2
        table[0] = 3
        _symbols.append(table.astype(np.uint64))
    return _symbols[0]


def grams(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(packed n-grams, offsets per text): one for each character, after ``order`` - 1 start marks (symbol 0)."""
    lowered = [t.lower() for t in texts]
    pad = "\0" * (order - 1)
    points = np.frombuffer((pad + pad.join(lowered)).encode("utf-32-le", "surrogatepass"), np.uint32)
    table = symbol_table()
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    seen = table[points]
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    # the pad in front of each text is the start mark, not a character
    first = offsets[:-1] + (order - 1) * np.arange(len(sizes))
    marks = (first[:, None] + np.arange(order - 1)).ravel()
    seen[marks] = 0
    at = np.delete(np.arange(len(seen)), marks)
    packed = np.zeros(len(at), np.uint64)
    for k in range(order):
        packed = (packed << np.uint64(BITS)) | seen[at - (order - 1 - k)]
    return packed, offsets


def counted(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, c): counts over all documents, added up in each task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, list] = {}
        size = 0

        def out():
            for lang, parts in held.items():
                key, count = _merge(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key.astype(np.int64)), pa.array(count)], names=["lang", "gram", "c"])

        for batch in batches:
            langs = batch.column(0).to_pylist()
            _, offsets = column_bytes(batch.column(1))
            for i, j in slices(offsets, CHUNK):
                texts = batch.column(1).slice(i, j - i).to_pylist()
                by: dict[str | None, list[str]] = {}
                for lang, text in zip(langs[i:j], texts):
                    if text:
                        by.setdefault(lang, []).append(text)
                for lang, some in by.items():
                    key = np.sort(grams(some, order)[0])
                    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                    parts = held.setdefault(lang, [])
                    parts.append((key[edge], np.diff(np.append(edge, len(key)))))
                    size += len(edge)
            if size > HELD_COUNTS:
                held = {lang: [_merge(parts)] for lang, parts in held.items()}
                size = sum(len(p[0][0]) for p in held.values())
                if size > HELD_COUNTS // 2:
                    yield from out()
                    held, size = {}, 0
        yield from out()

    rows = docs.select("lang", "text").mapInArrow(run, "lang string, gram long, c long")
    return rows.groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def _merge(parts: list) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    key, count = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key[edge], np.add.reduceat(count, edge) if len(edge) else count


def kneser_ney(counts: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame]:
    """Interpolated modified Kneser-Ney: (grams, contexts).

    ``grams`` has (lang, n, gram, p, rest) for each n-gram seen, at every order:
    its probability, and what its context leaves it without its own count.
    ``contexts`` has (lang, n, context, left, kinds): the weight a context
    leaves to the next lower order, and the language's number of n-grams.
    Orders below the top count how many symbols precede an n-gram; the
    discounts of an order follow from how many of its n-grams count 1 to 4.
    The lowest order is interpolated with an even share of the symbols seen.
    """
    levels = {order: counts}
    for n in range(order - 1, 0, -1):
        low = F.col("gram").bitwiseAND((1 << (BITS * n)) - 1).alias("gram")
        levels[n] = materialize(levels[n + 1].groupBy("lang", low).agg(F.count(F.lit(1)).alias("c")), "perplexity")
    grams = contexts = lower = None
    for n in range(1, order + 1):
        rows = levels[n]
        context = F.shiftright("gram", BITS).alias("context")
        tally = rows.groupBy("lang").agg(*[F.sum((F.col("c") == k).cast("double")).alias(f"t{k}") for k in (1, 2, 3, 4)], F.count(F.lit(1)).alias("kinds"))
        y = F.try_divide(F.col("t1"), F.col("t1") + 2 * F.col("t2"))
        cut = [F.least(F.lit(float(k)), F.greatest(F.lit(0.0), F.coalesce(k - (k + 1) * y * F.try_divide(F.col(f"t{k + 1}"), F.col(f"t{k}")), F.lit(0.5)))).alias(f"d{k}") for k in (1, 2, 3)]
        discount = F.broadcast(tally.select(F.col("lang").alias("of"), "kinds", *cut))  # one row per language and half
        own = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = rows.select("lang", "gram", "c", context).join(discount, F.col("lang").eqNullSafe(F.col("of"))).withColumn("d", own)
        rows = rows.select("lang", "gram", "c", "context", "d", "kinds")
        total = rows.groupBy(F.col("lang").alias("l"), F.col("context").alias("x")).agg(F.sum("c").alias("total"), F.sum("d").alias("mass"), F.first("kinds").alias("k"))
        total = materialize(total.withColumn("left", F.greatest(F.col("mass") / F.col("total"), F.lit(LEAST_LEFT))), "perplexity")
        rows = rows.join(total.drop("k"), F.col("lang").eqNullSafe(F.col("l")) & (F.col("context") == F.col("x")))
        if lower is None:
            below = 1 / F.col("kinds")
        else:
            suffix = F.col("gram").bitwiseAND((1 << (BITS * (n - 1))) - 1)
            rows = rows.join(lower, F.col("lang").eqNullSafe(F.col("low_lang")) & (suffix == F.col("low")))
            below = F.col("low_p")
        rest = F.col("left") * below
        rows = materialize(rows.select("lang", F.lit(n).alias("n"), "gram", ((F.col("c") - F.col("d")) / F.col("total") + rest).alias("p"), rest.alias("rest")), "perplexity")
        lower = rows.select(F.col("lang").alias("low_lang"), F.col("gram").alias("low"), F.col("p").alias("low_p"))
        of = total.select(F.col("l").alias("lang"), F.lit(n).alias("n"), F.col("x").alias("context"), "left", F.col("k").alias("kinds"))
        grams, contexts = (rows, of) if grams is None else (grams.unionByName(rows), contexts.unionByName(of))
    return grams, contexts


def _key(lang: str | None, tag: int, packed: np.ndarray) -> np.ndarray:
    """64-bit hash of an n-gram (``tag`` its order) or a context (``tag`` its order, negative) of a language."""
    name = np.frombuffer(f"{tag}{'' if lang is None else '=' + lang}".encode(), np.uint8)
    seed = span_hash(prefix_hash(name), np.array([0]), np.array([len(name)]))
    return mix(packed ^ seed)


def hash_arrays(grams: DataFrame, contexts: DataFrame) -> DataFrame:
    """(h, logp): the model's entries under their hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram = batch.column(2).to_numpy().astype(np.uint64)
            h = np.zeros(len(gram), np.uint64)
            for lang, rows in _by_model(batch.column(0)):
                tags = batch.column(1).to_numpy()
                for tag in np.unique(tags[rows]).tolist():
                    of = rows & (tags == tag)
                    h[of] = _key(lang, tag, gram[of])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(batch.column(3).to_numpy().astype(np.float32))], names=["h", "logp"])

    ship_package(grams.sparkSession)
    seen = grams.select("lang", "n", "gram", F.log(F.col("p") / F.col("rest")).alias("value"))
    left = contexts.select("lang", (-F.col("n")).alias("n"), F.col("context").alias("gram"), F.log("left").alias("value"))
    return seen.unionByName(left).mapInArrow(run, "h long, logp float")


def _by_model(langs: pa.Array) -> Iterator[tuple[str | None, np.ndarray]]:
    for lang in langs.unique().to_pylist():
        of = langs.is_null() if lang is None else pa.compute.fill_null(pa.compute.equal(langs, lang), False)
        yield lang, of.to_numpy(zero_copy_only=False)


def log_sums(lang: str | None, packed: np.ndarray, keys: np.ndarray, logs: np.ndarray, order: int) -> np.ndarray:
    """What the entries in ``keys`` (sorted) say of each n-gram: seen suffixes and contexts of all orders, added up.

    ``packed`` holds distinct n-grams; there are ever fewer suffixes and
    contexts, so each order looks up its own distinct ones.
    """
    if not len(keys) or not len(packed):
        return np.zeros(len(packed))

    def found(tag: int, part: np.ndarray) -> np.ndarray:
        key = _key(lang, tag, part).view(np.int64)
        sort = np.argsort(key)
        key = key[sort]
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        out = np.empty(len(key))
        out[sort] = np.where(keys[at] == key, logs[at], 0.0)
        return out

    contexts, place = np.unique(packed >> np.uint64(BITS), return_inverse=True)
    out = found(order, packed) + found(-order, contexts)[place]
    if order > 1:
        lower, place = np.unique(packed & np.uint64((1 << (BITS * (order - 1))) - 1), return_inverse=True)
        out += log_sums(lang, lower, keys, logs, order - 1)[place]
    return out


def base_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    starts, ends, rows = words(data, offsets)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    chars = row_sums(points[ends] - points[starts], rows)
    signs = row_sums(_SIGN[data], offsets)
    prefix = prefix_hash(data)
    of = row_of(rows)
    # lines with a word, equal to an earlier one of the text
    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate((offsets[:-1], breaks + 1)))
    line_start = line_start[line_start < len(data)]
    line_of = np.searchsorted(offsets, line_start, "right") - 1
    line_end = np.minimum(np.append(line_start[1:], len(data)), offsets[line_of + 1])
    line_end = line_end - ((line_end > line_start) & (data[np.maximum(line_end, 1) - 1] == 10))
    has_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    key, line_of = span_hash(prefix, line_start[has_word], line_end[has_word]), line_of[has_word]
    dup = np.bincount(line_of[_later(line_of, key)], minlength=len(offsets) - 1)
    # words in windows that occur twice or more in their text
    token = span_hash(prefix, starts, ends)
    repeat = np.zeros(len(offsets) - 1, np.int64)
    n = len(token) - WINDOW_WORDS + 1
    if n > 0:
        window = np.zeros(n, np.uint64)
        for k in range(WINDOW_WORDS):
            window = mix(window + token[k:k + n])
        first = np.flatnonzero(of[:n] == of[WINDOW_WORDS - 1:])
        twice = first[_shared(of[first], window[first])]
        cover = np.zeros(len(token) + 1, np.int64)
        np.add.at(cover, twice, 1)
        np.add.at(cover, twice + WINDOW_WORDS, -1)
        repeat = np.bincount(of[np.cumsum(cover)[:-1] > 0], minlength=len(offsets) - 1)
    return np.column_stack((np.diff(rows), chars, signs, dup, repeat))


def _runs(of: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): a sort by text and key that keeps positions in turn, and where a value begins."""
    order = np.lexsort((key, of))
    new = np.ones(len(order), bool)
    new[1:] = (of[order][1:] != of[order][:-1]) | (key[order][1:] != key[order][:-1])
    return order, new


def _later(of: np.ndarray, key: np.ndarray) -> np.ndarray:
    order, new = _runs(of, key)
    return order[~new]


def _shared(of: np.ndarray, key: np.ndarray) -> np.ndarray:
    order, new = _runs(of, key)
    last = np.append(new[1:], True)[:len(new)]
    return order[~(new & last)]


def _scored(docs: DataFrame, part: tuple | None, first: bool, order: int) -> DataFrame:
    """Each document's sum of logs over one slice of the model; the first pass adds the base counts."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, logs = table.value
        for batch in batches:
            langs = batch.column(2).to_pylist()
            data, offsets = column_bytes(batch.column(3))
            total, count = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            base = []
            for i, j in slices(offsets, CHUNK):
                if first:
                    base.append(base_counts(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
                texts = batch.column(3).slice(i, j - i).to_pylist()
                by: dict[str | None, list[int]] = {}
                for k, text in enumerate(texts):
                    if text:
                        by.setdefault(langs[i + k], []).append(k)
                for lang, some in by.items():
                    packed, off = grams([texts[k] for k in some], order)
                    kinds, at = np.unique(packed, return_inverse=True)
                    running = np.concatenate(([0.0], np.cumsum(log_sums(lang, kinds, keys, logs, order)[at])))
                    total[np.array(some) + i] = running[off[1:]] - running[off[:-1]]
                    count[np.array(some) + i] = np.diff(off)
            columns = [batch.column(0), batch.column(1), pa.array(total)]
            if first:
                columns += [batch.column(2), pa.array(count), *map(pa.array, np.concatenate(base or [np.zeros((0, 5), np.int64)]).T.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, row_key long, logp double"
    if first:
        schema += ", lang string, n_chars_scored long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    names = [c.split()[0] for c in schema.split(", ")]
    return docs.mapInArrow(run, schema)


def measured(docs: DataFrame, arrays: DataFrame, slice_entries: int, order: int = ORDER) -> DataFrame:
    """Base counts and summed entries (``logp``) of each document, one pass per slice of the model."""
    total = arrays.count()
    n_slices = max(1, -(-total * 5 // (slice_entries * 4)))  # a quarter of room: hash ranges are even, not equal
    width = (1 << 64) // n_slices + 1
    rows = more = None
    for s in range(n_slices):
        low, high = s * width - (1 << 63), min((s + 1) * width, 1 << 64) - (1 << 63) - 1
        part = arrays.where(F.col("h").between(low, high)).toArrow()  # about slice_entries rows at most
        h, logs = part.column("h").to_numpy(), part.column("logp").to_numpy()
        rank = np.argsort(h)
        scored = _scored(docs, (h[rank], logs[rank]), s == 0, order)
        if s == 0:
            rows = scored
        else:
            scored = scored.dropDuplicates(["doc_id", "row_key"]).select("doc_id", "row_key", F.col("logp").alias("more"))
            more = scored if more is None else more.unionByName(scored)
    if more is not None:
        more = more.groupBy(F.col("doc_id").alias("more_id"), F.col("row_key").alias("more_key")).agg(F.sum("more").alias("more"))
        rows = rows.join(more, F.col("doc_id").eqNullSafe(F.col("more_id")) & (F.col("row_key") == F.col("more_key")), "left")
        rows = rows.withColumn("logp", F.col("logp") + F.coalesce("more", F.lit(0.0))).drop("more", "more_id", "more_key")
    return rows.drop("row_key")


def judge(docs: DataFrame, band: float = 6.0, margin: float = 0.25, short_margin: float = 4.0, slice_entries: int = 4_000_000, order: int = ORDER,
          text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang") -> DataFrame:
    """One row per document: base counts, ``base_failed``, ``log_perplexity``, its language's band, ``kept``."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(*[F.col(f"`{c}`") for c in (id_col, lang_col, text_col)]).alias("row_key"),
                       F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # a text is counted for the other half's model and scored by its own half's: names of models stand in for languages
    half = F.pmod(F.xxhash64("text"), F.lit(2))
    name = (lambda k: F.concat(F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")), F.lit("#"), k.cast("string")))
    counts = materialize(counted(rows.select(name(1 - half).alias("lang"), "text"), order), "perplexity")
    grams, contexts = kneser_ney(counts, order)
    arrays = materialize(hash_arrays(grams, contexts), "perplexity", sort_by=["h"])
    scored = measured(rows.withColumn("lang", name(half)), arrays, slice_entries, order).withColumnRenamed("lang", "model")
    models = contexts.where("n = 1").select(F.col("lang").alias("model"), "kinds")  # one row per language and half
    # every symbol's sum ends in an even share of the symbols seen
    value = F.try_divide(F.col("n_chars_scored") * F.log(F.col("kinds").cast("double")) - F.col("logp"), F.col("n_chars_scored"))
    lang = F.expr("if(startswith(model, '='), substr(model, 2, char_length(model) - 3), null)")
    rows = materialize(scored.join(models, "model", "left").withColumns({"lang": lang, "log_perplexity": value}).drop("logp", "model", "kinds"), "perplexity")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    q = F.percentile_approx("log_perplexity", [0.25, 0.5, 0.75], 10_000)
    bands = rows.where(~failed).groupBy(F.col("lang").alias("of")).agg(q.alias("q"))
    bands = bands.select("of", (F.col("q")[1] - band * (F.col("q")[1] - F.col("q")[0]) - margin).alias("band_low"),
                         (F.col("q")[1] + band * (F.col("q")[2] - F.col("q")[1]) + margin).alias("band_high"))
    rows = rows.join(F.broadcast(bands), F.col("lang").eqNullSafe(F.col("of")), "left").drop("of")  # one row per language
    wider = F.coalesce(F.try_divide(F.lit(short_margin), F.sqrt(F.col("n_chars_scored"))), F.lit(0.0))
    rows = rows.withColumns({"band_low": F.col("band_low") - wider, "band_high": F.col("band_high") + wider})
    inside = F.coalesce(F.col("log_perplexity").between(F.col("band_low"), F.col("band_high")), F.lit(True))
    return rows.withColumn("kept", ~F.col("base_failed") & inside)
