"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text (``FEATURES``): densities of lexicon words as written and
with their obfuscation undone, second-person words and how often they stand
within ``NEAR`` words of a lexicon word, capitals, punctuation, elongated
letters, and words that mix letters with digits or signs.  The lexicon is
learnt: words whose share among toxic labelled documents is high against the
others.  Trees are fitted on four fifths of the labelled sample, the isotonic
curve on the last fifth, whose rows the lexicon has not seen.

Labels reach the model only from the rows of the given labelled frame, in a
bounded sample (``sample_rows``, by hash order of the id).

Defined results: a null text counts as empty; without both labels in the
sample every score is the share of label 1 (0 without labels); repeated
labels of an id count as their greatest; repeated rows are scored alike; an
empty table gives no rows; columns clashing with those added give way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tickweave.llm.textops import LOWER, column_bytes, prefix_hash, row_of, row_sums, slices, span_hash
from tickweave.session import materialize, ship_package

#: Second-person words, and the letters that signs and digits stand for.
SECOND_PERSON = ("you your yours yourself u ur du dich dir dein deine deiner euch euer "
                 "tu te toi ton ta tes vous votre vos ti tus usted ustedes").split()
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
FEATURES = ("lexicon_density", "plain_lexicon_density", "lexicon_weight", "lexicon_hits", "hidden_hits", "second_person_density",
            "second_person_near", "capitals", "shouted_words", "exclamations", "questions", "repeated_marks", "elongations",
            "obfuscated_words", "log_words")
NEAR = 3
CHUNK = 1 << 20

_UNDO = LOWER.copy()
for _sign, _letter in STANDS_FOR.items():
    _UNDO[ord(_sign)] = ord(_letter)
_bytes = np.arange(256)
_LETTER = ((_bytes >= 65) & (_bytes <= 90)) | ((_bytes >= 97) & (_bytes <= 122)) | (_bytes >= 128)
_UPPER = (_bytes >= 65) & (_bytes <= 90)
_SIGN = ((_bytes >= 48) & (_bytes <= 57)) | np.isin(_bytes, [ord(c) for c in "@$*"])
_TOKEN = _LETTER | _SIGN


def _count(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[ends] - total[starts]


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, token offsets per row) of runs of letters, digits and the signs @ $ *."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _TOKEN[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(words: list[str]) -> np.ndarray:
    """Hashes of whole lower-case words, as those of tokens."""
    out = np.zeros(len(words), np.uint64)
    for i, w in enumerate(words):
        raw = LOWER[np.frombuffer(w.encode(), np.uint8)]
        out[i] = span_hash(prefix_hash(raw), np.array([0]), np.array([len(raw)]))[0]
    return out


def _find(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Position of each key in the sorted table, or -1."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def features(data: np.ndarray, offsets: np.ndarray, lexicon: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text; ``lexicon`` holds sorted word hashes."""
    n = len(offsets) - 1
    starts, ends, rows = tokens(data, offsets)
    words = np.diff(rows)
    of = row_of(rows)
    plain = _find(span_hash(prefix_hash(LOWER[data]), starts, ends), lexicon)
    undone = _find(span_hash(prefix_hash(_UNDO[data]), starts, ends), lexicon)
    hit = np.where(plain >= 0, plain, undone)
    is_hit = hit >= 0
    second = _find(span_hash(prefix_hash(LOWER[data]), starts, ends), _second_person()) >= 0
    signs, letters = _count(_SIGN[data], starts, ends), _count(_LETTER[data], starts, ends)
    mixed = (signs > 0) & (letters > 0)
    shouted = (_count(_UPPER[data], starts, ends) == ends - starts) & (ends - starts >= 3)
    # a second-person word within NEAR tokens of a hit, in the same text
    near = np.zeros(len(starts), bool)
    spots = np.flatnonzero(is_hit)
    for step in range(-NEAR, NEAR + 1):
        there = spots + step
        ok = (there >= 0) & (there < len(starts))
        near[spots[ok]] |= second[there[ok]] & (of[there[ok]] == of[spots[ok]])
    size = np.diff(offsets)

    def per(count, base):
        return count / np.maximum(1, base)

    def sums(flags):
        return row_sums(flags, rows)

    def chars(flags):
        return row_sums(flags, offsets)

    same = np.zeros(len(data), bool)
    same[1:] = data[1:] == data[:-1]
    thrice = np.zeros(len(data), bool)
    thrice[2:] = same[2:] & same[1:-1] & _LETTER[data[2:]]
    mark = (data == ord("!")) | (data == ord("?"))
    weight = np.bincount(of[is_hit], weights=weights[hit[is_hit]], minlength=n)[:n]
    hits = sums(is_hit)
    return np.column_stack((
        100 * per(hits, words), 100 * per(sums(plain >= 0), words), 100 * per(weight, words), np.log1p(hits),
        sums(is_hit & (plain < 0)), 100 * per(sums(second), words), per(sums(near), hits),
        per(chars(_UPPER[data]), chars(_LETTER[data])), per(sums(shouted), words), 100 * per(chars(data == ord("!")), size),
        100 * per(chars(data == ord("?")), size), 100 * per(chars(mark & same), size), 100 * per(chars(thrice), size),
        100 * per(sums(mixed), words), np.log1p(words)))


_second: list[np.ndarray] = []


def _second_person() -> np.ndarray:
    if not _second:
        _second.append(np.sort(word_hashes(SECOND_PERSON)))
    return _second[0]


def _featured(docs: DataFrame, text_col: str, lexicon: np.ndarray, weights: np.ndarray) -> DataFrame:
    """All columns of ``docs`` and ``features``, an array of doubles."""
    ship_package(docs.sparkSession)
    place = docs.columns.index(text_col)
    # a few thousand words at most (``lexicon_size``), carried in the task's function

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(place))
            out = [features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], lexicon, weights) for i, j in slices(offsets, CHUNK)]
            flat = np.concatenate(out).ravel() if out else np.zeros(0)
            column = pa.FixedSizeListArray.from_arrays(pa.array(flat), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "features"])

    schema = StructType([*docs.schema.fields, StructField("features", ArrayType(DoubleType()))])
    return docs.mapInArrow(run, schema)


def learn_lexicon(sample: DataFrame, text_col: str, lexicon_size: int, least_support: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(sorted hashes, weights, words): words much more frequent among toxic texts, by smoothed log ratio of shares."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(0))
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for i, j in slices(offsets, CHUNK):
                part, off = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                starts, ends, rows = tokens(part, off)
                fit = (ends - starts >= 3) & (ends - starts <= 40)
                of = row_of(rows)[fit]
                starts, ends = starts[fit], ends[fit]
                low = LOWER[part]
                key = span_hash(prefix_hash(low), starts, ends)
                # each word once per text
                order = np.lexsort((of, key))
                new = np.ones(len(order), bool)
                new[1:] = (key[order][1:] != key[order][:-1]) | (of[order][1:] != of[order][:-1])
                order = order[new]
                word = np.ones(len(order), bool)
                word[1:] = key[order][1:] != key[order][:-1]
                at = np.flatnonzero(word)
                if not len(at):
                    continue
                flags = toxic[i:j][of[order]] > 0
                bad = np.add.reduceat(flags, at, dtype=np.int64)
                good = np.add.reduceat(~flags, at, dtype=np.int64)
                raw = low.tobytes()
                names = [raw[starts[k]:ends[k]].decode("utf-8", "ignore") for k in order[at].tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(bad), pa.array(good)], names=["word", "bad", "good"])

    counts = sample.select(text_col, "toxic").mapInArrow(run, "word string, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_bad, n_good = totals.get(1, 0), totals.get(0, 0)
    ratio = F.log((F.col("bad") + 0.5) / (n_bad + 1)) - F.log((F.col("good") + 0.5) / (n_good + 1))
    best = counts.where(F.col("bad") >= least_support).select("word", "bad", ratio.alias("weight")).where(F.col("weight") >= 2.0)
    best = best.orderBy(F.desc(F.col("weight") * F.log1p("bad")), "word").limit(lexicon_size).collect()  # bounded by lexicon_size
    words = [r["word"] for r in best]
    hashes, weights = word_hashes(words), np.array([r["weight"] for r in best], float)
    order = np.argsort(hashes)
    return hashes[order], weights[order], [words[i] for i in order]


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, lexicon_size: int = 2_000, least_support: int = 4,
          text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic") -> dict:
    """A model from the labelled documents: lexicon, trees and curve."""
    ship_package(docs.sparkSession)
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("label_id"))
    chosen = chosen.agg((F.max(label_col) > 0).cast("int").alias("toxic")).orderBy(F.xxhash64("label_id"), "label_id").limit(sample_rows)
    # two numbers for each of at most sample_rows ids
    rows = docs.select(F.col(f"`{id_col}`").alias("label_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    sample = materialize(rows.join(F.broadcast(chosen), "label_id"), "toxicity")
    curve_fold = F.pmod(F.xxhash64("label_id", F.lit("curve")), F.lit(5)) == 0
    counts = {r["toxic"]: r["count"] for r in sample.where(~curve_fold).groupBy("toxic").count().collect()}
    if len(counts) < 2:
        whole = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
        return {"share": whole.get(1, 0) / max(1, sum(whole.values()))}
    lexicon, weights, words = learn_lexicon(sample.where(~curve_fold), "text", lexicon_size, least_support)
    table = _featured(sample, "text", lexicon, weights).withColumns({"curve": curve_fold, "label": F.col("toxic").cast("double")})
    table = materialize(table.select("curve", "features", "label"), "toxicity").withColumn("vector", array_to_vector("features"))
    trees = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=20, maxDepth=4, stepSize=0.2, maxBins=64, seed=11)
    trees = trees.fit(table.where(~F.col("curve")))
    margins = trees.transform(table.where(F.col("curve"))).select("label", vector_to_array("rawPrediction")[1].alias("margin"))
    # trees leave few different margins, and one may hold most rows: equal ones are one weighted point
    margins = margins.groupBy("margin").agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("rows"), F.count_distinct("label").alias("kinds"))
    share = counts.get(1, 0) / sum(counts.values())
    spread = margins.agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max("kinds").alias("kinds")).first()
    both = spread["kinds"] is not None and (spread["kinds"] == 2 or spread["low"] != spread["high"])
    curve = IsotonicRegression(featuresCol="margin", labelCol="label", weightCol="rows").fit(margins) if both else None
    return {"share": share, "lexicon": lexicon, "weights": weights, "words": words, "trees": trees, "curve": curve}


def score(docs: DataFrame, model: dict, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The documents with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on)."""
    added = {"score", "predicted", "features", "vector", "rawprediction", "probability", "prediction", "margin", "calibrated"}
    own = [c for c in docs.columns if c.lower() not in added or c == text_col]
    docs = docs.select(*[F.col(f"`{c}`") for c in own])
    if "trees" not in model:
        scored = docs.withColumn("score", F.lit(float(model["share"])))
    else:
        rows = _featured(docs, text_col, model["lexicon"], model["weights"]).withColumn("vector", array_to_vector("features"))
        rows = model["trees"].transform(rows)
        if model["curve"] is not None:
            rows = model["curve"].setPredictionCol("calibrated").transform(rows.withColumn("margin", vector_to_array("rawPrediction")[1]))
            value = F.col("calibrated")
        else:
            value = vector_to_array("probability")[1]
        scored = rows.withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), value)))
    return scored.select(*[F.col(f"`{c}`") for c in own], "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
