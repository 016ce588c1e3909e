"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

The lexicon (words and word beginnings with their log-odds), the trees and the calibration are learned from a bounded
sample of the training rows, weighted by the counted totals of the classes; two folds keep the features and scores that the next
step learns from apart from the labels behind them. Features: lexicon densities
(as written and after undoing look-alike characters), the nearness of second-person words to lexicon words,
and the rates of capitals, punctuation and obfuscated words. Trees and calibration are Spark ML's.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .fitting import id_remainder, labelled
from .tokenize import forget_encoders
from .util import list_array, materialize, row_slices, string_buffer

#: Training documents per class; entries of a lexicon; training documents that an entry must be in.
SAMPLE, LEXICON, SUPPORT = 5000, 4000, 3
PREFIX = 4
SECOND_PERSON = ("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre vos "
                 "tú usted ustedes ti tus vosotros").split()
#: Look-alike characters and the letters they stand for.
LOOK_ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}
FEATURES = ("length", "lexicon", "lexicon_count", "strongest", "beginnings", "beginning_count", "second_person", "nearness",
            "capitals", "capital_words", "punctuation", "exclamations", "obfuscated", "disguised", "repeated")

_UNMASK = K.LOWER.copy()
for _a, _b in LOOK_ALIKE.items():
    _UNMASK[ord(_a)] = ord(_b)
_MASKED = K.SPACE.copy()
_MASKED[[ord(c) for c in ".,;:?()[]{}\"'"]] = True  # characters that end a word even in a disguised text
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = _LETTER[0xC3:] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[33:48] = _PUNCT[58:65] = _PUNCT[91:97] = _PUNCT[123:127] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LOOK_ALIKE]] = _SIGN[ord("*")] = True


def _hash_of(words: list[str]) -> np.ndarray:
    out = []
    for w in words:
        raw = np.frombuffer(w.encode(), np.uint8)
        out.append(K.span_hashes(raw, np.array([0]), np.array([len(raw)]))[0])
    return np.sort(np.array(out, np.uint64))


_YOU = _hash_of(SECOND_PERSON)


@dataclass(frozen=True)
class Lexicon:
    """Sorted hashes and log-odds of words and of word beginnings."""
    words: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    odds: np.ndarray = field(default_factory=lambda: np.empty(0))
    prefixes: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    prefix_odds: np.ndarray = field(default_factory=lambda: np.empty(0))


def _is_in(h: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(known) or not len(h):
        return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return known[at] == h, at


def _word_parts(low: np.ndarray, offs: np.ndarray, delim: np.ndarray):
    starts, ends, counts = K.word_bounds(low, offs, delim)
    long = ends - starts > PREFIX
    return starts, ends, counts, K.span_hashes(low, starts, ends), long, K.span_hashes(low, starts, np.minimum(starts + PREFIX, ends))


def _sum_rows(flags: np.ndarray, row_of: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row_of, weights=flags, minlength=n)


def features(buf: np.ndarray, offs: np.ndarray, lex: Lexicon) -> np.ndarray:
    """One row of FEATURES per text (UTF-8 bytes and row offsets)."""
    n = len(offs) - 1
    low = K.LOWER[buf]
    starts, ends, counts, h, long, ph = _word_parts(low, offs, K.NOT_ALNUM)
    row = np.repeat(np.arange(n), counts)
    words = np.maximum(counts, 1)
    chars = np.maximum(np.diff(offs), 1)
    byte_sum = lambda flags: np.diff(np.append(0, np.cumsum(flags))[offs])
    hit, at = _is_in(h, lex.words)
    phit, _ = _is_in(ph, lex.prefixes)
    phit &= long
    strongest = np.zeros(n)
    if hit.any():
        np.maximum.at(strongest, row[hit], lex.odds[at[hit]])
    bad, you = hit | phit, _is_in(h, _YOU)[0]
    nearness = np.zeros(n)
    a, b = np.flatnonzero(you), np.flatnonzero(bad)
    if len(a) and len(b):
        for side in (np.searchsorted(b, a) - 1, np.searchsorted(b, a)):
            k = np.clip(side, 0, len(b) - 1)
            same = row[b[k]] == row[a]
            np.maximum.at(nearness, row[a[same]], 1.0 / (1 + np.abs(b[k] - a)[same]))
    caps = np.diff(np.append(0, np.cumsum(_UPPER[buf]))[np.c_[starts, ends]], axis=1).ravel() if len(starts) else np.empty(0)
    plain = _UNMASK[buf]
    ms, me, mc, mh, mlong, mph = _word_parts(plain, offs, _MASKED)
    mrow = np.repeat(np.arange(n), mc)
    span = lambda flags: np.diff(np.append(0, np.cumsum(flags))[np.c_[ms, me]], axis=1).ravel() if len(ms) else np.empty(0)
    letters, signs = span(_LETTER[buf]), span(_SIGN[buf])
    inner = (letters > 1) & (signs > 0) & (_LETTER[buf[np.maximum(me - 1, 0)]] if len(ms) else np.empty(0, bool))
    unmasked = _is_in(mh, lex.words)[0] | (_is_in(mph, lex.prefixes)[0] & mlong)
    triple = np.zeros(len(buf), bool)
    if len(buf) > 2:
        triple[2:] = (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & _LETTER[buf[2:]]
    cols = {
        "length": np.log1p(counts), "lexicon": _sum_rows(hit, row, n) / words, "lexicon_count": np.log1p(_sum_rows(hit, row, n)), "strongest": strongest,
        "beginnings": _sum_rows(phit, row, n) / words, "beginning_count": np.log1p(_sum_rows(phit, row, n)),
        "second_person": _sum_rows(you, row, n) / words, "nearness": nearness,
        "capitals": byte_sum(_UPPER[buf]) / chars, "capital_words": _sum_rows((caps > 1) & (caps == ends - starts), row, n) / words,
        "punctuation": byte_sum(_PUNCT[buf]) / chars, "exclamations": byte_sum(buf == 33) / chars,
        "obfuscated": _sum_rows(inner, mrow, n) / words, "disguised": np.log1p(_sum_rows(inner & unmasked, mrow, n)), "repeated": byte_sum(triple) / chars,
    }
    return np.column_stack([cols[c] for c in FEATURES])


def _with_features(df: DataFrame, text: str, lex: Lexicon, out: str) -> DataFrame:
    """``df`` with the features of its string column ``text`` as an array column ``out``."""
    def run(it):
        forget_encoders()
        for batch in it:
            buf, offs = string_buffer(batch.column(text))
            for i, j in row_slices(offs):
                x = features(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], lex)
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, list_array(x.ravel(), np.full(len(x), len(FEATURES)), pa.float64())], [*batch.schema.names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))]))


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """From (text, y): entries in at least SUPPORT toxic texts whose log-odds of toxic are 2 or more."""
    def run(it):
        forget_encoders()
        for batch in it:
            buf, offs = string_buffer(batch.column("text"))
            y = batch.column("y").to_numpy()
            for i, j in row_slices(offs):
                _, _, counts, h, long, ph = _word_parts(K.LOWER[buf[offs[i]:offs[j]]], offs[i:j + 1] - offs[i], K.NOT_ALNUM)
                row = np.repeat(np.arange(i, j), counts)
                for kind, key, of in ((0, h, row), (1, ph[long], row[long])):
                    order = np.lexsort((key, of))
                    key, of = key[order], of[order]
                    first = np.ones(len(key), bool)
                    first[1:] = (key[1:] != key[:-1]) | (of[1:] != of[:-1])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(int(first.sum()), kind, np.int32)), pa.array(key[first].view(np.int64)), pa.array(y[of[first]])], ["kind", "h", "y"])

    totals = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    counts = (sample.select("text", "y").mapInArrow(run, "kind int, h long, y int").groupBy("kind", "h")
              .agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n")).filter(F.col("p") >= SUPPORT)
              .withColumn("odds", F.log((F.col("p") + 0.5) / (n1 + 1)) - F.log((F.col("n") + 0.5) / (n0 + 1))).filter("odds >= 2"))
    out = []
    for kind in (0, 1):
        rows = counts.filter(F.col("kind") == kind).orderBy(F.desc(F.col("odds") * F.col("p")), "h").limit(LEXICON).collect()
        h = np.array([r["h"] for r in rows], np.int64).view(np.uint64)
        order = np.argsort(h)
        out += [h[order], np.array([r["odds"] for r in rows], float)[order]]
    return Lexicon(*out)


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    rate: float

    def transform(self, df: DataFrame, text: str, out: str) -> DataFrame:
        """``df`` with the score of its string column ``text`` (null: empty) as ``out``."""
        if self.trees is None:
            return df.withColumn(out, F.lit(self.rate))
        df = _with_features(df, text, self.lexicon, "_tox_f").withColumn("_tox_x", array_to_vector("_tox_f"))
        df = self.trees.transform(df).withColumn("_tox_p", vector_to_array("_tox_y")[1])
        if self.calibration is not None:
            df = self.calibration.transform(df.withColumn("_tox_c", F.lit(0.0)))
        score = F.col("_tox_s") if self.calibration is not None else F.col("_tox_p")
        return df.withColumn(out, F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))).drop("_tox_f", "_tox_x", "_tox_r", "_tox_y", "_tox_k", "_tox_p", "_tox_c", "_tox_s")


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "toxic", per_class: int = SAMPLE) -> ToxicityModel:
    """Fit on labelled rows whose doc_id meets ``allowed``; with fewer than two rows of a class, the score is the class's share.

    The sample is dealt into two folds, each with half of either class. A fold's features use the lexicon of the other one,
    and its rows are scored for the calibration by trees fitted on the other one: nothing is calibrated on rows that it
    was fitted on, whatever the size. The final lexicon and trees see both folds. Rows weigh what they stand for.
    """
    sample = labelled(docs, labels, label, allowed, per_class, 29)
    fold = F.row_number().over(Window.partitionBy("y").orderBy("part", "doc_id", F.xxhash64("text"))) % 2
    sample = materialize(sample.withColumn("fold", fold.cast("int")), "toxicity-sample")
    counts = {r["y"]: r for r in sample.groupBy("y").agg(F.count("*").alias("n"), F.sum("w").alias("w")).collect()}
    if any(y not in counts or counts[y]["n"] < 2 for y in (0, 1)):
        total = sum(r["w"] for r in counts.values())
        return ToxicityModel(Lexicon(), None, None, counts[1]["w"] / total if 1 in counts else 0.0)
    other = [learn_lexicon(sample.filter(F.col("fold") == 1 - k)) for k in (0, 1)]
    rows = None
    for k in (0, 1):
        part = sample.filter(F.col("fold") == k).select("text", "fold", "w", F.col("y").cast("double").alias("y"))
        part = _with_features(part, "text", other[k], "f").drop("text")
        rows = part if rows is None else rows.unionByName(part)
    rows = materialize(rows.coalesce(4).withColumn("_tox_x", array_to_vector("f")).drop("f"), "toxicity-rows")

    def trees(df: DataFrame) -> GBTClassificationModel:
        g = GBTClassifier(featuresCol="_tox_x", labelCol="y", predictionCol="_tox_k", weightCol="w", maxIter=20, maxDepth=4, maxBins=32, stepSize=0.2, seed=7, checkpointInterval=-1)
        return g.setProbabilityCol("_tox_y").setRawPredictionCol("_tox_r").fit(df)

    held = None
    for k in (0, 1):
        part = trees(rows.filter(F.col("fold") != k)).transform(rows.filter(F.col("fold") == k)).select("y", "w", vector_to_array("_tox_y")[1].alias("_tox_p"))
        held = part if held is None else held.unionByName(part)
    calibration = IsotonicRegression(featuresCol="_tox_p", labelCol="y", weightCol="w", predictionCol="_tox_s").fit(held)
    return ToxicityModel(learn_lexicon(sample), trees(rows), calibration, 0.0)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row: rows with crc32(doc_id) mod 5 = 0 are held out of the fit.

    Null and empty texts are scored as texts without words; repeated rows each get a row; texts of any length are read
    whole, in slices of their own; an empty table gives no rows. Other columns are not read.
    """
    model = fit(docs, labels, id_remainder(F.col("doc_id"), 5) != 0)
    out = model.transform(docs.select("doc_id", "text"), "text", "score")
    return out.select("doc_id", (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
