"""Quality score by compression: zstandard dictionaries built from good and from bad labelled text.

A text is compressed with each dictionary. The difference of the two sizes, normalised by their sum, says
which kind of text it is closer to; a logistic calibration over it, the size per byte and the length turns
it into a probability of label 1. Dictionaries and calibration are fitted on two parts of a bounded sample
of the training rows (``SAMPLE`` per class).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fitting import id_remainder, labelled, logistic, sigmoid
from .util import materialize, string_buffer

#: Training documents per class; pieces of them per class for a dictionary, and a piece's bytes.
SAMPLE, PIECES, PIECE_BYTES = 6000, 6000, 1024
DICT_BYTES, LEVEL = 112_640, 3


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray


def _features(sizes: np.ndarray) -> np.ndarray:
    """From (bytes, size with the good dictionary, size with the bad one)."""
    n, good, bad = sizes.T.astype(float)
    diff = (bad - good) / np.maximum(bad + good, 1)
    ratio, length = np.log((good + 8) / (n + 8)), np.log(n + 1) / 10
    return np.c_[diff, ratio, length, diff * diff, ratio * ratio, diff * ratio, diff * length, ratio * length]


class _Sizes:
    def __init__(self, good: bytes, bad: bytes):
        self.packers = []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw) if raw else None
            if d is not None:
                d.precompute_compress(level=LEVEL)
            self.packers.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False))

    def __call__(self, texts: pa.Array) -> np.ndarray:
        buf, offs = string_buffer(texts)
        view = memoryview(np.ascontiguousarray(buf))
        out = np.empty((len(offs) - 1, 3), np.int64)
        out[:, 0] = np.diff(offs)
        for k, p in enumerate(self.packers):
            out[:, k + 1] = [len(p.compress(view[a:b])) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
        return out


def _dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary; the pieces themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICT_BYTES:]


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "quality", per_class: int = SAMPLE) -> QualityModel:
    """Fit on labelled rows whose doc_id meets ``allowed``. Without a class's texts its dictionary is empty.

    The calibration weights the sample's rows by the counted totals of the classes, so that 0.5 means the same at any size.
    """
    sample = materialize(labelled(docs, labels, label, allowed, per_class, 11), "quality-sample")

    def cut(it):
        for batch in it:
            buf, offs = string_buffer(batch.column("text"))
            raw, ys, got = buf.tobytes(), batch.column("y").to_numpy(), ([], [])
            for y, a, b in zip(ys.tolist(), offs[:-1].tolist(), offs[1:].tolist()):
                for at in range(a, b, PIECE_BYTES):
                    got[0].append(y)
                    got[1].append(raw[at:min(at + PIECE_BYTES, b)])
            yield pa.RecordBatch.from_arrays([pa.array(got[0], pa.int32()), pa.array(got[1], pa.binary())], ["y", "piece"])

    pieces = sample.filter("part < 600").select("y", "text").mapInArrow(cut, "y int, piece binary")
    order = F.xxhash64("piece")
    trained = []
    for y in (1, 0):
        rows = pieces.filter(F.col("y") == y).select("piece").orderBy(order, "piece").limit(PIECES).collect()
        trained.append(_dictionary([bytes(r["piece"]) for r in rows]))
    good, bad = trained

    def measure(it):
        sizes = _Sizes(good, bad)
        for batch in it:
            s = sizes(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("w"), *(pa.array(s[:, k]) for k in range(3))], ["y", "w", "n", "good", "bad"])

    rows = sample.filter("part >= 600").select("y", "w", "text").mapInArrow(measure, "y int, w double, n long, good long, bad long").collect()
    rows.sort()
    x, y, w = _features(np.array([r[2:] for r in rows], float).reshape(-1, 3)), np.array([r[0] for r in rows], float), np.array([r[1] for r in rows], float)
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-9) if len(x) else (np.zeros(8), np.ones(8))
    weights = logistic(np.c_[np.ones(len(x)), (x - mean) / scale], y, w) if len(x) else np.zeros(9)
    return QualityModel(good, bad, mean, scale, weights)


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) of every row; a null text is scored as an empty one. Other columns are not read."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(it):
        sizes = _Sizes(model.good, model.bad)
        for batch in it:
            x = (_features(sizes(batch.column("text"))) - model.mean) / model.scale
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sigmoid(np.c_[np.ones(len(x)), x] @ model.weights))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted): rows with crc32(doc_id) mod 3 = 1 are held out of the fit.

    Null and empty texts are scored as empty ones; a null id counts as the empty text in the fold; repeated rows each get a row;
    texts of any length are compressed whole; an empty table gives no rows. Other columns are not read.
    """
    model = fit(docs, labels, id_remainder(F.col("doc_id"), 3) != 1)
    return score(docs, model).select(
        "doc_id", (id_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
