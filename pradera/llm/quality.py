"""Compression quality classifier: zstandard dictionaries of good and bad texts, sizes turned into a score.

Two dictionaries are trained from a bounded sample of labelled texts, one per class.  A text is compressed whole with
each; the class whose dictionary shortens it more is likelier.  The normalised size difference
(good - bad) / max(good, bad), with both sizes relative to the text's, is calibrated by a logistic fit on sample
rows that the dictionaries did not see, both classes weighing the same.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pradera.session import ship_package

SAMPLE_ROWS = 2000       # labelled rows per class, at most, that the fit may use
SAMPLE_CHARS = 32_768    # longer texts are left out of the fit (never out of the scoring)
DICT_BYTES = 65_536
LEVEL = 3
PIECE = 4096             # dictionary training samples, in bytes
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    mean: tuple
    scale: tuple
    weights: tuple       # intercept first


@lru_cache(maxsize=8)
def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    # a frame of its own for each text: no checksum, no size and no dictionary id in the counted bytes
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(content),
                                    write_checksum=False, write_content_size=False, write_dict_id=False)


def features(texts, good: bytes, bad: bytes) -> np.ndarray:
    """Per text: normalised size difference, and each size relative to the text's bytes."""
    cg, cb = _compressor(good), _compressor(bad)
    out = np.empty((len(texts), 3))
    for i, t in enumerate(texts):
        raw = t.encode("utf-8", "replace") if t else b""
        g, b = len(cg.compress(raw)), len(cb.compress(raw))
        out[i] = (g - b) / max(g, b), g / (len(raw) + 1), b / (len(raw) + 1)
    return out


def _dictionary(texts: list[str]) -> bytes:
    raw = [t.encode("utf-8", "replace") for t in texts]
    pieces = [r[i:i + PIECE] for r in raw for i in range(0, len(r), PIECE)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:  # too few texts to train on: their end is the dictionary
        return b"".join(raw)[-DICT_BYTES:]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 60):
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / scale]
    w = np.zeros(z.shape[1])
    for _ in range(rounds):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = z.T @ (z * (p * (1 - p) + 1e-9)[:, None]) + ridge * len(y) * np.eye(len(w))
        w -= np.linalg.solve(h, z.T @ (p - y) + ridge * len(y) * w)
    return mean, scale, w


def fit_rows(good: list[str], bad: list[str]) -> Model | None:
    """Model from texts of both classes (each list in a reproducible order); None if a class has no text."""
    if not good or not bad:
        return None
    half = lambda x: (x[0::2], x[1::2] or x)
    (dg, hg), (db, hb) = half(good), half(bad)
    g, b = _dictionary(dg), _dictionary(db)
    x = features(hg + hb, g, b)
    y = np.r_[np.ones(len(hg)), np.zeros(len(hb))]
    mean, scale, w = _logistic(x, y)
    w[0] -= np.log(len(hg) / len(hb))
    return Model(g, b, tuple(mean), tuple(scale), tuple(w))


def score_texts(texts, m: Model | None) -> np.ndarray:
    if m is None:
        return np.full(len(texts), 0.5)
    x = (features(texts, m.good, m.bad) - np.array(m.mean)) / np.array(m.scale)
    z = np.clip(m.weights[0] + x @ np.array(m.weights[1:]), -30, 30)
    return 1 / (1 + np.exp(-z))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text divides by 5 (null ids as well)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Learn from at most SAMPLE_ROWS labelled documents per class.

    Labels with a null id, a quality other than 0 or 1, or contradicting rows for one id are not used.  The sample is
    the smallest hashes of the ids, so reruns agree; texts reach the driver only for those ids.
    """
    clean = (labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
             .groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("q2")).where("q = q2"))
    counts = {r["q"]: r["n"] for r in clean.groupBy("q").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    ids = None
    for q in (0, 1):
        part = (clean.where(F.col("q") == q).select("doc_id", "q", F.xxhash64("doc_id").alias("_h"))
                .orderBy("_h", "doc_id").limit(SAMPLE_ROWS))
        ids = part if ids is None else ids.union(part)
    rows = (docs.select("doc_id", "text").where(F.length("text").between(1, SAMPLE_CHARS))
            .join(F.broadcast(ids), "doc_id")  # 2 * SAMPLE_ROWS rows at most
            .groupBy("doc_id", "q", "_h").agg(F.min("text").alias("text"))
            .collect())
    rows.sort(key=lambda r: (r["_h"], r["doc_id"]))
    return fit_rows([r["text"] for r in rows if r["q"] == 1], [r["text"] for r in rows if r["q"] == 0])


def score(text: Column, model: Model | None) -> Column:
    """Score of whole texts, 0 to 1 (higher: good likelier).  Null and empty texts get the score of an empty text;
    without labelled rows of both classes every score is 0.5."""
    ship_package(SparkSession.active())

    @F.pandas_udf("double")
    def quality_score(s: pd.Series) -> pd.Series:
        return pd.Series(score_texts(s.tolist(), model))
    return quality_score(text)


def classify(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``: one row per row of ``docs`` (ids may repeat or be null)."""
    s = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score"))
    return s.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that the classifier accepts, with their columns as they are."""
    return docs.where(score(docs["text"], model) >= threshold)
