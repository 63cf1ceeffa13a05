"""Language identification: presence kernels of blended n-grams, Nystroem landmarks, one-versus-rest kernel ridge.

A text is the set of its lower-cased character n-grams, n = 1 to 3 (the blended spectrum), hashed to 2 ** BIN_BITS bins.  The
kernel of two texts is the number of shared n-grams over the root of the product of their numbers of n-grams.  Only
n-grams of the landmarks can be shared with one, so those are the columns of a batch's presence matrix; kernels of a
batch with all landmarks, and the scores, are two matrix products.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pradera.session import ship_package

LANDMARKS = 40           # per language
SAMPLE_ROWS = 240        # labelled rows per language, at most, that the fit may use
SAMPLE_CHARS = 20_000    # longer texts are left out of the fit (never out of the prediction)
BIN_BITS = 19
BINS = 1 << BIN_BITS
ORDERS = (1, 2, 3)
RIDGE = 1e-3
SHARPNESS = 6.0          # softmax of the ridge outputs
BATCH = 128              # texts per matrix product
CHUNK = 1 << 20          # characters hashed at a time
UNDETERMINED = "und"
_STEP, _SPREAD = np.uint32(0x01000193), np.uint32(0x9E3779B1)


def has_letter(text: str) -> bool:
    """Numbers, also those that aren't digits (as in fractions), are no letters."""
    return any(map(str.isalpha, text))


def ngram_bins(text: str):
    """Arrays of n-gram bins of a whole text, a chunk and an order at a time (chunks overlap, so none is lost)."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    for at in range(0, len(c), CHUNK):
        part = c[at:at + CHUNK + max(ORDERS) - 1]
        h = np.zeros(len(part), dtype=np.uint32)
        for n in range(1, max(ORDERS) + 1):  # h: hash of the n characters that start here
            if len(part) < n:
                break
            h = h[:len(part) - n + 1] * _STEP + part[n - 1:]
            if n in ORDERS:
                yield ((h ^ (h >> np.uint32(15))) * _SPREAD) >> np.uint32(32 - BIN_BITS)


@dataclass
class Model:
    languages: list
    column: np.ndarray    # bin -> column of the presence matrix; bins of no landmark: the last
    landmarks: np.ndarray  # columns x landmarks, scaled by 1 / sqrt(n-grams of the landmark)
    weights: np.ndarray   # landmarks x languages
    bias: np.ndarray


def _presence(texts: list[str], column: np.ndarray, width: int) -> np.ndarray:
    p = np.zeros((len(texts), width + 1), dtype=np.uint8)  # the last column takes n-grams of no landmark
    for row, t in zip(p, texts, strict=True):
        for bins in ngram_bins(t):
            row[column[bins]] = 1
    return p[:, :-1].astype(np.float32)


def _kernel(texts: list[str], column: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    p = _presence(texts, column, landmarks.shape[0])
    return (p @ landmarks) / np.sqrt(np.maximum(p.sum(1), 1.0))[:, None]


def fit_rows(rows: list[tuple[str, str]]) -> Model | None:
    """rows: (text, language) in a reproducible order; None without rows."""
    by: dict[str, list[str]] = {}
    for t, lang in rows:
        by.setdefault(lang, []).append(t)
    if not by:
        return None
    languages = sorted(by)
    marks = [t for x in languages for t in by[x][:LANDMARKS]]
    sets = [np.unique(np.concatenate([*ngram_bins(t), np.zeros(0, np.uint32)])) for t in marks]
    vocab = np.unique(np.concatenate(sets))
    column = np.full(BINS, len(vocab), dtype=np.int32)
    column[vocab] = np.arange(len(vocab), dtype=np.int32)
    land = np.zeros((len(vocab), len(marks)), dtype=np.float32)
    for j, s in enumerate(sets):
        land[column[s], j] = 1.0 / np.sqrt(max(len(s), 1))
    texts = [t for x in languages for t in by[x]]
    k = np.concatenate([_kernel(texts[i:i + BATCH], column, land) for i in range(0, len(texts), BATCH)]).astype(float)
    kmm = _kernel(marks, column, land).astype(float)
    kmm = (kmm + kmm.T) / 2
    val, vec = np.linalg.eigh(kmm)
    root = vec[:, val > 1e-6] / np.sqrt(val[val > 1e-6])  # Nystroem features: k @ root
    phi = k @ root
    y = np.array([[1.0 if x == lang else -1.0 for lang in languages] for x in languages for _ in by[x]])
    size = np.array([len(by[x]) for x in languages for _ in by[x]], dtype=float)
    share = (len(texts) / len(languages) / size)[:, None]  # every language weighs the same
    mean = y.mean(0)
    w = np.linalg.solve(phi.T @ (phi * share) + RIDGE * len(texts) * np.eye(phi.shape[1]),
                        phi.T @ ((y - mean) * share))
    return Model(languages, column, land, (root @ w).astype(np.float32), mean.astype(np.float32))


def predict_texts(texts, m: Model | None) -> tuple[list[str], np.ndarray]:
    lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    todo = [i for i, t in enumerate(texts) if m is not None and t and has_letter(t)]
    for at in range(0, len(todo), BATCH):
        part = todo[at:at + BATCH]
        f = _kernel([texts[i] for i in part], m.column, m.landmarks) @ m.weights + m.bias
        e = np.exp(SHARPNESS * (f - f.max(1, keepdims=True)))
        best = f.argmax(1)
        prob = e[np.arange(len(part)), best] / e.sum(1)
        for i, b, p in zip(part, best, prob, strict=True):
            lang[i], score[i] = m.languages[b], float(min(p, 1.0))
    return lang, score


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text is 2 modulo 4 (null ids as well)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def fit(docs: DataFrame) -> Model | None:
    """Learn from at most SAMPLE_ROWS labelled documents per language.

    The counts per language are read without the texts; each language's share of ids is then taken by a hash of the
    id, so reruns agree and no language's rows are gathered in one task.  ``lang`` has few values.
    """
    base = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in base.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    u = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("lang")), 12) / F.lit(float(1 << 52))
    take = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, 2.0 * SAMPLE_ROWS / n))])
    rows = (base.where(u < take[F.col("lang")]).where(F.length("text").between(1, SAMPLE_CHARS))
            .groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select(u.alias("u"), "doc_id", "lang", "text")
            .collect())
    rows.sort(key=lambda r: (r["u"], r["doc_id"], r["lang"]))
    out, seen = [], {}
    for r in rows:
        if has_letter(r["text"]) and seen.setdefault(r["lang"], 0) < SAMPLE_ROWS:
            seen[r["lang"]] += 1
            out.append((r["text"], r["lang"]))
    return fit_rows(out)


def prediction(text: Column, model: Model | None) -> Column:
    """Struct of ``lang_pred`` and ``score`` of whole texts.  Null texts and texts without a letter: und, 0;
    the same for every text if no labelled row was there to learn from."""
    spark = SparkSession.active()
    ship_package(spark)
    # BINS and the landmarks bound the model's size
    shared = None if model is None else spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def language(s: pd.Series) -> pd.DataFrame:
        lang, score = predict_texts(s.tolist(), None if shared is None else shared.value)
        return pd.DataFrame({"lang_pred": lang, "score": score})
    return language(text)


def classify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``: one row per row of ``docs``."""
    s = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), prediction(F.col("text"), model).alias("_p"))
    return s.select("doc_id", "held_out", "_p.lang_pred", "_p.score")


def keep_languages(docs: DataFrame, model: Model | None, least: float = 0.0) -> DataFrame:
    """Rows whose language is determined with a score of ``least`` at least, columns as they are."""
    p = prediction(docs["text"], model)
    return docs.where((p["lang_pred"] != UNDETERMINED) & (p["score"] >= least))
