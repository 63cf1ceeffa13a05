"""Approximate nearest neighbours by largest inner product, with a permutation index.

PIVOTS vectors, fitted on a bounded sample, order themselves by nearness to every vector; a vector is represented by
its PREFIX nearest pivots in order.  An index block posts each of its vectors in the inverted files of those pivots,
with the rank there.  A query walks the files of its own pivots and sums up how small the footrule distance of the two
rankings is; the vectors are ranked by that distance, and the nearest SHARE of a block, with all that tie with the last of
them, are reranked by the exact inner product.  No other inner products are computed.  Queries that find fewer than they
should are compared with every vector.

Vectors of unequal length are led back to angles: a vector x of length up to M gets a further component
sqrt(M^2 - |x|^2), a query 0, so the angle between them orders like the inner product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pradera.session import ship_package

from .common import stored
from .groups import over_groups
from .vectors import matrix, unit_rows, usable

NEIGHBOURS = 20
PIVOTS = 512
PREFIX = 64              # pivots that represent a vector
SHARE = 0.2              # of a block's vectors, the nearest by footrule, that are reranked
INDEX_ROWS = 16_384      # vectors of an index block
QUERY_ROWS = 1024        # queries of a query block


@dataclass
class Index:
    pivots: np.ndarray    # unit rows, one component more than the vectors
    reach: float          # M
    width: int

    def ranks(self, x: np.ndarray, queries: bool) -> np.ndarray:
        """The PREFIX nearest pivots of each row, nearest first."""
        more = np.zeros((len(x), 1)) if queries else np.sqrt(np.maximum(self.reach ** 2 - (x * x).sum(1), 0.0))[:, None]
        near = unit_rows(np.hstack([x, more])) @ self.pivots.T
        return np.argsort(-near, axis=1, kind="stable")[:, :min(PREFIX, len(self.pivots))].astype(np.uint16)


class Files:
    """Inverted files of an index block: for each pivot the vectors that it represents, and how near it is to them
    (PREFIX for the nearest pivot, down to 1)."""

    def __init__(self, ranks: np.ndarray, pivots: int):
        n, k = ranks.shape
        self.n = n
        pivot = ranks.reshape(-1)
        order = np.argsort(pivot, kind="stable")
        at = np.searchsorted(pivot[order], np.arange(pivots + 1))
        row, near = order // k, k - order % k
        self.files = [(row[a:b], near[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]

    def closeness(self, ranks: np.ndarray) -> np.ndarray:
        """Of each vector to a query: the largest footrule distance of two rankings minus theirs, halved.

        A pivot in both rankings, a and b from the end of each, brings the distance down by 2 min(a, b).
        """
        out = np.zeros(self.n, dtype=np.int32)
        for r, p in enumerate(ranks.tolist()):
            row, near = self.files[p]
            out[row] += np.minimum(near, len(ranks) - r).astype(np.int32)
        return out


def exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products, every row summed in the same order, so equal rows give equal values."""
    return (x * q).sum(axis=1)


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def fit(sample: np.ndarray, reach: float) -> Index:
    """The pivots are vectors of the sample, as unit rows."""
    pivots = np.asarray(sample[:PIVOTS], dtype=float)
    more = np.sqrt(np.maximum(reach ** 2 - (pivots * pivots).sum(1), 0.0))[:, None]
    return Index(unit_rows(np.hstack([pivots, more])), reach, pivots.shape[1])


def nearest_rankings(closeness: np.ndarray, k: int) -> np.ndarray:
    """Places of the nearest SHARE (but 4 k at least) by footrule, with ties; never those without a common pivot."""
    n = len(closeness)
    keep = max(4 * k, math.ceil(SHARE * n))
    edge = np.partition(closeness, n - keep)[n - keep] if n > keep else 1
    return np.flatnonzero(closeness >= max(edge, 1))


def _represent(batches: Iterator[pa.RecordBatch], ix: Index) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = matrix(b.column("embedding"), ix.width)
        v, q = ix.ranks(x, False), ix.ranks(x, True)
        yield pa.RecordBatch.from_arrays(
            [b.column("vec_id"), pa.array([r.astype("<f8").tobytes() for r in x], pa.binary()),
             pa.array([r.astype("<u2").tobytes() for r in v], pa.binary()),
             pa.array([r.astype("<u2").tobytes() for r in q], pa.binary())],
            names=["vec_id", "x", "as_vector", "as_query"])


def _search(table: pa.Table, starts: np.ndarray, ix: Index, k: int, every: bool) -> Iterator[pa.RecordBatch]:
    """The k best candidates of each query of a query block in an index block."""
    out_q, out_v, out_s = [], [], []
    for s, e in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows], strict=True):
        t = table.slice(s, e - s)
        is_query = t.column("is_query").to_numpy() == 1
        ids = t.column("vec_id").to_numpy()
        x = np.frombuffer(b"".join(t.column("x").to_pylist()), dtype="<f8").reshape(len(t), -1)
        ranks = np.frombuffer(b"".join(t.column("ranks").to_pylist()), dtype="<u2").reshape(len(t), -1)
        v, v_id = x[~is_query], ids[~is_query]
        if not len(v):
            continue
        files = Files(ranks[~is_query], len(ix.pivots))
        at = np.flatnonzero(is_query)
        for i in at.tolist():
            own = v_id == ids[i]
            if every:
                cand = np.flatnonzero(~own)
            else:
                near = files.closeness(ranks[i])
                near[own] = 0
                cand = nearest_rankings(near, k)
            score = exact(v[cand], x[i])
            best = best_of(v_id[cand], score, k)
            out_q.append(np.full(len(best), ids[i]))
            out_v.append(v_id[cand][best])
            out_s.append(score[best])
    cat = lambda a, t: pa.array(np.concatenate(a) if a else np.zeros(0), t)
    yield pa.RecordBatch.from_arrays([cat(out_q, pa.int64()), cat(out_v, pa.int64()), cat(out_s, pa.float64())],
                                     names=["query_id", "vec_id", "score"])


def _blocks(points: DataFrame, queries: DataFrame, n: int, n_queries: int) -> DataFrame:
    """Queries and vectors in (query block, index block) groups: each query meets each vector in one of them."""
    index_blocks, query_blocks = max(1, -(-n // INDEX_ROWS)), max(1, -(-n_queries // QUERY_ROWS))
    block = lambda k: F.pmod(F.xxhash64("vec_id"), F.lit(k)).cast("long")
    all_of = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
    v = points.select(all_of(query_blocks).alias("qb"), block(index_blocks).alias("vb"), F.lit(0).alias("is_query"),
                      "vec_id", "x", F.col("as_vector").alias("ranks"))
    q = queries.select(block(query_blocks).alias("qb"), all_of(index_blocks).alias("vb"), F.lit(1).alias("is_query"),
                       "vec_id", "x", F.col("as_query").alias("ranks"))
    return v.unionByName(q)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query, k: int = NEIGHBOURS) -> DataFrame:
    """The k nearest found of every vector that ``is_query`` (a condition on ``vec_id``) holds for, among all others.

    ``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (inner product in double precision of the vectors as they
    are), ties to the smaller vec_id; all others if there are fewer than k.  Vectors that are null, zero or hold null
    or non-finite components, and null ids, take no part; shorter vectors are filled up with zeros; of rows that share
    an id the least vector counts.  Other columns are not read.  Without queries there is no row.
    """
    pts = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).groupBy("vec_id").agg(
        F.min("embedding").alias("embedding"))
    pts = stored(pts.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"), "ann-vectors")
    square = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda a, v: a + v.cast("double") * v.cast("double"))
    n, n_queries, width, reach = pts.agg(
        F.count(F.lit(1)), F.count_if(is_query), F.max(F.size("embedding")), F.max(F.sqrt(square))).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n_queries or n < 2:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = (pts.select("embedding", F.xxhash64("vec_id").alias("_h"), "vec_id").orderBy("_h", "vec_id").limit(PIVOTS)
            .collect())
    sample = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        sample[i, :len(r["embedding"])] = r["embedding"]
    ix = fit(sample, float(reach))
    ship_package(vectors.sparkSession)
    shared = vectors.sparkSession.sparkContext.broadcast(ix)  # PIVOTS vectors
    points = stored(pts.mapInArrow(lambda b: _represent(b, shared.value),
                                   "vec_id long, x binary, as_vector binary, as_query binary"), "ann-index")
    queries = points.where(is_query)
    out = "query_id long, vec_id long, score double"
    run = lambda blocks, every: over_groups(blocks, ["qb", "vb"], "vec_id",
                                            lambda t, s: _search(t, s, shared.value, k, every), out)
    found = stored(_top(run(_blocks(points, queries, n, n_queries), False), k), "ann-found")
    full = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min(k, n - 1))
    short = queries.join(full, queries["vec_id"] == full["query_id"], "left_anti")
    n_short = short.count()
    if n_short:  # too few candidates: those queries are compared with every vector
        again = _top(run(_blocks(points, short, n, n_short), True), k)
        found = found.join(full, "query_id", "left_semi").select(*again.columns).union(again)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
