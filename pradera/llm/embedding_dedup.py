"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations, with multiprobe buckets.

A rotation is three rounds of random signs and a fast Hadamard transform; the hash of a unit vector is the axis, with
its sign, that the rotated vector lies nearest to.  A table's bucket is FUNCTIONS such hashes; a vector is posted in
its own bucket and in the PROBES next ones, by how much nearer the chosen axes are than the probed ones.  Vectors that
meet in a bucket are compared exactly; a forest of the links leaves each bucket.  What links connect are groups, in
which all pairs are compared exactly, block by block, to count every vector's links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pradera.session import ship_package

from .common import block_pairs, connected_components, stored
from .groups import link_forest, over_groups
from .vectors import matrix, unit_rows, usable

SIMILAR = 0.98
TABLES = 6
FUNCTIONS = 2
PROBES = 2               # buckets besides its own that a vector is posted in, per table
BLOCK_ROWS = 1024        # vectors of a block of a bucket or group
ROUNDING = 1e-9         # by which a matrix product may differ from a row's sum
SEED = 11


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of the rows (a power of two long), scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def buckets(x: np.ndarray, tables: int = TABLES, functions: int = FUNCTIONS, probes: int = PROBES,
            seed: int = SEED) -> np.ndarray:
    """Codes of the buckets of unit rows: (rows, tables, 1 + probes), the own bucket first."""
    n, width = x.shape
    d = max(2, 1 << (width - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, d - width)))
    rng = np.random.Generator(np.random.PCG64(seed))
    signs = rng.choice([-1.0, 1.0], size=(tables, functions, 3, d))
    near = min(probes + 1, d)
    out = np.empty((n, tables, probes + 1), dtype=np.int64)
    every = np.arange(n)[:, None]
    for t in range(tables):
        code, loss = np.zeros((n, 1), dtype=np.int64), np.zeros((n, 1))
        for f in range(functions):
            y = x
            for r in range(3):
                y = hadamard(y * signs[t, f, r])
            size = np.abs(y)
            axis = np.argsort(-size, axis=1, kind="stable")[:, :near]
            gap = (size[every, axis[:, :1]] - size[every, axis]) ** 2
            axis = 2 * axis + (y[every, axis] < 0)
            code = (code[:, :, None] * (2 * d) + axis[:, None, :]).reshape(n, -1)
            loss = (loss[:, :, None] + gap[:, None, :]).reshape(n, -1)
            best = np.argsort(loss, axis=1, kind="stable")[:, :probes + 1]
            code, loss = code[every, best], loss[every, best]
        if code.shape[1] <= probes:  # fewer axes than probes
            code = np.pad(code, ((0, 0), (0, probes + 1 - code.shape[1])), mode="edge")
        out[:, t] = code
    return out


def _post(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        code = buckets(unit_rows(matrix(b.column("embedding"), width)))
        n, tables, per = code.shape
        ids = np.repeat(b.column("id").to_numpy(), tables * per)
        table = np.tile(np.repeat(np.arange(tables), per), n)
        part = np.repeat(b.column("part").to_numpy(), tables * per)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(part, pa.int64()),
                                          pa.array(table, pa.int64()), pa.array(code.reshape(-1), pa.int64())],
                                         names=["id", "part", "table", "code"])


def _arrays(table: pa.Table):
    return (table.column(c).to_numpy() for c in ("id", "blk", "bi", "bj"))


def _bucket_links(table: pa.Table, starts: np.ndarray, width: int, similar: float) -> Iterator[pa.RecordBatch]:
    ids, blk, bi, bj = _arrays(table)
    x = unit_rows(matrix(table.column("embedding"), width))
    f = link_forest(starts, blk, bi == bj, lambda i, j: (x[i] * x[j]).sum(-1) >= similar)
    yield pa.RecordBatch.from_arrays([pa.array(ids[f.a], pa.int64()), pa.array(ids[f.b], pa.int64())], names=["a", "b"])


def _count_links(table: pa.Table, starts: np.ndarray, width: int, similar: float) -> Iterator[pa.RecordBatch]:
    """Numbers of linked rows (copies counted) in block pairs of groups."""
    ids, blk, bi, bj = _arrays(table)
    x = unit_rows(matrix(table.column("embedding"), width))
    size, links = table.column("size").to_numpy(), np.zeros(len(ids), dtype=np.int64)
    for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)], strict=True):
        left, right = s + np.flatnonzero(blk[s:e] == bi[s]), s + np.flatnonzero(blk[s:e] == bj[s])
        near = x[left] @ x[right].T
        hit = near >= similar
        i, j = np.nonzero(np.abs(near - similar) < ROUNDING)
        hit[i, j] = (x[left[i]] * x[right[j]]).sum(-1) >= similar  # as links are decided
        if bi[s] == bj[s]:
            np.fill_diagonal(hit, False)
        else:
            links[right] += hit.T @ size[left]
        links[left] += hit @ size[right]
    at = np.flatnonzero(links)
    yield pa.RecordBatch.from_arrays([pa.array(ids[at], pa.int64()), pa.array(links[at], pa.int64())],
                                     names=["id", "links"])


def near_duplicates(vectors: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Links of vectors (vec_id, embedding, label) whose labels are equal and whose cosine is ``similar`` or more.

    One row per row of ``vectors``: ``vec_id``; ``n_links``: other rows linked directly; ``component_id``: the
    smallest vec_id that links lead to, its own included; ``kept``: vec_id = component_id.  Null labels and vectors
    that are null, zero or hold null or non-finite components link with nothing.  Vectors of fewer components are
    filled up with zeros.  Repeated rows are linked copies; null ids take part and are nobody's smallest id unless
    nobody has one.  Other columns are not read.  An empty table gives no row.  ``similar`` below SIMILAR is an error.
    """
    if similar < SIMILAR:
        raise ValueError(f"the tables and probes are made for cosines of {SIMILAR} and more: {similar}")
    v = vectors.select("vec_id", "label", "embedding")
    fit = F.col("label").isNotNull() & usable(F.col("embedding"))
    same = v.where(fit).groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("size"),
                                                          F.min("vec_id").alias("first"))
    hashed = F.xxhash64("label", "embedding")
    # a 64-bit id of each distinct vector; should two share one, the later ones get the next numbers
    again = F.row_number().over(Window.partitionBy(hashed).orderBy("label", "embedding")) - 1
    sets = stored(same.select("label", "embedding", "size", "first", hashed.bitwiseXOR(again.cast("long")).alias("id"),
                              F.xxhash64("label").alias("part")), "dedup-sets")
    width = sets.agg(F.max(F.size("embedding"))).first()[0] or 1

    ship_package(vectors.sparkSession)
    posts = sets.select("id", "part", "embedding").mapInArrow(
        lambda b: _post(b, width), "id long, part long, table long, code long")
    key = F.xxhash64("part", "table", "code").alias("bucket")  # rows of other buckets that share a hash are only compared
    posts = stored(posts.select("id", key).distinct(), "dedup-posts")
    met = posts.join(posts.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "bucket").drop("n")
    dealt = block_pairs(met, "bucket", BLOCK_ROWS).join(sets.select("id", "part", "embedding"), "id")
    links = over_groups(dealt, ["bucket", "part", "bi", "bj"], "id",
                        lambda t, s: _bucket_links(t, s, width, similar), "a long, b long")
    group = connected_components(links, "dedup")

    dealt = block_pairs(group, "component", BLOCK_ROWS).join(sets.select("id", "size", "embedding"), "id")
    counts = over_groups(dealt, ["component", "bi", "bj"], "id",
                         lambda t, s: _count_links(t, s, width, similar), "id long, links long")
    counts = counts.groupBy("id").agg(F.sum("links").alias("links"))
    of = (sets.select("label", "embedding", "size", "first", "id").join(group, "id", "left").join(counts, "id", "left")
          .withColumn("component", F.coalesce("component", "id")))
    first = of.groupBy("component").agg(F.min("first").alias("component_id"))
    of = of.join(first, "component").select("label", "embedding", "component_id", (
        F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = v.where(fit).join(of, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    rest = v.where(~fit).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
