"""Chosen-path join of documents by the Jaccard similarity of their word n-grams.

Documents with the same words are one class; classes are joined.  Every class has a signature of MinHash values, one
per coordinate, so two sets agree on a coordinate with the probability of their similarity.  A run starts with all
sets in one node; a node with many sets is split: a hash of its path chooses coordinates, SPLITS on average, and the
sets of a child share the value there.  Nodes of up to LEAF sets, those of sets that are alike, and those at the last level are
leaves.  In a leaf signatures are compared, and pairs that agree on LOOSE of the coordinates or more connect their sets.
Every run's first node has a child, and there are as many runs as ``miss`` needs to be below 1 - RECALL for a pair at
the limit that has to go down to the last level in every run.

Connected sets form groups; inside a group all pairs are compared exactly, block by block, on the texts' n-grams.
What comes out per task are numbers of links and, for every block, a forest of links, never the pairs.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pradera.session import ship_package

from .common import block_pairs, connected_components, stored
from .groups import binary_rows, link_forest, over_groups

WORDS = 5                # words of an n-gram
SIMILAR = 0.8
COORDINATES = 96         # of a signature
RUNS = 24                # at least
RECALL = 0.9999          # of pairs at the limit, were all nodes above the last level split
SPLITS = 1.25            # chosen coordinates of a node, on average: 1 / SIMILAR
LEVELS = 4
LEAF = 64                # sets that a node may hold and not be split
LOOSE = 0.6              # agreement of signatures that connects two sets before the exact comparison
DENSE = 0.5              # share of a node's sets that are alike, from which it is a leaf of any size
PEEK = 24                # coordinates that tell whether a node is dense
BLOCK_ROWS = 4096        # sets of a block of a leaf
GROUP_ROWS = 256         # of a block of a group
CHUNK = 1 << 20          # characters split into words at a time
_WORD, _NO_WORD = re.compile(r"\w+"), re.compile(r"\W")


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of a text's words in order; long texts are split at the end of a word."""
    out, at, text = [], 0, (text or "").lower()
    while at < len(text):
        end = at + CHUNK
        end = m.start() if end < len(text) and (m := _NO_WORD.search(text, end)) else len(text)
        seen: dict[str, int] = {}
        out.append(np.array([seen.get(w) or seen.setdefault(w, xxhash.xxh3_64_intdigest(w))
                             for w in _WORD.findall(text, at, end)], dtype=np.uint64))
        at = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def shingles(h: np.ndarray, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of hashed words; a shorter text is one n-gram, no word is none."""
    if not len(h):
        return h
    n = min(n, len(h))
    out = np.full(len(h) - n + 1, np.uint64(n))
    for k in range(n):
        out = (out ^ h[k:len(h) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


_rng = np.random.Generator(np.random.PCG64(20))
_A = (_rng.integers(1 << 31, size=COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_B = _rng.integers(1 << 32, size=COORDINATES, dtype=np.uint32)[:, None]


def signature(grams: np.ndarray) -> np.ndarray:
    """MinHash values of a set that isn't empty."""
    x = ((grams * np.uint64(0xD1342543DE82EF95)) >> np.uint64(32)).astype(np.uint32)
    best = np.full(COORDINATES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(best, (_A * x[None, at:at + 2048] + _B).min(axis=1), out=best)
    return best


def _sign(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        digest, size, sig, short = [], [], [], []
        for t in b.column("text"):
            words = word_hashes(t.as_py())
            g = shingles(words, n)
            s = signature(g) if len(g) else None
            digest.append(xxhash.xxh3_128_digest(words.tobytes()) if len(words) else None)
            size.append(len(g))
            sig.append(None if s is None else s.astype("<u4").tobytes())
            short.append(None if s is None else s.astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("h1"), b.column("h2"), pa.array(digest, pa.binary()), pa.array(size, pa.int64()),
             pa.array(sig, pa.binary()), pa.array(short, pa.binary())],
            names=["doc_id", "h1", "h2", "words", "n_grams", "sig", "short"])


def row_keys(docs: DataFrame) -> DataFrame:
    """Adds ``h1``, ``h2``: two hashes of id and text; repeated rows have the same, other rows differ."""
    idt = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({"h1": F.xxhash64(idt, text), "h2": F.xxhash64(F.lit(7), text, idt)})


def _sets(signed: DataFrame) -> DataFrame:
    """One row per class of equal word sequences: ``id``, number of rows, and what its rows share."""
    c = (signed.where("words is not null").groupBy("words")
         .agg(F.count(F.lit(1)).alias("size"), *[F.first(x).alias(x) for x in ("sig", "short")]))
    # a 64-bit id; should two digests share one, the later ones get the next numbers
    same = F.row_number().over(Window.partitionBy(F.xxhash64("words")).orderBy("words")) - 1
    return c.withColumn("id", F.xxhash64("words").bitwiseXOR(same.cast("long")))


def _leaf(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    sig = binary_rows(table.column("short"), COORDINATES, np.uint8)
    get = lambda c: table.column(c).to_numpy()
    least = LOOSE * COORDINATES
    f = link_forest(starts, get("blk"), get("bi") == get("bj"),
                    lambda i, j: (sig[i] == sig[j]).sum(-1) >= least)
    ids = get("id")
    yield pa.RecordBatch.from_arrays([pa.array(ids[f.a], pa.int64()), pa.array(ids[f.b], pa.int64())], names=["a", "b"])


def _first_nodes(runs: int, seed: int = 9) -> list[tuple[int, int]]:
    """(run, coordinate) of the children of the runs' first nodes: one or more a run, SPLITS on average; a coordinate
    comes again only after all others."""
    rng = np.random.Generator(np.random.PCG64(seed))
    per = 1 + np.bincount(rng.permutation(runs)[:math.ceil(SPLITS * runs) - runs], minlength=runs)
    order = rng.permutation(COORDINATES)
    return [(int(r), int(order[i % COORDINATES])) for i, r in enumerate(np.repeat(np.arange(runs), per))]


def miss(similar: float, runs: int, levels: int = LEVELS) -> float:
    """Probability that two sets of Jaccard similarity ``similar`` share no leaf of ``levels`` levels or differ there.

    Given that k coordinates agree, a node below the first has a binomial number of children in which both are, and
    those of the first nodes are drawn without replacement.
    """
    n, out = COORDINATES, 0.0
    cycles, rest = divmod(len(_first_nodes(runs)), n)
    for k in range(n + 1):
        apart = 0.0  # of two sets in one node of the second level
        for _ in range(levels - 1):
            apart = (1 - SPLITS / n * (1 - apart)) ** k
        lost = 1.0 if k < LOOSE * n else apart ** (k * cycles) * sum(
            math.comb(k, a) * math.comb(n - k, rest - a) * apart ** a for a in range(rest + 1)) / math.comb(n, rest)
        out += math.comb(n, k) * similar ** k * (1 - similar) ** (n - k) * lost
    return out


def enough_runs(similar: float = SIMILAR, levels: int = LEVELS, recall: float = RECALL) -> int:
    runs = RUNS
    while miss(similar, runs, levels) > 1 - recall:
        runs += 1
        if runs > 40 * RUNS:
            raise ValueError(f"no number of runs reaches recall {recall} at similarity {similar}")
    return runs


def candidates(sets: DataFrame, runs: int, levels: int = LEVELS) -> DataFrame:
    """Pairs (a, b) of ``sets`` (id, sig, short) that are loosely similar: a forest for each leaf."""
    value = lambda c: F.substring("sig", c * 4 + 1, 4)
    whole, share = 1 << 20, int(SPLITS / COORDINATES * (1 << 20))
    edges, nodes = None, None
    for level in range(1, levels + 1):
        if level == 1:
            child = sets.select("id", F.explode(F.array(*[
                F.xxhash64(F.lit(r), F.lit(c), value(F.lit(c))) for r, c in _first_nodes(runs)])).alias("path"))
        else:
            chosen = F.filter(F.sequence(F.lit(0), F.lit(COORDINATES - 1)),
                              lambda c: F.pmod(F.xxhash64(F.col("path"), c), F.lit(whole)) < share)
            child = nodes.join(sets.select("id", "sig"), "id").select("id", F.explode(F.transform(
                chosen, lambda c: F.xxhash64(F.col("path"), c, value(c)))).alias("path"))
        sizes = child.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        met = stored(child.join(sizes, "path"), "jaccard-nodes")
        if level < levels:
            dense = stored(_dense_nodes(met.where(F.col("n") > LEAF), sets), "jaccard-dense")
            leaf = met.where(F.col("n") <= LEAF).unionByName(met.join(dense, "path", "left_semi"))
            nodes = met.where(F.col("n") > LEAF).join(dense, "path", "left_anti").select("id", "path")
        else:
            leaf = met
        dealt = block_pairs(leaf.select("id", "path"), "path", BLOCK_ROWS)
        dealt = dealt.join(sets.select("id", "short"), "id")
        found = over_groups(dealt, ["path", "bi", "bj"], "id", _leaf, "a long, b long")
        edges = found if edges is None else edges.union(found)
    return edges


def _dense_nodes(big: DataFrame, sets: DataFrame) -> DataFrame:
    """Paths of nodes whose sets are alike, DENSE of them to a member drawn by a hash: splitting wouldn't part them."""
    short = sets.select("id", F.substring("short", 1, PEEK).alias("s"))
    chosen = big.groupBy("path").agg(F.min_by("id", F.xxhash64("path", "id")).alias("id"))
    chosen = chosen.join(short, "id").select("path", F.col("s").alias("t"))
    same = F.size(F.filter(F.sequence(F.lit(1), F.lit(PEEK)),
                           lambda c: F.substring("s", c, F.lit(1)) == F.substring("t", c, F.lit(1))))
    return (big.select("id", "path").join(short, "id").join(chosen, "path")
            .groupBy("path").agg(F.avg((same >= LOOSE * PEEK).cast("double")).alias("share"))
            .where(F.col("share") >= DENSE).select("path"))


def _overlaps(grams: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each left set, the number of n-grams that it shares with every right set."""
    owner = np.repeat(np.arange(len(right)), [len(grams[j]) for j in right])
    value = np.concatenate([grams[j] for j in right])
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    for i in left.tolist():
        count = np.zeros(len(right), dtype=np.int64)
        g = grams[i]
        lo, hi = np.searchsorted(value, g, "left"), np.searchsorted(value, g, "right")
        at = 0
        while at < len(g):  # some million shared n-grams at a time
            s = hi[at:at + 4096] - lo[at:at + 4096]
            place = np.repeat(lo[at:at + 4096] - (np.cumsum(s) - s), s) + np.arange(s.sum())
            count += np.bincount(owner[place], minlength=len(right))
            at += 4096
        yield i, count


def _compare(table: pa.Table, starts: np.ndarray, n: int, similar: float) -> Iterator[pa.RecordBatch]:
    """Exact links in block pairs of groups: (id, links, null) with the linked rows, and (a, null, b) of a forest."""
    get = lambda c: table.column(c).to_numpy()
    ids, size, blk, bi, bj = (get(c) for c in ("id", "size", "blk", "bi", "bj"))
    links, a, b = np.zeros(len(ids), dtype=np.int64), [], []
    limit = round(similar * 1000)
    for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)], strict=True):
        grams = [shingles(word_hashes(t), n) for t in table.column("text").slice(s, e - s).to_pylist()]
        total = np.array([len(g) for g in grams])
        left, right = np.flatnonzero(blk[s:e] == bi[s]), np.flatnonzero(blk[s:e] == bj[s])
        if not len(left) or not len(right):
            continue
        label = np.arange(e - s)
        for i, shared in _overlaps(grams, left, right):
            # |x n y| / |x u y| >= similar, in thousandths
            hit = right[shared * 1000 >= limit * (total[i] + total[right] - shared)]
            hit = hit[hit > i] if bi[s] == bj[s] else hit
            links[s + i] += size[s + hit].sum()
            links[s + hit] += size[s + i]
            new, at = np.unique(label[hit], return_index=True)
            for x, j in zip(new.tolist(), hit[at].tolist(), strict=True):
                if x != label[i]:
                    low, high = min(x, label[i]), max(x, label[i])
                    label[label == high] = low
                    a.append(int(ids[s + i]))
                    b.append(int(ids[s + j]))
    at = np.flatnonzero(links)
    none = lambda k: pa.nulls(k, pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(ids[at], pa.int64()), pa.array(links[at], pa.int64()), none(len(at))],
                                     names=["id", "links", "b"])
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), none(len(a)), pa.array(b, pa.int64())],
                                     names=["id", "links", "b"])


def classes(docs: DataFrame, n: int = WORDS, similar: float = SIMILAR, runs: int | None = None,
            levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``h1``, ``h2`` (the row's keys), ``n_grams``, ``n_links``,
    ``class_id``, ``kept``."""
    if similar < SIMILAR:
        raise ValueError(f"the splits and the loose limit are made for similarities of {SIMILAR} and more: {similar}")
    runs = runs or enough_runs(similar, levels)
    ship_package(docs.sparkSession)
    keyed = row_keys(docs.select("doc_id", "text"))
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL(
        "h1 long, h2 long, words binary, n_grams long, sig binary, short binary").fields])
    signed = stored(keyed.mapInArrow(lambda b: _sign(b, n), schema), "jaccard-signed")
    sets = stored(_sets(signed), "jaccard-sets")
    group = connected_components(candidates(sets, runs, levels), "jaccard-loose")

    # one row's text for each class that loosely resembles another one
    members = group.join(sets.select("id", "words", "size"), "id")
    dealt = block_pairs(members.select("id", "component", "size"), "component", GROUP_ROWS)
    row = signed.where("words is not null").groupBy("words").agg(F.min(F.struct("h1", "h2")).alias("k"))
    row = members.select("id", "words").join(row, "words").select("id", "k.h1", "k.h2")
    texts = keyed.select("h1", "h2", "text").join(row, ["h1", "h2"]).select("id", "text").dropDuplicates(["id"])
    out = stored(over_groups(dealt.join(texts, "id"), ["component", "bi", "bj"], "id",
                             lambda t, s: _compare(t, s, n, similar), "id long, links long, b long"), "jaccard-links")
    links = out.where("links is not null").groupBy("id").agg(F.sum("links").alias("links"))
    linked = connected_components(out.where("b is not null").select(F.col("id").alias("a"), "b"), "jaccard")

    of = (sets.select("words", "id", "size").join(links, "id", "left").join(linked, "id", "left")
          .select("words", F.coalesce("component", "id").alias("component"),
                  (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    rows = signed.select("doc_id", "h1", "h2", "words", "n_grams").join(of, "words", "left")
    # nulls are the largest ids; the row that stands for a class has the smallest id, then the smallest key
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("h1"), F.col("h2"))
    first = rows.where("component is not null").groupBy("component").agg(F.min(order).alias("_first"))
    rows = rows.join(first, "component", "left")
    alone = F.col("component").isNull()
    return rows.select(
        "doc_id", "h1", "h2", "n_grams", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("_first.d")).alias("class_id"),
        (alone | ((F.col("h1") == F.col("_first.h1")) & (F.col("h2") == F.col("_first.h2")))).alias("kept"))


def join(docs: DataFrame, n: int = WORDS, similar: float = SIMILAR, runs: int | None = None,
         levels: int = LEVELS) -> DataFrame:
    """Similar documents: one row per row of ``docs``.

    ``doc_id``; ``class_id``: the smallest id among the documents that links lead to, its own included; ``n_links``:
    other rows whose n-grams have a Jaccard similarity of ``similar`` or more, copies included; ``n_grams``: the size
    of the set; ``kept``: the row stands for its class (of repeated rows, with the same id and text, all do).

    Words are runs of word characters, lower-cased; a text of fewer than ``n`` words is one n-gram; null texts and
    texts without words have none, link with nothing and stand for themselves.  Null ids come after all others.  Other
    columns are not read.  An empty table gives no row.  ``similar`` below SIMILAR is an error.
    """
    return classes(docs, n, similar, runs, levels).select("doc_id", "class_id", "n_links", "n_grams", "kept")


def keep_one(docs: DataFrame, n: int = WORDS, similar: float = SIMILAR) -> DataFrame:
    """One row of each class, with the columns of ``docs`` as they are; repeated rows come once."""
    keep = classes(docs, n, similar).where("kept").select("h1", "h2")
    whole = docs.select(F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("_row"), "doc_id", "text")
    out = row_keys(whole).join(keep, ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"])
    return out.select([(F.col("text") if c == "text" else F.col("_row")[c]).alias(c) for c in docs.columns])
