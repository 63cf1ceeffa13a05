import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pradera.llm import common, embedding_dedup, groups, jaccard_join, permutation_index
from pradera.llm.common import read

from .helpers import components, docs, grams


# --- documents -----------------------------------------------------------------------------------

def test_limits_below_the_tuned_ones_are_errors(spark):
    with pytest.raises(ValueError, match="0.8"):
        jaccard_join.join(docs(spark, [(1, "a b")]), similar=0.5)
    with pytest.raises(ValueError, match="0.98"):
        embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"),
                                        similar=0.9)


def test_runs_reach_the_recall():
    runs = jaccard_join.enough_runs()
    first = jaccard_join._first_nodes(runs)
    assert {r for r, _ in first} == set(range(runs)) and len({c for _, c in first}) == min(len(first), 96)
    assert abs(len(first) - jaccard_join.SPLITS * runs) < 1 and len(set(first)) == len(first)
    worst = jaccard_join.miss(jaccard_join.SIMILAR, runs, jaccard_join.LEVELS)
    assert worst <= 1 - jaccard_join.RECALL
    assert all(jaccard_join.miss(jaccard_join.SIMILAR, runs, n) <= worst for n in range(1, jaccard_join.LEVELS))
    assert jaccard_join.enough_runs(recall=1 - 1e-5) > runs

    rnd = np.random.default_rng(1)
    p, lost, n = jaccard_join.SPLITS / 96, 0, 4000
    few = jaccard_join._first_nodes(6)  # few runs, so that a draw shows the misses

    def meet(same, level):
        return level == 4 or any(meet(same, level + 1) for _ in range(rnd.binomial(same.sum(), p)))
    for _ in range(n):
        same = rnd.random(96) < jaccard_join.SIMILAR
        lost += not any(same[c] and meet(same, 1) for _, c in few)
    want = jaccard_join.miss(jaccard_join.SIMILAR, 6)
    assert abs(lost / n - want) < 5 * (want / n) ** 0.5


def _brute(rows):
    sets = [grams(r[1]) for r in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 1000 * len(sets[i] & sets[j]) >= 800 * len(sets[i] | sets[j])]
    links = [0] * len(rows)
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    root = components(len(rows), pairs)
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(root[i], []).append(r[0])
    smallest = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return links, [smallest[x] for x in root], len(set(root))


def _check(spark, rows):
    links, root, n = _brute(rows)
    d = docs(spark, rows, clash=True)
    got = jaccard_join.join(d).collect()
    key = lambda a: sorted(map(str, a))
    assert key((r.doc_id, r.n_links, r.class_id, r.n_grams) for r in got) == key(
        (r[0], k, c, len(grams(r[1]))) for r, k, c in zip(rows, links, root, strict=True))
    return d, got, n


def _near(text, rnd, edits):
    w = text.split(" ")
    for _ in range(edits):
        w[rnd.randrange(len(w))] = f"new{rnd.randrange(10**6)}"
    return " ".join(w)


def test_join_of_planted_copies(spark):
    rnd = random.Random(2)
    text = lambda n: " ".join(f"t{rnd.randrange(10**6)}" for _ in range(n))
    passage, rows = text(60), []
    for _ in range(25):
        base = text(rnd.randint(30, 200))
        for _ in range(rnd.randint(1, 5)):
            rows.append(_near(base, rnd, rnd.randint(0, 5)))
    rows += [passage + " " + text(rnd.randint(1, 60)) for _ in range(60)]  # a passage that many share
    big = text(120)
    rows += [_near(big, rnd, rnd.randint(0, 3)) for _ in range(150)] + [big] * 60 + [rows[0].upper() + " !!"]
    rows = list(enumerate(rows))
    rnd.shuffle(rows)
    rows += [(1000, None), (1001, ""), (1002, "?!"), (1003, "two words"), (1004, "Two  words"), (1005, "two"),
             (1006, "é ñ"), (1003, "two words"), (None, "two words"), (1010, "w " * 60_000), (1011, "w " * 50_000)]
    d, got, n = _check(spark, rows)
    assert sum(r.kept for r in got) == n + 1  # 1003 stands for its class and comes twice
    one = jaccard_join.keep_one(d)
    assert one.columns == d.columns
    ids = [r.doc_id for r in one.collect()]
    assert len(ids) == len(set(ids)) and set(ids) == {r.doc_id for r in got if r.kept}


def test_join_with_leaves_that_are_split(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LEAF", 4)
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", 8)
    monkeypatch.setattr(jaccard_join, "GROUP_ROWS", 8)
    rnd = random.Random(5)
    base = " ".join(f"t{rnd.randrange(10**6)}" for _ in range(80))
    rows = [(i, _near(base, rnd, rnd.randint(0, 4))) for i in range(60)]
    _check(spark, rows)


def test_join_of_the_table(spark):
    d = read(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    links, root, _ = _brute(rows)
    assert sum(links)
    got = {r.doc_id: r for r in jaccard_join.join(d).collect()}
    assert {i: (r.n_links, r.class_id) for i, r in got.items()} == {
        r[0]: (k, c) for r, k, c in zip(rows, links, root, strict=True)}


def test_join_of_nothing(spark):
    assert jaccard_join.join(docs(spark, [])).count() == jaccard_join.keep_one(docs(spark, [])).count() == 0
    got = jaccard_join.join(docs(spark, [(2, None), (1, "")])).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links, r.kept) for r in got) == [(1, 1, 0, True), (2, 2, 0, True)]


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = "The cat's Éñ_9 sat, on  a mat! " * 5
    whole = jaccard_join.word_hashes(text)
    monkeypatch.setattr(jaccard_join, "CHUNK", 7)
    assert (jaccard_join.word_hashes(text) == whole).all() and len(whole) == 40
    assert len(jaccard_join.shingles(whole)) == len(grams(text))


def test_signature_agreement_estimates_similarity():
    rnd = np.random.default_rng(1)
    a = np.unique(rnd.integers(0, 2**63, 400, dtype=np.uint64))
    b = np.r_[a[:360], rnd.integers(0, 2**63, 40, dtype=np.uint64)]
    same = np.mean([np.mean(jaccard_join.signature(a ^ np.uint64(k)) == jaccard_join.signature(b ^ np.uint64(k)))
                    for k in range(1, 30)])
    assert abs(same - 360 / 440) < 0.03


# --- shared parts --------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(4))
def test_components(spark, seed):
    rnd = random.Random(seed)
    n = 120
    pairs = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(90)] + [(i, i + 1) for i in range(60, 100)] + [(3, 3)]
    e = spark.createDataFrame([(a * 7 - 300, b * 7 - 300) for a, b in pairs], "a long, b long")
    got = {r.id: r.component for r in common.connected_components(e, "t").collect()}
    root = components(n, pairs)
    seen = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {i * 7 - 300: root[i] * 7 - 300 for i in seen}


def test_block_pairs_meet_once(spark):
    rows = [(g, i) for g, n in ((1, 1), (2, 7), (3, 40)) for i in range(n)]
    d = common.block_pairs(spark.createDataFrame(rows, "g long, id long"), "g", 10).collect()
    cells = {}
    for r in d:
        cells.setdefault((r.g, r.bi, r.bj), []).append(r)
    met = {}
    for (g, bi, bj), rs in cells.items():
        for a in rs:
            for b in rs:
                if a.id < b.id and (bi == bj or a.blk != b.blk):
                    met[g, a.id, b.id] = met.get((g, a.id, b.id), 0) + 1
    assert met == {(g, a, b): 1 for g, n in ((1, 1), (2, 7), (3, 40)) for a in range(n) for b in range(a + 1, n)}


def test_groups_across_batches():
    import pyarrow as pa
    keys = np.repeat(np.arange(9), [1, 5, 3, 30, 1, 1, 2, 12, 1])
    for step in (1, 2, 7, 100):
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[i:i + step]), pa.array(np.arange(len(keys))[i:i + step])],
                                              names=["k", "v"]) for i in range(0, len(keys), step)]
        out = []
        for t, starts in groups.whole_groups(iter(batches), ["k"]):
            for s, e in zip(starts, [*starts[1:], t.num_rows], strict=True):
                out.append((t.column("k")[int(s)].as_py(), t.column("v").to_pylist()[s:e]))
        assert out == [(k, np.flatnonzero(keys == k).tolist()) for k in range(9)]


@pytest.mark.parametrize("small", [2, 64])
def test_forest_joins_what_pairs_join(small, monkeypatch):
    monkeypatch.setattr(groups, "SMALL", small)
    rnd = np.random.default_rng(small)
    starts = np.array([0, 1, 20, 50])
    n = 90
    x = rnd.random(n)
    like = lambda i, j: np.abs(x[i] - x[j]) < 0.03
    f = groups.link_forest(starts, np.zeros(n, dtype=int), np.ones(n, dtype=bool), like)
    group = np.searchsorted(starts, np.arange(n), side="right")
    pairs = [(i, j) for i in range(n) for j in range(i) if group[i] == group[j] and like(i, j)]
    assert components(n, pairs) == components(n, list(zip(f.a, f.b, strict=True)))
    assert len(f.a) == n - len(set(components(n, pairs)))


# --- vectors -------------------------------------------------------------------------------------

VEC = "vec_id long, embedding array<float>, label int"


def _vectors(spark, rows):
    return spark.createDataFrame(rows, VEC).withColumns({c: F.lit("own") for c in ("id", "size", "part", "rank", "x")})


def _cluster(rnd, centre, n, spread):
    return [[float(v) for v in centre + spread * rnd.normal(size=len(centre))] for _ in range(n)]


ODD = [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, []]


def test_embedding_links(spark):
    rnd = np.random.default_rng(3)
    rows = []
    for k in range(12):
        c = rnd.normal(size=16)
        for v in _cluster(rnd, c, 12, 0.12):
            rows.append((len(rows), v, int(rnd.integers(0, 2)) if k else 1))
    c = rnd.normal(size=16)
    rows += [(1000 + i, [float(x) for x in c], 5) for i in range(40)]  # copies
    rows += [(2000 + i, [float(x) * 4 for x in c], 5) for i in range(3)] + [(2100, [float(x) for x in -c], 5)]
    rows += [(3000 + i, v, 5) for i, v in enumerate(ODD)] + [(3100, rows[0][1], None), (None, rows[0][1], rows[0][2]),
                                                             (4000, [1.0, 2.0], 7), (4000, [1.0, 2.0], 7), (4001, [1.0, 2.0, 0.0], 7)]
    ok = [i for i, r in enumerate(rows) if r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])
          and r[2] is not None]
    unit = {}
    for i in ok:
        x = np.zeros(16)
        x[:len(rows[i][1])] = np.array(rows[i][1], dtype=np.float32)
        unit[i] = x / np.linalg.norm(x)
    pairs = [(i, j) for i in ok for j in ok if j < i and rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= 0.98]
    links = [0] * len(rows)
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    root = components(len(rows), pairs)
    first = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            first[root[i]] = min(first.get(root[i], r[0]), r[0])
    got = embedding_dedup.near_duplicates(_vectors(spark, rows)).collect()
    assert sorted(map(str, ((r.vec_id, r.n_links, r.component_id) for r in got))) == sorted(
        map(str, ((r[0], links[i], first[root[i]]) for i, r in enumerate(rows))))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_embedding_links_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 16)
    rnd = np.random.default_rng(8)
    c = rnd.normal(size=32)
    rows = [(i, v, 1) for i, v in enumerate(_cluster(rnd, c, 90, 0.1))]
    u = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    want = ((u @ u.T) >= 0.98).sum(1) - 1
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(_vectors(spark, rows)).collect()}
    assert [got[i] for i in range(90)] == want.tolist() and want.sum()


def test_links_at_the_limit_count_as_they_connect():
    """Pairs made to lie at the limit: the count and the forest decide alike."""
    import pyarrow as pa
    rnd = np.random.default_rng(7)
    width, n = 48, 120
    x = rnd.normal(size=(n, width)) + 4
    y = embedding_dedup.unit_rows(x)
    limits = np.sort((y[:, None, :] * y[None, :, :]).sum(-1)[np.triu_indices(n, 1)])[::400]  # values that pairs really have
    t = pa.table({"id": np.arange(n), "blk": np.zeros(n, int), "bi": np.zeros(n, int), "bj": np.zeros(n, int),
                  "size": np.ones(n, int), "embedding": pa.array(x.tolist(), pa.list_(pa.float64()))})
    for similar in limits:
        links = next(embedding_dedup._count_links(t, np.array([0]), width, similar)).to_pydict()
        found = next(embedding_dedup._bucket_links(t, np.array([0]), width, similar)).to_pydict()
        linked = (y[:, None, :] * y[None, :, :]).sum(-1) >= similar
        np.fill_diagonal(linked, False)
        assert dict(zip(links["id"], links["links"], strict=True)) == {i: k for i, k in enumerate(linked.sum(1)) if k}
        assert {*found["a"], *found["b"]} == {i for i, k in enumerate(linked.sum(1)) if k}


def test_hadamard_is_orthogonal():
    x = np.random.default_rng(0).normal(size=(5, 16))
    y = embedding_dedup.hadamard(x)
    assert np.allclose((y * y).sum(1), (x * x).sum(1)) and np.allclose(embedding_dedup.hadamard(y), x)


def test_hashing_finds_pairs_at_the_limit():
    rnd = np.random.default_rng(1)
    a, b = rnd.normal(size=(2000, 64)), rnd.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    x, y = embedding_dedup.buckets(a), embedding_dedup.buckets(0.98 * a + np.sqrt(1 - 0.98 ** 2) * b)
    met = np.array([(x[:, t, :, None] == y[:, t, None, :]).any((1, 2)) for t in range(x.shape[1])])
    assert met.any(0).all() and (1 - met.mean()) ** len(met) < 1e-6  # a pair is missed with this probability


def _search_brute(rows, q, k=20):
    ok = {}
    for i, v, _ in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v):
            ok[i] = np.array(v, dtype=np.float32).astype(float)
    s = sorted(((-float((ok[q] * v).sum()), i) for i, v in ok.items() if i != q))
    return [(i, -x) for x, i in s[:k]]


def test_search_recall_and_order(spark):
    d = read(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r.vec_id, r.embedding, r.label) for r in d.collect()]
    got = {}
    for r in permutation_index.search(d, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append(r)
    ids = np.array([r[0] for r in rows])
    assert set(got) == set(ids[ids % 20 == 0].tolist())
    found = []
    for q, rs in got.items():
        rs.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rs] == list(range(1, 21)) and q not in [r.vec_id for r in rs]
        want = _search_brute(rows, q)
        true = dict(_search_brute(rows, q, len(rows)))
        assert all(abs(true[r.vec_id] - r.score) < 1e-12 for r in rs)
        assert [(-r.score, r.vec_id) for r in rs] == sorted((-r.score, r.vec_id) for r in rs)
        found.append(len({i for i, _ in want} & {r.vec_id for r in rs}) / 20)
    assert np.mean(found) >= 0.9


def test_search_of_odd_rows(spark):
    rnd = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rnd.normal(size=16) * (1 + i % 7)], 0) for i in range(10)]
    rows += [(20, rows[0][1], 0), (40, rows[0][1], 0), (60, None, 0), (80, [0.0] * 16, 0), (None, rows[1][1], 0),
             (100, [float("nan")] * 16, 0), (5, rows[5][1], 0)]
    got = permutation_index.search(_vectors(spark, rows), F.col("vec_id") % 20 == 0).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(by) == {0, 20, 40}
    for q, found in by.items():  # fewer than 20 others: all of them, through the exact way
        want = _search_brute(rows, q)
        assert [i for i, _ in found] == [i for i, _ in want] and np.allclose([s for _, s in found], [s for _, s in want])
    assert permutation_index.search(_vectors(spark, rows[:0]), F.col("vec_id") % 20 == 0).count() == 0
    assert permutation_index.search(_vectors(spark, rows[:1]), F.col("vec_id") % 20 == 0).count() == 0


def test_only_the_nearest_rankings_are_reranked(spark, monkeypatch):
    """Ties with the last one stay, what shares no pivot doesn't; a share of the inner products is computed."""
    c = np.array([5, 0, 9, 5, 5, 1, 7, 0, 5, 3])
    monkeypatch.setattr(permutation_index, "SHARE", 0.3)
    assert permutation_index.nearest_rankings(c, 0).tolist() == [0, 2, 3, 4, 6, 8]
    assert permutation_index.nearest_rankings(c, 5).tolist() == [0, 2, 3, 4, 5, 6, 8, 9]
    monkeypatch.undo()
    x = np.random.default_rng(3).normal(size=(3000, 32))
    ix = permutation_index.fit(x[:512], float(np.sqrt((x * x).sum(1)).max()))
    files = permutation_index.Files(ix.ranks(x, False), len(ix.pivots))
    kept = [len(permutation_index.nearest_rankings(files.closeness(r), 20)) for r in ix.ranks(x[:40], True)]
    assert np.mean(kept) < 0.22 * len(x) and min(kept) >= 0.2 * len(x)


def test_closeness_is_the_footrule():
    rnd = np.random.default_rng(0)
    k, pivots = 6, 15
    r = np.array([rnd.permutation(pivots)[:k] for _ in range(30)], dtype=np.uint8)
    files = permutation_index.Files(r, pivots)
    place = lambda a, p: a.tolist().index(p) if p in a.tolist() else k
    for q in r[:5]:
        foot = [sum(abs(place(q, p) - place(v, p)) for p in range(pivots)) for v in r]
        assert (k * (k + 1) - 2 * files.closeness(q)).tolist() == foot
