import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pradera.llm import spelling

from .helpers import docs


def _near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _brute(vocab, ratio=10):
    form, out = {}, {}
    for w, n in vocab.items():
        near = [v for v in vocab if _near(w, v)]
        best = min(near, key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best is not None and vocab[best] >= ratio * n else None
        out[w] = len(near)
    rows = []
    for w, n in vocab.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, out[w], vocab[form[w]] if form[w] else None))
    return sorted(rows)


def _words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def _vocab(n, seed, letters="abé", low=7, high=10):
    rnd = random.Random(seed)
    words = {"".join(rnd.choice(letters) for _ in range(rnd.randint(low, high))) for _ in range(n)}
    for w in list(words)[:n // 2]:
        i = rnd.randrange(len(w))
        words.add(rnd.choice([w[:i] + rnd.choice(letters) + w[i:], w[:i] + "z" + w[i + 1:], w + "a", "a" + w, w + w[-1]]))
    return {w: rnd.choice([2, 3, 20, 30, 300, 4000]) for w in sorted(words)}


@pytest.mark.parametrize("block_rows", [4096, 8])
def test_variants_equal_brute_force(spark, block_rows):
    vocab = _vocab(500, block_rows)
    vocab |= {"q" * 7: 2, "q" * 8: 30, "q" * 9: 400, "q" * 10: 5000, "q" * 300: 2, "q" * 301: 20, "k" * 300: 5}
    df = spark.createDataFrame(list(vocab.items()), "word string, n long").repartition(3)
    got = spelling.variants(df, block_rows=block_rows)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == _brute(vocab)


def test_scan_equals_brute_force_in_every_range():
    rnd = random.Random(5)
    for _ in range(60):
        lam = rnd.randint(1, 6)
        words = sorted({"".join(rnd.choice("ab") for _ in range(rnd.choice([lam, lam + 1]))) for _ in range(30)})
        lo = rnd.randint(0, lam)
        hi = rnd.randint(lo + 1, lam + 1)
        full = lambda x: np.full(len(words), x)
        i, j = spelling.near_pairs(words, np.array([0]), full(lam), full(lo), full(hi))

        def prefix(a, b):
            return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        want = [(a, b) for a in range(len(words)) for b in range(a + 1, len(words)) if _near(words[a], words[b])
                and min(len(words[a]), len(words[b])) == lam and lo <= prefix(words[a], words[b]) < hi]
        assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == want


def test_vocabulary_equals_brute_force(spark):
    rnd = random.Random(3)
    pool = [w for w in _vocab(60, 9)] + ["ÀÉÎ×÷ÿñßtail", "MIXEDcase", "short", "ſharpſ", "x" * 9000, "Ωmegaaaa"]
    rows = [(rnd.choice([None, *range(400)]), " ,\n".join(rnd.choice(pool) for _ in range(40))) for _ in range(300)]
    rows += [(1, None), (2, ""), (3, "1234 ..."), (5, "again again again " * 3), (5, "again again again " * 3)]
    rows += [(9, "veryfrequentword " * 5000)]
    found = spelling.runs(docs(spark, rows, clash=True))
    got = spelling.vocabulary(found.select(spelling.misspelt(found).alias("word")))
    want = _words(rows)
    assert {r["word"]: r["n"] for r in got.collect()} == want and any(len(w) > 8000 for w in want)
    assert any(w not in {p.lower() for p in pool} for w in want) or len(want) > 10


def test_empty_vocabulary(spark):
    found = spelling.runs(docs(spark, []))
    assert spelling.variants(spelling.vocabulary(found.select(spelling.misspelt(found).alias("word")))).collect() == []
    one = spark.createDataFrame([("oneword", 5), (None, 3)], "word string, n long")
    assert [tuple(r) for r in spelling.variants(one).collect() if r["word"]] == [("oneword", None, "oneword", 5, 0, None)]
