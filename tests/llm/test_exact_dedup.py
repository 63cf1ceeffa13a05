import hashlib
import random
import re

import pytest

from pradera.llm import exact_dedup

from .helpers import docs


def _brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in rows]
    groups = {}
    for i, t in enumerate(norm):
        groups.setdefault(t, []).append(i)
    out = []
    for t, members in groups.items():
        best = min(members, key=lambda i: (-len(rows[i][1] or ""), 1 << 63 if rows[i][0] is None else rows[i][0], i))
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(rows[i][0], rows[best][0], len(members), i == best, sha) for i in members]
    return sorted(map(str, out))


def _rows(n, seed):
    rnd = random.Random(seed)
    texts = ["a b c", "abc", " a\tb\nc ", "abc\x0b\x0c\r", "", " \n", None, "a bc", "é t é", "été", "x" * 70_000,
             "x " * 70_000, "\U0001f600 a", "\U0001f600a"]
    texts += ["".join(rnd.choice("ab c") for _ in range(rnd.randint(1, 9))) for _ in range(n)]
    ids = list(range(n)) + [None, None, 3, 3]
    rows = [(rnd.choice(ids), rnd.choice(texts)) for _ in range(n)]
    return rows + [(n + i, "the hot text") for i in range(n // 2)] + [(7, "again"), (7, "again")]


@pytest.mark.parametrize("limits", [
    {},
    {"page_bytes": 200, "bucket_bytes": 300, "owner_bytes": 2_000},
    {"page_bytes": 100, "bucket_bytes": 100, "owner_bytes": 500, "chain_bytes": 1_000},
    {"page_bytes": 300, "bucket_bytes": 100, "owner_bytes": 400, "key_bits": 2},  # keys collide, buckets can't split
    {"page_bytes": 100, "chain_bytes": 2_000, "key_bits": 1},                     # nor can chains become short
])
def test_duplicates_equal_brute_force(spark, limits):
    rows = _rows(300, len(limits))
    got = exact_dedup.duplicates(docs(spark, rows, clash=True).repartition(5), **limits)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(str(tuple(r)) for r in got.collect()) == _brute(rows)


def test_empty_table(spark):
    assert exact_dedup.duplicates(docs(spark, [])).collect() == []


def test_a_page_holds_equal_rows_once(spark):
    df = docs(spark, [(i, "copy  of a text") for i in range(500)]).coalesce(1)
    p = exact_dedup.pages(df)
    assert p.where("body is not null").count() == 1 and p.count() == 500


def test_directory_doubles_until_buckets_fit(spark):
    rows = [(i << 53, 100) for i in range(1024)] + [(5 << 53, 5_000)]  # one key can't be split
    d = exact_dedup.directory(spark.createDataFrame(rows, "key long, bytes long"), 2, 12, 900).collect()
    deep = max(r["depth"] for r in d)
    assert deep == 12 and all(r["bytes"] <= 900 for r in d if r["depth"] < deep)
    assert sum(r["bytes"] for r in d) == 102_400 + 5_000
    spans = sorted((r["key"], r["key"] + (1 << (63 - r["depth"]))) for r in d if r["depth"] < deep)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    # a bucket is only split if it was overfull
    load = {}
    for k, b in rows:
        for depth in range(13):
            load[depth, k >> (63 - depth)] = load.get((depth, k >> (63 - depth)), 0) + b
    assert all(r["depth"] == 2 or load[r["depth"] - 1, r["key"] >> (64 - r["depth"])] > 900 for r in d)
