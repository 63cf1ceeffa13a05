import hashlib
import random
import zlib

import pytest

from pradera.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def _rebuilt(rows):
    seqs = {}
    order = sorted((r for r in rows if r[0] is not None),
                   key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    for c, _, role, text in order:
        seqs.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(seqs.get(c - c % 100, [])[:h] + own[h:])
    return out


def _brute(seqs):
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    saved, leaves = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        k = kids.get(p, [])
        leaves[p] = sum(leaves[x] for x in k) if k else 1
        saved[p] = sum(saved[x] for x in k) + ((len(nodes[p]) - 1) * len(p[-1][1]) if p else 0)
    rows = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(seqs[c]) == len(p))
        rows.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids.get(p, [])),
                     leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows)


def _rows(seed):
    rnd = random.Random(seed)
    rows = []
    for c in range(0, 330, 1 if seed % 2 else 3):
        if c % 100 == 0 and c % 200:
            continue  # no conversation to take the opening from
        n = rnd.choice([1, 1, 2, 3, 4, 5, 6, 7, 9])
        for t in range(n):
            turn = rnd.choice([t, t, t, t, None, 1])
            rows.append((c, turn, rnd.choice(["user", "bot", None]), rnd.choice(["", "a", "bb", None, "été", "b\x00"])))
    rows += [(1000 + c, t, "user", "copy") for c in range(60) for t in range(7)]     # equal conversations
    rows += [(2000, t, "user", str(t % 3)) for t in range(150)]                      # a long one, and with its end cut
    rows += [(2100, t, "user", str(t % 3)) for t in range(140)]
    rows += [(None, 1, "user", "x"), (3001, 5, "user", "one turn"), (3001, 5, "user", "one turn")]
    rnd.shuffle(rows)
    return rows


def _both(spark, rows, segment):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'own' as digest", "7 as pos", "0 as depth", "1 as layer")
    turns, convs = prefix_trie.rebuilt(prefix_trie.ordered_turns(df.repartition(3)))
    got = prefix_trie.trie(turns, convs, segment)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                           "ends_sha256"]
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("seed, segment, batch", [(1, 128, 10_000), (2, 2, 7), (3, 3, 40), (5, 5, 1)])
def test_trie_equals_brute_force(spark, seed, segment, batch):
    rows = _rows(seed)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))  # small blocks: many boundaries
    try:
        got = _both(spark, rows, segment)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == _brute(_rebuilt(rows))


def test_empty_table_and_conversations_without_turns(spark):
    assert _both(spark, [], 128) == []
    none = [c for c in range(1, 60) if zlib.crc32(str(c).encode()) % 6 > 1][:5]  # one turn, which the opening replaces
    rows = [(c, 0, "user", "x") for c in none]
    sha = hashlib.sha256(",".join(map(str, none)).encode()).hexdigest()
    assert _both(spark, rows, 128) == [(none[0], 0, None, 5, 0, 1, 0, sha)]


def test_long_lists_of_ends_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 16)
    rows = [(c, t, "u", "same") for c in range(1, 400) if c % 100 for t in range(8)]
    assert _both(spark, rows, 128) == _brute(_rebuilt(rows))
