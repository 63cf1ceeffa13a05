import base64
import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from pradera.llm import licenses, mixing, warc
from pradera.session import scratch_path

from .helpers import docs

PAGES = "page_id long, url string, html string"


def _pages(spark):
    rows = [(1, "u1", "<p>a</p>"), (2, "u2", "<p>a</p>"), (9, None, "<p>a</p>"), (3, "u\r\nX: y", "é"), (4, "u4", ""),
            (5, "u5", None), (6, "u6", "long " * 50_000), (None, "u7", "z"), (7, "u7", "z"), (8, "u8", "q"), (8, "u8", "q")]
    return rows, spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit("own")).withColumn("sha1", F.lit(1))


def test_archive_round_trip(spark):
    rows, pages = _pages(spark)
    path = scratch_path(spark, "t-warc")
    warc.write_archive(pages, path)
    got = warc.archived(spark, path).collect()
    assert len(got) == len(rows)
    payload = defaultdict(list)
    for i, _, h in rows:
        payload[h or ""].append(i)
    for r in got:
        h = next(h or "" for i, _, h in rows if i == r.page_id)
        b = h.encode()
        assert r.payload_bytes == len(b)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(b).digest()).decode()
        first = max(i for i in payload[h] if i is not None)
        if r.page_id == first:
            assert (r.record_type, r.refers_to) == ("response", None)
        else:
            assert (r.record_type, r.refers_to) == ("revisit", first)
    stored = warc.read_payloads(spark, path).collect()
    assert len(stored) == len(payload) and all(r.verified for r in stored)  # every payload once
    records = warc.reconstruct(spark, path).collect()
    for r in records:
        h = next(h or "" for i, _, h in rows if i == r.page_id)
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        assert bytes(r.payload).decode() == h and rest.endswith(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        body = rest[:-4]
        assert int(fields["Content-Length"]) == len(body)
        assert body == (b"" if fields["WARC-Type"] == "revisit" else h.encode())
        assert "X" not in fields  # a line break in a url ends no header line
    assert len(records) == len(rows)


def test_archive_with_a_least_size(spark):
    _, pages = _pages(spark)
    path = scratch_path(spark, "t-warc")
    warc.write_archive(pages, path, least_bytes=5)
    kinds = {r.page_id: r.record_type for r in warc.archived(spark, path).collect()}
    assert kinds[1] == kinds[2] == "revisit" and kinds[4] == kinds[5] == kinds[None] == "response"


def test_empty_archive(spark):
    path = scratch_path(spark, "t-warc")
    warc.write_archive(spark.createDataFrame([], PAGES), path)
    assert warc.archived(spark, path).count() == warc.reconstruct(spark, path).count() == 0


def test_changed_payload_is_noticed(spark):
    _, pages = _pages(spark)
    path = scratch_path(spark, "t-warc")
    warc.write_archive(pages, path)
    p = spark.read.parquet(f"{path}/payloads")
    other = scratch_path(spark, "t-warc")
    p.withColumn("payload", F.concat("payload", F.lit(b"!"))).write.parquet(f"{other}/payloads")
    assert not any(r.verified for r in warc.read_payloads(spark, other).collect())


def test_records_of_a_damaged_archive_stay(spark):
    rows, pages = _pages(spark)
    path, other = scratch_path(spark, "t-warc"), scratch_path(spark, "t-warc")
    warc.write_archive(pages, path)
    spark.read.parquet(f"{path}/records").write.parquet(f"{other}/records")
    p = spark.read.parquet(f"{path}/payloads").where(F.col("payload") != F.lit(b"q"))  # one is missing
    changed = F.when(F.col("payload") == F.lit("é".encode()), F.lit(b"e")).otherwise(F.col("payload"))
    p.withColumn("payload", changed).write.parquet(f"{other}/payloads")
    got = warc.archived(spark, other).collect()
    assert len(got) == len(rows) and all(r.payload_digest for r in got)
    assert sorted(r.page_id for r in got if not r.verified) == [3, 8, 8]
    assert all((r.payload_bytes is None) == (not r.verified) for r in got)
    records = warc.reconstruct(spark, other).collect()
    assert len(records) == len(rows) and sorted(r.page_id for r in records if not r.verified) == [3, 8, 8]
    assert all(r.payload is None and r.record is None for r in records if r.page_id in (3, 8))


# --- licences ------------------------------------------------------------------------------------

MIT = next(t for n, t in licenses.LICENCES if t.startswith("Permission is hereby"))


@pytest.mark.parametrize("text, names, whole", [
    ("Released under the MIT License.", "MIT", True),
    ("RELEASED -- under the MIT licence!!", "MIT", True),
    ("Copyright (c) 2020 Someone\nReleased under the MIT License.\nAll rights reserved.", "MIT", True),
    ("Some prose. Licensed under CC BY-NC 4.0. More prose.", "CC-BY-NC-4.0", False),
    ("MIT License\n\nCopyright 2020-2024 A. Body\n\n" + MIT.upper().replace("COPYRIGHT HOLDERS", "Copyright Owners"),
     "MIT", True),
    (MIT, "MIT", True),
    ("x\n\n" + MIT.replace("\n\n", "\n") + "\n\ny", "MIT", False),
    ("Released under the MIT License or so.", "", False),
    (MIT[:-40], "", False),
    ("Licensed under CC BY 4.0.\nSPDX-License-Identifier: MIT", "CC-BY-4.0,MIT", False),
    (None, "", False), ("", "", False), ("\n \n.", "", False), ("word " * 100_000, "", False)])
def test_licence(spark, text, names, whole):
    r = licenses.scan(docs(spark, [(1, text)], clash=True), licenses.known_licences(spark)).first()
    assert (r.licences, r.whole_text, r.n_matches > 0) == (names, whole, names != "")


def test_neighbouring_spellings_are_all_replaced(spark):
    """Neighbours share the space between them."""
    text = spark.createDataFrame([("licence licence Licence",), ("per cent per cent",)], "text string")
    got = [r[0] for r in text.select(licenses.canonical(F.col("text"))).collect()]
    assert got == ["license license license", "percent percent"]
    known = spark.createDataFrame([("X", "A licence licence for all.")], "licence string, text string")
    rows = [(1, "A license license for all."), (2, "a licence license for all"), (3, "a license for all")]
    assert {r.doc_id: r.n_matches for r in licenses.scan(docs(spark, rows), known).collect()} == {1: 1, 2: 1, 3: 0}


def test_licence_rows(spark):
    d = docs(spark, [(1, "Released under the MIT License."), (1, "a\x01b"), (None, "Licensed under CC BY 4.0."), (2, "x")])
    got = {r.doc_id: r for r in licenses.scan(d, licenses.known_licences(spark)).collect()}
    assert len(got) == 3 and got[1].n_matches == 1 and got[None].licences == "CC-BY-4.0" and got[2].n_matches == 0
    assert licenses.scan(docs(spark, []), licenses.known_licences(spark)).count() == 0
    none = spark.createDataFrame([], "licence string, text string")
    assert licenses.scan(d, none).agg(F.sum("n_matches")).first()[0] == 0


def test_first_word_far_behind_blank_lines(spark):
    one = "Released under the MIT License. "
    d = docs(spark, [(1, "\n" * 520 + MIT), (2, "\n" * 520 + one), (3, "\n \t" * 900 + one)])
    got = licenses.scan(d, licenses.known_licences(spark)).collect()
    assert all((r.licences, r.whole_text) == ("MIT", True) for r in got) and len(got) == 3


@pytest.mark.parametrize("run", ["\n" * 2400, "\n. " * 2400, ". " * 2400, "\n \n." * 1200])
def test_long_runs_of_separators(spark, run):
    inside = MIT.replace("\n\n", run + "\n\n")
    d = docs(spark, [(1, run + MIT), (2, inside), (3, MIT + run), (4, run + inside + run), (5, "a" + run + "b")])
    got = {r.doc_id: r for r in licenses.scan(d, licenses.known_licences(spark)).collect()}
    assert all((got[i].licences, got[i].whole_text, got[i].n_matches) == ("MIT", True, 1) for i in range(1, 5))
    assert got[5].n_matches == 0


def test_full_texts_are_known(spark):
    full = {"BSD-2-Clause", "BSD-3-Clause", "Zlib", "BSL-1.0", "Unlicense", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1",
            "LGPL-3.0", "MPL-2.0", "CC0-1.0"}
    long = [(n, t) for n, t in licenses.LICENCES if len(t) > 600 and n in full]
    assert {n for n, _ in long} == full
    d = docs(spark, [(i, "Copyright (c) 2020 Someone\n\n" + t.upper()) for i, (_, t) in enumerate(long)])
    got = {r.doc_id: r for r in licenses.scan(d, licenses.known_licences(spark)).collect()}
    for i, (n, _) in enumerate(long):
        assert got[i].whole_text and n in got[i].licences.split(","), n


# --- mixing --------------------------------------------------------------------------------------

def test_permutation_is_a_bijection_and_runs_backwards(spark):
    for n in (1, 2, 3, 7, 64, 1000):
        d = spark.range(n).withColumn("n", F.lit(n).cast("long"))
        d = d.withColumn("keys", mixing.round_keys(F.lit("t"), F.col("n")))
        d = d.withColumn("y", mixing.permute(F.col("id"), F.col("n"), F.col("keys")))
        d = d.withColumn("x", mixing.permute(F.col("y"), F.col("n"), F.reverse("keys")))
        rows = d.select("id", "x", "y").collect()
        assert sorted(r.y for r in rows) == list(range(n)) and all(r.x == r.id for r in rows)
        assert n < 64 or sum(r.y == r.id for r in rows) < n / 4


def _targets(sizes):
    """Share by weight, stop at three times the size, share the rest again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, out, open_ = sum(sizes.values()), {}, set(names)
    while open_:
        left = total - sum(out.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return out | share
        out |= {s: 3.0 * sizes[s] for s in over}
        open_ -= over
    return out


def _mix_rows():
    rows, n = [], 0
    for s, k, words in (("b", 40, 300), ("a", 3, 100), (None, 20, 70), ("é", 1, 9), ("Z", 5, 0), ("c", 60, 500)):
        for j in range(k):
            text = " ".join(f"w{n}x{i}" for i in range(words + j)) if words else ("", None, " \n\t")[j % 3]
            rows.append((n, text, "en", s))
            n += 1
    return rows + [rows[0], (None, "a b c", None, "b"), (500, "u v\x1cw x", None, "c")]


def test_mix(spark):
    rows = _mix_rows()
    d = docs(spark, rows, clash=True)
    got = mixing.mix_counts(d).collect()
    assert len(got) == len(rows)
    words = lambda t: len([w for w in (t or "").replace("\t", " ").replace("\n", " ").split(" ") if w])
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += words(t)
    want, taken = _targets(dict(sizes)), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= mixing.BLOCK, s
    again = mixing.mix_counts(d.repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_documents_hold_what_is_counted(spark):
    rows = [r for r in _mix_rows() if r[0] != 0]  # ids once
    d = docs(spark, rows, clash=True)
    out = mixing.mix_documents(d)
    assert out.columns == d.columns
    taken, texts = defaultdict(int), {r[0]: r[1] for r in rows}
    for r in out.collect():
        words = r.text.split()
        taken[r.doc_id] += len(mixing_words(r.text))
        source = (texts[r.doc_id] or "").split()
        it = iter(source)
        assert all(w in it for w in words)  # the document's words, in their order
        assert r.n_chars == len(r.text) and r.score == "own score"
    for r in mixing.mix_counts(d).collect():
        assert taken[r.doc_id] == r.taken


def test_shards_hold_multinomial_counts(spark):
    rows = _mix_rows()
    d = docs(spark, rows)
    _, _, _, sources = mixing._plan(d, 0, mixing.BLOCK, 3)
    s = mixing.slots(sources, 4, shard_blocks=64).collect()
    about = {r.sid: r for r in sources.collect()}
    assert len(s) == sum(r.slots for r in about.values())
    assert len({(r.shard, r.place) for r in s}) == len(s) and max(r.place for r in s) == 63
    used = defaultdict(int)
    for r in s:
        assert 0 <= r.block < about[r.sid].blocks
        used[r.sid, r.block] += 1
    for (sid, _), n in used.items():
        full = about[sid].slots // about[sid].blocks
        assert full <= n <= full + 1 <= 4 and n <= 3
    big = max(about, key=lambda i: about[i].slots)
    whole = [sum(r.sid == big for r in s if r.shard == k) for k in range(len(s) // 64)]
    share = 64 * about[big].slots / len(s)
    assert len(set(whole)) > 1 and all(abs(w - share) < 6 * share ** 0.5 for w in whole)


def test_shards_hold_their_blocks_in_order(spark):
    rows = [r for r in _mix_rows() if r[0] != 0]  # ids once
    d = docs(spark, rows, clash=True)
    plan = mixing._plan(d, 0, mixing.BLOCK, 3)
    at = defaultdict(list)
    for r in mixing.positions(plan[1], plan[2], plan[3]).where("size > 0").collect():
        text = next(t for i, t, *_ in rows if i == r.doc_id)
        for k, w in enumerate(mixing_words(text)):
            at[r.sid, (r.start + k) // mixing.BLOCK].append((r.start + k, w))
    got = [list(p) for p in mixing.mix(d, shard_blocks=16).rdd.glom().collect()]
    held = defaultdict(list)
    for part in got:
        assert [(r.shard, r.place, r.start) for r in part] == sorted((r.shard, r.place, r.start) for r in part)
        for r in part:
            assert r.text in next(t for i, t, *_ in rows if i == r.doc.doc_id)  # one contiguous piece
            held[r.shard, r.place].append(r)
    where = {(r.shard, r.place): (r.sid, r.block) for r in mixing.slots(plan[3], 4, shard_blocks=16).collect()}
    assert held.keys() == where.keys()
    for k, pieces in held.items():
        assert {(r.sid, r.block) for r in pieces} == {where[k]}
        assert [w for r in pieces for w in mixing_words(r.text)] == [w for _, w in sorted(at[where[k]])]
    whole = [s for s in {r.shard for p in got for r in p} if s < len(where) // 16]
    sids = lambda s: [where[s, p][0] for p in range(16)]
    assert sum(len(set(sids(s))) > 1 for s in whole) > len(whole) / 2  # sources lie among each other


def mixing_words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t)


def test_mixed_documents_come_by_shard_and_place(spark):
    d = docs(spark, [(i, " ".join(f"w{i}x{k}" for k in range(200)), "en", "ab"[i % 2]) for i in range(60)])
    want = Counter((r.doc.doc_id, r.text) for r in mixing.mix(d).collect())
    parts = mixing.mix_documents(d).rdd.glom().collect()
    got = [r for p in parts for r in p]
    assert Counter((r.doc_id, r.text) for r in got) == want
    assert all(len(r.text.split()) <= mixing.BLOCK for r in got)
    runs = 1 + sum(a.source != b.source for a, b in zip(got, got[1:], strict=False))
    assert runs > len(got) / 6  # no long runs of one source


@pytest.mark.parametrize("block", [64, 7])
def test_pieces_of_a_round_make_up_their_document(spark, block):
    """Joined in order they are the text, to the byte, and the last one is marked; repeated rows come as often."""
    text = " ".join(f"w{k}\n" * (1 + k % 3) for k in range(150)) + " \t\n"
    rows = [(i, f"\n d{i} " + text, "en", "s") for i in range(9)] + [(3, "\n d3 " + text, "en", "s")] + [
        (None, "one", "en", "s"), (None, "one", None, "s"), (7, " ", "en", "s")]
    got = mixing.mix(docs(spark, rows, clash=True), block=block).collect()  # one source: its target is its size
    whole = defaultdict(list)
    for r in got:
        whole[r.start].append((r.block, r.text, r.ends, r.doc.doc_id))
    assert Counter((p[0][3], "".join(t for _, t, _, _ in p)) for p in map(sorted, whole.values())) == Counter(
        (r[0], r[1]) for r in rows if r[1].strip())
    assert all([e for _, _, e, _ in sorted(p)] == [False] * (len(p) - 1) + [True] for p in whole.values())
    out = mixing.mix_documents(docs(spark, rows), block=block, marked=True).collect()
    assert Counter((r.text, r.n_chars) for r in out) == Counter((r.text, len(r.text) if r.ends else None) for r in got)


def test_nothing_that_grows_is_broadcast(spark):
    """Slots are a stored table, joined by its size, and counts read no text again."""
    d = docs(spark, _mix_rows())
    _, narrow, sizes, sources = mixing._plan(d, 0, mixing.BLOCK, 3)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = mixing.drawn(mixing.positions(narrow, sizes, sources).select("sid", "start", "size"), sources)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Broadcast" not in plan and "text" not in plan


def test_mix_of_nothing(spark):
    assert mixing.mix_counts(docs(spark, [])).count() == mixing.mix_documents(docs(spark, [])).count() == 0
    got = mixing.mix_counts(docs(spark, [(1, None), (2, "")])).collect()
    assert [(r.size, r.taken, r.target) for r in got] == [(0, 0, 0.0)] * 2


@pytest.mark.parametrize("name", ["op2_warc", "op3_licences", "op5_mixing"])
def test_oracle_sql(spark, name):
    from pradera.llm import queries
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = queries.queries()[name](spark, sf)
    rel = con.sql(queries.oracle_sql()[name])
    assert sorted(rel.columns) == sorted(df.columns)
    at = [rel.columns.index(c) for c in df.columns]
    norm = lambda row: tuple(round(v, 6) if isinstance(v, float) else v for v in row)
    assert sorted(map(str, map(norm, df.collect()))) == sorted(str(norm([r[i] for i in at])) for r in rel.fetchall())
