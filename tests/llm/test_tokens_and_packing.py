import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pradera.llm import packing, token_counts
from pradera.llm.common import read

from .helpers import docs

PIECES, BYTES = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json")
ODD = [None, "", " ", "  a", "a  ", "▁", "<s>", "</s> x", "a\nb\tc", "漢字 ß 😀é", "\x00", "x" * 700, " " * 77 + "é",
       "<|endoftext|>", "it's  <|endoftext|>it", "the and of " * 20_000]


def _bytes_encoder():
    return packing.Encoder(packing.vocabulary(open(BYTES, encoding="utf-8").read()))


def _random_texts(n, seed=4):
    rnd = random.Random(seed)
    letters = [*"aabbtheinr .,!\n▁  ß漢😀012<s>'_-", "  ", "the", "tion", " the ", "<|endoftext|>"]
    return ["".join(rnd.choices(letters, k=rnd.randint(0, 50))) for _ in range(n)]


def test_token_counts_are_the_library_s():
    sp, m = sentencepiece.SentencePieceProcessor(model_file=PIECES), token_counts.load(PIECES)
    texts = _random_texts(4000) + ODD + [" " * k for k in range(1, 70)]
    assert token_counts.count_text_list(texts, m) == [len(sp.encode(t or "")) for t in texts]


def test_long_runs_of_spaces_are_the_library_s():
    sp, m = sentencepiece.SentencePieceProcessor(model_file=PIECES), token_counts.load(PIECES)
    runs = [*range(1, 300), 1000, 4095, 4096, 4097, 5000, 65_536, 65_552, 70_000, 1_000_000]
    texts = [t for n in runs for t in (" " * n, "ab" + " " * n + "cd", "x" + " " * n)]
    assert token_counts.count_text_list(texts, m) == [len(sp.encode(t)) for t in texts]


def test_long_texts_are_counted_in_parts(monkeypatch):
    sp, m = sentencepiece.SentencePieceProcessor(model_file=PIECES), token_counts.load(PIECES)
    monkeypatch.setattr(token_counts, "LONG_TEXT", 9)
    texts = _random_texts(800, 5) + ["the cat  sat on\na mat   " * 9, "a" * 50, " " * 50, "a b c d e f g h i j k"]
    assert len(token_counts._parts(texts[-1])) > 1
    assert token_counts.count_text_list(texts, m) == [len(sp.encode(t)) for t in texts]


def test_long_words_by_rounds_and_by_heap():
    sp, m = sentencepiece.SentencePieceProcessor(model_file=PIECES), token_counts.load(PIECES)
    rnd = random.Random(1)
    words = ["".join(rnd.choices("abetnrsé", k=rnd.randint(200, 900))) for _ in range(60)]
    want = [len(sp.encode(w)) for w in words]
    assert [token_counts.merge_long("▁" + w, m)[0] for w in words] == want
    assert token_counts.merge_ragged(["▁" + w for w in words], m)[0].tolist() == want


def test_ragged_merges_stop_for_a_better_pair():
    # after a+b, the pair (ab, a) ranks before the second a+b: only the leftmost merge may go first
    m = token_counts.from_scores({"▁": -9.0, "a": -10.0, "b": -11.0, "ab": -3.0, "aba": -1.0})
    got, _ = token_counts.merge_ragged(["▁abab"], m)
    assert got[0] == token_counts.merge_long("▁abab", m)[0] == 3  # ▁, aba, b


def test_token_count_rows(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    d = docs(spark, [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "a b")], clash=True)
    rows = token_counts.count_tokens(d, PIECES).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        t = "a b" if r.doc_id is None else ODD[r.doc_id] or ""
        n = len(sp.encode(t))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 4096)
    assert token_counts.count_tokens(docs(spark, []), PIECES).count() == 0


def test_token_counts_of_the_table(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    d = read(spark, "/root/testdata/sf0.001", "documents")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(d, PIECES).collect()}
    assert got == {r.doc_id: len(sp.encode(r.text)) for r in d.collect()}


def test_ids_are_the_library_s():
    e, t = _bytes_encoder(), Tokenizer.from_file(BYTES)
    assert e.fast is not None
    for x in _random_texts(3000, 8) + [o for o in ODD if o]:
        assert np.concatenate(list(e(x))).tolist() == t.encode(x, add_special_tokens=False).ids


def test_long_texts_are_cut_where_a_word_ends(monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 7)
    e, t = _bytes_encoder(), Tokenizer.from_file(BYTES)
    x = "the cat's  tail , it's\n\nred and blue  yes" * 9
    parts = list(e(x))
    assert len(parts) > 5 and np.concatenate(parts).tolist() == t.encode(x, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    " " * 1_000_000, "\n" * 1_000_000, "\t" * 3_000_000, " \n\t" * 400_000, "word" + " " * 1_000_000 + "next",
    "a" + " " * (packing.BLANKS + 1) + "b", "a" + " " * packing.BLANKS + "b", "漢字仮名" * 300_000], ids=lambda t: f"{t[:3]!r}")
def test_long_runs_are_the_library_s(text):
    ids = np.concatenate(list(_bytes_encoder()(text))).tolist()
    assert ids == Tokenizer.from_file(BYTES).encode(text, add_special_tokens=False).ids


def test_end_ids_follow_rows_that_end(spark):
    from pyspark.sql import functions as F
    d = docs(spark, [(1, "a b"), (2, "c d"), (3, ""), (4, None), (5, "e")]).coalesce(1)
    got = packing.pack(d, BYTES, ends=F.col("doc_id").isin(2, 4)).collect()
    last = {r.doc_id: np.frombuffer(r.ids, "<u4")[-1] == 1 for r in got}
    assert last == {1: False, 2: True, 4: True, 5: False}  # a row without ids and end has no piece
    assert {r.doc_id: r.doc_tokens for r in got}[4] == 1


def test_other_vocabularies_run_in_the_library():
    path = P.path("word_bpe_49k.json")
    e = packing.Encoder(packing.vocabulary(open(path, encoding="utf-8").read()))
    assert e.fast is None
    assert list(e("Some Words"))[0].tolist() == Tokenizer.from_file(path).encode(
        "Some Words", add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_cuts_are_the_cheapest(seed):
    rnd = np.random.default_rng(seed)
    window, n = 16, int(rnd.integers(20, 120))
    doc = np.unique(np.r_[rnd.integers(1, n + 1, 4), n])
    pos, cost = packing.candidates(n, doc, np.unique(rnd.integers(1, n + 1, 9)), window, True)
    # every position of the last window, so all gaps are short there; thin out nothing else
    ends = packing.best_cuts(pos, cost, window, True)
    f = {0: 0.0}
    for j, c in zip(pos.tolist()[1:], cost.tolist()[1:], strict=True):
        f[j] = min((f[i] + packing.OPEN_COST + float(packing.padding(j - i, window)) + c
                    for i in f if 0 < j - i <= window), default=float("inf"))
    start, spent, price = 0, 0.0, dict(zip(pos.tolist(), cost.tolist(), strict=True))
    for e in ends.tolist():
        assert 0 < e - start <= window
        spent += packing.OPEN_COST + float(packing.padding(e - start, window)) + price[e]
        start = e
    assert start == n and np.isclose(spent, f[n])


def _check_pieces(rows, texts, window):
    t = Tokenizer.from_file(BYTES)
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert len(r.ids) == 4 * r.length
    for i, text in texts.items():
        ps = sorted(by_doc[i], key=lambda r: r.start)
        ids = np.frombuffer(b"".join(p.ids for p in ps), dtype="<u4").tolist()
        want = t.encode(text or "", add_special_tokens=False).ids + [1]
        assert ids == want and all(p.doc_tokens == len(want) for p in ps)
        assert [p.start for p in ps] == np.cumsum([0, *[p.length for p in ps]])[:-1].tolist()
    sizes = []
    for s in by_seq.values():
        s.sort(key=lambda r: r.offset)
        assert [p.offset for p in s] == np.cumsum([0, *[p.length for p in s]])[:-1].tolist()
        sizes.append(sum(p.length for p in s))
    assert max(sizes) <= window
    return int(packing.padding(np.array(sizes), window).sum()) / sum(sizes)


def test_packing_odd_rows(spark):
    texts = dict(enumerate(ODD))
    d = docs(spark, list(texts.items()), clash=True)
    _check_pieces(packing.pack(d.coalesce(1), BYTES).collect(), texts, 2048)
    _check_pieces(packing.pack(d.coalesce(1), BYTES, window=64).collect(), texts, 64)
    twice = packing.pack(docs(spark, [(7, "a b c"), (7, "a b c"), (None, "x")]), BYTES).collect()
    assert sorted((str(r.doc_id), r.length) for r in twice) == [("7", 4), ("7", 4), ("None", 2)]
    assert packing.pack(docs(spark, []), BYTES).count() == 0


def test_packing_the_table_has_little_padding(spark, monkeypatch):
    d = read(spark, "/root/testdata/sf0.01", "documents")
    texts = {r.doc_id: r.text for r in d.collect()}
    assert _check_pieces(packing.pack(d, BYTES).collect(), texts, 2048) < 0.01


def test_groups_carry_over():
    import pyarrow as pa
    v, group = packing.vocabulary(open(BYTES, encoding="utf-8").read()), packing.GROUP
    packing.GROUP = 500
    try:
        texts = {i: "one sentence here. " * (i * 17) for i in range(12)}
        b = pa.RecordBatch.from_arrays([pa.array(list(texts), pa.int64()), pa.array(list(texts.values()))],
                                       names=["doc_id", "text"])
        out = pa.Table.from_batches(packing._pack_partition(iter([b]), v, 1, 64, pa.int64(), 0)).to_pandas()
    finally:
        packing.GROUP = group
    _check_pieces(list(out.itertuples()), texts, 64)
