from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from pradera.llm import language_id, mixing, packing, quality
from pradera.llm.common import read, stored

from .helpers import components, docs, grams

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage."""
    d, out = read(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, d, SF), f"t-{name}")
        out.append((name, d, after))
        d = after
    return out


def test_stages_keep_the_columns(stages):
    assert [s[0] for s in stages] == ["quality", "language", "near_duplicates", "source_mix", "packing"]
    for name, before, after in stages[:-1]:
        assert after.dtypes == before.dtypes, name


def test_quality_stage(spark, stages):
    _, before, after = stages[0]
    model = quality.fit(before, read(spark, SF, "labels"))
    rows = before.collect()
    s = quality.score_texts([r.text for r in rows], model)
    assert Counter(after.collect()) == Counter(r for r, x in zip(rows, s, strict=True) if x >= quality.THRESHOLD)


def test_language_stage(stages):
    _, before, after = stages[1]
    rows = before.collect()
    lang, s = language_id.predict_texts([r.text for r in rows], language_id.fit(before))
    assert Counter(after.collect()) == Counter(r for r, a, x in zip(rows, lang, s, strict=True)
                                               if a != "und" and x >= corpus_pipeline.LANGUAGE_SCORE)


def test_near_duplicate_stage(stages):
    _, before, after = stages[2]
    rows = sorted(before.collect(), key=lambda r: r.doc_id)
    sets = [grams(r.text) for r in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])]
    root = components(len(rows), pairs)
    assert Counter(after.collect()) == Counter(r for i, r in enumerate(rows) if root[i] == i)


def test_mix_stage(stages):
    _, before, after = stages[3]
    words = lambda t: len(mixing_words(t))
    taken = Counter()
    for r in after.collect():
        taken[r.doc_id] += words(r.text)
    want = {r.doc_id: r.taken for r in mixing.mix_counts(before, block=corpus_pipeline.MIX_BLOCK).collect()}
    assert {k: v for k, v in want.items() if v} == dict(taken)


def mixing_words(t):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", t)


def test_packing_stage(stages):
    _, before, after = stages[4]
    import public_tokenizers as P
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter()
    for r in before.collect():
        ids = t.encode(r.text, add_special_tokens=False).ids + [1] * (r.n_chars is not None)
        want.update((r.doc_id, i) for i in ids)
    got, seq = Counter(), Counter()
    for r in after.collect():
        got.update((r.doc_id, int(i)) for i in np.frombuffer(r.ids, dtype="<u4"))
        seq[r.sequence_id] += r.length
    assert got == want
    size = np.array(list(seq.values()))
    assert size.max() <= 2048 and packing.padding(size).sum() < 0.02 * size.sum()


def test_end_ids_follow_ends_of_documents_only(spark, stages):
    """Every document's last block is drawn as often as the packed corpus has end ids of it."""
    import public_tokenizers as P
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    _, before, _ = stages[3]
    _, mixed, packed = stages[4]
    texts = {r.doc_id: r.text for r in before.collect()}
    ends = Counter()
    own = Counter()  # the end id may be one of a text's own
    for r in mixed.collect():
        own[r.doc_id] += t.encode(r.text, add_special_tokens=False).ids.count(1)
        assert r.text in texts[r.doc_id] and (r.n_chars is None or r.n_chars == len(r.text))
        if r.n_chars is None:  # more of the document follows
            assert len(mixing_words(r.text)) < len(mixing_words(texts[r.doc_id]))
        else:
            assert texts[r.doc_id].endswith(r.text)
            ends[r.doc_id] += 1
    got = Counter()
    for r in packed.collect():
        got[r.doc_id] += int((np.frombuffer(r.ids, dtype="<u4") == 1).sum())
    assert any(r.n_chars is None for r in mixed.collect()) and got == ends + own


def test_run_is_the_chain(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == stages[-1][2].columns and got.count() == stages[-1][2].count()


def test_empty_documents(spark):
    d = docs(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        d = stored(stage(spark, d, SF), f"t-{name}")
        assert d.count() == 0
