import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pradera.llm import language_id, quality
from pradera.llm.common import read

from .helpers import CLASHING, docs

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def quality_model(spark):
    return quality.fit(read(spark, SF, "documents"), read(spark, SF, "labels"))


@pytest.fixture(scope="module")
def language_model(spark):
    return language_id.fit(read(spark, SF, "documents"))


def test_quality_on_held_out_rows(spark, quality_model):
    d = read(spark, SF, "documents")
    got = quality.classify(d, quality_model).join(read(spark, SF, "labels"), "doc_id").where("held_out").toPandas()
    assert ((got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5) == 0)).all()
    right = got.predicted == got.quality
    assert right.mean() > 0.9 and got.score.between(0, 1).all()
    assert right[got.quality == 1].mean() > 0.95  # clean documents stay
    assert right[got.quality == 0].mean() > 0.7


def test_language_on_held_out_rows(spark, language_model):
    got = language_id.classify(read(spark, SF, "documents"), language_model).join(
        read(spark, SF, "documents").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert ((got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4) == 2)).all()
    assert (got.lang_pred == got.lang).mean() > 0.97 and got.score.between(0, 1).all()


def _odd(spark, clash=False):
    rows = [(1, None), (2, ""), (3, "12 !! 34"), (4, "the and of " * 40_000), (5, "the and of the"),
            (5, "the and of the"), (None, "the and of the")]
    return docs(spark, rows, clash)


def test_quality_of_odd_rows(spark, quality_model):
    got = quality.classify(_odd(spark, clash=True), quality_model)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[1].score == by[2].score and by[None].held_out
    kept = quality.keep_good(_odd(spark, clash=True), quality_model)
    assert kept.columns == _odd(spark, clash=True).columns
    assert kept.count() == sum(r.predicted for r in rows)
    assert all(r[c] == f"own {c}" for r in kept.collect() for c in CLASHING)


def test_language_of_odd_rows(spark, language_model):
    rows = language_id.classify(_odd(spark, clash=True), language_model).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 7
    assert [by[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and by[3].score == 0
    assert by[5].lang_pred == by[None].lang_pred != "und" and by[None].held_out
    kept = language_id.keep_languages(_odd(spark, clash=True), language_model)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["4", "5", "5", "None"]


def test_numbers_are_no_letters(spark, language_model):
    rows = [(1, "½ ²"), (2, "①②"), (3, "Ⅷ ٣ 一"), (4, "_ 12 ..."), (5, "é")]
    got = {r.doc_id: r.lang_pred for r in language_id.classify(docs(spark, rows), language_model).collect()}
    assert got[1] == got[2] == got[4] == "und" and got[3] != "und" and got[5] != "und"


def test_without_anything_to_learn_from(spark):
    empty = docs(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit(empty, labels) is None and language_id.fit(empty) is None
    some = docs(spark, [(1, "a word"), (2, None)])
    assert {r.score for r in quality.classify(some, None).collect()} == {0.5}
    assert {r.lang_pred for r in language_id.classify(some, None).collect()} == {"und"}
    assert quality.classify(empty, None).count() == language_id.classify(empty, None).count() == 0


def test_labels_that_contradict_or_lack_values_are_not_learned(spark):
    d = docs(spark, [(i, f"word {i} " * 20, "xx") for i in range(200)])
    lab = [(i, i % 2, 0) for i in range(100)] + [(i, 1 - i % 2, 0) for i in range(100)] + [(None, 1, 0), (150, None, 0)]
    assert quality.fit(d, spark.createDataFrame(lab, "doc_id long, quality int, toxic int")) is None


def test_presence_kernel_is_what_it_says():
    texts = ["Abcab", "abd", "zz"]
    rows = [(t, "x" if i else "y") for i, t in enumerate(texts)]
    m = language_id.fit_rows(rows)

    def spectrum(t):
        t = t.lower()
        return {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    k = language_id._kernel(texts, m.column, m.landmarks)
    order = [t for lang in m.languages for t, x in rows if x == lang]
    for i, a in enumerate(texts):
        for j, b in enumerate(order):
            sa, sb = spectrum(a), spectrum(b)
            assert np.isclose(k[i, j], len(sa & sb) / np.sqrt(len(sa) * len(sb)), atol=1e-6)


def test_chunks_lose_no_ngram(monkeypatch):
    bins = lambda: set(np.concatenate(list(language_id.ngram_bins("the quick brown fox jumps"))).tolist())
    whole = bins()
    monkeypatch.setattr(language_id, "CHUNK", 4)
    assert bins() == whole


def test_fit_is_reproducible(spark):
    small = "/root/testdata/sf0.01"
    d, lab = read(spark, small, "documents"), read(spark, small, "labels")
    a, b = quality.fit(d, lab), quality.fit(d.orderBy(F.desc("doc_id")).repartition(5), lab)
    assert a == b
