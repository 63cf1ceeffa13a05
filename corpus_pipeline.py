"""Corpus pipeline: quality, language, near duplicates, source mix, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pradera.llm import jaccard_join, language_id, mixing, packing, quality
from pradera.llm.common import read, stored

MIX_BLOCK = 1024  # words of a block of the mix, about a training sequence
LANGUAGE_SCORE = 0.35  # texts whose best language scores less are of no determined language


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts."""
    return quality.keep_good(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the string-kernel classifier determines."""
    return language_id.keep_languages(docs, language_id.fit(docs), LANGUAGE_SCORE)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: the smallest id."""
    return jaccard_join.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' words as the mix of sources takes them: a document once per slot that holds words of it.

    Documents are cut only where a block ends; ``n_chars`` is null for a piece that its document goes on behind."""
    return mixing.mix_documents(docs, block=MIX_BLOCK, marked=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences: their ids, where they lie in the document and the sequence.

    The end id follows what ends a document, as the mix marks it."""
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), ends=F.col("n_chars").isNotNull())
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("quality", good_documents), ("language", known_language), ("near_duplicates", one_of_each),
          ("source_mix", mixed), ("packing", packed)]

# trained classifiers, the chosen-path join and packing have no SQL form: tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
