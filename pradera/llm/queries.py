"""One query per operator over the shared tables, with production parameters and whole tables, and their oracle SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pradera.session import scratch_path

from . import (
    embedding_dedup,
    exact_dedup,
    jaccard_join,
    language_id,
    licenses,
    mixing,
    packing,
    permutation_index,
    prefix_trie,
    quality,
    spelling,
    token_counts,
    warc,
)
from .common import read


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archive(read(spark, sf_dir, "pages"), path)
    which = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    broken = F.raise_error(F.concat(F.lit("no intact payload for record "), which))
    size = F.when(F.col("verified"), F.col("payload_bytes")).otherwise(broken.cast("long"))
    return warc.archived(spark, path).select("page_id", size.alias("payload_bytes"), "payload_digest", "record_type",
                                             "refers_to")


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"), licenses.known_licences(spark))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(read(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language_id.classify(docs, language_id.fit(docs))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def op10_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = prefix_trie.rebuilt(prefix_trie.ordered_turns(read(spark, sf_dir, "conversations")))
    return prefix_trie.trie(turns, convs)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(read(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.runs(read(spark, sf_dir, "documents"))
    return spelling.variants(spelling.vocabulary(found.select(spelling.misspelt(found).alias("word"))))


QUERIES = {f.__name__: f for f in (
    op1_embedding_dedup, op2_warc, op3_licences, op4_packing, op5_mixing, op6_token_counts, op7_jaccard_join,
    op8_language_id, op9_quality, op10_permutation_index, op11_prefix_trie,
    op12_exact_dedup, op13_spelling)}
SQL = {"op2_warc": warc.sql(), "op3_licences": licenses.sql(), "op5_mixing": mixing.sql(),
       "op11_prefix_trie": prefix_trie.sql(), "op12_exact_dedup": exact_dedup.sql(), "op13_spelling": spelling.sql()}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
