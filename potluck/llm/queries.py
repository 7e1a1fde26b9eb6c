"""The registered queries ``opN_*`` over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from potluck.llm import (bpe, cotraining, dictionary_codes, html, langid, outliers, packing, sharding, simhash, sql_outliers, sql_vectors,
                         topk, toxicity, viterbi, walsh)
from potluck.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


@query("op8_simhash_near_duplicates")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (3-word shingles, 3 bits)."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from four fifths of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op7_quality_cotraining")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by co-training of two views."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    model = cotraining.learn(docs, table(spark, sf_dir, "labels"))
    return cotraining.score(docs, model).select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"),
        "score", "text_score", "meta_score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        (F.col("score") >= 0.5).alias("kept"))


@query("op3_packing_nnls")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in windows of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


_TOP_K_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM (SELECT DISTINCT vec_id, e FROM v) q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""


@query("op1_exact_top_k", _TOP_K_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every vector whose id divides by 50."""
    return topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0, k=5)


@query("op2_rendezvous_sharding")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal weight by the key law."""
    return (sharding.shard_rows(table(spark, sf_dir, "documents"), "doc_id", "text", [1.0] * 24)
            .select(F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"))


@query("op4_byte_level_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded by the ranks and decoded again, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
            .select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))


@query("op5_unigram_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of unigram pieces of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return viterbi.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).select("doc_id", "n_tokens")


@query("op6_robust_outliers", sql_outliers.build())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and robust outliers of every document, DataFrame functions only."""
    return outliers.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op10_main_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op11_dictionary_codes", sql_vectors.codes())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 codes of 64 entries for every vector, after two rounds."""
    return dictionary_codes.codes(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


@query("op12_language_pieces")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned from three quarters of the documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rest = F.crc32(F.col("doc_id").cast("string")) % 4
    model = langid.learn(docs, rest != 2, public_tokenizers.path("piece_bpe_32k.model"))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op13_walsh_clusters", sql_vectors.clusters())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 centroids over all vectors of 64 components, ten rounds."""
    return walsh.assign(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
