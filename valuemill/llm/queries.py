"""The registered queries of this folder, opN_<name>, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuemill.llm import bpe, line_dedup, mixing, ngram_join, prefix_trie, pseudo_lm, quality_fm, secret_scan, sharding, streaming_dedup, structure_repair, token_counts, vector_topk
from valuemill.llm.common import table
from valuemill.session import sf_path


def op1_fm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = quality_fm.train(docs, table(spark, sf_dir, "labels"))
    return quality_fm.scored(docs, model, threshold=0.7, keep=["doc_id"]).select(
        "doc_id", quality_fm.held_out().alias("held_out"), F.col("fm_score").alias("score"), F.col("fm_predicted").alias("predicted"))


def op2_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.histogram_shards(table(spark, sf_dir, "documents"), shards=24)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op3_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path())
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_masked_pseudo_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pseudo_lm.scored(docs, pseudo_lm.train(docs), shares=pseudo_lm.word_shares(docs))


def op5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixed(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "source", "lang", "mix_topic", "mix_tokens", "mix_weight", "mix_probability", "mix_sampled")


def op6_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.length_report(table(spark, sf_dir, "documents"), tokenizer_path(), by="source")


def op7_streaming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sf_path(sf_dir, "documents")
    dedup = streaming_dedup.StreamingDedup(spark)
    dedup.advance(path)
    return dedup.result(path)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.drop_frequent_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), threshold=10, shortest=1)
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op10_norm_sorted_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_topk.top_inner_products(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", secret_scan.is_base)
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in secret_scan.BASE_KINDS]
    return rows.select("doc_id", *counts, F.sha2(secret_scan.listed(base), 256).alias("base_sha256"), secret_scan.listed(F.col("spans")).alias("spans"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return structure_repair.repair(rows, structure_repair.damaged(rows))


QUERIES = {f.__name__: f for f in (op1_fm_quality, op2_histogram_shards, op3_chunk_bpe, op4_masked_pseudo_lm, op5_mixture, op6_length_histogram, op7_streaming_dedup, op8_line_dedup, op9_ngram_join, op10_norm_sorted_topk,
                                  op11_prefix_trie, op12_secret_scan, op13_structure_repair)}

ORACLE_SQL = {
    "op2_histogram_shards": sharding.SHARD_SQL,
    "op7_streaming_dedup": streaming_dedup.DEDUP_SQL,
    "op8_line_dedup": line_dedup.LINE_SQL,
    "op10_norm_sorted_topk": vector_topk.TOPK_SQL,
    "op11_prefix_trie": prefix_trie.TRIE_SQL,
    "op13_structure_repair": structure_repair.REPAIR_SQL,
}
