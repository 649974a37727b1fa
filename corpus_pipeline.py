"""The corpus pipeline: quality, line deduplication, near duplicates, mixture, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet under
the shared checkpoint folder and rereads it as the next stage's documents. All stages but the last return the
columns of ``documents``; n_chars follows the text where a stage changes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuemill.llm import bpe, line_dedup, mixing, ngram_join, quality_fm
from valuemill.llm.common import table
from valuemill.llm.queries import tokenizer_path
from valuemill.session import materialize, ship_package


def _aside(docs: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with its columns of these names, which an operator would replace, under free names; and what puts them and the order of columns back."""
    columns, moved = docs.columns, {}
    for c in names:
        if c in columns:
            free = c
            while free in columns or free in names:
                free = f"_{free}"
            moved[c] = free
    back = lambda rows: rows.select(*[F.col(f"`{moved.get(c, c)}`").alias(c) for c in columns])
    return docs.withColumnsRenamed(moved), back


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine does not reject (score of 0.5 or more: better than even odds).

    It learns from the documents that are labelled and not held out.
    """
    ship_package(spark)
    rows, back = _aside(docs, "fm_score", "fm_predicted")
    model = quality_fm.train(rows, table(spark, sf_dir, "labels"))
    return back(quality_fm.scored(rows, model, threshold=0.5).where("fm_score >= 0.5"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that 10 or more different texts share; a document that had text and has none left goes.

    Copies of a text count once, so a text with many copies stays whole for the next stage, which keeps one of them.
    """
    ship_package(spark)
    rows, back = _aside(docs, "n_lines", "n_dropped")
    rows = line_dedup.drop_frequent_lines(rows, threshold=10, shortest=1, copies_once=True)
    rows = rows.where((F.col("n_dropped") == 0) | (F.btrim("text", F.lit(line_dedup.STRIPPED)) != ""))
    return back(rows.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, that with the least id; a row goes for its own text. Documents without an id or without words stay."""
    ship_package(spark)
    return ngram_join.first_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str, share: float = mixing.KEPT) -> DataFrame:
    """A sample of ``share`` of all tokens by the raked probabilities of source, language and topic."""
    ship_package(spark)
    rows, back = _aside(docs, "mix_topic", "mix_tokens", "mix_weight", "mix_probability", "mix_sampled")
    return back(mixing.mixed(rows, share=share).where("mix_sampled"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text that they decode to."""
    ship_package(spark)
    rows = bpe.encode(docs, tokenizer_path())
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality classifier", quality), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates),
          ("mixing sources to target weights", mixture), ("BPE encoding and decoding", encoding)]

#: A trained classifier and a tokenizer are not SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
