"""Exact length histogram: documents by encoded length; suffix sums answer totals, quantiles and truncated totals for every context limit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from valuemill.llm.bpe import word_encoder
from valuemill.llm.common import blocks, utf8_block


def encoded_lengths(docs: DataFrame, path: str, by: str | None = "source", text: str = "text") -> DataFrame:
    """(grp, length) of every row: its group as text (null without ``by``) and the ids of its whole text. A null text has length 0.

    Each word is encoded once while a worker keeps it; the lengths of a block come from one weighted count over its words.
    With a tokenizer that joins text across white space every text is encoded whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        for batch in batches:
            data, offsets = utf8_block(batch.column(1))
            for i, j in blocks(offsets):
                raw, at = data[offsets[i]:offsets[j]].tobytes(), (offsets[i:j + 1] - offsets[i]).tolist()
                texts = [raw[a:b] for a, b in zip(at, at[1:], strict=False)]
                if encoder.separable:
                    words = [t.split() for t in texts]
                    size = {w: len(ids) // 4 for w, ids in encoder.learn(set().union(*words)).items()}
                    lengths = [sum(map(size.__getitem__, w)) for w in words]
                else:
                    lengths = [len(ids) // 4 for ids in encoder.packed(texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i).cast(pa.string()), pa.array(np.asarray(lengths, np.int64))], ["grp", "length"])

    group = F.col(by).cast("string") if by else F.lit(None).cast("string")
    return docs.select(group.alias("grp"), F.col(text).alias("text")).mapInArrow(run, "grp string, length long")


def histogram(lengths: DataFrame) -> DataFrame:
    """(grp, length, n_docs): combined before it is shuffled, so a hot group costs one row for each length and task."""
    return lengths.groupBy("grp", "length").agg(F.count("*").alias("n_docs"))


def limits(hist: DataFrame) -> DataFrame:
    """For each group and each length that occurs in it, taken as context limit: exact counts and totals.

    Between two neighbouring lengths a <= limit < b nothing else changes than ``truncated_tokens``, which is
    ``tokens_below + docs_over * limit`` with the row of a, ``tokens_below + tokens_at`` and its ``docs_over``; so the rows answer any limit.
    ``docs_over``/``tokens_over`` are suffix sums over longer documents, ``quantile`` the share of documents of at most this length.
    """
    longer = Window.partitionBy("grp").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("grp")
    tokens = F.col("n_docs") * F.col("length")
    return (hist.select("grp", "length", "n_docs", F.sum("n_docs").over(longer).alias("d"), F.sum(tokens).over(longer).alias("t"),
                        F.sum("n_docs").over(whole).alias("total_docs"), F.sum(tokens).over(whole).alias("total_tokens"))
            .select("grp", F.col("length").alias("context_limit"), "n_docs", "total_docs", "total_tokens",
                    (F.col("d") - F.col("n_docs")).alias("docs_over"), (F.col("t") - F.col("n_docs") * F.col("length")).alias("tokens_over"),
                    (F.col("total_tokens") - F.col("t")).alias("tokens_below"),
                    (F.col("total_tokens") - F.col("t") + F.col("d") * F.col("length")).alias("truncated_tokens"),
                    ((F.col("total_docs") - F.col("d") + F.col("n_docs")) / F.col("total_docs")).alias("quantile")))


def quantiles(hist: DataFrame, shares: tuple[float, ...]) -> DataFrame:
    """(grp, share, length): for each share the least length that at least this share of the documents does not exceed."""
    rows = limits(hist).select("grp", "context_limit", "quantile", F.explode(F.array(*map(F.lit, shares))).alias("share"))
    return rows.where("quantile >= share").groupBy("grp", "share").agg(F.min("context_limit").alias("length"))


def length_report(docs: DataFrame, path: str, by: str | None = "source", text: str = "text") -> DataFrame:
    """``limits`` for all documents (scope ``all``) and for each value of ``by`` (scope ``by``; a null value is a group). An empty table gives no rows."""
    hist = histogram(encoded_lengths(docs, path, by, text))
    both = hist.select(F.struct(F.lit("by").alias("scope"), "grp").alias("grp"), "length", "n_docs") if by else None
    total = (hist.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))
             .select(F.struct(F.lit("all").alias("scope"), F.lit(None).cast("string").alias("grp")).alias("grp"), "length", "n_docs"))
    rows = limits(total.unionByName(both) if by else total)
    return rows.select("grp.scope", F.col("grp.grp").alias("grp"), *[c for c in rows.columns if c != "grp"])
