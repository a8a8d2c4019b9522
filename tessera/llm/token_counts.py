"""Operator 10 -- token counts from an exact length histogram.

Every document is encoded whole with a public tokenizer; only its encoded
length is kept.  The histogram (one row per distinct length) answers, through
running sums from either end, the totals, quantiles and truncated totals of
every context limit: between two lengths of the histogram the counts do not
change and the truncated total grows by ``docs_longer`` a token.

The histogram is summed in each task before the shuffle, so hot sources,
copies or lengths cost nothing; its rows are bounded by the longest document,
and only that small table is put in order in one task.

Defined cases: null and empty texts have length 0 and are counted; repeated
rows count each; an empty table gives an empty histogram; very long texts are
encoded whole, white space of any length included.  Only the text column is
read; the vocabulary file is read by the driver and shipped with the tasks.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.arrow_text import slices
from tessera.llm.vocabulary import BYTE_BPE, TOKENIZERS, byte_bpe, file_bytes


def _coder(folder: str):
    """Encoded length of a text; markers of special tokens are ordinary text."""
    return _length(file_bytes(folder, BYTE_BPE))


def _length(vocabulary: bytes):
    _, encode = byte_bpe(vocabulary, special_as_text=True)
    return lambda text: len(encode([text])[0])


def length_histogram(docs: DataFrame, text_col: str = "text", tokenizers: str = TOKENIZERS) -> DataFrame:
    """n_tokens, n_docs: one row per distinct encoded length."""
    vocabulary = file_bytes(tokenizers, BYTE_BPE)

    def count(batches):
        length = _length(vocabulary)
        found: Counter = Counter()
        for part in slices(batches, text_col):
            found.update(map(length, part.texts()))
        yield pa.RecordBatch.from_pydict(
            {"n_tokens": pa.array(list(found), pa.int64()), "n_docs": pa.array(list(found.values()), pa.int64())})

    partial = docs.select(F.col(text_col).cast("string").alias(text_col)).mapInArrow(
        count, "n_tokens long, n_docs long")
    return partial.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def context_limits(histogram: DataFrame) -> DataFrame:
    """One row per distinct length, taken as a context limit: documents of
    that length, documents and tokens beyond it, the total if every document
    is cut to it, and the share of documents that fit (the quantile)."""
    up = W.orderBy("n_tokens").rowsBetween(W.unboundedPreceding, 0)
    everything = W.partitionBy()
    tokens = F.col("n_tokens") * F.col("n_docs")
    rows = histogram.select(
        "n_tokens", "n_docs", F.sum("n_docs").over(up).alias("docs_up_to"), F.sum(tokens).over(up).alias("tokens_up_to"),
        F.sum("n_docs").over(everything).alias("total_docs"), F.sum(tokens).over(everything).alias("total_tokens"))
    longer = F.col("total_docs") - F.col("docs_up_to")
    return rows.select(
        F.col("n_tokens").alias("context_limit"), "n_docs", longer.alias("docs_longer"),
        (F.col("total_tokens") - F.col("tokens_up_to")).alias("tokens_longer"),
        (F.col("tokens_up_to") + F.col("n_tokens") * longer).alias("truncated_total"), "total_tokens",
        (F.col("docs_up_to") / F.col("total_docs")).alias("share_fitting"))


def quantile(limits: DataFrame, share: float) -> int | None:
    """The smallest length that at least ``share`` of the documents fit."""
    row = limits.filter(F.col("share_fitting") >= share).agg(F.min("context_limit")).first()
    return row[0]


def truncated_total(limits: DataFrame, limit: int) -> int:
    """Tokens left if every document is cut to ``limit`` (any number)."""
    row = (limits.filter(F.col("context_limit") <= limit)
           .agg(F.max(F.struct("context_limit", "truncated_total", "docs_longer")).alias("m")).first())
    if row["m"] is None:  # all documents are longer
        first = limits.agg(F.max(F.col("n_docs") + F.col("docs_longer"))).first()[0]
        return (first or 0) * limit
    return row["m"]["truncated_total"] + (limit - row["m"]["context_limit"]) * row["m"]["docs_longer"]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    return context_limits(length_histogram(docs))
