"""Corpus pipeline: documents fit for training, mixed to source targets.

Each stage takes the rows that the one before kept (written as Parquet and
reread) and its decisions take effect on them:

* quality   rows that the classifier rejects go (score below its cut);
* dedup     of each group of near-duplicates one row stays (that of the
            smallest doc_id, if ids are unique);
* benchmark rows with a passage of a benchmark item go;
* privacy   personal data in the texts is replaced by marks, n_chars follows;
* mixing    the words that the mix takes of each document.

All stages but the last return the columns of documents.  Decisions are made
and applied per row: a doc_id that occurs with several texts, or null, is
several documents (``_keyed``); only rows equal in every column collapse, in
dedup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontamination, minhash, mixing, pii, quality_model
from tessera.llm.arrow_text import bounded_batches
from tessera.operators.merge import assign_keys
from tessera.operators.sinks import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels of the rows at hand."""
    bounded_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = quality_model.train(docs.select("doc_id", "text"), labels)
    scored = quality_model.score(docs, model, docs.columns, name="\nscore")
    return scored.filter(F.col("\nscore") >= quality_model.CUT).drop("\nscore")


def _columns(df: DataFrame) -> list:
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def _keyed(docs: DataFrame, collapse: bool = False) -> tuple[DataFrame, str]:
    """``docs`` with a unique long per row, and its column's name: the doc_id
    where it names one row; the other rows are numbered from the largest id up
    (``collapse``: once for rows that are equal in every column)."""
    key = "row key"
    while key in docs.columns:
        key += "_"
    row_id = F.col("doc_id").cast("long")
    ids = docs.groupBy(row_id.alias("id")).count().filter("count > 1 OR id IS NULL").select("id")
    ids = materialize(ids, "pipeline-repeated-ids")
    if not ids.limit(1).count():
        return docs.withColumn(key, row_id), key
    same = row_id.eqNullSafe(F.col("id"))
    once = docs.join(ids, same, "left_anti").select(*_columns(docs)).withColumn(key, row_id)
    others = docs.join(ids, same, "left_semi").select(*_columns(docs))
    largest = once.agg(F.max(key)).first()[0] or 0
    return once.unionByName(assign_keys(others.distinct() if collapse else others, key, max(largest, 0))), key


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    rows, key = _keyed(docs, collapse=True)
    groups = minhash.near_duplicates(rows.select(key, "text"), words=5, id_col=key)
    gone = groups.filter("NOT kept").select(F.col("doc_id").alias(key))
    return rows.join(gone, key, "left_anti").select(*_columns(docs))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    rows, key = _keyed(docs)
    found = decontamination.matches(rows.select(key, "text"), items, id_col=key)
    return rows.join(found.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").select(*_columns(docs))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.Mix(docs).taken()


STAGES = [("quality", quality), ("dedup", dedup), ("benchmark", benchmark), ("privacy", privacy), ("mixing", mix)]

#: Training and the random field can't be stated in SQL; the tests compare the
#: stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
