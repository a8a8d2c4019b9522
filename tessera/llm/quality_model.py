"""Operator 5 -- quality classifier: hashed word n-gram logistic regression.

Tokens are runs of letters and digits and runs of other characters, so noise
around a word is a token of its own.  Features are the token unigrams and
bigrams, hashed to ``2**BITS`` buckets; a bigram of twice the same token is one
feature whatever the token.  A text is the sparse vector of its counts over the
square root of their number; its score is the logistic of a sparse dot product.

Training is follow-the-regularised-leader (per-coordinate FTRL-proximal) over a
bounded sample: the ``SAMPLE`` labelled documents with the smallest hash of
their id, those held out left out.  They are fitted in one task, which holds
their feature counts only, and the model (a vector of fixed length) is shipped
to the scoring tasks.  Scoring is a pass over the text without a shuffle.

Defined cases: a null or empty text has no feature and gets the score of the
intercept; a label row without a document, a null label and a null id are
ignored in training; documents with several label rows are trained on each;
without any label the score is 0.5; repeated rows are scored row by row; very
long texts are scored whole; only id and text are read of the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.arrow_text import WORDS, Spans, TextSlice, mix64, slices

BITS = 18
SAMPLE = 6000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.01
CUT = 0.3
FOLDS, HELD_OUT = 5, 0


def fold(id_col: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(col.cast("string").cast("binary")) % folds


def _token_classes() -> np.ndarray:
    kinds = np.where(WORDS == 0, 0, 2).astype(np.uint8)
    kinds[128:] = 1
    for low, high in ((48, 58), (65, 91), (97, 123)):
        kinds[low:high] = 1
    return kinds


TOKENS = _token_classes()


def features(part: TextSlice, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every n-gram occurrence, index of each text's first one)."""
    spans = Spans(part, TOKENS)
    h = spans.hashes()
    n = spans.per_text()
    shift = np.uint64(64 - bits)
    text = np.repeat(np.arange(len(n)), n)
    pair = text[1:] == text[:-1] if len(h) else np.zeros(0, bool)
    twice = mix64(h[:-1] * np.uint64(31) + h[1:])
    twice[h[:-1] == h[1:]] = np.uint64(0x5EED)
    owner = np.concatenate([text, text[1:][pair]])
    bucket = np.concatenate([h >> shift, mix64(twice[pair]) >> shift]).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.searchsorted(owner[order], np.arange(len(n) + 1))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int = BITS,
         epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last one is the intercept) after ``epochs`` passes over
    sparse rows of (buckets, values)."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(i) -> np.ndarray:
        shrunk = np.sign(z[i]) * np.maximum(np.abs(z[i]) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n[i])) / ALPHA + L2)

    for _ in range(epochs):
        for (i, x), y in zip(rows, labels):
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    return weights(slice(None))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE,
          id_col: str = "doc_id", folds: int = FOLDS, held_out: int = HELD_OUT) -> np.ndarray:
    """The model, fitted on at most ``sample`` labelled documents."""
    spread = F.xxhash64(F.col(id_col), F.lit(5))
    chosen = (labels.select(F.col(id_col).alias(id_col), F.col(label_col).cast("int").alias("label"))
              .filter((fold(id_col, folds) != held_out) & F.col("label").isNotNull())
              .withColumn("spread", spread).orderBy("spread", id_col, "label").limit(sample))
    # At most ``sample`` rows of three numbers.
    rows = docs.select(id_col, F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), id_col)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            buckets, first = features(part)
            rows = [np.unique(buckets[first[k]:first[k + 1]], return_counts=True) for k in range(len(part))]
            yield pa.RecordBatch.from_arrays(
                [part.column("spread"), part.column("label"), pa.array([r[0] for r in rows], pa.list_(pa.int64())),
                 pa.array([r[1] for r in rows], pa.list_(pa.int64()))], names=["spread", "label", "at", "count"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for spread, label, at, count in zip(*batch.columns):
                at, count = at.values.to_numpy(), count.values.to_numpy()
                x = np.append(count / np.sqrt(max(count.sum(), 1)), 1.0)
                held.append((spread.as_py(), label.as_py(), np.append(at, 1 << BITS), x))
        if not held:
            return
        held.sort(key=lambda r: (r[0], r[1], len(r[2])))  # the same order in every run
        w = ftrl([r[2:] for r in held], np.array([float(r[1] > 0) for r in held]))
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int64()), "w": pa.array(w[at], pa.float64())})

    # The scan and the features run in all tasks; the sample's counts meet in one.
    counts = rows.select("spread", "label", "text").mapInArrow(
        counted, "spread long, label int, at array<long>, count array<long>")
    found = counts.repartition(1).mapInArrow(fit, "at long, w double").toArrow()
    model = np.zeros((1 << BITS) + 1)
    model[found["at"].to_numpy()] = found["w"].to_numpy()
    return model


def score(docs: DataFrame, model: np.ndarray, keep: list[str], text_col: str = "text",
          name: str = "score") -> DataFrame:
    """The ``keep`` columns and a score in [0, 1] per row, called ``name``."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    # mapInArrow can't take every column name: the columns are numbered inside.
    names = [f"c{i}" for i in range(len(keep))]
    kept = [F.col("`" + c.replace("`", "``") + "`").alias(n) for c, n in zip(keep, names)]
    given = docs.select(*kept, F.col(text_col).cast("string").alias("text"))
    schema = docs.select(*kept).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shipped.value
        for part in slices(batches):
            buckets, first = features(part)
            sums = np.concatenate([[0.0], np.cumsum(w[buckets])])
            n = np.diff(first)
            dot = (sums[first[1:]] - sums[first[:-1]]) / np.sqrt(np.maximum(n, 1)) + w[-1]
            out = [part.column(c) for c in names] + [pa.array(1 / (1 + np.exp(-np.clip(dot, -30, 30))), pa.float64())]
            yield pa.RecordBatch.from_arrays(out, names=[*names, "score"])

    return given.mapInArrow(run, schema).toDF(*keep, name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    scored = score(docs, train(docs, labels), ["doc_id"])
    return scored.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
                         F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"))
