"""Quality classifier and language identification."""

import zlib

import numpy as np
import pytest

from tessera.llm import language_id, quality_model

MIDDLE = "/root/testdata/sf0.01"


def test_quality_held_out_accuracy(spark):
    rows = quality_model.query(spark, MIDDLE).join(spark.read.parquet(f"{MIDDLE}/labels.parquet"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) >= 0.9 * len(held)
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert np.mean([[a > b for a in good] for b in bad]) >= 0.97
    assert all(r.predicted for r in held if r.quality == 1)


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, None), (None, 1), (999, 0), (4, 0)],
                                   "doc_id long, quality int")
    model = quality_model.train(odd_docs, labels)
    rows = quality_model.score(odd_docs, model, ["doc_id"]).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert np.array_equal(model, quality_model.train(odd_docs.repartition(5), labels))
    assert quality_model.score(no_docs, model, ["doc_id"]).collect() == []
    blank = quality_model.train(odd_docs, labels.limit(0))
    assert {r.score for r in quality_model.score(odd_docs, blank, ["doc_id"]).collect()} == {0.5}


def test_quality_training_scans_documents_in_parallel(spark):
    from pyspark import AccumulatorParam, TaskContext
    from pyspark.sql import functions as F

    class Tasks(AccumulatorParam):
        def zero(self, value):
            return set()

        def addInPlace(self, a, b):
            return a | b

    tasks = spark.sparkContext.accumulator(set(), Tasks())

    @F.udf("string")
    def text(i):
        tasks.add({TaskContext.get().partitionId()})
        return f"word{i % 7} the"

    docs = spark.range(0, 120, 1, 6).select(F.col("id").alias("doc_id"), text("id").alias("text"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, quality int")
    quality_model.train(docs, labels)
    assert len(tasks.value) >= 6


def test_scoring_equals_a_plain_dot_product(spark):
    """The sliced, vectorised score against one text at a time."""
    texts = ["the the cat", "a!! b!! c", "", "Ünï çode tëxt 12,5"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    model = np.random.default_rng(0).normal(size=(1 << quality_model.BITS) + 1)
    together = {r.doc_id: r.score for r in quality_model.score(df, model, ["doc_id"]).collect()}
    for i, t in enumerate(texts):
        one = spark.createDataFrame([(i, t)], "doc_id long, text string")
        assert quality_model.score(one, model, ["doc_id"]).first().score == pytest.approx(together[i])


def test_language_held_out_accuracy(spark):
    rows = language_id.query(spark, MIDDLE).join(
        spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_table_equals_bundled_vectors():
    """Dots by table against the cosine of really bundled vectors."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    grams = rng.integers(0, language_id.GRAMS, 300)
    table = pa.table({"lang": ["x"] * 200 + ["y"] * 200, "gram": np.concatenate([grams[:200], grams[100:]]),
                      "n": rng.integers(1, 9, 400)})
    model = language_id.Model(table, 512)
    letters = language_id.letter_vectors(512)
    bundle = language_id.gram_vectors(grams[:50], letters).sum(0)
    assert np.allclose(model.dots[grams[:50]].sum(0), model.prototypes @ bundle, rtol=1e-3, atol=1e-2)


def test_language_odd_rows(spark, odd_docs, no_docs):
    model = language_id.learn(odd_docs)
    rows = {r.doc_id: r for r in language_id.predict(odd_docs, model, ["doc_id"]).collect() if r.doc_id is not None}
    assert [rows[i].lang_pred for i in (0, 1, 2, 9)] == ["und"] * 4
    assert rows[0].score == 0 and rows[6].lang_pred in ("en", "fr")
    assert language_id.predict(no_docs, model, ["doc_id"]).collect() == []
    nothing = language_id.learn(no_docs)
    assert {r.lang_pred for r in language_id.predict(odd_docs, nothing, ["doc_id"]).collect()} == {"und"}


def test_ftrl_equals_a_dictionary_version():
    """Follow-the-regularised-leader, one coordinate at a time."""
    import math

    q = quality_model
    rng = np.random.default_rng(4)
    rows = [(np.append(rng.choice(40, 6, replace=False), 1 << q.BITS), np.append(rng.random(6), 1.0)) for _ in range(50)]
    labels = (rng.random(50) < 0.5).astype(float)
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= q.L1:
            return 0.0
        return -(z[i] - math.copysign(q.L1, z[i])) / ((q.BETA + math.sqrt(n[i])) / q.ALPHA + q.L2)

    for _ in range(q.EPOCHS):
        for (at, x), y in zip(rows, labels):
            w = {int(i): weight(int(i)) for i in at}
            p = 1 / (1 + math.exp(-sum(w[int(i)] * v for i, v in zip(at, x))))
            for i, v in zip(at.tolist(), x.tolist()):
                g = (p - y) * v
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / q.ALPHA * w[i]
                n[i] = n.get(i, 0.0) + g * g
    found = q.ftrl(rows, labels)
    assert np.allclose([found[i] for i in z], [weight(i) for i in z], atol=1e-9)
    assert np.count_nonzero(found) <= len(z)


def test_language_predictions_equal_bundled_documents(spark):
    """Whole predictions against texts that are really bundled, one n-gram at
    a time, and compared by their own cosine."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.learn(docs.filter("doc_id % 2 = 0"))
    table, letters = language_id.symbol_table(), language_id.letter_vectors()
    checked = 0
    for r in language_id.predict(docs.filter("doc_id % 2 = 1"), model, ["doc_id", "text"]).collect():
        symbols = [0]
        for c in r.text or "":
            s = int(table[ord(c)])
            if s or symbols[-1]:
                symbols.append(s)
        symbols += [0] if symbols[-1] else []
        bundle = np.zeros(language_id.DIMENSIONS)
        for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
            if b:
                bundle += np.roll(letters[a], 2).astype(int) * np.roll(letters[b], 1) * letters[c]
        if not bundle.any():
            assert r.lang_pred == "und"
            continue
        cosine = model.prototypes @ bundle / np.linalg.norm(bundle)
        first, second = np.sort(cosine)[::-1][:2]
        if first - second > 1e-4:
            assert r.lang_pred == model.languages[int(cosine.argmax())]
            checked += 1
    assert checked > 50
