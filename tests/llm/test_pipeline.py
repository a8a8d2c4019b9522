import re

import corpus_pipeline
from tessera.llm import minhash, pii

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, word):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    columns, held = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, SMALL), f"test-{name}")
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name != "privacy":
            assert all(after[i] == before[i] for i in after)
        held[name] = (before, after)
    before, after = held["quality"]
    assert all(i in after for i, q in labels.items() if q == 1 and i in before)
    rejected = [i for i, q in labels.items() if q == 0 and i in before]
    assert sum(i in after for i in rejected) <= 0.3 * len(rejected)  # few labels at this size

    def shingles(text):
        w = word.findall(text.lower())
        return frozenset(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()

    before, after = held["dedup"]
    sets = {i: shingles(r.text) for i, r in before.items()}

    def similar(i, j):
        a, b = sets[i], sets[j]
        return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)

    kept = sorted(after)
    assert not any(similar(i, j) for k, i in enumerate(kept) for j in kept[:k])
    assert all(any(similar(i, j) for j in before if j != i) for i in set(before) - set(after))
    before, after = held["benchmark"]
    flat = {i: " ".join(word.findall(r.text.lower())) for i, r in before.items()}
    leaks = {i for i, t in flat.items() if any(" ".join(word.findall(x.lower())) in t for x in items)}
    assert leaks and leaks == set(before) - set(after)
    before, after = held["privacy"]
    assert set(before) == set(after) and all(r.n_chars == len(r.text) for r in after.values())
    assert not any(pii.base_spans(re.sub("<[A-Z]+>", " ", r.text)) for r in after.values())
    assert all(after[i].text == r.text for i, r in before.items() if not re.search("[0-9@]", r.text))
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in mixed} == set(after) and all(0 <= r.taken <= 3 * r["size"] for r in mixed)


def test_odd_rows_pass_every_stage(spark, odd_docs):
    docs = odd_docs.selectExpr("doc_id", "text", "lang", "source", "cast(length(text) as long) n_chars", "score", "a", "rank")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SMALL), f"odd-{name}")
        assert docs.count()


def test_empty_documents(spark, odd_docs):
    docs = odd_docs.selectExpr("doc_id", "text", "lang", "source", "cast(length(text) as long) n_chars").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.collect() == []


def test_repeated_rows_leave_one(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "en", "s", 11)] * 3 + [(2, "other words are here now ok", "en", "s", 27)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.dedup(spark, df, SMALL).collect()) == [1, 2]
    assert minhash.near_duplicates(df).count() == 4


def test_repeated_ids_keep_their_unique_texts(spark):
    """Ids with several texts, and without one: decisions are per row."""
    rng = __import__("random").Random(3)
    text = lambda: " ".join("".join(rng.choices("abdeklmnorstu", k=5)) for _ in range(40))
    unique = [text() for _ in range(7)]
    rows = [(1, unique[0]), (2, unique[1]), (2, unique[2]), (3, unique[0] + " end"), (3, unique[3]), (None, unique[4]),
            (None, unique[5]), (None, unique[1]), (4, unique[6]), (4, unique[6]), (2**62, None), (5, ""), (5, None)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.dedup(spark, df, SMALL).collect()
    assert sorted(r.text for r in out if r.text) == sorted(unique)
    assert sum(not r.text for r in out) == 3
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    odd = spark.createDataFrame([(1, item, 0), (1, unique[0], 0), (None, item, 0), (None, unique[1], 0), (2, item, 0)],
                                "doc_id long, text string, `a.b` int")
    assert sorted(r.text for r in corpus_pipeline.benchmark(spark, odd, SMALL).collect()) == sorted(unique[:2])


def test_names_with_dots(spark, odd_docs):
    docs = odd_docs.selectExpr("doc_id", "text", "lang", "source", "cast(length(text) as long) n_chars", "a as `a.b`", "rank as `c d`",
                               "score as `row key`")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SMALL), f"dots-{name}")
        assert "a.b" in docs.columns and docs.count()
    assert corpus_pipeline.mix(spark, docs, SMALL).count()
