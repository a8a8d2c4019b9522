import numpy as np
import pytest

from tessera.llm import minhash


def brute(rows, words, word, threshold=80):
    """Per distinct (doc_id, text): component by all pairs."""
    def shingles(text):
        w = word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()

    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets)


@pytest.mark.parametrize("words", [4, 5])
def test_components_match_all_pairs(odd_docs, word, words):
    named = odd_docs.filter("doc_id IS NOT NULL")
    found = sorted(tuple(r) for r in minhash.near_duplicates(named, words).collect())
    assert found == brute([(r.doc_id, r.text) for r in named.collect()], words, word)


def test_chains_and_groups(spark, word):
    """Long texts that drift word by word: ends differ, neighbours are linked;
    the group of variants has members that link only with some others."""
    rng = np.random.default_rng(5)
    text = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(40):
        text = list(text)
        text[int(rng.integers(0, 120))] = f"new{i}"
        rows.append((100 - i, " ".join(text)))
    base = [f"g{i}" for i in range(100)]
    for i in range(60):
        v = list(base)
        for k in rng.integers(0, 100, int(rng.integers(0, 7))):
            v[int(k)] = f"x{i}_{k}"
        rows.append((200 + i, " ".join(v)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in minhash.near_duplicates(df, 4).collect()) == brute(rows, 4, word)


def drifting(n, shared, own, seed=3):
    """Texts with a common passage: alike, but below the threshold."""
    rng = np.random.default_rng(seed)
    passage = [f"p{i}" for i in range(shared)]
    return [(i, " ".join([*passage, *(f"u{i}_{k}" for k in rng.permutation(own))])) for i in range(n)]


def test_hot_buckets_lose_no_link(spark, word, monkeypatch):
    monkeypatch.setattr(minhash, "HOT", 2)
    rng = np.random.default_rng(11)
    rows = drifting(60, 80, 24)
    for i in range(60):  # near copies of some of them, of each other, and longer ones
        words = rows[int(rng.integers(0, 60))][1].split()
        for k in rng.integers(0, len(words), int(rng.integers(0, 5))):
            words[int(k)] = f"n{i}_{k}"
        rows.append((1000 - i, " ".join(words + [f"tail{i}_{k}" for k in range(int(rng.integers(0, 12)))])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in minhash.near_duplicates(df, 4).collect()) == brute(rows, 4, word)


def test_rare_pairs_of_texts_that_share_a_passage_are_few(spark):
    """Four fifths in common, no pair similar: work stays linear."""
    from pyspark.sql import functions as F

    from tessera.operators.sinks import materialize

    df = materialize(spark.createDataFrame(drifting(1500, 160, 40), "doc_id long, text string"), "test-drifting")
    ids = materialize(df.select("doc_id", F.col("doc_id").alias("component")), "test-ids")
    assert minhash.rare_pairs(ids, df, 5, 80).count() == 0
    near = df.withColumn("text", F.concat("text", F.lit(" and end"))).withColumn("doc_id", F.col("doc_id") + 5000)
    both = materialize(df.union(near), "test-both")
    ids = materialize(both.select("doc_id", F.col("doc_id").alias("component")), "test-ids")
    assert {(r.a, r.b) for r in minhash.rare_pairs(ids, both, 5, 80).collect()} == {(i, i + 5000) for i in range(1500)}


def test_null_ids_and_empty_table(spark, odd_docs, no_docs):
    rows = minhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r.component_id for r in rows if r.doc_id is None} == {10, None}
    assert minhash.near_duplicates(no_docs).collect() == []


def test_estimate_is_close():
    rng = np.random.default_rng(1)
    universe = np.sort(rng.integers(0, 1 << 63, 6000).astype(np.uint64) * np.uint64(2))
    a, b = universe[:5000], universe[500:5500]
    r = minhash.registers([a, b])
    equal, filled = ((r[0] == r[1]) & (r[0] < 0)).sum(), ((r[0] < 0) | (r[1] < 0)).sum()
    assert abs(minhash.estimate(equal, filled) - 4500 / 5500) < 0.1
    bits = minhash.bitmaps([a, b])
    assert bits.shape == (2, minhash.BITMAP // 64)
