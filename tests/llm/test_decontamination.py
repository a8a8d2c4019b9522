import random
from collections import Counter

from tessera.llm import decontamination


def brute(docs, items, word):
    """All windows of an item's size, compared directly."""
    found = {}
    for i, text in docs:
        w = word.findall((text or "").lower())
        for j, item in items:
            v = word.findall((item or "").lower())
            if i is None or j is None or not v:
                continue
            n = min(len(v), 5)
            bag = Counter(tuple(v[k:k + n]) for k in range(len(v) - n + 1))
            for start in range(max(len(w) - len(v), 0) + 1):
                part = w[start:start + len(v)]
                own = Counter(tuple(part[k:k + n]) for k in range(len(part) - n + 1))
                low, high = sum((bag & own).values()), sum((bag | own).values())
                if low and 100 * low >= 80 * high:
                    found.setdefault((i, j), {})[start] = round(low / high, 9)
    return found


def test_matches_all_windows(spark, odd_docs, word):
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([2, 3, 8, 20, 45])))) for k in range(12)]
    items += [(90, None), (91, ""), (None, "v1 v2 v3 v4 v5 v6"), (92, items[4][1]), (93, "one")]
    docs = [(r.doc_id, r.text) for r in odd_docs.collect() if r.text is None or len(r.text) < 5000]
    for k in range(40):
        words = (items[k % 12][1] or "x").split()
        if k % 3 == 1 and len(words) > 8:
            words[rng.choice([0, len(words) - 1, len(words) // 2])] = "changed"
        if k % 3 == 2:
            words = [x.upper() for x in words]
        docs.append((1000 + k, " ".join([*rng.choices(vocabulary, k=rng.randint(0, 30)), *words,
                                         *rng.choices(vocabulary, k=rng.randint(0, 30))])))
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, hashes int")
    bench = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int")
    rows = decontamination.matches(df, bench).collect()
    best = brute(docs, items, word)
    found = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in rows}
    assert found == {k: max(v.values()) for k, v in best.items()}
    assert all(best[r.doc_id, r.item_id][r.start_word] == round(r.similarity, 9) for r in rows)
    assert len(rows) == len({(r.doc_id, r.item_id) for r in rows}) > 25


def test_blocks_cover_the_radius(spark):
    """Whatever 19 bits differ, some block agrees; blocks tile the bits."""
    rng = random.Random(2)
    rows = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 19):
            b ^= 1 << bit
        rows.append((a - (1 << 63), b - (1 << 63)))
    df = spark.createDataFrame(rows, "a long, b long").select(
        decontamination.blocks("a").alias("x"), decontamination.blocks("b").alias("y"))
    assert all(set(r.x) & set(r.y) for r in df.collect())


def test_long_texts_and_empty_tables(spark, odd_docs, no_docs):
    item = spark.createDataFrame([(1, " ".join(f"w{i} the" for i in range(30)))], "item_id long, text string")
    found = decontamination.matches(odd_docs, item).collect()
    assert {r.doc_id for r in found} == {6, 7}
    assert decontamination.matches(no_docs, item).collect() == []
    assert decontamination.matches(odd_docs, item.limit(0)).collect() == []


def test_candidates_among_many_items_of_one_size(spark):
    """A thousand items of equal length that share a phrase: candidates stay
    few, and every similar window is one."""
    from pyspark.sql import functions as F

    from tessera.operators.sinks import materialize

    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(2000)]
    phrase = "in the middle of this sentence stands"
    texts = []
    for _ in range(1000):
        words = rng.choices(vocabulary, k=33)
        texts.append(" ".join(words[:10] + phrase.split() + words[10:]))
    near = []
    for t in texts[:200]:
        words = t.split()
        words[rng.randrange(len(words))] = "changed"
        near.append(" ".join(words))

    def lists(rows, id_col, hashes, mark):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], f"{id_col} long, text string")
        df = df.select(id_col, decontamination.lower_words("text").alias("w"))
        df = df.select(id_col, F.size("w").alias("size"), F.lit(0).alias("start"), decontamination.shingles("w", 5).alias(hashes))
        return materialize(df.withColumn(mark, decontamination.simhash(hashes)), "test-lists")

    windows, items = lists(near, "doc_id", "hashes", "print"), lists(texts, "item_id", "item_hashes", "item_print").drop("start")
    found = {(r.doc_id, r.item_id) for r in decontamination.candidates(windows, items, 19, 80).collect()}
    assert len(found) < 0.1 * 200 * 1000
    sets = [Counter(tuple(t.split()[k:k + 5]) for k in range(36)) for t in texts]
    for i, t in enumerate(near):
        own = Counter(tuple(t.split()[k:k + 5]) for k in range(36))
        low, high = sum((own & sets[i]).values()), sum((own | sets[i]).values())
        assert (i, i) in found or 100 * low < 80 * high


def test_rarest_shingles_lose_no_similar_pair(spark):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        base = [rng.randint(0, 30) for _ in range(rng.randint(1, 25))]
        other = list(base)
        for _ in range(rng.randint(0, 3)):
            other[rng.randrange(len(other))] = rng.randint(0, 30)
        rows.append((i, base, other))
    df = spark.createDataFrame(rows, "i long, a array<bigint>, b array<bigint>")
    seen = df.selectExpr("i", "explode(array_distinct(b)) hash").groupBy("hash").count().toDF("hash", "times")
    left = {(r.i, r.hash, r.nth) for r in decontamination.rarest(df, ["i"], "a", seen, 80).collect()}
    right = {(r.i, r.hash, r.nth) for r in decontamination.rarest(df, ["i"], "b", seen, 80).collect()}
    met = {x[0] for x in left & right}
    for i, a, b in rows:
        low, high = sum((Counter(a) & Counter(b)).values()), sum((Counter(a) | Counter(b)).values())
        assert i in met or 100 * low < 80 * high
