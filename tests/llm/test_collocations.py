import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tessera.llm import collocations as C
from tessera.operators.sinks import materialize


def plain(rows, threshold, share=100, max_words=5):
    """Counts and kept candidates by dictionary, one text at a time."""
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, max_words + 1):
                for i in range(len(words) - n + 1):
                    f[lang, tuple(words[i:i + n])] += 1
    f = {k: v for k, v in f.items() if v >= threshold}
    inside: dict = {}
    for (lang, v), n in f.items():
        for m in range(2, len(v)):
            for i in range(len(v) - m + 1):
                key = lang, v[i:i + m]
                inside[key] = max(inside.get(key, 0), n)
    out = set()
    for (lang, v), a in f.items():
        if len(v) > 1 and 100 * inside.get((lang, v), 0) < share * a:
            score, _, l, r = min((Fraction(1000 * a * total[lang], f[lang, v[:k]] * f[lang, v[k:]]).__floor__(), k,
                                  f[lang, v[:k]], f[lang, v[k:]]) for k in range(1, len(v)))
            out.add((lang, " ".join(v), a, l, r, total[lang], score))
    return f, out


def texts(n=400, seed=3):
    rng = random.Random(seed)
    words = ["Ka", "to", "mi", "ö", "x y", "the", "of", "re"]
    out = [(None, "en"), ("", None), (" \t ", "en"), (",.;", "en"), ("a,b c", "und")]
    for _ in range(n):
        sep = rng.choice([" ", "  ", " \t", ", ", "\n", ". "])
        out.append((sep.join(rng.choices(words, k=rng.randint(0, 14))), rng.choice(["en", "en", "fr", None, "und"])))
    line = "license granted to any person, free of charge"
    return out + [(line, "en")] * 30 + [out[9]] * 3


@pytest.mark.parametrize("setting", [{}, {"bitmap_bits": 10}, {"partition_mass": 50}])
def test_counts_and_candidates_match_brute_force(spark, setting):
    rows = texts()
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "text string, lang string, f int, words int").repartition(6)
    f, kept = plain(rows, 12)
    counts = materialize(C.frequent(docs, threshold=12, **setting), "test-counts")
    got = {(r.lang, tuple(r.phrase.split(" "))): r.f for r in counts.filter("words > 0").collect()}
    assert got == f
    for share in (100, 60):
        found = C.collocations(counts, share).collect()
        assert {(r.lang, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found} == plain(rows, 12, share)[1]
        assert len(found) == len({(r.lang, r.phrase) for r in found})
    assert len(kept) > 8


def test_small_summaries_lose_no_frequent_key():
    """Merged from many parts, whatever the order and however small the start."""
    rng = np.random.default_rng(7)
    for capacity, budget in ((1, 9), (40, 9), (400, 4)):
        summary, truth = C.Summary(capacity, budget), Counter()
        for _ in range(60):
            keys = rng.zipf(1.3, 300).clip(max=4000).astype(np.uint32)
            names, times = np.unique(keys, return_counts=True)
            summary.merge(names, times.astype(np.int64))
            truth.update(keys.tolist())
        kept = dict(zip(summary.keys.tolist(), summary.counts.tolist()))
        assert summary.taken <= budget
        assert all(kept.get(k, 0) <= n <= kept.get(k, 0) + summary.taken for k, n in truth.items())
        assert {k for k, n in truth.items() if n >= 2 * budget} <= set(summary.survivors(2 * budget).tolist())
        assert len(kept) < len(truth)


def test_products_beyond_64_bits_are_exact(spark):
    big = 9_000_000_000_007
    rows = [("en", None, 0, 70_000_000_000_000_011), ("en", "a", 1, 12_345_678_901), ("en", "b", 1, 98_765_432_109),
            ("en", "a b", 2, big), ("en", "b a", 2, 7)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, words int, f long")
    got = {r.phrase: r.score for r in C.collocations(counts).collect()}
    for phrase, a in (("a b", big), ("b a", 7)):
        assert got[phrase] == 1000 * a * 70_000_000_000_000_011 // (12_345_678_901 * 98_765_432_109)


def test_empty_table_and_long_text(spark, no_docs):
    assert C.frequent(no_docs).filter("words > 0").collect() == []
    docs = spark.createDataFrame([("a bc " * 600_000, "en")], "text string, lang string")
    found = {r.phrase: r.f for r in C.frequent(docs).collect()}
    assert found["a bc a bc a"] == 599_998 and found["bc"] == 600_000 and found[None] == 1_200_000
