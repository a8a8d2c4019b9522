from collections import defaultdict

import pytest

from tessera.llm import mixing


def filled(sizes, weights=(5, 2, 1), cap=3):
    """Targets by repeated sharing."""
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: float(cap * sizes[s]) for s in over}


@pytest.fixture(scope="module")
def uneven(spark):
    rows = [(i, "w " * (i % 50 + 1), s) for i, s in enumerate(
        ["a"] * 3 + ["b"] * 200 + ["c"] * 40 + ["d"] * 5 + [None] * 30 + ["Z"] * 80)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_targets_and_taken(uneven):
    rows, df = uneven
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(t.split())
    found = mixing.Mix(df).taken().collect()
    expected, taken = filled(sizes), defaultdict(int)
    for r in found:
        assert r.target == pytest.approx(expected[r.source])
        assert r.source_size == sizes[r.source] and r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    for s, target in expected.items():
        assert abs(taken[s] - target) <= 0.01 * target + 3
    again = mixing.Mix(df.repartition(7)).taken().collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_schedule_keeps_proportions_in_every_stretch(uneven):
    _, df = uneven
    mix = mixing.Mix(df, slots=500)
    slots = sorted((r.slot, r.source_key, r["rank"]) for r in mix.slots.collect())
    assert [s for s, _, _ in slots] == list(range(mix.n_slots))
    total = mix.plan.agg({"target": "sum"}).first()[0]
    share = {r.source_key: r.target / total for r in mix.plan.collect()}
    ranks = defaultdict(list)
    for _, key, rank in slots:
        ranks[key].append(rank)
    assert all(v == list(range(len(v))) for v in ranks.values())
    half = slots[:len(slots) // 2]
    for key, part in share.items():
        assert abs(sum(k == key for _, k, _ in half) - part * len(half)) <= 6
    pieces = mix.pieces().collect()
    by_slot = defaultdict(int)
    for p in pieces:
        by_slot[p.slot] += p.n_words
    assert set(by_slot.values()) <= {mix.block_words} | {v for v in by_slot.values() if v < mix.block_words}


def test_odd_rows_and_empty_tables(odd_docs, no_docs, word):
    rows = mixing.Mix(odd_docs).taken().collect()
    sizes = sorted(len(word.findall(r.text or "")) for r in odd_docs.collect())
    assert sorted(r["size"] for r in rows) == sizes
    assert all(r.taken <= 3 * r["size"] for r in rows)
    assert mixing.Mix(no_docs).taken().collect() == []
    assert {r.taken for r in mixing.Mix(odd_docs.filter("text IS NULL")).taken().collect()} == {0}


@pytest.mark.parametrize("slots", [8, 50])
def test_tiny_sources_reach_their_targets_with_long_blocks(spark, slots):
    """Blocks of thousands of words, sources below one block and of a few blocks."""
    per = {"a": 1, "b": 3, "big": 20000, "c": 40, "d": 700, "e": 2, None: 5, "other": 9000}
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate((s, n) for s, n in per.items() for _ in range(10))]
    mix = mixing.Mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), slots=slots)
    assert mix.block_words > 2000
    slot = sorted((r.slot, r.source_key) for r in mix.slots.collect())
    assert [k for k, _ in slot] == list(range(mix.n_slots)) and slots <= mix.n_slots <= slots + len(per)
    expected, taken = filled({s: 10 * n for s, n in per.items()}), defaultdict(int)
    for r in mix.taken().collect():
        assert r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    for s, target in expected.items():
        assert abs(taken[s] - target) <= 0.5, s
