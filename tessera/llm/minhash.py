"""Operator 3 -- near-duplicates by HyperMinHash.

A document's set holds the 64-bit hashes of its distinct word shingles.  Its
sketch has one register per bucket (the top bits of a hash choose the bucket):
the least of the bucket's remaining bits, stored as its leading-zero count and
the mantissa bits after it.  An empty bucket copies the bucket that a fixed
random sequence reaches first; the register's sign tells own values (negative)
from copies, and only own values count in estimates.

1. Documents with the same set form a class (two 64-bit sums of the set); the
   class stands behind its smallest doc_id, so copies cost nothing further.
2. Bands of registers of the representatives meet in buckets.
3. Leaders: a representative is compared with the smallest one it meets.  Pairs
   pass a size bound (no pair beyond it can reach the threshold), then the
   collision-corrected similarity estimate of the registers, then the exact
   comparison of the full sets.  Linked documents get their component.
4. Rest: pairs that meet in a bucket but lie in different components go through
   the same comparison, unless their bitmaps rule it out: each set is also kept
   as a bitmap of ``BITMAP`` bits by hash, and a bit that only one set has stands
   for an element that the other lacks.  So no pair that a band brings together
   is lost, while the members of a large group, and texts that merely share a
   passage, are not compared with each other.
5. Hot buckets: where more than ``HOT`` representatives of different components
   meet, pairs are not formed by bucket.  All documents of such buckets are
   joined by their rarest shingles instead: the smaller of two similar sets
   shares one of its n - ceil(2t / (1 + t) * n) + 1 rarest elements with the
   n - ceil(t * n) + 1 rarest of the larger one, and what comes after the first
   common one must still suffice for the threshold.  Many texts that share most
   of their words without reaching the threshold thus meet nowhere: their
   rarest elements are their own.

With ``BANDS`` bands of ``ROWS`` registers a pair at similarity 0.8 shares no
band with probability (1 - 0.8**ROWS)**BANDS, about 1e-7.

Hot groups: classes and leaders are minima summed up before the shuffle; the
joins back to them are plain equi-joins that AQE splits.  Nothing per group is
gathered in a task, and nothing of documents' size reaches the driver.

Defined cases: texts that are null or have no word have the empty set, link
with nothing and stand alone; with fewer words than a shingle the whole
sequence is the one shingle; rows that repeat a doc_id count as one document
for linking and are all returned; a null doc_id is its class's smallest id's
copy, or alone; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.arrow_text import LOWER, Spans, TextSlice, WORDS, bounded_batches, mix64, slices
from tessera.llm.text import total
from tessera.operators.sinks import materialize

BUCKET_BITS = 8
MANTISSA_BITS = 9
BITMAP = 2048
ROWS, BANDS = 5, 40
THRESHOLD = 80
#: The estimate may be so many standard deviations below the threshold.
SLACK = 5.0
#: Representatives in a bucket that are still compared pair by pair.
HOT = 256
#: Ids are broadcast up to this many (8 bytes each); beyond it they are shuffled.
BROADCAST_IDS = 2_000_000
_SEQUENCE = np.random.default_rng(33).integers(0, 1 << BUCKET_BITS, (64, 1 << BUCKET_BITS))


def shingle_sets(part: TextSlice, words: int) -> Iterator[np.ndarray]:
    """The sorted set of each text of a slice."""
    spans = Spans(part, WORDS)
    h = spans.hashes(LOWER)
    n = spans.per_text()
    combined = mix64(h + np.uint64(words))
    for k in range(1, words):  # shingle i: words i .. i + words - 1
        combined = mix64(combined[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[k:]) if len(combined) > 1 else combined[:0]
    for first, count in zip(spans.first[:-1].tolist(), n.tolist()):
        if count >= words:
            yield np.unique(combined[first:first + count - words + 1])
        elif count:
            value = np.uint64(count)
            for x in h[first:first + count]:
                value = mix64(np.array([value ^ x]))[0] + np.uint64(1)
            yield np.array([value], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def compress(values: np.ndarray) -> np.ndarray:
    """Leading zeros (high bits) and mantissa of numbers of 64 - BUCKET_BITS bits."""
    width = 64 - BUCKET_BITS
    exponent = np.frexp(values.astype(np.float64))[1]  # bits in use
    zeros = np.clip(width - exponent, 0, 63)
    # The bits after the leading one.
    rest = values << np.minimum(zeros + 1, width).astype(np.uint64)
    mantissa = (rest & np.uint64((1 << width) - 1)) >> np.uint64(width - MANTISSA_BITS)
    return (zeros.astype(np.uint16) << np.uint16(MANTISSA_BITS)) | mantissa.astype(np.uint16)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of registers per (non-empty) set."""
    size = 1 << BUCKET_BITS
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    bucket = owner * size + (flat >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    # Sets are sorted, so the first of a bucket is its least.
    least = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(flat) else bucket
    out = np.zeros(len(sets) * size, np.uint16)
    filled = np.zeros(len(sets) * size, bool)
    out[bucket[least]] = compress(flat[least] & np.uint64((1 << (64 - BUCKET_BITS)) - 1))
    filled[bucket[least]] = True
    out, filled = out.reshape(-1, size), filled.reshape(-1, size)
    held, empty, own = out.copy(), ~filled, filled.copy()
    for source in _SEQUENCE:
        if not empty.any():
            break
        take = empty & filled[:, source]
        out[take] = held[:, source][take]
        empty &= ~take
    if empty.any():  # the sequence reached no filled bucket: the next one to the right
        for k in range(1, size):
            take = empty & np.roll(filled, -k, 1)
            out[take] = np.roll(held, -k, 1)[take]
            empty &= ~take
    return out.view(np.int16) | np.where(own, np.int16(-0x8000), np.int16(0))


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``BITMAP`` bits per set, as 64-bit words."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    out = np.zeros((len(sets), BITMAP), bool)
    out[owner, (flat % np.uint64(BITMAP)).astype(np.int64)] = True
    return np.packbits(out, axis=1).view(np.int64)


#: Two different minima get the same code if their leading-zero counts agree
#: (probability 1/3, the sum of 4**-z) and their mantissas do.
CHANCE = 2.0 ** -MANTISSA_BITS / 3


def estimate(equal, filled):
    """Similarity from the number of buckets filled in either set and of those
    with equal own values in both, corrected for equal codes by chance."""
    share = equal / filled
    return (share - CHANCE) / (1 - CHANCE)


def allowance(filled, union, threshold: int):
    """Variance of the estimate at the threshold: ``filled`` values drawn
    without replacement out of a union of that size."""
    t = threshold / 100
    return t * (1 - t) / filled * (1 - (filled - 1) / union)


def sketches(docs: DataFrame, words: int, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, the set's two sums, registers (null if empty), bitmap."""
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = list(shingle_sets(part, words))
            rows = registers([s for s in sets if len(s)])
            coded, held = iter(rows), []
            for s in sets:
                held.append(next(coded) if len(s) else None)
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "sum_a": pa.array([int(mix64(s).sum(dtype=np.uint64).view(np.int64)) for s in sets], pa.int64()),
                "sum_b": pa.array([int(mix64(s ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64).view(np.int64))
                                   for s in sets], pa.int64()),
                "registers": pa.array(held, pa.list_(pa.int16())),
                "bits": pa.array(list(bitmaps(sets)), pa.list_(pa.int64()))})

    return given.mapInArrow(run, "doc_id long, n_shingles long, sum_a long, sum_b long, registers array<short>, bits array<long>")


def _near(n: str, m: str, threshold: int):
    """Sizes that allow the threshold: similarity is at most min / max."""
    return 100 * F.least(n, m) >= threshold * F.greatest(n, m)


def estimated(pairs: DataFrame, sketch: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose registers leave the threshold possible."""
    side = sketch.select("doc_id", "n_shingles", "registers")
    both = (pairs.join(side.toDF("a", "n_a", "r_a"), "a").join(side.toDF("b", "n_b", "r_b"), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = dict(zip(batch.schema.names, batch.columns))
            a, b = (col[c].flatten().to_numpy().reshape(-1, 1 << BUCKET_BITS) for c in ("r_a", "r_b"))
            equal, filled = ((a == b) & (a < 0)).sum(1), ((a < 0) | (b < 0)).sum(1)
            union = np.maximum((col["n_a"].to_numpy() + col["n_b"].to_numpy()) / (1 + threshold / 100), filled)
            low = threshold / 100 - SLACK * np.sqrt(allowance(filled, union, threshold))
            keep = pa.array(estimate(equal, filled) >= low)
            yield pa.RecordBatch.from_pydict({"a": col["a"].filter(keep), "b": col["b"].filter(keep)})

    return both.mapInArrow(run, "a long, b long")


def _texts_of(ids: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    """doc_id and text of the documents listed in ``ids`` (a written table)."""
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    few = ids.count() <= BROADCAST_IDS
    return given.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def verified(pairs: DataFrame, docs: DataFrame, words: int, threshold: int, id_col: str = "doc_id") -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    ids = materialize(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "minhash-ids")
    given = _texts_of(ids, docs, id_col)

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"),
                "hashes": pa.array([s.tobytes() for s in shingle_sets(part, words)], pa.binary())})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = dict(zip(batch.schema.names, batch.columns))
            keep = []
            for x, y in zip(col["h_a"], col["h_b"]):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                merged = np.sort(np.concatenate([x, y]))
                common = int((merged[1:] == merged[:-1]).sum())
                keep.append(100 * common >= threshold * (len(x) + len(y) - common))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_pydict({"a": col["a"].filter(keep), "b": col["b"].filter(keep)})

    sets = given.mapInArrow(to_sets, "doc_id long, hashes binary")
    both = pairs.join(sets.toDF("a", "h_a"), "a").join(sets.toDF("b", "h_b"), "b")
    return both.mapInArrow(compare, "a long, b long").distinct()


def rare_pairs(ids: DataFrame, docs: DataFrame, words: int, threshold: int, id_col: str = "doc_id") -> DataFrame:
    """(a, b) of different components that may reach the threshold, among the
    documents in ``ids`` (doc_id, component; written): those that share a rare
    shingle early enough.  No pair that reaches it is missing."""
    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = list(shingle_sets(part, words))
            n = np.array([len(s) for s in sets])
            key = np.array([int(mix64(s).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0 for s in sets])
            own = np.repeat(np.arange(len(sets)), n)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(own)), pa.array(key[own], pa.int64()), pa.array(n[own], pa.int64()),
                 pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64))], names=["doc_id", "key", "n", "hash"])

    listed = materialize(ids.select("doc_id").distinct(), "minhash-hot-ids")
    tokens = materialize(_texts_of(listed, docs, id_col).mapInArrow(exploded, "doc_id long, key long, n long, hash long").distinct(),
                         "minhash-hot-shingles")
    times = tokens.groupBy("hash").agg(F.count("*").alias("times"))
    large = F.expr(f"cast(n - ({threshold} * n + 99) div 100 + 1 AS int)")
    small = F.expr(f"n - (2 * {threshold} * n + {99 + threshold}) div {100 + threshold} + 1")
    first = F.slice(F.sort_array(F.collect_list(F.struct("times", "hash"))), 1, large)
    ranked = (tokens.join(times, "hash").groupBy("doc_id", "key", "n").agg(first.alias("first"))
              .select("doc_id", "n", F.posexplode("first").alias("pos", "x")).filter("x.times > 1")
              .select("doc_id", "n", "pos", F.col("x.hash").alias("hash"), small.alias("small")).join(ids, "doc_id"))
    ranked = materialize(ranked, "minhash-hot-prefixes")
    one = ranked.filter("pos < small").select("hash", *(F.col(c).alias(f"{c}_a") for c in ("doc_id", "n", "pos", "component")))
    two = ranked.select("hash", *(F.col(c).alias(f"{c}_b") for c in ("doc_id", "n", "pos", "component")))
    enough = F.expr(f"{100 + threshold} * least(n_a - pos_a, n_b - pos_b) >= {threshold} * (n_a + n_b)")
    smaller = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("doc_id_a") < F.col("doc_id_b")))
    return (one.join(two, "hash").filter(smaller & (F.col("component_a") != F.col("component_b")) & _near("n_a", "n_b", threshold) & enough)
            .select(F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b")).distinct())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest node reachable, for every node with an
    edge.  Each round takes the least label among the neighbours, then the
    label's own label; it ends when no label changes."""
    both = materialize(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
                       .union(edges.select(F.col(b), F.col(a))).distinct(), "components-edges")
    labels = materialize(both.groupBy("u").agg(F.min("v").alias("least"))
                         .select(F.col("u").alias("node"), F.least("u", "least").alias("component")),
                         "components-labels")
    while True:
        near = (both.join(labels.toDF("v", "label"), "v").groupBy("u").agg(F.min("label").alias("least"))
                .select(F.col("u").alias("node"), "least"))
        step = labels.join(near, "node").select("node", "component", F.least("component", "least").alias("next"))
        jump = step.select(F.col("node").alias("next"), F.col("next").alias("far"))
        step = materialize(step.join(jump, "next").select(
            "node", "component", F.least("next", "far").alias("next")), "components-labels")
        changed = step.filter("component <> next").limit(1).count()
        labels = step.select("node", F.col("next").alias("component"))
        if not changed:
            return labels


def _open_pair(threshold: int) -> Column:
    """Of rows that meet in a band: pairs of different components whose common
    part, as far as sizes and bitmaps bound it, can reach the threshold.

    A set has at most as many elements in the common part as bits in common
    and elements that share a bit with another one (``crowd``)."""
    bits = functools.reduce(lambda x, y: x + y, (
        F.bit_count(F.col(f"a{i}").bitwiseAND(F.col(f"b{i}"))) for i in range(BITMAP // 64)))
    most = F.least("crowd_a", "crowd_b") + bits
    return ((F.col("c_a") < F.col("c_b")) & _near("n_a", "n_b", threshold)
            & ((100 + threshold) * most >= threshold * (F.col("n_a") + F.col("n_b"))))


def near_duplicates(docs: DataFrame, words: int = 5, threshold: int = THRESHOLD,
                    id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``."""
    sketch = materialize(sketches(docs, words, id_col), "minhash-sketches")
    filled = sketch.filter((F.col("n_shingles") > 0))
    key = ["n_shingles", "sum_a", "sum_b"]
    classes = materialize(filled.groupBy(*key).agg(F.min("doc_id").alias("rep")), "minhash-classes")
    # The representatives' sketches (a repeated id has its sketch once).
    reps = materialize(filled.join(classes.filter("rep IS NOT NULL"), key)
                       .filter("doc_id = rep").select("doc_id", "n_shingles", "registers", "bits")
                       .dropDuplicates(["doc_id", "n_shingles", "registers"]), "minhash-representatives")
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                       lambda i: F.xxhash64(i, F.slice("registers", i * ROWS + 1, ROWS)))
    # Outer, or Spark would make the keys once more for a filter on their number.
    bands = reps.select("doc_id", "n_shingles", F.explode_outer(keys).alias("band"))
    meet = bands.groupBy("band").agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("other"),
                                     F.min(F.struct("doc_id", "n_shingles"))["n_shingles"].alias("leader_n"))
    members = materialize(bands.join(meet.filter("leader < other").drop("other"), "band"), "minhash-members")

    def check(pairs: DataFrame, name: str) -> DataFrame:
        possible = materialize(estimated(pairs, reps, threshold), f"minhash-{name}-candidates")
        return materialize(verified(possible, docs, words, threshold, id_col), f"minhash-{name}-links")

    # Leaders: one comparison per representative.
    led = (members.filter((F.col("leader") < F.col("doc_id")) & _near("n_shingles", "leader_n", threshold))
           .groupBy("doc_id").agg(F.min("leader").alias("leader")))
    links = check(led.select(F.col("doc_id").alias("a"), F.col("leader").alias("b")), "leader")
    found = components(links)
    # Rest: pairs in a band across components.
    labelled = (members.join(found.toDF("doc_id", "component"), "doc_id", "left")
                .select("band", "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component")))
    split = (labelled.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .filter("low < high").select("band"))
    filled_bits = total(F.transform("bits", lambda x: F.bit_count(x)))
    open_rows = materialize(
        labelled.join(split, "band").join(reps.select("doc_id", "n_shingles", "bits"), ["doc_id", "n_shingles"])
        .select("band", "doc_id", "n_shingles", "component", (F.col("n_shingles") - filled_bits).alias("crowd"),
                *(F.get("bits", F.lit(i)).alias(f"bits{i}") for i in range(BITMAP // 64))), "minhash-open")
    hot = materialize(open_rows.groupBy("band").count().filter(F.col("count") > HOT).select("band"), "minhash-hot-bands")
    crowded = bool(hot.limit(1).count())
    cold_rows = open_rows.join(hot, "band", "left_anti") if crowded else open_rows
    one, two = (cold_rows.toDF("band", side, f"n_{side}", f"c_{side}", f"crowd_{side}",
                               *(f"{side}{i}" for i in range(BITMAP // 64))) for side in "ab")
    rest = one.join(two, "band").filter(_open_pair(threshold)).select("a", "b").distinct()
    if crowded:
        ids = materialize(open_rows.join(hot, "band").select("doc_id", "component").distinct(), "minhash-hot")
        rest = rest.union(rare_pairs(ids, docs, words, threshold, id_col)).distinct()
    more = check(rest, "rest")
    if more.limit(1).count():
        found = components(links.union(more))
    # Back from classes to documents.
    named = (classes.join(found.toDF("rep", "component"), "rep", "left")
             .select(*key, F.coalesce("component", "rep").alias("component")))
    rows = sketch.select("doc_id", *key).join(named, key, "left")
    component = F.coalesce("component", "doc_id")
    return rows.select("doc_id", "n_shingles", component.alias("component_id"),
                       F.col("doc_id").eqNullSafe(component).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, words=4)


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
edge AS (SELECT a AS u, b AS v FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS u, doc_id AS v FROM d UNION SELECT reach.u, edge.v FROM reach JOIN edge ON edge.u = reach.v),
comp AS (SELECT u, min(v) AS c FROM reach GROUP BY u)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, comp.c AS component_id, doc_id = comp.c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN comp ON comp.u = d.doc_id
"""
