"""Operator 1 -- benchmark decontamination by SimHash of item-sized windows.

Words are lower-cased; a text's shingles are its runs of ``SHINGLE`` words (an
item with fewer words has its whole sequence as its one shingle).

1. Windows: similarity needs shared shingles, so only windows that hold one are
   cut.  A document's shingles meet the benchmark's; each meeting puts a window
   of the item's size where the item would start.  No window without a common
   shingle can be similar, so nothing is lost and most texts end here.
2. Fingerprints: the SimHash of each window and item, 64 bits, every shingle
   weighing as often as it occurs.
3. Multi-index: fingerprints are cut into ``RADIUS + 1`` blocks.  Two that differ
   in at most ``RADIUS`` bits agree in a block (there are more blocks than
   differing bits).  A block has few bits, so it selects little by itself; the
   join key is a block together with a rare shingle.  Of a window or item of n
   shingles (equal ones told apart by number) only the n - ceil(n *
   ``THRESHOLD`` %) + 1 rarest in the benchmark count: two texts that are
   similar enough share one of these, in whatever order they are ranked, if it
   is the same for both.  A window with more shingles than that outside the
   benchmark matches nothing and goes at once.  So the equi-join on (size,
   shingle, block, bits) finds every similar window and item within the radius;
   the bit count of their difference keeps those.
4. Verification: the weighted shingle similarity, sum of the smaller counts
   over the sum of the larger, must be ``THRESHOLD`` percent or more.

At similarity 0.8 the expected distance is 9.7 bits with a deviation of 2.9;
beyond a radius of 19 lie about three pairs in ten thousand, and fewer the more
similar they are.

All steps are DataFrame expressions.  The benchmark's shingles are broadcast
if they are at most ``BROADCAST_ROWS``, counted first, and shuffled otherwise;
the same holds for the places of windows in the documents.

Defined cases: null and empty texts share nothing; items without words are
ignored; null ids on either side are ignored; repeated rows and ids give one
row per (doc_id, item_id): the most similar of the windows that shared shingles
place, the first one of equals;
a window never leaves its text, one longer than the text is the whole text;
empty tables give an empty result.  Only ids and texts are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.text import WORD, total, whole
from tessera.operators.sinks import materialize

SHINGLE = 5
THRESHOLD = 80
BITS = 64
RADIUS = 19
BROADCAST_ROWS = 2_000_000


def lower_words(text: str) -> Column:
    return F.regexp_extract_all(F.lower(whole(text)), F.lit(WORD), F.lit(0))


def shingles(w: str, n: int) -> Column:
    """Hashes of the n-word runs of the array column ``w``, in order."""
    runs = F.transform(w, lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, n))))
    return F.slice(runs, 1, F.greatest(F.size(w) - (n - 1), F.lit(0)))


def simhash(hashes: str) -> Column:
    """Bit b is set if more than half of the hashes have it set."""
    half = F.size(hashes) / 2.0

    def bit(acc: Column, b: Column) -> Column:
        ones = F.filter(hashes, lambda h: F.getbit(h, b) == 1)
        return acc.bitwiseOR(F.when(F.size(ones) > half, F.call_function("shiftleft", F.lit(1).cast("long"), b))
                             .otherwise(F.lit(0).cast("long")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"), bit)


def blocks(fingerprint: str, radius: int = RADIUS) -> Column:
    """array<struct<block, bits>>: ``radius + 1`` blocks of nearly equal width."""
    n = radius + 1
    edges = [BITS * k // n for k in range(n + 1)]
    parts = []
    for k, (low, high) in enumerate(zip(edges[:-1], edges[1:])):
        value = F.shiftrightunsigned(F.col(fingerprint), low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        parts.append(F.struct(F.lit(k).alias("block"), value.alias("bits")))
    return F.array(*parts)


def common(a: str, b: str) -> Column:
    """Sum over the distinct elements of the smaller of their two counts."""
    def times(col: str, h: Column) -> Column:
        return F.size(F.filter(col, lambda x: x == h)).cast("long")

    return total(F.transform(F.array_distinct(b), lambda h: F.least(times(a, h), times(b, h))))


def _bounded(df: DataFrame, weight: Column | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a written table whose row count (or sum of ``weight``) is
    within the limit."""
    total = df.agg(F.sum(F.lit(1) if weight is None else weight)).first()[0] or 0
    return F.broadcast(df) if total <= limit else df


def numbered(hashes: str) -> Column:
    """array<struct<hash, nth>>: equal hashes of a list told apart."""
    return F.transform(hashes, lambda x, i: F.struct(
        x.alias("hash"), F.size(F.filter(F.slice(hashes, 1, i), lambda y: y == x)).alias("nth")))


def rarest(rows: DataFrame, keys: list[str], hashes: str, seen: DataFrame, threshold: int) -> DataFrame:
    """keys, hash, nth: of each list the shingles that a similar list must
    share one of, without those that the benchmark does not have.  ``seen``:
    hash, times (in the benchmark)."""
    tokens = rows.select(*keys, F.size(hashes).alias("n"), F.explode_outer(numbered(hashes)).alias("token"))
    tokens = tokens.select(*keys, "n", "token.hash", "token.nth").join(seen, "hash", "left")
    ranked = F.sort_array(F.collect_list(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "hash", "nth")))
    kept = F.expr(f"cast(n - ({threshold} * n + 99) div 100 + 1 AS int)")
    some = tokens.groupBy(*keys, "n").agg(ranked.alias("ranked")).select(*keys, F.explode(F.slice("ranked", 1, kept)).alias("x"))
    return some.select(*keys, "x.hash", "x.nth", "x.times").filter("times > 0").drop("times")


def candidates(windows: DataFrame, items: DataFrame, radius: int, threshold: int) -> DataFrame:
    """doc_id, size, start, print, item_id, item_print: windows (doc_id, size,
    start, print, hashes) and items (item_id, size, item_print, item_hashes)
    that agree in a rare shingle and a block."""
    seen = items.select("item_id", F.explode(F.array_distinct("item_hashes")).alias("hash"))
    seen = _bounded(materialize(seen.groupBy("hash").agg(F.count("*").alias("times")), "decontamination-times"))
    left = rarest(windows, ["doc_id", "size", "start", "print"], "hashes", seen, threshold)
    right = rarest(items, ["item_id", "size", "item_print"], "item_hashes", seen, threshold)
    left = left.select("*", F.inline(blocks("print", radius)))
    right = right.select("*", F.inline(blocks("item_print", radius)))
    return left.join(right, ["size", "hash", "nth", "block", "bits"]).select(
        "doc_id", "size", "start", "print", "item_id", "item_print").distinct()


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", shingle: int = SHINGLE,
            radius: int = RADIUS, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, item_id, start_word (from 0), n_words, similarity."""
    texts = docs.select(F.col(id_col).alias("doc_id"), lower_words("text").alias("w")).filter("doc_id IS NOT NULL")
    items = benchmark.select("item_id", lower_words("text").alias("w")).filter(
        "item_id IS NOT NULL AND size(w) > 0")
    items = items.select("item_id", "w", F.size("w").alias("size"), F.least(F.size("w"), F.lit(shingle)).alias("run"))
    lengths = [r[0] for r in items.select("run").distinct().collect()]  # at most ``shingle`` numbers

    def by_length(rows: DataFrame, n: int) -> DataFrame:
        return rows.filter(F.col("run") == n).withColumn("hashes", shingles("w", n))

    hits, windows, coded = [], [], []
    for n in sorted(lengths):
        own = by_length(items, n)
        # The outer explode keeps Spark from filtering on the array's size below
        # the projection that makes it, which would make it anew per element.
        found = own.select("size", F.posexplode_outer("hashes").alias("offset", "hash")).distinct()
        found = _bounded(materialize(found, "decontamination-shingles"))
        grams = texts.select("doc_id", F.size("w").alias("length"), shingles("w", n).alias("hashes")).select(
            "doc_id", "length", F.posexplode_outer("hashes").alias("pos", "hash"))
        last = F.greatest(F.col("length") - F.col("size"), F.lit(0))
        hits.append(grams.join(found, "hash").select(
            "doc_id", F.lit(n).alias("run"), "size",
            F.greatest(F.least(F.col("pos") - F.col("offset"), last), F.lit(0)).alias("start")))
        coded.append(own.select("item_id", "size", "hashes"))
    if not hits:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, item_id long, start_word long, n_words long, similarity double")
    where = hits[0]
    fingerprints = coded[0]
    for more, other in zip(hits[1:], coded[1:]):
        where, fingerprints = where.union(more), fingerprints.union(other)
    where = where.groupBy("doc_id").agg(F.collect_set(F.struct("run", "size", "start")).alias("places"))
    where = materialize(where, "decontamination-windows")
    # Windows are cut inside the document's row; then only they travel.
    cut = (texts.join(_bounded(where, F.size("places")), "doc_id").select("doc_id", F.explode_outer(F.transform(
        "places", lambda p: F.struct(p["run"].alias("run"), p["size"].alias("size"), p["start"].alias("start"),
                                     F.slice("w", p["start"] + 1, p["size"]).alias("w")))).alias("p"))
           .select("doc_id", "p.*"))
    for n in sorted(lengths):
        windows.append(by_length(cut, n).select("doc_id", "size", "start", "hashes"))
    found = windows[0]
    for more in windows[1:]:
        found = found.union(more)
    found = materialize(found.withColumn("print", simhash("hashes")).dropDuplicates(["doc_id", "size", "start", "print"]),
                        "decontamination-prints")
    fingerprints = materialize(fingerprints.withColumn("item_print", simhash("hashes")).withColumnRenamed("hashes", "item_hashes")
                               .dropDuplicates(["item_id", "size", "item_print"]), "decontamination-items")
    near = candidates(found, fingerprints, radius, threshold).filter(
        F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
    pairs = (near.join(found, ["doc_id", "size", "start", "print"]).join(fingerprints, ["item_id", "size", "item_print"]))
    pairs = pairs.select("doc_id", "item_id", "size", "start", F.size("hashes").alias("n_a"),
                         F.size("item_hashes").alias("n_b"), common("hashes", "item_hashes").alias("both"))
    either = F.col("n_a") + F.col("n_b") - F.col("both")
    best = (pairs.filter(100 * F.col("both") >= threshold * either)
            .groupBy("doc_id", "item_id").agg(F.max(F.struct(
                (F.col("both") / either).alias("similarity"), (-F.col("start")).alias("before"), "size")).alias("m")))
    return best.select("doc_id", "item_id", (-F.col("m.before")).cast("long").alias("start_word"),
                       F.col("m.size").cast("long").alias("n_words"), F.col("m.similarity").alias("similarity"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"),
                   spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


# Every window of an item's size that shares a shingle, without fingerprints.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark WHERE text IS NOT NULL),
dg AS (SELECT doc_id, p, n, array_to_string(w[p + 1:p + 5], ' ') AS g
       FROM (SELECT doc_id, w, len(w) AS n, unnest(range(0, len(w) - 4)) AS p FROM d WHERE len(w) >= 5)),
ig AS (SELECT item_id, p, n, array_to_string(w[p + 1:p + 5], ' ') AS g
       FROM (SELECT item_id, w, len(w) AS n, unnest(range(0, len(w) - 4)) AS p FROM i WHERE len(w) >= 5)),
win AS (SELECT DISTINCT doc_id, ig.n AS size, greatest(least(dg.p - ig.p, dg.n - ig.n), 0) AS start, dg.n AS length
        FROM dg JOIN ig ON dg.g = ig.g),
wg AS (SELECT win.doc_id, size, start, least(size, length) - 4 AS total, g, count(*) AS c
       FROM win JOIN dg ON dg.doc_id = win.doc_id AND dg.p >= start AND dg.p <= start + size - 5 GROUP BY ALL),
ic AS (SELECT item_id, n, g, count(*) AS c FROM ig GROUP BY ALL),
sim AS (SELECT doc_id, item_id, size, start, sum(least(wg.c, ic.c)) AS shared, any_value(total) + n - 4 AS sums
        FROM wg JOIN ic ON wg.g = ic.g AND ic.n = wg.size GROUP BY doc_id, item_id, size, start, n),
hit AS (SELECT *, shared / (sums - shared) AS similarity FROM sim WHERE 100 * shared >= 80 * (sums - shared))
SELECT doc_id, item_id, start::BIGINT AS start_word, size::BIGINT AS n_words, similarity::DOUBLE AS similarity
FROM hit QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""
