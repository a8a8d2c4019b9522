"""Operator 4 -- mixing sources to target weights by a low-discrepancy schedule.

The mix is a sequence of slots.  Slot k gets the point
frac((k + 1/2) * golden ratio); the point's place among the cumulative target
weights names the slot's source, so every stretch of the mix holds each source
in its proportion.  A source that no point names gets a slot of its own, put in
at a golden-ratio place among the others.  The slots of a source are ranked in
slot order and share its target, rounded to whole words: rank r takes block r
of the source's shuffled words, laid end to end as often as needed (the blocks
of a source differ by one word at most, so a document may be cut).  So each
source's taken words are its target to half a word, however long a block is.

Sources in code-point order, null last, weigh 5, 2, 1, 5, 2, 1, ... and share
the total of all sizes by weight; a target stops at ``max_repeats`` times its
source's size and the excess is shared by weight among the others.

Nothing depends on the size of one source: running totals go through hash
buckets (sums per bucket, then offsets, then a window inside the bucket), so a
source with a third of the rows is spread over all of them.  Only the table of
sources (one row each) is ranked in one task.

Defined cases: a null text has size 0, takes nothing and returns taken 0; a
null source is a source of its own; repeated rows are separate documents; an
empty table, or one without any word, gives an empty schedule and taken 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.text import words
from tessera.operators.sinks import materialize

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: Points of a schedule at most; blocks hold about total / SLOTS words.
SLOTS = 1 << 18
BUCKETS = 1024
GOLDEN = 0.6180339887498949
CELLS = 4096
SEED = 20177


def sized(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, source, a non-null source key, size in words."""
    return docs.select(
        F.col(id_col).alias(id_col), F.col("source").cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("source_key"),
        F.size(words("text")).cast("long").alias("size"))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: weight, size, target and the target in whole words.

    With the sources in order of cap / weight, a source is capped if and only
    if its cap is below its share of what the sources before it leave."""
    per = sizes.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]),
                                         rank % len(weights)))
    cap = (max_repeats * F.col("source_size")).cast("double")
    per = per.withColumn("cap", cap).withColumn("level", F.col("cap") / F.col("weight"))
    everything = W.partitionBy()
    before = W.orderBy("level", "source_key").rowsBetween(W.unboundedPreceding, -1)
    per = (per.withColumn("left", F.sum("source_size").over(everything)
                          - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("weight_left", F.sum("weight").over(everything)
                       - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    per = per.withColumn("capped", F.col("level") <= F.col("left") / F.col("weight_left"))
    free = F.when(~F.col("capped"), F.col("weight"))
    rest = (F.sum("source_size").over(everything)
            - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0.0)))
    target = F.when(F.col("capped"), F.col("cap")).otherwise(
        rest * F.col("weight") / F.sum(free).over(everything))
    return (per.withColumn("target", target)
            .select("source_key", "source", "weight", "source_size", "target",
                    F.least(F.round("target"), F.col("cap")).cast("long").alias("target_words")))


def _ranked(rows: DataFrame, key: str, bucket: Column, order: list, value: Column) -> DataFrame:
    """Adds ``total_before``: the sum of ``value`` over the rows of the same key
    that come before in (bucket, order); one task holds one bucket of a key."""
    rows = rows.withColumn("bucket", bucket)
    sums = rows.groupBy(key, "bucket").agg(F.sum(value).alias("bucket_sum"))
    earlier = W.partitionBy(key).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(key, "bucket", F.coalesce(F.sum("bucket_sum").over(earlier), F.lit(0))
                       .alias("offset"))
    inside = W.partitionBy(key, "bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (rows.join(sums, [key, "bucket"])
            .withColumn("total_before", F.col("offset") + F.coalesce(F.sum(value).over(inside), F.lit(0))))


def schedule(plan: DataFrame, slots: int, cells: int = CELLS, start: float = 0.5) -> DataFrame:
    """slot, source_key and the slot's rank within its source; ``slots`` points
    and one more slot for each source without a point.

    Points find their interval of the cumulative weights by cell: an interval
    is listed in each cell it touches, a point only in its own."""
    spark = plan.sparkSession
    everything = W.partitionBy()
    upto = W.orderBy("source_key").rowsBetween(W.unboundedPreceding, 0)
    share = F.sum("target").over(upto) / F.sum("target").over(everything)
    bounds = plan.filter(F.col("target") > 0).select("source_key", share.alias("high"))
    low = F.coalesce(F.lag("high").over(W.orderBy("source_key")), F.lit(0.0))
    last = F.lead("high").over(W.orderBy("source_key")).isNull()
    bounds = bounds.select("source_key", low.alias("low"),
                           F.when(last, F.lit(1.0)).otherwise(F.col("high")).alias("high"))
    bounds = bounds.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1)))))
    point = (F.col("id") + F.lit(start)) * F.lit(GOLDEN)
    points = spark.range(slots).select(F.col("id").alias("slot"), (point - F.floor(point)).alias("x"))
    points = points.withColumn("cell", F.floor(F.col("x") * cells))
    placed = materialize(points.join(bounds, "cell").filter("low <= x AND x < high")
                         .select("source_key", "slot", F.lit(0).alias("late")), "mix-points")
    # Sources with words to give and no point: one row each, ranked in one task.
    missed = plan.filter("target_words > 0").join(placed.select("source_key").distinct(), "source_key", "left_anti")
    place = F.row_number().over(W.orderBy("source_key")) * F.lit(GOLDEN)
    missed = missed.select("source_key", F.floor((place - F.floor(place)) * slots).alias("slot"), F.lit(1).alias("late"))
    together = placed.unionByName(missed).withColumn("all", F.lit(0))
    one = F.lit(1).cast("long")
    numbered = _ranked(together, "all", F.floor(F.col("slot") / F.lit(BUCKETS)), ["slot", "late", "source_key"], one)
    numbered = numbered.select("source_key", F.col("total_before").alias("slot"))
    return (_ranked(numbered, "source_key", F.floor(F.col("slot") / F.lit(BUCKETS)), ["slot"], one)
            .select("source_key", "slot", F.col("total_before").alias("rank")))


class Mix:
    """The mix of ``docs``: per-document rows (``placed``), the ``plan`` of
    sources, the ``slots``, the ``blocks`` of each source (``block_words`` words
    at most) and the ``pieces`` each slot takes."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", weights: tuple = WEIGHTS,
                 max_repeats: int = MAX_REPEATS, slots: int = SLOTS, seed: int = SEED):
        spark = docs.sparkSession
        self.id_col, self.max_repeats = id_col, max_repeats
        # Texts are read once: everything below works on ids and sizes.
        self.sizes = materialize(sized(docs, id_col), "mix-sizes")
        self.plan = materialize(targets(self.sizes, weights, max_repeats).coalesce(1), "mix-targets")
        total = self.plan.agg(F.sum("source_size")).first()[0] or 0
        points = -(-total // max(1, -(-total // slots)))
        spread = F.xxhash64(F.col(id_col), F.lit(seed))
        shuffled = self.sizes.withColumn("spread", spread)
        placed = _ranked(shuffled, "source_key", F.pmod(F.col("spread"), F.lit(BUCKETS)),
                         ["spread", id_col, "size"], F.col("size"))
        # Repeated rows stay apart by their place in the bucket.
        same = W.partitionBy("source_key", "bucket").orderBy("spread", id_col, "size")
        self.placed = placed.select(id_col, "source", "source_key", "bucket", "size",
                                    F.row_number().over(same).alias("row"),
                                    F.col("total_before").alias("start"))
        self.slots = materialize(schedule(self.plan, points) if points else spark.createDataFrame(
            [], "source_key string, slot long, rank long"), "mix-slots")
        # A source's first ``longer`` blocks hold one word more than ``block``.
        per = self.slots.groupBy("source_key").agg(F.count("*").alias("blocks"))
        self.blocks = materialize(self.plan.join(per, "source_key").select(
            "source_key", "source_size", "target_words", "blocks", F.expr("target_words div blocks").alias("block"),
            F.expr("target_words % blocks").alias("longer")).coalesce(1), "mix-blocks")
        self.n_slots, self.block_words = self.blocks.agg(
            F.coalesce(F.sum("blocks"), F.lit(0)),
            F.coalesce(F.max(F.col("block") + F.sign("longer").cast("long")), F.lit(0))).first()

    def pieces(self) -> DataFrame:
        """One row per (slot, document) overlap: which words of the document,
        and in which repeat of its source, the slot takes."""
        docs = self.placed.filter("size > 0").join(self.blocks, "source_key")
        repeat = F.explode(F.sequence(F.lit(0), F.lit(self.max_repeats - 1)))
        laid = docs.withColumn("repeat", repeat).withColumn(
            "at", F.col("start") + F.col("repeat") * F.col("source_size"))
        laid = laid.filter("at < target_words").withColumn("end", F.least(F.expr("at + size"), F.col("target_words")))

        def block(word: str) -> Column:
            return F.expr(f"CASE WHEN {word} < longer * (block + 1) THEN {word} div (block + 1) "
                          f"ELSE longer + ({word} - longer * (block + 1)) div greatest(block, 1) END")

        laid = laid.withColumn("rank", F.explode(F.sequence(block("at"), block("(end - 1)"))))
        begin = F.greatest(F.col("at"), F.expr("rank * block + least(rank, longer)"))
        end = F.least(F.col("end"), F.expr("(rank + 1) * block + least(rank + 1, longer)"))
        return (laid.join(self.slots, ["source_key", "rank"])
                .select(self.id_col, "source_key", "bucket", "row", "slot", "rank", "repeat",
                        (begin - F.col("at")).alias("first_word"), (end - begin).alias("n_words")))

    def taken(self) -> DataFrame:
        """One row per document with the words that the mix takes of it."""
        key = ["source_key", "bucket", "row"]
        taken = self.pieces().groupBy(*key).agg(F.sum("n_words").alias("taken"))
        return (self.placed.join(taken, key, "left")
                .join(self.plan.select("source_key", "source_size", "target"), "source_key")
                .select(self.id_col, "source", "size", "source_size", "target",
                        F.coalesce(F.col("taken"), F.lit(0)).cast("long").alias("taken")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return Mix(docs).taken().select("doc_id", "size", "source_size", "target", "taken")
