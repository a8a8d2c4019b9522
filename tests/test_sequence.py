"""The bucketed sequence functions equal plain windows, including a hot entity
that spans many buckets, NULL entities, composite entities and single-row
entities."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.sequence import neighbors


def _reference(df, ents):
    w = Window.partitionBy(*ents).orderBy("t", "id")
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.select("*", F.lead("v").over(w).alias("next_v"), F.lag("v").over(w).alias("prev_v"),
                     F.row_number().over(w).alias("rn"), F.first("t").over(full).alias("first_t"))


def _compare(spark, rows, ents=("e",)):
    schema = "e long, g string, t long, id long, v string"
    df = spark.createDataFrame(rows, schema)
    got = neighbors(df, list(ents), ["t", "id"], ["v"], lead=True, lag=True, row_number="rn",
                    first=["t"])
    assert sorted(got.collect(), key=repr) == sorted(_reference(df, list(ents)).collect(), key=repr)


def test_hot_entity_spans_partitions(spark):
    rng = random.Random(7)
    rows = [(0, "x", rng.randrange(1000), i, f"h{i}") for i in range(3000)]            # hot
    rows += [(rng.randrange(1, 300), "x", rng.randrange(1000), 10_000 + i, f"c{i}")
             for i in range(1500)]
    rows += [(None, "x", rng.randrange(50), 20_000 + i, f"n{i}") for i in range(40)]   # NULL
    _compare(spark, rows)


def test_composite_entity(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2]), rng.choice(["a", "b", None]), rng.randrange(100), i, f"v{i}")
            for i in range(800)]
    _compare(spark, rows, ents=("e", "g"))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, 3, None]), st.integers(0, 20)),
                min_size=1, max_size=60))
def test_matches_window_property(spark, pairs):
    rows = [(e, "x", t, i, f"v{i}") for i, (e, t) in enumerate(pairs)]
    _compare(spark, rows)


def test_trailing_sums_match_range_window(spark):
    import datetime as dt
    from decimal import Decimal

    from tessera.operators.sequence import trailing_sums

    rng = random.Random(11)
    base = dt.date(2020, 1, 1)
    rows = []
    for i in range(2500):
        e = 0 if i < 1200 else rng.randrange(1, 60)                      # one hot entity
        rows.append((e, f"r{i}", base + dt.timedelta(days=rng.randrange(400)),
                     Decimal(rng.randrange(0, 10000)) / 100))
    df = spark.createDataFrame(rows, "e long, id string, d date, amt decimal(14,2)")
    for lo, hi in ((90, 0), (182, 1)):
        got = trailing_sums(df, "e", "d", "id", ["amt"], lo, hi)
        day = F.datediff("d", F.lit("1970-01-01").cast("date"))
        w = Window.partitionBy("e").orderBy(day).rangeBetween(-lo, -hi)
        want = df.select("*", F.count("*").over(w).alias("w_count"),
                         F.sum("amt").over(w).alias("w_amt"))
        g = {r.id: (r.w_count, r.w_amt or 0) for r in got.collect()}
        x = {r.id: (r.w_count, r.w_amt or 0) for r in want.collect()}
        assert g == x, (lo, hi)


def test_running_sums_with_nulls_and_every_order_type(spark):
    """Sums skip NULLs and are NULL before the first value, as in a window;
    order columns of dates, negative and fractional numbers and text, with NULLs."""
    import datetime as dt
    from decimal import Decimal

    rng = random.Random(2)
    rows = []
    for i in range(1500):
        day = None if rng.random() < 0.02 else dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(900))
        rows.append((rng.choice([0, 0, 0, 1, None]), day, rng.choice([None, rng.uniform(-5000, 5000), 0.0, -1.0, 8.0]),
                     rng.choice([None, "", "a", "ab", "abc", "é", "zz"]), i,
                     None if i < 400 or rng.random() < 0.5 else Decimal(rng.randrange(1000)) / 100))
    df = spark.createDataFrame(rows, "e long, d date, n double, s string, id long, x decimal(14,2)")
    for order in ("d", "n", "s", "id"):
        got = neighbors(df, "e", [order, "id"], ["id"], lag=True, row_number="rn", running_sums=["x"])
        w = Window.partitionBy("e").orderBy(order, "id")
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        want = df.select("*", F.lead("id").over(w).alias("next_id"), F.lag("id").over(w).alias("prev_id"),
                         F.row_number().over(w).alias("rn"), F.sum("x").over(upto).alias("cum_x"))
        assert got.schema["cum_x"].dataType == want.schema["cum_x"].dataType
        assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr), order


def test_trailing_sums_with_repeated_ids(spark):
    import datetime as dt

    from tessera.operators.sequence import trailing_sums

    rows = [(1, "a", dt.date(2020, 1, d), 1) for d in (1, 1, 5, 9)] + [(2, "a", dt.date(2020, 1, 5), 7), (2, "b", None, 1)]
    df = spark.createDataFrame(rows, "e long, id string, d date, amt long")
    got = sorted(((r.e, r.d.day, r.w_count, r.w_amt) for r in trailing_sums(df, "e", "d", "id", ["amt"], 4, 0).collect()
                  if r.d))
    assert got == [(1, 1, 2, 2), (1, 1, 2, 2), (1, 5, 3, 3), (1, 9, 2, 2), (2, 5, 1, 7)]


def test_building_the_plan_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "plan-only")
    df = spark.range(100).selectExpr("id % 3 e", "id t", "id", "'v' v")
    neighbors(df, "e", ["t", "id"], ["v"], running_sums=["t"], row_number="rn")
    assert not tracker.getJobIdsForGroup("plan-only")
    spark.sparkContext.setJobGroup("", "")
