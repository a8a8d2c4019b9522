"""Point-in-time over several satellites, links, carried values."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import vault
from tessera.operators.sequence import carried_forward

DAY = dt.date(2024, 1, 1)


def test_carried_forward_equals_plain_window_with_a_hot_entity(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "b", None]), DAY + dt.timedelta(days=rng.randint(0, 900)), i,
             rng.choice([None, None, i]), rng.choice([None, None, None, str(i)])) for i in range(1200)]
    df = spark.createDataFrame(rows, "e string, d date, i int, x int, y string").repartition(6)
    w = Window.partitionBy("e").orderBy("d", "i").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("e", "d", "i", *[F.last(c, ignorenulls=True).over(w).alias(c) for c in ("x", "y")])
    got = carried_forward(df, "e", ["d", "i"], ["x", "y"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_snapshots_take_each_satellites_last_load(spark):
    rng = random.Random(9)
    loads = {name: sorted({(k, DAY + dt.timedelta(days=rng.randint(0, 60))) for k in "abcd" for _ in range(rng.randint(0, 5))})
             for name in ("one", "two", "three")}
    sats = {n: spark.createDataFrame(v, "hk string, load_date date") for n, v in loads.items()}
    first, last = DAY + dt.timedelta(days=5), DAY + dt.timedelta(days=50)
    got = {(r.hk, r.snapshot_date): (r.one_load_date, r.two_load_date, r.three_load_date)
           for r in vault.point_in_time_all(sats, "hk", first, last).collect()}
    want = {}
    for k in "abcd":
        for n in range(5, 51):
            day = DAY + dt.timedelta(days=n)
            held = tuple(max((d for x, d in loads[s] if x == k and d <= day), default=None) for s in sats)
            if any(held):
                want[k, day] = held
    assert got == want


def test_link_and_its_satellite_keep_unchanged_rows(spark):
    rows = spark.createDataFrame([("p1", "n1", 1), ("p1", "n2", 1)], "p string, n string, v int")
    link = vault.load_link(None, rows, ["p", "n"], "hk", DAY, "x")
    sat = vault.load_satellite(None, rows, ["p", "n"], "hk", ["v"], DAY, "x")
    later = spark.createDataFrame([("p1", "n1", 1), ("p1", "n2", 2), ("p2", "n1", 1)], "p string, n string, v int")
    assert vault.load_link(link, later, ["p", "n"], "hk", DAY, "x").count() == 1
    assert sorted(r.v for r in vault.load_satellite(sat, later, ["p", "n"], "hk", ["v"], DAY, "x").collect()) == [1, 2]
    assert set(link.columns) == {"hk", "hk_p", "hk_n", "load_date", "record_source"}
