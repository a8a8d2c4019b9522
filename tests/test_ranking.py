"""Ranks from distributed counts against plain windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.ranking import ranked


def rows(spark, n=1500, seed=2):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        v = rng.choice([None, 0.0, 0.0, 0.0, float(rng.randint(-9, 9)), rng.uniform(-1e6, 1e6), float("nan"), 1e-9])
        out.append((i * 7 % n, rng.choice(["a", "a", "a", "b", None]), v, rng.choice([None, 1, 2, 50])))
    out += [(n, "one", 3.5, 4), (n + 1, "two", None, None), (n + 2, "two", None, 6)]
    return spark.createDataFrame(out, "k long, g string, v double, amount long").repartition(7)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("nulls_last", [False, True])
def test_equals_plain_windows(spark, descending, nulls_last):
    df = rows(spark)
    v = F.col("v")
    by = {(False, False): v.asc_nulls_first(), (False, True): v.asc_nulls_last(),
          (True, False): v.desc_nulls_first(), (True, True): v.desc_nulls_last()}[descending, nulls_last]
    w, t = Window.partitionBy("g").orderBy(by), Window.partitionBy("g").orderBy(by, "k")
    want = df.select("*", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"), F.percent_rank().over(w).alias("p"),
                     F.row_number().over(t).alias("n"), F.ntile(4).over(t).alias("t4"), F.ntile(7).over(t).alias("t7"),
                     F.coalesce(F.sum("amount").over(t.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)).alias("s"))
    got = ranked(df, "g", "v", "k", descending, nulls_last, rank="r", dense_rank="d", percent_rank="p", row_number="n",
                 ntile={"t4": 4, "t7": 7}, running_sums={"s": "amount"})

    def norm(x):
        return sorted(tuple(repr(round(c, 9) if isinstance(c, float) else c) for c in r) for r in x.select(*want.columns).collect())

    assert norm(got) == norm(want)


def test_no_window_over_a_whole_group_of_rows(spark):
    """Windows on rows name the value or the cell; those that name the group
    alone run on one row per bucket."""
    df = spark.range(100_000).selectExpr("id AS k", "'g' AS g", "cast(id % 1000 AS double) AS v", "1L AS amount")
    out = ranked(df, "g", "v", "k", rank="r", ntile={"t": 4}, running_sums={"s": "amount"})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and "row_number" in line:
            assert "_tie" in line
    assert out.agg(F.max("r"), F.count_if(F.col("t") == 1), F.max("s")).first()[:] == (99_901, 25_000, 100_000)


def test_empty(spark):
    assert ranked(rows(spark).limit(0), "g", "v", "k", rank="r", ntile={"t": 4}).collect() == []
