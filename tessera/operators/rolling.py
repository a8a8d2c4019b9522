"""Exact rolling distinct counts over calendar-day windows.

Spark rejects COUNT(DISTINCT) as a window function, and a range self-join
on the group keys tests every (day, user-day) pair of a group, which grows
with history length and skews on large groups.  Instead each activity row is
shifted onto the target days it counts for:

    (day d, group g, id u)  ->  (d + k, g, u, k)   for k = 0 .. W-1

then ``min(k)`` per (target day, g, u) says in which windows u is present,
and one count per (target day, g) gives every window size at once.

Shuffle plan: rows are hash-partitioned once by (group, id).  That
partitioning already satisfies the per-(target, group, id) aggregate, so the
W-fold expansion never crosses the network; only one row per (target day,
group) and task reaches the final shuffle.  A hot group is spread over its
ids; one id contributes at most W rows per active day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rolling_distinct(df: DataFrame, day_col: str, group_cols: Sequence[str], id_col: str,
                     windows: dict[str, int], num_partitions: int | None = None,
                     out_day: str | None = None) -> DataFrame:
    """Distinct ``id_col`` per trailing window, for each (day, group).

    ``windows`` maps output column -> window length in days (window includes
    the day itself).  Rows with a NULL group value are skipped: an equality
    join on NULL never matches, so such groups count zero (ruling R2).
    Output covers every day on which any window is non-empty.
    """
    w_max = max(windows.values())
    out_day = out_day or day_col
    keys = list(group_cols) + [id_col]
    base = df.select(F.col(day_col).alias("_d"), *[F.col(c) for c in keys])
    for c in group_cols:
        base = base.where(F.col(c).isNotNull())
    base = base.where(F.col(id_col).isNotNull())
    parts = [num_partitions] if num_partitions else []
    base = base.repartition(*parts, *keys)
    shifted = base.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(w_max - 1))).alias("_k"),
                          "_d")
    shifted = shifted.select(*keys, "_k", F.date_add("_d", F.col("_k")).alias("_t"))
    present = shifted.groupBy("_t", *keys).agg(F.min("_k").alias("_k"))
    counts = present.groupBy("_t", *group_cols).agg(
        *[F.count_if(F.col("_k") < n).alias(name) for name, n in windows.items()])
    return counts.withColumnRenamed("_t", out_day)


def rolling_distinct_approx(df: DataFrame, day_col: str, group_cols: Sequence[str], id_col: str,
                            windows: dict[str, int], lg_config_k: int = 12,
                            out_day: str | None = None) -> DataFrame:
    """Approximate variant: one HLL sketch per (day, group), unioned over a
    calendar RANGE window of days and estimated.  State per group is one
    small sketch per day (a few KB), independent of the number of ids, so
    it also suits continuously maintained aggregates.  Relative error is
    about 1.6 % at ``lg_config_k=12``.  Rows are the (day, group) pairs with
    activity."""
    out_day = out_day or day_col
    base = df.where(F.col(id_col).isNotNull())
    for c in group_cols:
        base = base.where(F.col(c).isNotNull())
    daily = base.groupBy(day_col, *group_cols).agg(
        F.hll_sketch_agg(F.col(id_col), lg_config_k).alias("_sk"))
    epoch = F.datediff(F.col(day_col), F.lit("1970-01-01").cast("date"))
    part = Window.partitionBy(*group_cols).orderBy(epoch)
    cols = [F.hll_sketch_estimate(F.hll_union_agg("_sk").over(part.rangeBetween(-(n - 1), 0)))
            .alias(name) for name, n in windows.items()]
    return daily.select(F.col(day_col).alias(out_day), *group_cols, *cols)
