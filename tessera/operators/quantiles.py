"""Mergeable quantile sketches (A22, X9's approximate quantiles).

A KLL sketch per (keys, day) is stored once; a period of any length is answered
by merging its days' sketches, without reading the rows again.  ``k`` sets the
size: the rank of a returned quantile is off by at most ``rank_error(k)`` of
the rows with 99 % confidence, whatever the number of sketches merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 400


def rank_error(k: int = K) -> float:
    """Normalised rank error at 99 % confidence (published fit for KLL)."""
    return 2.296 / k ** 0.9021


def daily_sketches(rows: DataFrame, keys: Sequence[str], day: str, value: str, k: int = K) -> DataFrame:
    """keys, day, n, sketch: null values are not counted."""
    x = F.col(value).cast("double")
    return (rows.where(x.isNotNull()).groupBy(*keys, day)
            .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch")))


def period_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One sketch per key over the given days."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(sketches: DataFrame, keys: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """keys, n, share, value: one row per share."""
    asked = [F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(s))).alias("value"))
             for s in shares]
    return sketches.select(*keys, "n", F.inline(F.array(*asked)))


def rank_bounds(rows: DataFrame, found: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``found`` with the exact share of rows below and up to each value."""
    asked = found.groupBy(*keys).agg(F.collect_list("value").alias("_asked"), F.collect_list("share").alias("_shares"))
    x = F.col(value).cast("double")
    pair = F.explode(F.arrays_zip("_shares", "_asked")).alias("p")
    # A few asked values per key meet each row of the key and are added up in the task.
    met = rows.where(x.isNotNull()).join(asked, list(keys))
    exact = met.select(*keys, x.alias("_x"), pair).groupBy(*keys, F.col("p._shares").alias("share")).agg(
        (F.count_if(F.col("_x") < F.col("p._asked")) / F.count(F.lit(1))).alias("share_below"),
        (F.count_if(F.col("_x") <= F.col("p._asked")) / F.count(F.lit(1))).alias("share_upto"))
    return found.join(exact, [*keys, "share"])
