"""Ranks within groups from distributed order statistics.

``Window.partitionBy(group).orderBy(value)`` sorts a whole group in one task.
Here a group's rows never meet:

1. rows are counted per cell (group, value, bucket of the tie-break key); a
   value held by any number of rows is one count for each bucket of its ties;
2. inside a (group, bucket of values) running sums over cells give how many
   rows and distinct values come before a cell; a few totals per bucket, summed
   over the buckets before, complete them;
3. every row takes its cell's numbers by an equi-join; its place among its
   equals is its row number inside the cell.

``rank``, ``dense_rank`` and ``percent_rank`` follow from the counts alone;
``row_number``, ``ntile`` and running sums also need the place in the cell.
Buckets are monotone in the value (``sequence.order_bucket``), so the result
is that of the plain window for any data: nulls order as given, null groups are
one group, rows with an equal tie-break key too share the order of a window
(any of them may come first).
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.sequence import order_bucket

STEPS = 256


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return functools.reduce(lambda x, y: x & y, (F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)))


def ranked(df: DataFrame, group: str | Sequence[str], value: str, key: str, descending: bool = False,
           nulls_last: bool = True, rank: str | None = None, dense_rank: str | None = None,
           percent_rank: str | None = None, row_number: str | None = None,
           ntile: dict[str, int] | None = None, running_sums: dict[str, str] | None = None) -> DataFrame:
    """``df`` plus the named columns, per ``group`` in order of ``value``, then
    of ``key`` (ascending).  ``ntile``: column -> number of tiles;
    ``running_sums``: column -> summed column (rows before and this one, a null
    adding nothing)."""
    groups = [group] if isinstance(group, str) else list(group)
    tiles, sums = ntile or {}, running_sums or {}
    placed = bool(row_number or tiles or sums)
    tie = order_bucket(df, key, STEPS) if placed else F.lit(0)
    rows = df.withColumns({"_value": order_bucket(df, value, STEPS), "_tie": tie})

    def by(c: str) -> Column:
        if descending:
            return F.col(c).desc_nulls_last() if nulls_last else F.col(c).desc_nulls_first()
        return F.col(c).asc_nulls_last() if nulls_last else F.col(c).asc_nulls_first()

    adds = {f"_s{i}": F.coalesce(F.sum(c), F.lit(0)) for i, c in enumerate(sums.values())}
    cells = rows.groupBy(*groups, "_value", value, "_tie").agg(
        F.count(F.lit(1)).alias("_n"), *[x.alias(c) for c, x in adds.items()])
    # Inside a bucket of values.
    bucket = Window.partitionBy(*groups, "_value")
    upto_value = bucket.orderBy(by(value))
    before_cell = bucket.orderBy(by(value), F.col("_tie").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    here = Window.partitionBy(*groups, "_value", value)
    cells = cells.select(
        "*", (F.sum("_n").over(upto_value) - F.sum("_n").over(here)).alias("_less"),
        F.dense_rank().over(upto_value).alias("_dense"),
        F.coalesce(F.sum("_n").over(before_cell), F.lit(0)).alias("_before"),
        *[F.coalesce(F.sum(c).over(before_cell), F.lit(0)).alias(f"_b{c}") for c in adds])
    # Buckets: one row each.
    totals = cells.groupBy(*groups, "_value").agg(
        F.sum("_n").alias("_bucket_n"), F.max("_dense").alias("_bucket_dense"),
        *[F.sum(c).alias(f"_t{c}") for c in adds])
    order = Window.partitionBy(*groups).orderBy(by("_value"))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate([*groups, "_value"])],
        F.coalesce(F.sum("_bucket_n").over(earlier), F.lit(0)).alias("_off"),
        F.coalesce(F.sum("_bucket_dense").over(earlier), F.lit(0)).alias("_off_dense"),
        F.sum("_bucket_n").over(Window.partitionBy(*groups)).alias("_all"),
        *[F.coalesce(F.sum(f"_t{c}").over(earlier), F.lit(0)).alias(f"_o{c}") for c in adds])
    names = [*groups, "_value"]
    cells = cells.join(totals, _same(names, [f"_g{i}" for i in range(len(names))]))
    names = [*groups, value, "_tie"]
    cells = cells.select(
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(names)], (F.col("_off") + F.col("_less") + 1).alias("_rank"),
        (F.col("_off_dense") + F.col("_dense")).alias("_dense_rank"), (F.col("_off") + F.col("_before")).alias("_base"), "_all",
        *[(F.col(f"_o{c}") + F.col(f"_b{c}")).alias(f"_base{c}") for c in adds])
    if placed:
        inside = Window.partitionBy(*groups, value, "_tie").orderBy(key)
        upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.select("*", F.row_number().over(inside).alias("_place"),
                           *[F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(f"_in_s{i}") for i, c in enumerate(sums.values())])
    joined = rows.join(cells, _same(names, [f"_c{i}" for i in range(len(names))]))
    out = [F.col(c) for c in df.columns]
    if rank:
        out.append(F.col("_rank").cast("int").alias(rank))
    if dense_rank:
        out.append(F.col("_dense_rank").cast("int").alias(dense_rank))
    if percent_rank:
        out.append(F.when(F.col("_all") > 1, (F.col("_rank") - 1) / (F.col("_all") - 1)).otherwise(F.lit(0.0)).alias(percent_rank))
    number = F.col("_base") + F.col("_place")
    if row_number:
        out.append(number.cast("int").alias(row_number))
    for name, n in tiles.items():
        small, larger = F.floor(F.col("_all") / n), F.col("_all") % n
        wide = larger * (small + 1)
        tile = F.when(number <= wide, F.floor((number - 1) / (small + 1)) + 1).otherwise(
            larger + F.floor((number - 1 - wide) / F.greatest(small, F.lit(1))) + 1)
        out.append(tile.cast("int").alias(name))
    for i, name in enumerate(sums):
        out.append((F.col(f"_base_s{i}") + F.col(f"_in_s{i}")).alias(name))
    return joined.select(*out)
