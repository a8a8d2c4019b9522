"""Per-entity sequence functions (LEAD, LAG, ROW_NUMBER, first value, running
sums, trailing RANGE-frame sums) without pinning a hot entity to one task.

``Window.partitionBy(entity)`` sends every row of an entity to one task; an
entity holding a third of the table (an "unknown patient" key, a bot user)
then sorts a third of the data alone.  Here the order column is cut into
buckets (months of a date, about 16 steps per doubling of a number):

1. the functions are computed inside each (entity, bucket), so a task gets one
   bucket of an entity;
2. one aggregate row per (entity, bucket) holds its first and last row, count
   and sums; a window over these few rows gives each bucket the head of the
   next one, the tail of the one before, and the totals of all before;
3. both meet in an equi-join on (entity, bucket).

All of it is one lazy plan: nothing is sampled, collected or run while the plan
is built, and the result equals the plain window for any data (NULL entities
form one group, NULL order values come first, running sums skip NULLs).
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

STEPS_PER_DOUBLING = 16


def _entity_list(entity: str | Sequence[str]) -> list[str]:
    return [entity] if isinstance(entity, str) else list(entity)


def order_bucket(df: DataFrame, col: str, steps: int = STEPS_PER_DOUBLING) -> Column:
    """A coarse value that never falls as ``col`` rises."""
    kind, c = df.schema[col].dataType, F.col(col)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.trunc(c.cast("date"), "month")
    if isinstance(kind, T.NumericType):
        x = c.cast("double")
        size = F.abs(x) + 1
        octave = F.floor(F.log2(size))
        step = octave * steps + F.floor((size / F.pow(F.lit(2.0), octave) - 1) * steps)
        return F.when(F.isnan(x), F.lit(1 << 40)).otherwise(F.when(x < 0, -step).otherwise(step))
    return F.substring(c.cast("string"), 1, 2)


def _sum_type(df: DataFrame, col: str) -> T.DataType:
    return df.select(F.sum(col)).schema[0].dataType


def neighbors(df: DataFrame, entity: str | Sequence[str], order_cols: Sequence[str],
              values: Sequence[str] = (), lead: bool = True, lag: bool = False,
              row_number: str | None = None, first: Sequence[str] = (),
              running_sums: Sequence[str] = (),
              prefix_next: str = "next_", prefix_prev: str = "prev_",
              prefix_first: str = "first_", prefix_cum: str = "cum_") -> DataFrame:
    """``df`` plus, per entity ordered by ``order_cols`` (a total order):
    ``next_<v>`` / ``prev_<v>`` for each value column, an optional 1-based
    ``row_number`` column, ``first_<v>`` (value at the entity's first row)
    for each column in ``first`` and ``cum_<c>`` (running sum up to and
    including the row) for each column in ``running_sums``."""
    ents, cols = _entity_list(entity), df.columns
    x = df.withColumn("_bucket", order_bucket(df, order_cols[0]))
    w = Window.partitionBy(*ents, "_bucket").orderBy(*order_cols)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = [F.row_number().over(w).alias("_rn"), F.lead(F.lit(True)).over(w).alias("_has_next"),
             *[F.lead(v).over(w).alias(f"_n_{v}") for v in values if lead],
             *[F.lag(v).over(w).alias(f"_p_{v}") for v in values if lag],
             *[F.sum(c).over(upto).alias(f"_c_{c}") for c in running_sums]]
    carry = list(dict.fromkeys([*values, *first]))
    packed = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)],
                      *[F.col(c).alias(f"v_{c}") for c in carry])
    g = x.groupBy(*ents, "_bucket").agg(
        F.min(packed).alias("_head"), F.max(packed).alias("_tail"), F.count(F.lit(1)).alias("_rows"),
        *[F.sum(c).alias(f"_s_{c}") for c in running_sums])
    over = Window.partitionBy(*ents).orderBy("_bucket")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    g = g.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate([*ents, "_bucket"])],
        F.lead("_head").over(over).alias("_next_head"), F.lag("_tail").over(over).alias("_prev_tail"),
        F.first("_head").over(over.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_first_head"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        *[F.sum(f"_s_{c}").over(before).alias(f"_o_{c}") for c in running_sums])
    same = functools.reduce(lambda p, q: p & q, (
        F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate([*ents, "_bucket"])))
    y = x.select("*", *inner).join(g, same)
    out = [F.col(c) for c in cols]
    out += [F.when(F.col("_has_next").isNull(), F.col(f"_next_head.v_{v}")).otherwise(F.col(f"_n_{v}"))
            .alias(f"{prefix_next}{v}") for v in values if lead]
    out += [F.when(F.col("_rn") == 1, F.col(f"_prev_tail.v_{v}")).otherwise(F.col(f"_p_{v}"))
            .alias(f"{prefix_prev}{v}") for v in values if lag]
    if row_number:
        out.append((F.col("_rn") + F.col("_offset")).cast("int").alias(row_number))
    out += [F.col(f"_first_head.v_{v}").alias(f"{prefix_first}{v}") for v in first]
    for c in running_sums:
        here, earlier = F.col(f"_c_{c}"), F.col(f"_o_{c}")
        out.append(F.coalesce(here + earlier, here, earlier).cast(_sum_type(df, c)).alias(f"{prefix_cum}{c}"))
    return y.select(*out)


def carried_forward(df: DataFrame, entity: str | Sequence[str], order_cols: Sequence[str],
                    values: Sequence[str]) -> DataFrame:
    """``df`` with each null in ``values`` replaced by the entity's last known
    value before it in ``order_cols`` (a total order).  Values known in earlier
    buckets come from one row per (entity, bucket)."""
    ents, cols = _entity_list(entity), df.columns
    x = df.withColumn("_bucket", order_bucket(df, order_cols[0]))
    upto = (Window.partitionBy(*ents, "_bucket").orderBy(*order_cols)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    place = F.struct(*order_cols)
    g = x.groupBy(*ents, "_bucket").agg(*[
        F.max_by(F.struct(v), F.when(F.col(v).isNotNull(), place)).alias(f"_l_{v}") for v in values])
    before = Window.partitionBy(*ents).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    g = g.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate([*ents, "_bucket"])],
                 *[F.last(f"_l_{v}.{v}", ignorenulls=True).over(before).alias(f"_e_{v}") for v in values])
    same = functools.reduce(lambda p, q: p & q, (
        F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate([*ents, "_bucket"])))
    known = {v: F.last(v, ignorenulls=True).over(upto).alias(f"_h_{v}") for v in values}
    y = x.select("*", *known.values()).join(g, same)
    return y.select(*[F.coalesce(f"_h_{c}", f"_e_{c}").alias(c) if c in known else F.col(c) for c in cols])


def trailing_sums(df: DataFrame, entity: str | Sequence[str], day_col: str, id_col: str,
                  value_cols: Sequence[str], lo_days: int, hi_days: int = 0,
                  prefix: str = "w_", seq: bool = True) -> DataFrame:
    """Per row: count and sums of ``value_cols`` over the entity's rows whose
    day lies in [day - lo_days, day - hi_days] (a RANGE frame on days, peers
    on the same day included), without a window over an entity's rows.

    Rows are added up per (entity, day) first, so the frames run over at most
    one row per calendar day of an entity; each row takes its day's frame by an
    equi-join.  ``<prefix>seq`` (if ``seq``) is the row's running position in
    (day, id) order: the rows of the days before, and those of the day up to
    the id; rows that repeat entity, day and id share the larger position.
    Rows without a day have an empty frame."""
    ents = _entity_list(entity)
    rows = df.withColumn("_day", F.datediff(F.col(day_col), F.lit("1970-01-01").cast("date")))
    daily = rows.groupBy(*ents, "_day").agg(F.count(F.lit(1)).alias("_n"),
                                            *[F.sum(v).alias(f"_s{i}") for i, v in enumerate(value_cols)])
    over = Window.partitionBy(*ents).orderBy("_day")
    frame, before = over.rangeBetween(-lo_days, -hi_days), over.rowsBetween(Window.unboundedPreceding, -1)

    def inside(c: str) -> Column:
        return F.when(F.col("_day").isNotNull(), F.sum(c).over(frame))

    keys = [*ents, "_day"]
    days = daily.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)],
        F.coalesce(inside("_n"), F.lit(0)).alias(f"{prefix}count"),
        *[F.coalesce(inside(f"_s{i}"), F.lit(0)).cast(_sum_type(df, v)).alias(f"{prefix}{v}") for i, v in enumerate(value_cols)],
        *([F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_earlier")] if seq else []))
    if seq:
        upto = Window.partitionBy(*keys).orderBy(id_col).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumn("_place", F.count(F.lit(1)).over(upto))
    same = functools.reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)))
    joined = rows.join(days, same)
    position = [(F.col("_earlier") + F.col("_place")).alias(f"{prefix}seq")] if seq else []
    return joined.select(*df.columns, *position, f"{prefix}count", *[f"{prefix}{v}" for v in value_cols])
