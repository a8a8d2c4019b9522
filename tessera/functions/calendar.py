"""Date dimension (S12) and date spine.

Both are generated with ``sequence`` + ``explode``.  Their size is bounded by
the number of calendar days in the range, not by the data, so they are the
only inputs this library broadcasts without a runtime size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.exprs import date_key

# US federal holidays by rule (month, rule).  "nth weekday"
# rules use Spark's dayofweek numbering (1 = Sunday ... 7 = Saturday);
# n = -1 means the last such weekday of the month.
FIXED_DATE_HOLIDAYS = [(1, 1), (6, 19), (7, 4), (11, 11), (12, 25)]  # (month, day)
JUNETEENTH_FIRST_YEAR = 2021
NTH_WEEKDAY_HOLIDAYS = [
    (1, 2, 3),    # Martin Luther King Jr. Day: third Monday of January
    (2, 2, 3),    # Washington's Birthday: third Monday of February
    (5, 2, -1),   # Memorial Day: last Monday of May
    (9, 2, 1),    # Labor Day: first Monday of September
    (10, 2, 2),   # Columbus Day: second Monday of October
    (11, 5, 4),   # Thanksgiving: fourth Thursday of November
]


def _is_federal_holiday(d: Column) -> Column:
    m, dom, dow = F.month(d), F.dayofmonth(d), F.dayofweek(d)
    cond = F.lit(False)
    for month, day in FIXED_DATE_HOLIDAYS:
        c = (m == month) & (dom == day)
        if (month, day) == (6, 19):
            c = c & (F.year(d) >= JUNETEENTH_FIRST_YEAR)
        cond = cond | c
    nth = F.floor((dom - 1) / 7) + 1
    is_last = F.dayofmonth(F.last_day(d)) - dom < 7
    for month, weekday, n in NTH_WEEKDAY_HOLIDAYS:
        which = is_last if n == -1 else (nth == n)
        cond = cond | ((m == month) & (dow == weekday) & which)
    return cond


def _dates_between(spark: SparkSession, start, end) -> DataFrame:
    s = F.lit(start).cast("date") if not isinstance(start, Column) else start
    e = F.lit(end).cast("date") if not isinstance(end, Column) else end
    return spark.range(1).select(F.explode(F.sequence(s, e)).alias("full_date"))


def with_date_attributes(dates: DataFrame, fiscal_start_month: int = 10) -> DataFrame:
    """Add the 15 date-dimension attributes to a frame holding ``full_date``."""
    d = F.col("full_date")
    shift = (13 - fiscal_start_month) % 12
    fiscal_year = F.year(F.add_months(d, shift)) if shift else F.year(d)
    fiscal_no = ((F.month(d) - fiscal_start_month + 12) % 12) + 1
    return dates.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.dayofweek(d).cast("byte").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).cast("byte").alias("day_of_month"),
        F.dayofyear(d).cast("short").alias("day_of_year"),
        F.weekofyear(d).cast("byte").alias("week_of_year"),
        F.weekofyear(d).cast("byte").alias("iso_week"),
        F.month(d).cast("byte").alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).cast("byte").alias("quarter_number"),
        F.year(d).cast("short").alias("year_number"),
        F.format_string("FY%d-P%02d", fiscal_year, fiscal_no).alias("fiscal_period"),
        (~F.dayofweek(d).isin(1, 7)).alias("is_weekday"),
        _is_federal_holiday(d).alias("is_federal_holiday"),
    )


def date_dimension(spark: SparkSession, start, end, fiscal_start_month: int = 10) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive."""
    return with_date_attributes(_dates_between(spark, start, end), fiscal_start_month)


def date_dimension_for(bounds: DataFrame, fiscal_start_month: int = 10) -> DataFrame:
    """Date dimension covering a data-derived range.

    ``bounds`` is a one-row frame with ``min_date`` / ``max_date`` (an
    aggregate over the facts), so the range follows the data.
    """
    dates = bounds.select(F.explode(F.sequence(F.col("min_date"), F.col("max_date")))
                          .alias("full_date"))
    return with_date_attributes(dates, fiscal_start_month)


MAX_SPINE_DAYS = 3650


def date_spine_for(bounds: DataFrame, max_days: int | None = MAX_SPINE_DAYS) -> DataFrame:
    """Consecutive dates from ``start_date`` to ``end_date``; fails if there are
    more than ``max_days`` (the source generator's row count; None: any number)."""
    s, e = F.col("start_date"), F.col("end_date")
    end = e
    if max_days is not None:
        too_many = F.raise_error(F.lit(f"over {max_days} days: the spine would lose dates")).cast("date")
        end = F.when(F.datediff(e, s) >= max_days, too_many).otherwise(e)
    return bounds.where(s <= e).select(
        F.explode(F.sequence(s, end)).alias("spine_date"))
