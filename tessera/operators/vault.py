"""Data-vault loading (X6): hubs, satellites with hash diffs, links, and
point-in-time (PIT) tables.

Hub and link loads insert only unseen hash keys (anti join on the key
column).  A satellite row is inserted when its hash diff differs from the
latest stored row of that hub key (latest taken with one hash aggregate).
The PIT table of one satellite spreads each satellite row over the snapshot
dates it is valid for (from its load date to the day before the next load
of the same key), which is an equi-partitioned explode whose output size
is exactly the PIT table: no range join between snapshots and history.

The PIT table of several satellites aligns their histories: the change points
of all of them are united per key, each satellite's last load is carried
forward over the points that are not its own, and the stretches between
neighbouring points are spread over the snapshot dates.  A key with a very
long history is cut into months (``sequence``) in both steps.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.dedup import latest_per_key
from tessera.operators.sequence import carried_forward, neighbors


def hash_key(*cols) -> F.Column:
    """MD5 of the upper-cased, trimmed business key parts joined by '|'."""
    return F.md5(F.concat_ws("|", *[F.upper(F.trim(F.col(c).cast("string"))) for c in cols]))


def hash_diff(cols: Sequence[str]) -> F.Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))


def load_hub(hub: DataFrame | None, staged: DataFrame, business_key: str, hub_key: str,
             load_date: _dt.date, source: str) -> DataFrame:
    rows = staged.select(hash_key(business_key).alias(hub_key), business_key).distinct()
    if hub is not None:
        rows = rows.join(hub.select(hub_key), hub_key, "left_anti")
    return rows.select(hub_key, business_key, F.lit(load_date).alias("load_date"),
                       F.lit(source).alias("record_source"))


def load_satellite(sat: DataFrame | None, staged: DataFrame, business_key: str | Sequence[str], hub_key: str,
                   attributes: Sequence[str], load_date: _dt.date, source: str) -> DataFrame:
    """Satellite of a hub (one business key) or of a link (several)."""
    keys = [business_key] if isinstance(business_key, str) else business_key
    rows = staged.select(hash_key(*keys).alias(hub_key),
                         hash_diff(attributes).alias("hash_diff"), *attributes)
    if sat is not None:
        latest = latest_per_key(sat.select(hub_key, "load_date", "hash_diff"), [hub_key],
                                ["load_date"])
        rows = (rows.join(latest.select(hub_key, F.col("hash_diff").alias("_prev")), hub_key,
                          "left")
                .where(F.col("_prev").isNull() | (F.col("_prev") != F.col("hash_diff")))
                .drop("_prev"))
    return rows.select(hub_key, F.lit(load_date).alias("load_date"), "hash_diff", *attributes,
                       F.lit(source).alias("record_source"))


def load_link(link: DataFrame | None, staged: DataFrame, business_keys: Sequence[str],
              link_key: str, load_date: _dt.date, source: str) -> DataFrame:
    rows = staged.select(hash_key(*business_keys).alias(link_key),
                         *[hash_key(k).alias(f"hk_{k}") for k in business_keys]).distinct()
    if link is not None:
        rows = rows.join(link.select(link_key), link_key, "left_anti")
    return rows.select("*", F.lit(load_date).alias("load_date"), F.lit(source).alias("record_source"))


def point_in_time(sat: DataFrame, hub_key: str, first_snapshot: _dt.date,
                  last_snapshot: _dt.date) -> DataFrame:
    """One row per (hub key, snapshot date) with the load date of the
    satellite row current at that snapshot (daily snapshots)."""
    # Next load of the same key.
    loads = sat.select(hub_key, "load_date").distinct()
    nxt = neighbors(loads, hub_key, ["load_date"], ["load_date"], lead=True)
    valid = nxt.select(hub_key, "load_date",
                       F.date_sub(F.col("next_load_date"), 1).alias("valid_to"))
    lo, hi = F.lit(first_snapshot), F.lit(last_snapshot)
    start = F.greatest(F.col("load_date"), lo)
    end = F.least(F.coalesce(F.col("valid_to"), hi), hi)
    return (valid.where(start <= end)
            .select(hub_key, F.explode(F.sequence(start, end)).alias("snapshot_date"),
                    F.col("load_date").alias("sat_load_date")))


def change_points(satellites: dict[str, DataFrame], hub_key: str) -> DataFrame:
    """hub key, from_date, to_date (null: still valid) and, per satellite, the
    load date of its row current in between (``<name>_load_date``, null before
    its first load).  One row per key and date on which any of them changed."""
    stacked = None
    for name, sat in satellites.items():
        loads = sat.select(hub_key, F.col("load_date").alias("from_date"), F.lit(name).alias("satellite"))
        stacked = loads if stacked is None else stacked.unionByName(loads)
    names = {name: f"{name}_load_date" for name in satellites}
    points = stacked.groupBy(hub_key, "from_date").agg(*[
        F.max(F.when(F.col("satellite") == name, F.col("from_date"))).alias(c) for name, c in names.items()])
    held = carried_forward(points, hub_key, ["from_date"], list(names.values()))
    nxt = neighbors(held, hub_key, ["from_date"], ["from_date"])
    return nxt.select(hub_key, "from_date", F.date_sub("next_from_date", 1).alias("to_date"), *names.values())


def point_in_time_all(satellites: dict[str, DataFrame], hub_key: str, first_snapshot: _dt.date,
                      last_snapshot: _dt.date) -> DataFrame:
    """One row per (hub or link key, daily snapshot) on which any satellite
    has a row, with each one's current load date."""
    spans = change_points(satellites, hub_key)
    lo, hi = F.lit(first_snapshot), F.lit(last_snapshot)
    start, end = F.greatest("from_date", lo), F.least(F.coalesce("to_date", hi), hi)
    return (spans.where(start <= end)
            .select(hub_key, F.explode(F.sequence(start, end)).alias("snapshot_date"),
                    *[f"{name}_load_date" for name in satellites]))


def as_of_snapshot(pit: DataFrame, satellites: dict[str, tuple[DataFrame, Sequence[str]]], hub_key: str) -> DataFrame:
    """``pit`` with attributes of each satellite's current row: equi-joins on
    (key, load date), which is what a PIT table is for."""
    out = pit
    for name, (sat, attributes) in satellites.items():
        rows = sat.select(F.col(hub_key).alias("_key"), F.col("load_date").alias("_date"), *attributes)
        same = (F.col(hub_key) == F.col("_key")) & (F.col(f"{name}_load_date") == F.col("_date"))
        out = out.join(rows, same, "left").drop("_key", "_date")
    return out
