"""Incremental models (S21): one driver for any model.

A model is a function of a start (None: everything) that returns its rows from
there on.  ``refresh`` runs it from the table's newest cursor value less a
lookback and puts the rows in place:

* ``merge``: rows with a key that the table holds replace it, others are added
  (keys compare null-safe, so a group with a null key column is one row, too);
* ``replace_window``: everything from the start on is replaced, so keys that
  vanished from the window go.

Schema changes follow a policy: ``fail``, ``ignore`` (new columns are left
out), ``append_new_columns`` (older rows have null in them) or
``sync_all_columns`` (columns that are gone are dropped, too).

A ``VersionedTable`` gets a new version.  In a ``PartitionedTable`` whose
partition column is the cursor only partitions from the start on are read and
rewritten; the cursor must then be part of the key (a key never changes its
partition) and the strategy ``merge``.
"""

from __future__ import annotations

import datetime as _dt
import functools
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.sinks import PartitionedTable, VersionedTable, materialize

POLICIES = ("fail", "ignore", "append_new_columns", "sync_all_columns")


class SchemaChange(ValueError):
    pass


@dataclass(frozen=True)
class Incremental:
    """How a model is kept up to date."""

    unique_key: Sequence[str]
    cursor: str
    lookback: _dt.timedelta = _dt.timedelta(0)
    strategy: str = "merge"
    on_schema_change: str = "fail"


def aligned(target: DataFrame, fresh: DataFrame, policy: str) -> tuple[DataFrame, DataFrame]:
    """Both with the columns that the policy gives the table.  A column whose
    type changed fails under every policy."""
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}")
    old, new = dict(target.dtypes), dict(fresh.dtypes)
    changed = [c for c in old if c in new and old[c] != new[c]]
    added, gone = [c for c in new if c not in old], [c for c in old if c not in new]
    if changed or (policy == "fail" and (added or gone)) or (policy == "ignore" and gone):
        raise SchemaChange(f"changed {changed}, added {added}, gone {gone}")
    columns = {"ignore": list(old), "append_new_columns": [*old, *added], "sync_all_columns": list(new)}.get(policy, list(old))
    types = {**new, **old}

    def to(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in columns])

    return to(target), to(fresh)


def _replaced(target: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    new = fresh.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = functools.reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys))
    return target.join(new, same, "left_anti").unionByName(fresh)


def refresh(table: VersionedTable | PartitionedTable, model: Callable[[object], DataFrame], spec: Incremental,
            full_refresh: bool = False) -> dict:
    """Bring ``table`` up to date; what was done: ``mode`` and ``since``."""
    partitioned = isinstance(table, PartitionedTable)
    if partitioned and (spec.strategy != "merge" or table.partition_cols != [spec.cursor] or spec.cursor not in spec.unique_key):
        raise ValueError("a partitioned table takes merge, partitions by the cursor, and the cursor in the key")
    target = (table.read() if table.exists() else None) if partitioned else table.read()
    newest = None if target is None or full_refresh else target.agg(F.max(spec.cursor)).first()[0]
    since = None if newest is None else newest - spec.lookback
    fresh = materialize(model(since), "incremental_rows")
    twice = fresh.groupBy(*spec.unique_key).count().where("count > 1").limit(1).count()
    if twice:
        raise ValueError(f"{list(spec.unique_key)} is not unique in the model's rows")
    if since is None:
        if not partitioned:
            table.commit(fresh)
        elif target is None:
            table.create(fresh)
        else:
            table.replace_all(fresh)
        return {"mode": "full", "since": None}
    held, fresh = aligned(target, fresh, spec.on_schema_change)
    at = F.col(spec.cursor)
    if partitioned:
        table.replace_partitions(_replaced(held.where(at >= F.lit(since)), fresh, spec.unique_key))
    elif spec.strategy == "merge":
        table.commit(_replaced(held, fresh, spec.unique_key))
    else:
        table.commit(held.where((at < F.lit(since)) | at.isNull()).unionByName(fresh.where(at >= F.lit(since))))
    return {"mode": spec.strategy, "since": since}
