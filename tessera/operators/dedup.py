"""Keep one row per key (W9 / R10 / the QUALIFY-style top-1 dedup).

Formulated as a hash aggregate of ``max(struct(order columns, payload))``
rather than ``row_number()`` over a window: the aggregate is combined
map-side, so each task ships at most one row per key into the shuffle, and a
key holding a third of the input does not land in a single sorted window
partition.  Remaining ties are broken by the payload columns, so the choice
is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                   descending: bool = True) -> DataFrame:
    """Row with the greatest (``descending``) or least ``order_by`` tuple per
    key.  NULL order values rank lowest."""
    payload = [c for c in df.columns if c not in keys]
    ordered = list(order_by) + [c for c in payload if c not in order_by]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(ordered)])
    pick = F.max(packed) if descending else F.min(packed)
    best = df.groupBy(*keys).agg(pick.alias("_best"))
    return best.select(*[F.col(c) if c in keys else
                         F.col(f"_best._o{ordered.index(c)}").alias(c) for c in df.columns])
