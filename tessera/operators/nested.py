"""Nested storage: child rows inside their parent as ARRAY<STRUCT>.

``nest`` packs child rows into arrays of at most ``chunk`` structs: a parent
row holds the children whose place falls into one chunk, so a parent with any
number of children is several bounded rows, never one unbounded array.
Aggregates run over the arrays by higher-order functions, without exploding:
``leaf`` is the array of one field, and only the fields that are named reach
the scan (nested column pruning); results of a parent's chunks add up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 1024


def nest(children: DataFrame, keys: Sequence[str], place: str, fields: Sequence[str], name: str,
         chunk: int = CHUNK) -> DataFrame:
    """keys, chunk, ``name``: array of structs (``place`` and ``fields``) in
    order of place.  ``place`` numbers the children of a parent from any start
    (null: a chunk of its own); children that share a place stay apart."""
    part = F.floor(F.coalesce(F.col(place), F.lit(-1)) / chunk).cast("int")
    item = F.struct(place, *fields)
    return (children.groupBy(*keys, part.alias("chunk"))
            .agg(F.array_sort(F.collect_list(item)).alias(name)))


def leaf(array: str, field: str) -> Column:
    """The array of one field of the structs."""
    return F.col(f"{array}.{field}")


def total(values: Column, kind: str) -> Column:
    """Sum of an array, nulls adding nothing; null if nothing adds."""
    known = F.filter(values, lambda x: x.isNotNull())
    return F.when(F.size(known) > 0, F.aggregate(known, F.lit(0).cast(kind), lambda acc, x: (acc + x).cast(kind)))


def total_where(values: Column, flags: Column, wanted: Sequence[str], kind: str) -> Column:
    """Sum of the values whose flag is one of ``wanted``."""
    kept = F.filter(F.arrays_zip(values.alias("v"), flags.alias("f")), lambda x: x["f"].isin(*wanted) & x["v"].isNotNull())
    return F.aggregate(kept, F.lit(0).cast(kind), lambda acc, x: (acc + x["v"]).cast(kind))
