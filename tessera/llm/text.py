"""Word and line expressions shared by the text operators (JVM side only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def whole(text: Column | str) -> Column:
    """The text, a null counting as the empty one."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(col.cast("string"), F.lit(""))


def words(text: Column | str) -> Column:
    return F.regexp_extract_all(whole(text), F.lit(WORD), F.lit(0))


def ascii_lower(text: Column | str) -> Column:
    """A-Z to a-z and nothing else, as every engine does it alike."""
    return F.translate(whole(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda acc, x: acc + x)
