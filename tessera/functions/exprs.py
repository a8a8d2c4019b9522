"""Column -> Column helpers (all native Catalyst expressions, no Python UDFs).

Each one stays inside whole-stage codegen, so they cost nothing extra when
applied to billions of rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ── division helpers ────────────────────────────────────────────────────
def safe_divide(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Zero when the denominator is zero (the macro's code path), else n/d."""
    n, d = _c(num), _c(den)
    return F.when(d == 0, F.lit(0.0)).otherwise(n / d)


def null_divide(num: ColumnOrName, den: ColumnOrName) -> Column:
    """NULL when the denominator is zero: ``n / NULLIF(d, 0)``."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def ratio(num: ColumnOrName, den: ColumnOrName, scale: int = 4) -> Column:
    """``ROUND(n / NULLIF(d, 0), scale)`` as double."""
    return F.round(null_divide(num, den).cast("double"), scale)


def pct(num: ColumnOrName, den: ColumnOrName, scale: int = 2) -> Column:
    """``ROUND(n * 100.0 / NULLIF(d, 0), scale)`` computed on decimals."""
    n = _c(num).cast("decimal(20,0)") * F.lit(100).cast("decimal(4,1)")
    return F.round(n / F.nullif(_c(den), F.lit(0)).cast("decimal(20,0)"), scale)


def cents_to_dollars(c: ColumnOrName, precision: int = 2) -> Column:
    return F.round(_c(c).cast("decimal(20,2)") / F.lit(100).cast("decimal(5,1)"), precision)


# ── quality status rule (P16) ───────────────────────────────────────────
def failure_rate_pct(checked: ColumnOrName, failed: ColumnOrName) -> Column:
    ch, fa = _c(checked), _c(failed)
    rate = F.round(fa.cast("decimal(20,0)") * F.lit(100).cast("decimal(4,1)")
                   / F.nullif(ch, F.lit(0)).cast("decimal(20,0)"), 4)
    return F.when(ch == 0, F.lit(0)).otherwise(rate).cast("decimal(8,4)")


def check_status(rate: ColumnOrName, threshold: ColumnOrName) -> Column:
    r, t = _c(rate), _c(threshold)
    return (F.when(r == 0, F.lit("PASS"))
            .when(r <= t, F.lit("WARN"))
            .otherwise(F.lit("FAIL")))


# ── hashing and keys ────────────────────────────────────────────────────
def patient_row_hash(first, last, dob, gender, zip_code, state, payer) -> Column:
    """SHA-256 hex of the tracked patient attributes joined by '|'.

    ``concat_ws`` skips NULLs, exactly as the source function did.
    """
    return F.sha2(F.concat_ws(
        "|",
        F.upper(F.trim(_c(first))),
        F.upper(F.trim(_c(last))),
        _c(dob).cast("string"),
        F.upper(_c(gender)),
        _c(zip_code),
        F.upper(_c(state)),
        F.upper(F.trim(_c(payer))),
    ), 256)


def surrogate_key(cols: Iterable[ColumnOrName]) -> Column:
    """MD5 over the pipe-joined columns, NULL spelled ``_null_``."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit("_null_")) for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def fingerprint_key(c: ColumnOrName) -> Column:
    """Stable 64-bit key from a natural key (role of FARM_FINGERPRINT)."""
    return F.xxhash64(_c(c))


# ── dates ───────────────────────────────────────────────────────────────
def date_key(d: ColumnOrName) -> Column:
    """Integer YYYYMMDD key; NULL date gives NULL key.  Arithmetic, not a
    string format, so it stays in generated code."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def key_to_date(k: ColumnOrName) -> Column:
    k = _c(k)
    return F.make_date(F.floor(k / 10000).cast("int"),
                       F.floor((k % 10000) / 100).cast("int"),
                       (k % 100).cast("int"))


def diff_boundaries(unit: str, start: ColumnOrName, end: ColumnOrName) -> Column:
    """Count of ``unit`` boundaries crossed between two timestamps.

    The source dialect's DATEDIFF counts boundaries (00:59 -> 01:01 is one
    hour); Spark's ``timestampdiff`` counts whole units, so both ends are
    truncated to the unit first.
    """
    unit = unit.lower()
    if unit == "day":
        return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))
    s = F.date_trunc(unit, _c(start))
    e = F.date_trunc(unit, _c(end))
    return F.timestamp_diff(unit.upper(), s, e)


def to_utc(ts: ColumnOrName, source_tz: str = "UTC") -> Column:
    """Wall-clock conversion of a zone-less timestamp into UTC."""
    c = _c(ts)
    if source_tz.upper() == "UTC":
        return c
    return F.convert_timezone(F.lit(source_tz), F.lit("UTC"), c)


def least_strict(*cols: ColumnOrName) -> Column:
    """LEAST that returns NULL when any input is NULL (Spark skips NULLs)."""
    cs = [_c(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cs))


# ── exact rounded averages ──────────────────────────────────────────────
# ``ROUND(AVG(c), s)`` over doubles depends on summation order and on binary
# representation at the rounding boundary.  Summing exactly and dividing once
# in decimal keeps >= 16 fractional digits, so one HALF_UP rounding gives the
# same answer on any engine and any partitioning.
def avg_int_round(c: ColumnOrName, scale: int = 4) -> Column:
    col = _c(c)
    return F.round(F.sum(col).cast("decimal(20,0)") / F.count(col), scale).cast("double")


def avg_dec_round(c: ColumnOrName, scale: int = 4) -> Column:
    col = _c(c)
    return F.round(F.sum(col) / F.count(col), scale).cast("double")


def ts_lit(value) -> Column:
    """Zone-less timestamp literal.  Built from its text, so the Python
    process time zone never shifts it."""
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")
