from tessera.functions.exprs import (  # noqa: F401
    cents_to_dollars,
    check_status,
    date_key,
    diff_boundaries,
    failure_rate_pct,
    fingerprint_key,
    key_to_date,
    least_strict,
    null_divide,
    patient_row_hash,
    pct,
    ratio,
    safe_divide,
    surrogate_key,
    to_utc,
)
