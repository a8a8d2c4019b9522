"""Independent SQL formulations of the bound shapes and of every registered
query, for DuckDB over the same Parquet tables.

These strings are the parity oracle only; the Spark jobs never run them.
Rounded averages and percentages are computed with exact integer arithmetic
(HALF_UP) so they do not depend on binary floating-point rounding.
"""

from __future__ import annotations

# ── helpers ──────────────────────────────────────────────────────────────


def round_div(num: str, den: str, scale: int) -> str:
    """ROUND(num / den, scale) HALF_UP as DOUBLE, for exact integer num/den."""
    f = 10 ** scale
    n, d = f"CAST(({num}) AS HUGEINT)", f"CAST(NULLIF(({den}), 0) AS HUGEINT)"
    q = f"(sign({n}) * ((2 * abs({n}) * {f} + {d}) // (2 * {d})))"
    return f"(CAST({q} AS DOUBLE) / {f})"


def avg_cents(col: str, scale: int = 4) -> str:
    """ROUND(AVG(decimal money col), scale) exactly (aggregate context)."""
    return round_div(f"SUM({col} * 100)", f"COUNT({col}) * 100", scale)


def avg_int(col: str, scale: int = 4) -> str:
    return round_div(f"SUM({col})", f"COUNT({col})", scale)


def pct(num: str, den: str, scale: int = 2) -> str:
    return round_div(f"({num}) * 100", den, scale)


def date_key(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


# ── bound shapes (CTE bodies) ────────────────────────────────────────────
SHAPES: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def shape(name: str, deps: list[str] | None = None):
    def deco(sql: str) -> str:
        SHAPES[name] = sql
        DEPS[name] = deps or []
        return sql
    return deco


shape("patient_attrs")("""
SELECT c_custkey AS patient_key,
       'P' || CAST(c_custkey AS VARCHAR) AS patient_id,
       split_part(c_name, '#', 1) AS first_name,
       split_part(c_name, '#', 2) AS last_name,
       DATE '1940-01-01' + CAST((c_custkey * 37) % 25000 AS INTEGER) AS date_of_birth,
       CASE WHEN c_custkey % 200 = 0 THEN NULL
            WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
       CAST(NULL AS VARCHAR) AS race,
       CAST(NULL AS VARCHAR) AS ethnicity,
       lpad(CAST((c_custkey * 7919) % 100000 AS VARCHAR), 5, '0') AS zip_code,
       lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_code,
       c_mktsegment AS payer_type
FROM customer""")

ROW_HASH = """sha256(concat_ws('|', upper(trim(first_name)), upper(trim(last_name)),
       CAST(date_of_birth AS VARCHAR), upper(gender), zip_code, upper(state_code),
       upper(trim(payer_type))))"""

shape("dim_patient", ["patient_attrs"])(f"""
SELECT *, DATE '1995-01-01' AS effective_date, DATE '9999-12-31' AS expiration_date,
       TRUE AS is_current_record, {ROW_HASH} AS row_hash
FROM patient_attrs""")

shape("dim_provider")("""
SELECT s_suppkey AS provider_key,
       CASE WHEN s_suppkey % 25 = 0 THEN lpad(CAST(s_suppkey AS VARCHAR), 9, '0')
            ELSE lpad(CAST(s_suppkey AS VARCHAR), 10, '0') END AS npi,
       s_name AS provider_name, r_name AS specialty, n_name AS sub_specialty,
       TRUE AS is_current_record
FROM supplier JOIN nation ON s_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey""")

shape("dim_diagnosis")("""
SELECT diagnosis_key, icd10_code, icd10_description, is_chronic, cms_hcc_category
FROM (
  SELECT p_partkey AS diagnosis_key,
         (CASE WHEN b = 13 THEN 'E1' ELSE 'E' || lpad(CAST(b AS VARCHAR), 2, '0') END)
           || '.' || CAST(p_partkey AS VARCHAR) AS icd10_code,
         p_name AS icd10_description,
         b % 2 = 0 AS is_chronic,
         'HCC' || CAST(b AS VARCHAR) AS cms_hcc_category
  FROM (SELECT *, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS b FROM part))""")

shape("bridge")("""
SELECT l_orderkey AS encounter_key, l_partkey AS diagnosis_key,
       MIN(l_linenumber) AS diagnosis_seq
FROM lineitem GROUP BY l_orderkey, l_partkey""")

shape("fact_encounter")("""
SELECT encounter_key, patient_key, attending_provider_key, admit_date, discharge_date,
       primary_diagnosis_key, encounter_id, encounter_type, admit_source,
       length_of_stay_days, total_charges, total_payments,
       readmission_30d_flag, mortality_flag
FROM (
  SELECT o_orderkey AS encounter_key, o_custkey AS patient_key,
         lp.prov AS attending_provider_key,
         CAST(o_orderdate AS DATE) AS admit_date,
         CASE WHEN o_orderkey % 97 = 0 THEN CAST(o_orderdate AS DATE) - 1
              ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INTEGER) END AS discharge_date,
         lp.dx AS primary_diagnosis_key,
         'E' || CAST(o_orderkey AS VARCHAR) AS encounter_id,
         CASE o_orderstatus WHEN 'F' THEN 'IP' WHEN 'O' THEN 'OP' WHEN 'P' THEN 'ED'
              ELSE 'Telehealth' END AS encounter_type,
         o_orderpriority AS admit_source,
         CASE WHEN o_orderkey % 97 = 0 THEN -1 ELSE CAST(o_orderkey % 10 AS INTEGER) END
           AS length_of_stay_days,
         CAST(o_totalprice AS DECIMAL(14,2)) AS total_charges,
         CAST(round(CAST(o_totalprice AS DECIMAL(14,2)) * 0.85, 2) AS DECIMAL(14,2))
           AS total_payments,
         o_orderkey % 7 = 0 AS readmission_30d_flag,
         o_orderkey % 50 = 0 AS mortality_flag
  FROM orders
  JOIN (SELECT l_orderkey, MIN(l_suppkey) AS prov, MIN(l_partkey) AS dx
        FROM lineitem GROUP BY l_orderkey) lp ON lp.l_orderkey = o_orderkey)""")

shape("fact_claim")("""
SELECT 'C' || CAST(l_orderkey AS VARCHAR) AS claim_id,
       l_linenumber AS claim_line_number,
       l_orderkey AS encounter_key,
       l_suppkey AS rendering_provider_key,
       CAST(l_shipdate AS DATE) AS service_date,
       l_partkey AS procedure_key,
       CAST(l_extendedprice AS DECIMAL(14,2)) AS billed_amount,
       CAST(round(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)
            AS DECIMAL(14,2)) AS allowed_amount,
       CAST(round(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                  * (1 + CAST(l_tax AS DECIMAL(4,2))), 2) AS DECIMAL(14,2)) AS paid_amount,
       CAST(round(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)
            AS DECIMAL(14,2)) AS patient_responsibility,
       CAST(l_quantity AS INTEGER) AS units_of_service,
       CASE l_returnflag WHEN 'R' THEN 'Denied' WHEN 'A' THEN 'Adjusted'
            WHEN 'N' THEN 'Paid' ELSE 'Pending' END AS claim_status,
       CASE WHEN l_returnflag = 'R' THEN 'CO-' || l_linestatus END AS denial_reason_code
FROM lineitem""")


def with_shapes(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs for ``names`` and their dependencies."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({SHAPES[n]})" for n in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


# ── clinical queries ─────────────────────────────────────────────────────
ORACLE: dict[str, str] = {}

# Written apart from the engine's plans and from any window syntax: next rows
# by correlated minima, ranks by counting smaller rows, measures by separate
# sub-selects.
ORACLE["readmission_30d"] = with_shapes("""
WITH stays AS (SELECT encounter_id, patient_key, admit_date, discharge_date FROM fact_encounter
               WHERE encounter_type = 'IP' AND admit_date IS NOT NULL AND discharge_date IS NOT NULL),
followed AS (
  SELECT s.*, (SELECT MIN(later.admit_date) FROM stays later
               WHERE later.patient_key IS NOT DISTINCT FROM s.patient_key
                 AND (later.admit_date > s.admit_date
                      OR later.admit_date = s.admit_date AND later.encounter_id > s.encounter_id))
              AS next_admit_date
  FROM stays s)
SELECT *, COALESCE(next_admit_date - discharge_date <= 30, FALSE) AS is_30d_readmission,
       CAST(next_admit_date - discharge_date AS INTEGER) AS days_to_readmit
FROM followed""", "fact_encounter")


def provider_metrics_sql(year: int) -> str:
    """One row per provider, aggregated before the provider's names join."""
    return f"""
  SELECT provider_key, npi, provider_name, specialty, stays.* EXCLUDE (attending_provider_key)
  FROM (SELECT attending_provider_key, COUNT(DISTINCT encounter_key) AS total_encounters,
               {avg_int('length_of_stay_days')} AS avg_los, AVG(total_charges) AS raw_charges,
               {avg_cents('total_charges')} AS avg_charges, {avg_cents('total_payments')} AS avg_payments,
               COUNT(*) FILTER (readmission_30d_flag) AS readmissions,
               {pct('COUNT(*) FILTER (readmission_30d_flag)', 'COUNT(*)')} AS readmission_rate_pct,
               COUNT(*) FILTER (mortality_flag) AS mortalities
        FROM fact_encounter WHERE admit_date BETWEEN DATE '{year}-01-01' AND DATE '{year}-12-31'
        GROUP BY ALL) stays
  JOIN dim_provider ON provider_key = attending_provider_key"""


def provider_scorecard_sql(year: int) -> str:
    def tile(place: str) -> str:
        """The quarter of a 1-based place among n: the first n % 4 are one larger."""
        q, r = "(n // 4)", "(n % 4)"
        return (f"CASE WHEN {place} <= {r} * ({q} + 1) THEN ({place} - 1) // ({q} + 1) + 1 "
                f"ELSE {r} + ({place} - {r} * ({q} + 1) - 1) // greatest({q}, 1) + 1 END")

    return with_shapes(f"""
WITH prov AS (SELECT *, COALESCE(CAST(raw_charges AS DOUBLE), 'infinity') AS c,
                     COALESCE(readmission_rate_pct, 'infinity') AS r
              FROM ({provider_metrics_sql(year)})),
placed AS (
  SELECT me.provider_key, COUNT(*) AS n,
         COUNT(*) FILTER (o.c < me.c) + 1 AS cost_rank,
         COUNT(*) FILTER (o.r < me.r) + 1 AS quality_rank,
         COUNT(*) FILTER (o.c < me.c OR o.c = me.c AND o.provider_key <= me.provider_key) AS cost_place,
         COUNT(*) FILTER (o.r < me.r OR o.r = me.r AND o.provider_key <= me.provider_key) AS quality_place,
         CAST(SUM(o.total_encounters) FILTER (o.total_encounters > me.total_encounters
              OR o.total_encounters = me.total_encounters AND o.provider_key <= me.provider_key) AS BIGINT)
           AS cumulative_encounters_in_specialty
  FROM prov me JOIN prov o ON o.specialty IS NOT DISTINCT FROM me.specialty
  GROUP BY me.provider_key),
tiles AS (SELECT *, {tile('cost_place')} AS cost_quartile, {tile('quality_place')} AS quality_quartile FROM placed)
SELECT prov.* EXCLUDE (c, r, raw_charges), cost_rank, quality_rank,
       CASE WHEN n > 1 THEN (quality_rank - 1) / (n - 1) ELSE 0.0 END AS quality_percentile,
       CAST(cost_quartile AS INTEGER) AS cost_quartile, CAST(quality_quartile AS INTEGER) AS quality_quartile,
       cumulative_encounters_in_specialty,
       round((cost_quartile + quality_quartile) / 2, 1) AS composite_tier
FROM prov JOIN tiles USING (provider_key)""", "fact_encounter", "dim_provider")


ORACLE["chronic_progression"] = with_shapes("""
WITH seen AS (
  SELECT patient_key, icd10_code, icd10_description, cms_hcc_category, admit_date AS encounter_date,
         (admit_date, encounter_key, diagnosis_key) AS place
  FROM dim_diagnosis JOIN bridge USING (diagnosis_key) JOIN fact_encounter USING (encounter_key)
  WHERE is_chronic),
history AS (
  SELECT me.place, me.patient_key, me.icd10_code, COUNT(*) AS diagnosis_occurrence_num,
         MIN(old.encounter_date) AS first_diagnosis_date,
         MAX(old.encounter_date) FILTER (old.place < me.place) AS before_date
  FROM seen me JOIN seen old
    ON old.patient_key = me.patient_key AND old.icd10_code = me.icd10_code AND old.place <= me.place
  GROUP BY ALL),
load AS (SELECT patient_key, COUNT(*) AS total_chronic_conditions
         FROM (SELECT DISTINCT patient_key, icd10_code FROM seen) GROUP BY patient_key)
SELECT patient_key, icd10_code, icd10_description, cms_hcc_category, first_diagnosis_date, encounter_date,
       diagnosis_occurrence_num, CAST(encounter_date - first_diagnosis_date AS INTEGER) AS days_since_first_dx,
       CAST(encounter_date - before_date AS INTEGER) AS days_since_last_episode,
       before_date IS NOT NULL AND encounter_date - before_date > 365 AS is_new_episode_after_gap,
       total_chronic_conditions,
       ['Low', 'Moderate', 'Complex'][1 + CAST(total_chronic_conditions >= 2 AS INTEGER)
                                      + CAST(total_chronic_conditions >= 5 AS INTEGER)]
         AS condition_burden_category
FROM seen JOIN history USING (place, patient_key, icd10_code) JOIN load USING (patient_key)""",
                                            "fact_encounter", "bridge", "dim_diagnosis")

ORACLE["revenue_trend"] = with_shapes(f"""
WITH per_month AS (
  SELECT make_date(year(service_date), month(service_date), 1) AS month_start, COUNT(*) AS total_claims,
         CAST(SUM(billed_amount) AS DECIMAL(18,2)) AS total_billed,
         CAST(SUM(paid_amount) AS DECIMAL(18,2)) AS total_paid, COUNT(*) FILTER (claim_status = 'Denied') AS denied
  FROM fact_claim GROUP BY ALL),
placed AS (SELECT a.*, (SELECT COUNT(*) FROM per_month b WHERE b.month_start <= a.month_start) AS place
           FROM per_month a),
near AS (
  SELECT me.place, SUM(o.total_paid * 100) FILTER (me.place - o.place < 3) AS sum3,
         COUNT(*) FILTER (me.place - o.place < 3) AS n3, SUM(o.total_paid * 100) AS sum12, COUNT(*) AS n12,
         MAX(o.total_paid) FILTER (me.place - o.place = 1) AS last_paid
  FROM placed me JOIN placed o ON o.place BETWEEN me.place - 11 AND me.place GROUP BY me.place)
SELECT month_start, total_claims, total_billed, total_paid, {pct('denied', 'total_claims')} AS denial_rate_pct,
       CAST({round_div('sum3', 'n3 * 100', 2)} AS DECIMAL(18,2)) AS paid_3mo_moving_avg,
       CAST({round_div('sum12', 'n12 * 100', 2)} AS DECIMAL(18,2)) AS paid_12mo_moving_avg,
       {round_div('(total_paid - last_paid) * 10000', 'last_paid * 100', 2)} AS mom_growth_pct,
       (SELECT MAX(y.total_paid) FROM placed y WHERE y.place = placed.place - 12) AS prior_year_paid
FROM placed JOIN near USING (place)""", "fact_claim")

ORACLE["provider_avg_charges"] = with_shapes(f"""
WITH p AS (SELECT attending_provider_key, {avg_cents('total_charges')} AS provider_avg_charges
           FROM fact_encounter GROUP BY 1)
SELECT fe.encounter_id, fe.patient_key, fe.total_charges, p.provider_avg_charges
FROM fact_encounter fe LEFT JOIN p USING (attending_provider_key)""", "fact_encounter")

# Known patients and patients with a flagged stay, as sets.
ORACLE["readmitted_patients"] = with_shapes("""
SELECT patient_key FROM dim_patient INTERSECT SELECT patient_key FROM fact_encounter WHERE readmission_30d_flag""",
                                            "dim_patient", "fact_encounter")


def provider_cost_report_sql(year: int, min_n: int) -> str:
    """Inpatient stays of the year counted per provider row, then added up
    over the rows that share a name and specialty."""
    return with_shapes(f"""
WITH own AS (
  SELECT attending_provider_key AS k, COUNT(*) AS n, SUM(length_of_stay_days) AS days, COUNT(length_of_stay_days) AS n_days,
         SUM(total_charges * 100) AS cents, COUNT(total_charges) AS n_cents
  FROM (SELECT * FROM fact_encounter WHERE encounter_type = 'IP' AND admit_date BETWEEN '{year}-01-01' AND '{year}-12-31')
  GROUP BY ALL),
named AS (
  SELECT provider_name, specialty, SUM(n)::BIGINT AS encounter_count, SUM(days) AS d, SUM(n_days) AS nd,
         SUM(cents) AS c, SUM(n_cents) AS nc
  FROM own, (SELECT provider_key AS k, provider_name, specialty FROM dim_provider WHERE is_current_record) p
  WHERE own.k = p.k GROUP BY ALL)
SELECT provider_name, specialty, encounter_count, {round_div('d', 'nd', 4)} AS avg_los,
       {round_div('c', 'nc * 100', 4)} AS avg_charges FROM named WHERE encounter_count >= {min_n}""",
                       "fact_encounter", "dim_provider")


def oracle_for_registry() -> dict[str, str]:
    """Oracle SQL keyed like ``catalog.REGISTRY`` (parameters bound)."""
    from tessera import catalog as c
    out = dict(ORACLE)
    out["provider_scorecard"] = provider_scorecard_sql(c.CLINICAL_YEAR)
    out["provider_cost_report"] = provider_cost_report_sql(c.CLINICAL_YEAR,
                                                           c.COST_REPORT_MIN_ENCOUNTERS)
    out.update(dq_oracles(c.DQ_AS_OF, c.DQ_HISTORY_DAYS))
    out["provider_charge_rank"] = provider_charge_rank_sql()
    out.update(test_oracles(PRODUCT_AS_OF_SQL,
                            f"TIMESTAMP '{c.FRESHNESS_AS_OF:%Y-%m-%d %H:%M:%S}'"))
    return {k: v for k, v in out.items() if k in c.REGISTRY}


# ── product shapes ───────────────────────────────────────────────────────
PRODUCT_AS_OF_SQL = "TIMESTAMP '2024-01-30 00:00:00'"

shape("raw_events")("""
SELECT CAST(event_id AS VARCHAR) AS event_id,
       CAST(user_id AS VARCHAR) AS user_id,
       CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') || '-' || CAST(hour(ts) // 4 AS VARCHAR)
         AS session_id,
       CASE WHEN event_id % 7 = 0 THEN ' ' || upper(base_type) || ' ' ELSE base_type END AS event_type,
       '/app/' || src_type AS page_url,
       CASE WHEN base_type = 'feature_used' THEN 'feature_' || CAST(event_id % 10 AS VARCHAR) END
         AS feature_name,
       CASE WHEN event_id % 3 = 0 THEN 'web' WHEN event_id % 3 = 1 THEN ' ios' ELSE 'Android ' END
         AS platform,
       CASE WHEN user_id % 2 = 0 THEN 'desktop' ELSE 'mobile' END AS device_type,
       lpad(CAST(user_id % 25 AS VARCHAR), 2, '0') AS country_code,
       CASE WHEN event_id % 4 = 0 THEN ' google ' END AS utm_source,
       CASE WHEN event_id % 4 = 0 THEN 'cpc' END AS utm_medium,
       CAST(NULL AS VARCHAR) AS utm_campaign,
       CASE WHEN event_id % 1000 = 999 THEN NULL ELSE ts END AS occurred_at,
       ts + INTERVAL 5 MINUTE AS _loaded_at,
       'events/' || strftime(ts, '%Y-%m-%d') || '.json' AS _source_file
FROM (SELECT *, event_type AS src_type,
             CASE event_type
               WHEN 'signup' THEN 'signup'
               WHEN 'click' THEN CASE WHEN user_id % 5 <> 0 THEN 'feature_used' ELSE 'page_view' END
               WHEN 'purchase' THEN CASE WHEN user_id % 3 = 0 THEN 'upgrade' ELSE 'page_view' END
               WHEN 'view' THEN CASE WHEN event_id % 2 = 0 THEN 'page_view' ELSE 'login' END
               ELSE event_type END AS base_type
      FROM events)""")

_RAW_USER = """
SELECT CAST(c_custkey AS VARCHAR) AS user_id,
       ' ' || c_name || '@Example.com' AS email,
       split_part(c_name, '#', 1) AS first_name,
       split_part(c_name, '#', 2) AS last_name,
       {plan} AS plan_name,
       '{status}' AS account_status,
       CASE c_custkey % 3 WHEN 0 THEN 'organic' WHEN 1 THEN 'Paid' ELSE 'referral' END AS signup_source,
       lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS country_code,
       created AS created_at,
       created + INTERVAL {lag} DAY AS updated_at,
       created + INTERVAL {lag} DAY + INTERVAL 1 HOUR AS _loaded_at
FROM (SELECT *, CAST(DATE '2023-12-01' + CAST(c_custkey % 45 AS INTEGER) AS TIMESTAMP)
                  + to_hours(CAST(c_custkey % 24 AS INTEGER)) AS created
      FROM customer) {where}"""

shape("raw_users")(
    _RAW_USER.format(plan="""CASE c_mktsegment WHEN 'BUILDING' THEN 'free' WHEN 'AUTOMOBILE' THEN ' Starter'
                 WHEN 'MACHINERY' THEN 'growth' WHEN 'HOUSEHOLD' THEN 'ENTERPRISE' END""",
                     status="Active", lag=1, where="")
    + "\nUNION ALL\n"
    + _RAW_USER.format(plan="'free'", status="trial", lag=0, where=""))

shape("raw_sessions")("""
SELECT session_id, CAST(user_id AS VARCHAR) AS user_id, started_at,
       CASE WHEN user_id % 10 = 0 THEN NULL ELSE last_ts END AS ended_at,
       CASE WHEN first_event % 3 = 0 THEN 'web' WHEN first_event % 3 = 1 THEN ' ios' ELSE 'Android ' END
         AS platform,
       CASE WHEN user_id % 2 = 0 THEN 'desktop' ELSE 'mobile' END AS device_type,
       lpad(CAST(user_id % 25 AS VARCHAR), 2, '0') AS country_code,
       CAST(page_views AS INTEGER) AS page_views,
       CAST(events_count AS INTEGER) AS events_count,
       last_ts + INTERVAL 5 MINUTE AS _loaded_at
FROM (SELECT session_id, user_id, MIN(ts) AS started_at, MAX(ts) AS last_ts,
             MIN(event_id) AS first_event, count_if(event_type = 'view') AS page_views,
             COUNT(*) AS events_count
      FROM (SELECT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') || '-'
                     || CAST(hour(ts) // 4 AS VARCHAR) AS session_id, user_id, ts, event_id, event_type
            FROM events)
      GROUP BY session_id, user_id)""")

shape("raw_subscriptions")("""
SELECT 'S' || IF(event_id % 97 = 0, 0, event_id) AS subscription_id,
       IF(event_id % 333 = 0, NULL, CAST(user_id AS VARCHAR)) AS user_id,
       IF(event_type = 'signup', 'created', ['upgraded', 'downgraded', 'cancelled', 'reactivated', 'paused'][event_id % 5 + 1])
         AS event_type, ts AS occurred_at, ts + INTERVAL 5 MINUTE AS _loaded_at
FROM events WHERE event_type IN ('signup', 'purchase')""")

_CODES = ("event_type", "platform", "device_type", "utm_source", "utm_medium", "utm_campaign")
shape("stg_events", ["raw_events"])(f"""
SELECT * REPLACE ({", ".join(f"upper(trim({c})) AS {c}" for c in _CODES)}),
       occurred_at::DATE AS event_date,
       occurred_at::DATE + to_hours(CAST(hour(occurred_at) AS INTEGER)) AS event_hour
FROM raw_events WHERE COALESCE(CAST(event_id AS VARCHAR), '') <> '' AND occurred_at > TIMESTAMP '0001-01-01'""")

shape("stg_users", ["raw_users"])(f"""
SELECT r.* REPLACE (lower(trim(r.email)) AS email, trim(r.first_name) AS first_name, trim(r.last_name) AS last_name,
                    lower(trim(r.plan_name)) AS plan_name, lower(trim(r.account_status)) AS account_status,
                    lower(trim(r.signup_source)) AS signup_source, upper(trim(r.country_code)) AS country_code),
       r.created_at::DATE AS signup_date,
       CAST({PRODUCT_AS_OF_SQL}::DATE - r.created_at::DATE AS INTEGER) AS days_since_signup
FROM raw_users r JOIN (SELECT user_id, MAX(updated_at) AS updated_at FROM raw_users GROUP BY user_id) newest
  ON newest.user_id = r.user_id AND newest.updated_at = r.updated_at""")

shape("stg_sessions", ["raw_sessions"])(f"""
SELECT * REPLACE (upper(trim(platform)) AS platform, upper(trim(device_type)) AS device_type),
       started_at::DATE AS session_date,
       -- whole seconds of the clock, four hours at most
       CASE WHEN floor(epoch(ended_at)) - floor(epoch(started_at)) > 14400 THEN 14400
            ELSE CAST(floor(epoch(ended_at)) - floor(epoch(started_at)) AS BIGINT) END AS session_duration_seconds
FROM raw_sessions
WHERE session_id IS NOT NULL AND started_at IS NOT NULL
  AND NOT EXISTS (SELECT 1 WHERE started_at > COALESCE(ended_at, {PRODUCT_AS_OF_SQL}))""")


def user_activity_body(from_date: str | None = None) -> str:
    """Each measure of a user's day from a sub-select of its own."""
    day = f"(SELECT * FROM stg_events WHERE event_date >= DATE '{from_date}')" if from_date else "stg_events"

    def measure(name: str, expr: str, rows: str = day) -> str:
        return f"{name} AS (SELECT user_id, event_date, {expr} AS v FROM {rows} GROUP BY 1, 2)"

    def distinct(c: str) -> str:
        return f"(SELECT DISTINCT user_id, event_date, {c} FROM {day} WHERE {c} IS NOT NULL)"

    names = ("everything", "visits", "kinds", "used", "viewed", "began", "ended")
    joined = " ".join(f"LEFT JOIN {n} ON {n}.user_id IS NOT DISTINCT FROM k.user_id AND {n}.event_date = k.event_date"
                      for n in names)
    return f"""
WITH k AS (SELECT DISTINCT user_id, event_date FROM {day}),
{measure('everything', 'COUNT(*)')}, {measure('visits', 'COUNT(*)', distinct('session_id'))},
{measure('kinds', 'COUNT(*)', distinct('event_type'))},
{measure('used', 'COUNT(*)', f"(SELECT * FROM {day} WHERE event_type = 'FEATURE_USED')")},
{measure('viewed', 'COUNT(*)', f"(SELECT * FROM {day} WHERE event_type = 'PAGE_VIEW')")},
{measure('began', 'MIN(occurred_at)')}, {measure('ended', 'MAX(occurred_at)')},
days AS (
  SELECT k.user_id, k.event_date AS activity_date, everything.v AS total_events, COALESCE(visits.v, 0) AS sessions,
         COALESCE(kinds.v, 0) AS distinct_event_types, COALESCE(used.v, 0) AS feature_events,
         COALESCE(viewed.v, 0) AS page_views, began.v AS first_event_at, ended.v AS last_event_at,
         date_diff('minute', began.v, ended.v) AS active_minutes
  FROM k {joined})
SELECT days.*, u.plan_name, u.signup_date, u.country_code, u.signup_source,
       CAST(activity_date - u.signup_date AS INTEGER) AS days_since_signup,
       u.signup_date - CAST(isodow(u.signup_date) - 1 AS INTEGER) AS signup_cohort_week,
       CASE WHEN least(active_minutes // 30, feature_events // 5) >= 1 THEN 'power'
            WHEN greatest(active_minutes // 10, feature_events // 2) >= 1 THEN 'engaged'
            ELSE 'casual' END AS engagement_tier,
       {PRODUCT_AS_OF_SQL} AS _updated_at
FROM days LEFT JOIN stg_users u USING (user_id)"""


shape("user_activity", ["stg_events", "stg_users"])(user_activity_body())

ORACLE["stg_events"] = with_shapes("SELECT * FROM stg_events", "stg_events")
ORACLE["stg_users_dedup"] = with_shapes("SELECT * FROM stg_users", "stg_users")
ORACLE["stg_sessions"] = with_shapes("SELECT * FROM stg_sessions", "stg_sessions")
ORACLE["user_activity"] = with_shapes("SELECT * FROM user_activity", "user_activity")
ORACLE["user_activity_incremental"] = with_shapes(
    "SELECT * EXCLUDE (_updated_at) FROM user_activity", "user_activity")

# Every active day counts for itself and the 27 days after it.
shape("dau_wau_mau", ["user_activity"])(f"""
WITH own AS (
  SELECT activity_date, plan_name, country_code, COUNT(*) AS dau, CAST(SUM(total_events) AS BIGINT) AS daily_events,
         CAST(SUM(feature_events) AS BIGINT) AS daily_feature_events, {avg_int('active_minutes')} AS avg_active_minutes,
         COUNT(*) FILTER (engagement_tier = 'power') AS power_users,
         COUNT(*) FILTER (engagement_tier = 'engaged') AS engaged_users
  FROM user_activity GROUP BY ALL),
reach AS (
  SELECT activity_date + CAST(age AS INTEGER) AS activity_date, plan_name, country_code, user_id, MIN(age) AS age
  FROM (SELECT DISTINCT activity_date, plan_name, country_code, user_id, unnest(range(0, 28)) AS age FROM user_activity)
  GROUP BY ALL),
wide AS (SELECT activity_date, plan_name, country_code, COUNT(*) FILTER (age < 7) AS wau, COUNT(*) AS mau
         FROM reach WHERE user_id IS NOT NULL GROUP BY ALL),
"both" AS (SELECT own.*, COALESCE(wau, 0) AS wau, COALESCE(mau, 0) AS mau
         FROM own LEFT JOIN wide USING (activity_date, plan_name, country_code))
SELECT *, {round_div('dau', 'wau', 4)} AS dau_wau_stickiness, {round_div('dau', 'mau', 4)} AS dau_mau_stickiness,
       {round_div('wau', 'mau', 4)} AS wau_mau_stickiness,
       {round_div('daily_feature_events', 'daily_events', 4)} AS feature_adoption_rate,
       {PRODUCT_AS_OF_SQL} AS _updated_at
FROM "both" """)
ORACLE["dau_wau_mau"] = with_shapes("SELECT * FROM dau_wau_mau", "dau_wau_mau")

def _first(event: str) -> str:
    return f"(SELECT MIN(e.occurred_at) FROM stg_events e WHERE e.user_id = u.user_id AND e.event_type = '{event}')"


# The stages' events and names, in order.
_STAGES = (("SIGNUP", "Signup"), ("LOGIN", "First Login"), ("FEATURE_USED", "Feature Activated"),
           ("UPGRADE", "Converted to Paid"))
shape("funnel", ["stg_events", "stg_users"])(f"""
WITH hit AS (
  SELECT user_id, signup_date, plan_name, country_code, signup_source,
         signup_date - CAST(isodow(signup_date) - 1 AS INTEGER) AS signup_cohort_week,
         {_first('SIGNUP')} AS signed_up_at, {_first('LOGIN')} AS first_login_at,
         {_first('FEATURE_USED')} AS activated_at, {_first('UPGRADE')} AS converted_at
  FROM stg_users u),
reached AS (
  SELECT *, list_max(list_filter([IF(signed_up_at IS NULL, NULL, 1), IF(first_login_at IS NULL, NULL, 2),
                                  IF(activated_at IS NULL, NULL, 3), IF(converted_at IS NULL, NULL, 4)],
                                 lambda x: x IS NOT NULL)) AS max_stage_reached
  FROM hit)
SELECT *, {[name for _, name in _STAGES]}[max_stage_reached] AS furthest_stage_name,
       date_diff('hour', signed_up_at, first_login_at) AS hours_to_first_login,
       date_diff('hour', signed_up_at, activated_at) AS hours_to_activation,
       date_diff('hour', signed_up_at, converted_at) AS hours_to_conversion,
       NOT (signed_up_at IS NULL) AS did_signup, NOT (first_login_at IS NULL) AS did_first_login,
       NOT (activated_at IS NULL) AS did_activate, NOT (converted_at IS NULL) AS did_convert,
       COALESCE(activated_at::DATE - signed_up_at::DATE <= 7, FALSE) AS activated_within_7d,
       {PRODUCT_AS_OF_SQL} AS _updated_at
FROM reached""")

ORACLE["funnel"] = with_shapes("SELECT * FROM funnel", "funnel")


# ── data quality ─────────────────────────────────────────────────────────
def _sample_sql(fields: list[str], source: str, order: str) -> str:
    obj = ", ".join(f"'{f}': {f}" for f in fields)
    return (f"(SELECT to_json(list({{{obj}}} ORDER BY {order})) FROM "
            f"(SELECT * FROM {source} ORDER BY {order} LIMIT 5))")


def dq_suite_sql(run_id: str, as_of) -> str:
    """One run of the seven checks as dq_results rows (no check_id)."""
    import datetime as dt
    d = as_of.date()
    y = d - dt.timedelta(days=1)
    lo, hi = d - dt.timedelta(days=8), d - dt.timedelta(days=2)
    rule1 = ("(date_of_birth IS NULL OR gender IS NULL OR gender NOT IN ('M','F','U'))")
    checks = f"""
  SELECT 'patient_completeness_dob_gender' AS check_name, 'completeness' AS check_category,
         'edw.dim_patient' AS target_table, 'date_of_birth, gender' AS target_column,
         (SELECT COUNT(*) FROM dim_patient WHERE is_current_record) AS records_checked,
         (SELECT COUNT(*) FROM dim_patient WHERE is_current_record AND {rule1}) AS records_failed,
         1.0 AS threshold_pct,
         {_sample_sql(['patient_id', 'missing_field'],
                      f"(SELECT patient_id, ['invalid_gender', 'gender', 'date_of_birth'][1 + greatest(2 * (date_of_birth IS NULL)::INT, (gender IS NULL)::INT)] AS missing_field FROM dim_patient WHERE is_current_record AND {rule1})",
                      'patient_id, missing_field')} AS sample_failures
  UNION ALL
  SELECT 'icd10_code_format_validity', 'validity', 'edw.dim_diagnosis', 'icd10_code',
         (SELECT COUNT(*) FROM dim_diagnosis),
         (SELECT COUNT(*) FROM dim_diagnosis WHERE NOT regexp_full_match(icd10_code, '[A-Z][0-9]{{2}}(\\..*)?')),
         0.0,
         {_sample_sql(['icd10_code'], "(SELECT icd10_code FROM dim_diagnosis WHERE NOT regexp_full_match(icd10_code, '[A-Z][0-9]{2}(\\..*)?'))", 'icd10_code')}
  UNION ALL
  SELECT 'npi_format_validity', 'validity', 'edw.dim_provider', 'npi',
         (SELECT COUNT(*) FROM dim_provider WHERE is_current_record),
         (SELECT COUNT(*) FROM dim_provider WHERE is_current_record AND NOT regexp_full_match(npi, '[0-9]{{10}}')),
         0.0,
         {_sample_sql(['npi', 'provider_name'], "(SELECT npi, provider_name FROM dim_provider WHERE is_current_record AND NOT regexp_full_match(npi, '[0-9]{10}'))", 'npi, provider_name')}
  UNION ALL
  SELECT 'encounter_discharge_before_admit', 'consistency', 'edw.fact_encounter',
         'admit_date_key, discharge_date_key',
         (SELECT COUNT(*) FROM fact_encounter),
         (SELECT COUNT(*) FROM fact_encounter WHERE discharge_date < admit_date),
         0.0,
         {_sample_sql(['encounter_id', 'admit_date', 'discharge_date'], "(SELECT encounter_id, CAST(admit_date AS VARCHAR) AS admit_date, CAST(discharge_date AS VARCHAR) AS discharge_date FROM fact_encounter WHERE discharge_date < admit_date)", 'encounter_id, admit_date, discharge_date')}
  UNION ALL
  SELECT 'claim_paid_exceeds_billed', 'consistency', 'edw.fact_claim', 'paid_amount, billed_amount',
         (SELECT COUNT(*) FROM fact_claim),
         (SELECT COUNT(*) FROM fact_claim WHERE paid_amount > billed_amount),
         0.1,
         {_sample_sql(['claim_id', 'billed_amount', 'paid_amount'], "(SELECT claim_id, CAST(billed_amount AS VARCHAR) AS billed_amount, CAST(paid_amount AS VARCHAR) AS paid_amount FROM fact_claim WHERE paid_amount > billed_amount)", 'claim_id, billed_amount, paid_amount')}
  UNION ALL
  SELECT 'encounter_daily_volume_timeliness', 'timeliness', 'edw.fact_encounter', 'admit_date_key',
         1, CASE WHEN yc < avg7 * 0.5 THEN 1 ELSE 0 END, 0.0,
         to_json([{{'check': 'encounter_volume_drop', 'yesterday_count': CAST(yc AS VARCHAR),
                    '7day_avg': CAST(avg7 AS VARCHAR)}}])
  FROM (SELECT (SELECT COUNT(*) FROM fact_encounter WHERE admit_date = DATE '{y}') AS yc,
               (SELECT CAST({round_div('SUM(n)', 'COUNT(*)', 2)} AS DECIMAL(10,2))
                FROM (SELECT admit_date, COUNT(*) AS n FROM fact_encounter
                      WHERE admit_date BETWEEN DATE '{lo}' AND DATE '{hi}' GROUP BY 1)) AS avg7)
  UNION ALL
  SELECT 'encounter_id_uniqueness', 'uniqueness', 'edw.fact_encounter', 'encounter_id',
         (SELECT COUNT(*) FROM fact_encounter),
         (SELECT COUNT(*) FROM (SELECT encounter_id FROM fact_encounter GROUP BY 1 HAVING COUNT(*) > 1)),
         0.0,
         (SELECT to_json(list({{'encounter_id': encounter_id, 'count': CAST(cnt AS VARCHAR)}}
                              ORDER BY cnt DESC, encounter_id))
          FROM (SELECT encounter_id, COUNT(*) AS cnt FROM fact_encounter GROUP BY 1 HAVING COUNT(*) > 1
                ORDER BY cnt DESC, encounter_id LIMIT 5))"""
    rate = f"CAST(CASE WHEN records_checked = 0 THEN 0 ELSE {round_div('records_failed * 100', 'records_checked', 4)} END AS DECIMAL(8,4))"
    return f"""
SELECT '{run_id}' AS run_id, check_name, check_category, target_table, target_column,
       CAST(records_checked AS BIGINT) AS records_checked,
       CAST(records_failed AS BIGINT) AS records_failed,
       {rate} AS failure_rate_pct,
       CAST(threshold_pct AS DECIMAL(8,4)) AS threshold_pct,
       CASE WHEN {rate} = 0 THEN 'PASS' WHEN {rate} <= CAST(threshold_pct AS DECIMAL(8,4)) THEN 'WARN'
            ELSE 'FAIL' END AS status,
       sample_failures,
       TIMESTAMP '{as_of:%Y-%m-%d %H:%M:%S}' AS checked_at
FROM ({checks})"""


DQ_SHAPES = ("dim_patient", "dim_diagnosis", "dim_provider", "fact_encounter", "fact_claim")


def dq_history_sql(as_of, days: int) -> str:
    import datetime as dt
    runs = []
    for d in range(days - 1, -1, -1):
        at = as_of - dt.timedelta(days=d)
        runs.append(dq_suite_sql(f"run-{at:%Y%m%d}", at))
    return "\nUNION ALL\n".join(f"SELECT * FROM ({r})" for r in runs)


def dq_oracles(as_of, days: int) -> dict[str, str]:
    run_id = f"run-{as_of:%Y%m%d}"
    hist = dq_history_sql(as_of, days)
    return {
        "dq_results": with_shapes(f"SELECT * FROM ({dq_suite_sql(run_id, as_of)})", *DQ_SHAPES),
        "dq_run_status": with_shapes(
            f"SELECT run_id, status, COUNT(*) AS checks FROM ({dq_suite_sql(run_id, as_of)}) GROUP BY 1, 2",
            *DQ_SHAPES),
        "dq_latest_status": with_shapes(f"""
WITH h AS ({hist}),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY check_name ORDER BY checked_at DESC, run_id DESC) AS rn
      FROM h)
SELECT l.check_name, l.check_category, l.target_table, l.target_column, l.records_checked,
       l.records_failed, l.failure_rate_pct, l.threshold_pct, l.status, l.checked_at,
       l.sample_failures, t.last_7_statuses
FROM r l JOIN (SELECT check_name, string_agg(status, ',' ORDER BY rn) AS last_7_statuses
               FROM r WHERE rn <= 7 GROUP BY 1) t ON t.check_name = l.check_name
WHERE l.rn = 1""", *DQ_SHAPES),
        "dq_failure_trend": with_shapes(f"""
WITH h AS ({hist})
SELECT check_name, check_category, target_table, CAST(checked_at AS DATE) AS check_date,
       {round_div('SUM(failure_rate_pct * 10000)', 'COUNT(failure_rate_pct) * 10000', 4)} AS avg_failure_rate_pct,
       MAX(failure_rate_pct) AS max_failure_rate_pct,
       len(list_filter(list(status), lambda x: x = 'FAIL')) AS fail_count,
       len(list_filter(list(status), lambda x: x = 'WARN')) AS warn_count,
       len(list_filter(list(status), lambda x: x = 'PASS')) AS pass_count
FROM h GROUP BY ALL""", *DQ_SHAPES),
    }


# ── declarative tests ────────────────────────────────────────────────────
MODEL_SHAPES = {"events": "raw_events", "users": "raw_users", "sessions": "raw_sessions",
                "subscriptions": "raw_subscriptions",
                "stg_events": "stg_events", "stg_users": "stg_users",
                "stg_sessions": "stg_sessions", "mart_user_activity": "user_activity",
                "mart_dau_wau_mau": "dau_wau_mau", "mart_funnel_analysis": "funnel"}


def _unique_sql(model, column, expr=None):
    e = expr or column
    return (f"SELECT '{model}' AS model, '{column}' AS column_name, CAST({e} AS VARCHAR) AS value, "
            f"COUNT(*) AS n_records FROM {MODEL_SHAPES[model]} WHERE {e} IS NOT NULL "
            f"GROUP BY 3 HAVING COUNT(*) > 1")


def _not_null_sql(model, cols):
    return "\nUNION ALL\n".join(
        f"SELECT '{model}' AS model, '{c}' AS column_name, count_if({c} IS NULL) AS failures "
        f"FROM {MODEL_SHAPES[model]}" for c in cols)


def _values_sql(model, column, values):
    lit = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return (f"SELECT '{model}' AS model, '{column}' AS column_name, CAST({column} AS VARCHAR) AS value, "
            f"COUNT(*) AS n_records FROM {MODEL_SHAPES[model]} "
            f"WHERE {column} IS NOT NULL AND {column} NOT IN ({lit}) GROUP BY 3")


def _range_sql(model, column, lo, hi):
    conds = []
    if lo is not None:
        conds.append(f"{column} < {lo}")
    if hi is not None:
        conds.append(f"{column} > {hi}")
    return (f"SELECT '{model}' AS model, '{column}' AS column_name, "
            f"count_if(COALESCE({' OR '.join(conds)}, FALSE)) AS failures FROM {MODEL_SHAPES[model]}")


def test_oracles(as_of_sql: str, fresh_as_of_sql: str) -> dict[str, str]:
    from tessera.plans import assertions as a
    ALL = tuple(MODEL_SHAPES.values())
    uq = [_unique_sql("events", "event_id"), _unique_sql("users", "user_id"),
          _unique_sql("users", "email"), _unique_sql("sessions", "session_id"),
          _unique_sql("subscriptions", "subscription_id"),
          _unique_sql("stg_events", "event_id"), _unique_sql("stg_users", "user_id"),
          _unique_sql("stg_users", "email"), _unique_sql("stg_sessions", "session_id"),
          _unique_sql("mart_user_activity", "user_id_activity_date",
                      "user_id || '-' || CAST(activity_date AS VARCHAR)"),
          _unique_sql("mart_funnel_analysis", "user_id")]
    nn = [_not_null_sql("events", ["event_id", "user_id", "event_type", "occurred_at"]),
          _not_null_sql("users", ["user_id", "email"]),
          _not_null_sql("sessions", ["session_id", "user_id"]),
          _not_null_sql("subscriptions", ["subscription_id", "user_id"]),
          _not_null_sql("stg_events", ["event_id", "user_id", "event_type", "occurred_at", "event_date"]),
          _not_null_sql("stg_users", ["user_id", "email", "plan_name", "signup_date"]),
          _not_null_sql("stg_sessions", ["session_id", "user_id", "session_duration_seconds"]),
          _not_null_sql("mart_user_activity", ["user_id", "activity_date"]),
          _not_null_sql("mart_dau_wau_mau", ["activity_date", "dau"]),
          _not_null_sql("mart_funnel_analysis", ["user_id", "max_stage_reached"])]
    av = [_values_sql("events", "event_type", a.RAW_EVENT_TYPES),
          _values_sql("users", "plan_name", a.PLANS),
          _values_sql("subscriptions", "event_type", a.SUBSCRIPTION_EVENTS),
          _values_sql("stg_events", "event_type", a.STG_EVENT_TYPES),
          _values_sql("stg_users", "plan_name", a.PLANS),
          _values_sql("mart_user_activity", "engagement_tier", a.TIERS),
          _values_sql("mart_funnel_analysis", "max_stage_reached", a.FUNNEL_STAGE_VALUES)]
    ar = [_range_sql("stg_sessions", "session_duration_seconds", 0, 14400),
          _range_sql("mart_user_activity", "total_events", 1, None),
          _range_sql("mart_dau_wau_mau", "dau", 0, None),
          _range_sql("mart_dau_wau_mau", "dau_mau_stickiness", 0, 1),
          _range_sql("mart_funnel_analysis", "hours_to_activation", 0, None)]
    u = "\nUNION ALL\n"
    fresh = u.join(
        f"SELECT '{n}' AS source_name, MAX(_loaded_at) AS max_loaded_at FROM {s}"
        for n, s in (("events", "raw_events"), ("users", "raw_users"), ("sessions", "raw_sessions")))
    secs = f"date_diff('second', max_loaded_at, {fresh_as_of_sql})"
    return {
        "test_unique": with_shapes(u.join(uq), *ALL),
        "test_not_null": with_shapes(u.join(nn), *ALL),
        "test_accepted_values": with_shapes(u.join(av), *ALL),
        "test_accepted_range": with_shapes(u.join(ar), *ALL),
        "test_no_future_events": with_shapes(f"""
SELECT event_id, user_id, occurred_at, {as_of_sql} AS tested_at FROM stg_events
WHERE occurred_at > {as_of_sql} + INTERVAL 1 HOUR""", "stg_events"),
        # A stage's time against the one before it, as a list of pairs.
        "test_funnel_order": with_shapes("""
WITH pairs AS (
  SELECT *, unnest([
    {'early': signed_up_at, 'late': first_login_at, 'rule': 'login_before_signup'},
    {'early': first_login_at, 'late': activated_at, 'rule': 'activation_before_login'},
    {'early': activated_at, 'late': converted_at, 'rule': 'conversion_before_activation'}]) AS p FROM funnel)
SELECT user_id, signed_up_at, first_login_at, activated_at, converted_at, p.rule AS violation_type
FROM pairs WHERE date_diff('microsecond', p.early, p.late) < 0""",
                                         "funnel"),
        "source_freshness": with_shapes(f"""
SELECT source_name, max_loaded_at, {round_div(secs, '3600', 2)} AS age_hours,
       CASE WHEN max_loaded_at IS NULL THEN 'error'
            WHEN {secs} / 3600.0 > 24 THEN 'error' WHEN {secs} / 3600.0 > 6 THEN 'warn'
            ELSE 'pass' END AS status
FROM ({fresh})""", "raw_events", "raw_users", "raw_sessions"),
    }


# ── loads ────────────────────────────────────────────────────────────────
SCD2_NOW_SQL = "TIMESTAMP '2024-01-01 02:00:00'"

shape("scd2_target", ["dim_patient"])("""
SELECT dp.*, TIMESTAMP '1995-01-01 00:00:00' AS updated_at FROM dim_patient dp
WHERE dp.patient_key IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""")

shape("scd2_staging", ["patient_attrs"])(f"""
SELECT * REPLACE (CASE WHEN patient_key % 10 = 0 THEN 'MEDICAID' ELSE payer_type END AS payer_type)
FROM patient_attrs""")

ORACLE["scd2_final_state"] = with_shapes(f"""
WITH s AS (SELECT *, {ROW_HASH} AS new_hash FROM scd2_staging),
expired AS (
  SELECT t.* REPLACE (DATE '2023-12-31' AS expiration_date, FALSE AS is_current_record,
                      {SCD2_NOW_SQL} AS updated_at)
  FROM scd2_target t JOIN s ON s.patient_id = t.patient_id WHERE t.row_hash <> s.new_hash),
kept AS (
  SELECT t.* FROM scd2_target t
  WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.patient_id = t.patient_id AND t.row_hash <> s.new_hash)),
ins AS (
  SELECT s.patient_id, s.first_name, s.last_name, s.date_of_birth, s.gender, s.zip_code, s.state_code,
         s.payer_type, DATE '2024-01-01' AS effective_date, DATE '9999-12-31' AS expiration_date,
         TRUE AS is_current_record, s.new_hash AS row_hash, {SCD2_NOW_SQL} AS updated_at
  FROM s WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.patient_id = s.patient_id)),
cols AS (
  SELECT patient_id, first_name, last_name, date_of_birth, gender, zip_code, state_code, payer_type,
         effective_date, expiration_date, is_current_record, row_hash, updated_at FROM expired
  UNION ALL
  SELECT patient_id, first_name, last_name, date_of_birth, gender, zip_code, state_code, payer_type,
         effective_date, expiration_date, is_current_record, row_hash, updated_at FROM kept)
SELECT * FROM cols UNION ALL SELECT * FROM ins""", "scd2_target", "scd2_staging")

ORACLE["scd2_run_log"] = with_shapes(f"""
WITH s AS (SELECT *, {ROW_HASH} AS new_hash FROM scd2_staging),
kept AS (SELECT t.patient_id FROM scd2_target t
         WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.patient_id = t.patient_id AND t.row_hash <> s.new_hash))
SELECT 'sp_load_dim_patient' AS procedure_name,
       (SELECT COUNT(*) FROM s WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.patient_id = s.patient_id))
         AS rows_inserted,
       (SELECT COUNT(*) FROM scd2_target t JOIN s ON s.patient_id = t.patient_id WHERE t.row_hash <> s.new_hash)
         AS rows_updated,
       {SCD2_NOW_SQL} AS run_at""", "scd2_target", "scd2_staging")

_CLAIM_ORDER = ("service_date, encounter_key, patient_key, rendering_provider_key, service_date_key, "
                "paid_date_key, procedure_key, primary_diagnosis_key, billed_amount, allowed_amount, "
                "paid_amount, patient_responsibility, units_of_service, claim_status, denial_reason_code")
_CLAIM_COLS = ("claim_id, claim_line_number, encounter_key, patient_key, rendering_provider_key, "
               "service_date, service_date_key, paid_date_key, procedure_key, primary_diagnosis_key, "
               "billed_amount, allowed_amount, paid_amount, patient_responsibility, units_of_service, "
               "claim_status, denial_reason_code")

shape("claim_lines_all")(f"""
    SELECT 'C' || CAST(l_orderkey AS VARCHAR) AS claim_id, l_linenumber AS claim_line_number,
           l_orderkey AS encounter_key, o_custkey AS patient_key, l_suppkey AS rendering_provider_key,
           CAST(l_shipdate AS DATE) AS service_date,
           {date_key('CAST(l_shipdate AS DATE)')} AS service_date_key,
           CASE WHEN l_returnflag <> 'R' THEN {date_key('(CAST(l_shipdate AS DATE) + 30)')} END AS paid_date_key,
           l_partkey AS procedure_key, l_partkey AS primary_diagnosis_key,
           CAST(l_extendedprice AS DECIMAL(14,2)) AS billed_amount,
           CAST(round(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)
                AS DECIMAL(14,2)) AS allowed_amount,
           CAST(round(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                      * (1 + CAST(l_tax AS DECIMAL(4,2))), 2) AS DECIMAL(14,2)) AS paid_amount,
           CAST(round(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)
                AS DECIMAL(14,2)) AS patient_responsibility,
           CAST(l_quantity AS INTEGER) AS units_of_service,
           CASE l_returnflag WHEN 'R' THEN 'Denied' WHEN 'A' THEN 'Adjusted'
                WHEN 'N' THEN 'Paid' ELSE 'Pending' END AS claim_status,
           CASE WHEN l_returnflag = 'R' THEN 'CO-' || l_linestatus END AS denial_reason_code
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")

shape("claims", ["claim_lines_all"])(f"""
SELECT {_CLAIM_COLS} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY claim_id, claim_line_number
                               ORDER BY {', '.join(c.strip() + ' DESC NULLS LAST' for c in _CLAIM_ORDER.split(','))}) AS rn
  FROM claim_lines_all)
WHERE rn = 1""")

shape("claim_target", ["claims"])("SELECT * FROM claims WHERE service_date < DATE '1999-01-01'")
shape("claim_batch", ["claims"])(f"""
SELECT {_CLAIM_COLS.replace('paid_amount, patient_responsibility', 'new_paid AS paid_amount, patient_responsibility').replace('claim_status, denial_reason_code', 'new_status AS claim_status, new_denial AS denial_reason_code')}
FROM (
  SELECT *,
         CASE WHEN claim_line_number = 1 AND claim_status = 'Paid'
              THEN CAST(paid_amount - 10 AS DECIMAL(14,2)) ELSE paid_amount END AS new_paid,
         CASE WHEN claim_line_number = 1 AND claim_status = 'Paid' THEN 'Adjusted'
              ELSE claim_status END AS new_status,
         CASE WHEN claim_line_number = 2 AND claim_status = 'Denied' THEN 'CO-97'
              WHEN claim_line_number = 2 AND claim_status = 'Paid' THEN 'N1'
              ELSE denial_reason_code END AS new_denial
  FROM claims WHERE service_date >= DATE '1998-10-01')""")

def merged_claims_sql(target: str, batch: str) -> str:
    """Stored lines with the batch's five measures where a compared one
    differs (NULL never does), and the lines that are not stored."""
    measures = ("allowed_amount", "paid_amount", "patient_responsibility", "claim_status", "denial_reason_code")
    new = ", ".join(f"IF(differs, s.{m}, t.{m}) AS {m}" for m in measures)
    return f"""
SELECT t.* REPLACE ({new}) FROM {target} t
LEFT JOIN (SELECT b.*, COALESCE(k.claim_status <> b.claim_status OR k.paid_amount <> b.paid_amount
                                OR k.denial_reason_code <> b.denial_reason_code, FALSE) AS differs
           FROM {batch} b JOIN {target} k USING (claim_id, claim_line_number)) s USING (claim_id, claim_line_number)
UNION ALL BY NAME
SELECT b.* FROM {batch} b ANTI JOIN {target} USING (claim_id, claim_line_number)"""


shape("claim_merge_final", ["claim_target", "claim_batch"])(merged_claims_sql("claim_target", "claim_batch"))

shape("claim_batch_moved", ["claim_batch"])("""
SELECT * REPLACE (CASE claim_line_number WHEN 1 THEN service_date + 20 WHEN 3 THEN NULL ELSE service_date END
                  AS service_date) FROM claim_batch""")
shape("claim_adjust_2", ["claim_batch"])("""
SELECT * REPLACE (CAST(paid_amount - 5 AS DECIMAL(14,2)) AS paid_amount, 'Adjusted' AS claim_status)
FROM claim_batch WHERE claim_line_number = 2""")
shape("claim_adjust_1", ["claim_batch"])("""
SELECT * REPLACE (CAST(paid_amount + 2 AS DECIMAL(14,2)) AS paid_amount, 'Adjusted' AS claim_status)
FROM claim_batch WHERE claim_line_number = 1""")
shape("claims_after_2", ["claim_merge_final", "claim_adjust_2"])(merged_claims_sql("claim_merge_final", "claim_adjust_2"))

ORACLE["claims_partition_moves"] = with_shapes(
    merged_claims_sql("claim_target", "claim_batch_moved"), "claim_target", "claim_batch_moved")
ORACLE["claims_stream_batches"] = with_shapes(
    merged_claims_sql("claims_after_2", "claim_adjust_1"), "claims_after_2", "claim_adjust_1")
ORACLE["claims_first_load"] = with_shapes("""
SELECT * REPLACE (CAST(billed_amount + 1 AS DECIMAL(14,2)) AS billed_amount),
       (SELECT COUNT(*) FROM claim_batch) AS n_keys, 1::BIGINT AS low_key, (SELECT COUNT(*) FROM claim_batch) AS high_key
FROM claim_batch""", "claim_batch")
ORACLE["claim_merge_final_state"] = with_shapes("SELECT * FROM claim_merge_final", "claim_merge_final")
ORACLE["claims_stream_final_state"] = ORACLE["claim_merge_final_state"]

ENC_OUT = ("encounter_id, patient_key, attending_provider_key, admit_date, discharge_date, "
           "admit_date_key, discharge_date_key, primary_diagnosis_key, encounter_type, "
           "length_of_stay_days, total_charges, total_payments, readmission_30d_flag, mortality_flag")

ORACLE["encounter_append_final_state"] = with_shapes(f"""
WITH fe AS (SELECT *, {date_key('admit_date')} AS admit_date_key,
                   {date_key('discharge_date')} AS discharge_date_key FROM fact_encounter),
tgt AS (SELECT * FROM fe WHERE admit_date < DATE '2001-01-01'),
raw AS (SELECT * FROM fe WHERE admit_date >= DATE '2000-12-25'
          AND TIMESTAMP '2001-09-01 02:00:00' - to_hours(CAST(encounter_key % 48 AS INTEGER))
              >= TIMESTAMP '2001-08-31 02:00:00')
SELECT {ENC_OUT} FROM tgt
UNION ALL
SELECT {ENC_OUT} FROM raw r
WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.encounter_id = r.encounter_id)""", "fact_encounter")

ORACLE["encounters_last_365d"] = with_shapes("""
SELECT encounter_id, patient_key, admit_date, encounter_type, total_charges FROM fact_encounter
WHERE admit_date >= DATE '2001-06-30' - 365""", "fact_encounter")

ORACLE["claim_json_projection"] = with_shapes("""
SELECT c.claim_id, c.claim_line_number, 'E' || CAST(c.encounter_key AS VARCHAR) AS encounter_id,
       'P' || CAST(c.patient_key AS VARCHAR) AS patient_id,
       CASE WHEN c.rendering_provider_key % 25 = 0 THEN lpad(CAST(c.rendering_provider_key AS VARCHAR), 9, '0')
            ELSE lpad(CAST(c.rendering_provider_key AS VARCHAR), 10, '0') END AS rendering_npi,
       c.service_date, CASE WHEN c.paid_date_key IS NOT NULL THEN c.service_date + 30 END AS paid_date,
       'CPT' || CAST(c.procedure_key AS VARCHAR) AS procedure_code, d.icd10_code AS primary_icd10,
       c.billed_amount, c.allowed_amount, c.paid_amount, c.patient_responsibility, c.units_of_service,
       c.claim_status, c.denial_reason_code
FROM claim_lines_all c JOIN dim_diagnosis d ON d.diagnosis_key = c.primary_diagnosis_key""",
                                               "claim_lines_all", "dim_diagnosis")


# ── calendar, keys, hashes, pivots, pruning ──────────────────────────────
def _holiday_sql(d: str) -> str:
    from tessera.functions import calendar as cal
    conds = []
    for m, day in cal.FIXED_DATE_HOLIDAYS:
        c = f"(month({d}) = {m} AND day({d}) = {day})"
        if (m, day) == (6, 19):
            c = f"({c} AND year({d}) >= {cal.JUNETEENTH_FIRST_YEAR})"
        conds.append(c)
    for m, wd, n in cal.NTH_WEEKDAY_HOLIDAYS:
        which = (f"day(last_day({d})) - day({d}) < 7" if n == -1
                 else f"(day({d}) - 1) // 7 + 1 = {n}")
        conds.append(f"(month({d}) = {m} AND dayofweek({d}) + 1 = {wd} AND {which})")
    return "(" + " OR ".join(conds) + ")"


ORACLE["date_dimension"] = f"""
WITH b AS (SELECT (SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders) AS lo,
                  (SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem) AS hi),
d AS (SELECT CAST(g AS DATE) AS full_date FROM b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) t(g))
SELECT {date_key('full_date')} AS date_key, full_date,
       CAST(dayofweek(full_date) + 1 AS TINYINT) AS day_of_week,
       strftime(full_date, '%A') AS day_name,
       CAST(day(full_date) AS TINYINT) AS day_of_month,
       CAST(dayofyear(full_date) AS SMALLINT) AS day_of_year,
       CAST(weekofyear(full_date) AS TINYINT) AS week_of_year,
       CAST(weekofyear(full_date) AS TINYINT) AS iso_week,
       CAST(month(full_date) AS TINYINT) AS month_number,
       strftime(full_date, '%B') AS month_name,
       CAST(quarter(full_date) AS TINYINT) AS quarter_number,
       CAST(year(full_date) AS SMALLINT) AS year_number,
       printf('FY%d-P%02d', year(full_date + INTERVAL 3 MONTH), ((month(full_date) - 10 + 12) % 12) + 1)
         AS fiscal_period,
       dayofweek(full_date) NOT IN (0, 6) AS is_weekday,
       {_holiday_sql('full_date')} AS is_federal_holiday
FROM d"""

ORACLE["date_spine"] = """
WITH b AS (SELECT MIN(CAST(ts AS DATE)) AS s, DATE '2024-01-30' AS e FROM events)
SELECT CAST(g AS DATE) AS spine_date
FROM b, generate_series(b.s, b.e, INTERVAL 1 DAY) t(g) WHERE b.s <= b.e"""

ORACLE["surrogate_key_md5"] = with_shapes("""
SELECT user_id, activity_date, plan_name,
       md5(concat_ws('|', COALESCE(CAST(user_id AS VARCHAR), '_null_'),
                          COALESCE(CAST(activity_date AS VARCHAR), '_null_'),
                          COALESCE(CAST(plan_name AS VARCHAR), '_null_'))) AS surrogate_key
FROM user_activity""", "user_activity")

ORACLE["patient_row_hash"] = with_shapes(f"SELECT patient_id, {ROW_HASH} AS row_hash FROM scd2_staging",
                                         "scd2_staging")

ORACLE["column_values"] = with_shapes("""
SELECT DISTINCT plan_name FROM stg_users WHERE plan_name IS NOT NULL ORDER BY plan_name""",
                                      "stg_users")

ORACLE["plan_pivot"] = with_shapes("""
SELECT activity_date,
       CAST(SUM(CASE WHEN plan_name = 'enterprise' THEN total_events END) AS BIGINT) AS enterprise,
       CAST(SUM(CASE WHEN plan_name = 'free' THEN total_events END) AS BIGINT) AS free,
       CAST(SUM(CASE WHEN plan_name = 'growth' THEN total_events END) AS BIGINT) AS growth,
       CAST(SUM(CASE WHEN plan_name = 'starter' THEN total_events END) AS BIGINT) AS starter
FROM user_activity GROUP BY activity_date""", "user_activity")

ORACLE["claims_by_year_pruned"] = with_shapes("""
SELECT claim_id, claim_line_number, service_date, billed_amount, paid_amount, claim_status,
       CAST(year(service_date) AS INTEGER) AS service_year
FROM fact_claim WHERE year(service_date) = 1998""", "fact_claim")


# ── README-documented capabilities ───────────────────────────────────────
ORACLE["encounter_journey"] = with_shapes(f"""
SELECT encounter_id, patient_key, admit_date, total_charges,
       COUNT(*) OVER (PARTITION BY patient_key ORDER BY admit_date, encounter_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS encounter_seq,
       COUNT(*) OVER w AS encounters_90d,
       {round_div('SUM(total_charges * 100) OVER w', 'COUNT(total_charges) OVER w * 100', 4)}
         AS avg_charges_90d
FROM fact_encounter
WINDOW w AS (PARTITION BY patient_key ORDER BY admit_date
             RANGE BETWEEN INTERVAL 90 DAYS PRECEDING AND CURRENT ROW)""", "fact_encounter")

ORACLE["lace_scores"] = with_shapes("""
WITH e AS (
  SELECT fe.*, COALESCE(SUM(CASE WHEN encounter_type = 'ED' THEN 1 ELSE 0 END) OVER (
           PARTITION BY patient_key ORDER BY admit_date
           RANGE BETWEEN INTERVAL 182 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING), 0) AS ed_visits
  FROM fact_encounter fe),
c AS (SELECT b.encounter_key, COUNT(DISTINCT b.diagnosis_key) AS comorbidities
      FROM bridge b JOIN dim_diagnosis d ON d.diagnosis_key = b.diagnosis_key AND d.is_chronic
      GROUP BY 1),
s AS (
  SELECT e.encounter_id, e.patient_key, e.admit_date,
         CASE WHEN length_of_stay_days >= 14 THEN 7 WHEN length_of_stay_days >= 7 THEN 5
              WHEN length_of_stay_days >= 4 THEN 4 WHEN length_of_stay_days >= 3 THEN 3
              WHEN length_of_stay_days >= 2 THEN 2 WHEN length_of_stay_days >= 1 THEN 1 ELSE 0 END AS l_points,
         CASE WHEN admit_source IN ('1-URGENT', '2-HIGH') THEN 3 ELSE 0 END AS a_points,
         CASE WHEN COALESCE(comorbidities, 0) >= 4 THEN 5 ELSE COALESCE(comorbidities, 0) END AS c_points,
         CAST(least(ed_visits, 4) AS INTEGER) AS e_points
  FROM e LEFT JOIN c ON c.encounter_key = e.encounter_key
  WHERE e.encounter_type = 'IP'),
t AS (SELECT *, l_points + a_points + c_points + e_points AS lace_score FROM s)
SELECT t.*, round(CAST((SELECT COUNT(*) FROM t t2 WHERE t2.lace_score < t.lace_score) AS DOUBLE)
                  / greatest((SELECT COUNT(*) FROM t) - 1, 1), 6) AS lace_percentile
FROM t""", "fact_encounter", "bridge", "dim_diagnosis")

ORACLE["encounter_sequence"] = with_shapes("""
WITH h AS (SELECT encounter_id, patient_key, admit_date, encounter_type, total_charges,
                  (admit_date, encounter_id) AS place FROM fact_encounter)
SELECT me.encounter_id, me.patient_key, me.admit_date, COUNT(*) FILTER (o.place <= me.place) AS encounter_seq,
       arg_max(o.admit_date, o.place) FILTER (o.place < me.place) AS prev_admit_date,
       arg_max(o.encounter_type, o.place) FILTER (o.place < me.place) AS prev_encounter_type,
       arg_min(o.admit_date, o.place) FILTER (o.place > me.place) AS next_admit_date,
       arg_min(o.encounter_type, o.place) FILTER (o.place > me.place) AS next_encounter_type,
       CAST(me.admit_date - arg_max(o.admit_date, o.place) FILTER (o.place < me.place) AS INTEGER) AS days_since_last,
       CAST(SUM(o.total_charges) FILTER (o.place <= me.place) AS DECIMAL(18,2)) AS charges_to_date
FROM h me JOIN h o ON o.patient_key IS NOT DISTINCT FROM me.patient_key
GROUP BY me.encounter_id, me.patient_key, me.admit_date""", "fact_encounter")

# Days counted one by one, stay by stay.
ORACLE["facility_census"] = with_shapes(f"""
WITH stays AS (
  SELECT sub_specialty || ' General' AS facility_name, admit_date,
         least(IF(encounter_key % 50 = 0, DATE '2002-01-01', discharge_date), DATE '2002-01-01') - 1 AS last_day
  FROM fact_encounter JOIN dim_provider ON provider_key = attending_provider_key
  WHERE encounter_type = 'IP' AND admit_date <= DATE '2001-12-31'
    AND (encounter_key % 50 = 0 OR discharge_date > admit_date)),
here AS (SELECT facility_name, CAST(unnest(generate_series(admit_date, last_day, INTERVAL 1 DAY)) AS DATE) AS day FROM stays),
counted AS (SELECT facility_name, day, COUNT(*) AS n FROM here GROUP BY ALL),
daily AS (
  SELECT f.facility_name, f.day AS census_date, COALESCE(n, 0) AS census
  FROM (SELECT facility_name, CAST(unnest(generate_series((SELECT MIN(admit_date) FROM stays), DATE '2001-12-31',
                                                          INTERVAL 1 DAY)) AS DATE) AS day
        FROM (SELECT DISTINCT facility_name FROM stays)) f LEFT JOIN counted USING (facility_name, day)),
far AS (SELECT *, census_date - MIN(census_date) OVER (PARTITION BY facility_name) AS day_no FROM daily),
lists AS (SELECT facility_name, list(census ORDER BY day_no) AS c FROM far GROUP BY 1),
cut AS (SELECT facility_name, census_date, census, c[greatest(day_no - 5, 1):day_no + 1] AS w,
               c[greatest(day_no - 28, 1):day_no + 1] AS m, IF(day_no > 0, c[day_no], NULL) AS y
        FROM far JOIN lists USING (facility_name))
SELECT facility_name, census_date, census, {round_div('list_sum(w)', 'len(w)', 4)} AS avg_7d, list_max(w) AS max_7d,
       {round_div('list_sum(m)', 'len(m)', 4)} AS avg_30d, list_max(m) AS max_30d, census - y AS dod_delta
FROM cut""",
                                        "fact_encounter", "dim_provider")


def provider_charge_rank_sql() -> str:
    return with_shapes(f"""
WITH per AS (SELECT fe.attending_provider_key AS provider_key, p.specialty,
                    CAST(SUM(fe.total_charges) AS DECIMAL(18,2)) AS total_charges
             FROM fact_encounter fe JOIN dim_provider p ON p.provider_key = fe.attending_provider_key
             GROUP BY 1, 2),
a AS (SELECT *, CAST({round_div('SUM(total_charges * 100) OVER (PARTITION BY specialty)',
                                'COUNT(*) OVER (PARTITION BY specialty) * 100', 2)} AS DECIMAL(18,2)) AS avg2
      FROM per)
SELECT provider_key, specialty, total_charges,
       DENSE_RANK() OVER (PARTITION BY specialty ORDER BY total_charges DESC) AS charge_dense_rank,
       avg2 AS specialty_avg_charges,
       CAST(total_charges - avg2 AS DECIMAL(18,2)) AS diff_from_specialty_avg
FROM a""", "fact_encounter", "dim_provider")


ORACLE["cohort_retention"] = with_shapes(f"""
WITH ua AS (SELECT user_id, CAST(date_trunc('week', activity_date) AS DATE) AS activity_week
            FROM user_activity),
f AS (SELECT user_id, MIN(activity_week) AS cohort_week FROM ua GROUP BY 1),
a AS (SELECT DISTINCT f.cohort_week, ua.user_id,
             CAST(date_diff('day', f.cohort_week, ua.activity_week) / 7 AS INTEGER) AS week_offset
      FROM ua JOIN f USING (user_id)),
sz AS (SELECT cohort_week, COUNT(*) AS cohort_size FROM f GROUP BY 1),
ct AS (SELECT cohort_week, week_offset, COUNT(*) AS active_users FROM a GROUP BY 1, 2)
SELECT ct.cohort_week, week_offset, cohort_size, active_users,
       {round_div('active_users', 'cohort_size', 4)} AS retention_rate
FROM ct JOIN sz USING (cohort_week)""", "user_activity")

ORACLE["cohort_retention_monthly"] = with_shapes(f"""
WITH seen AS (SELECT DISTINCT user_id, year(activity_date) * 12 + month(activity_date) - 1 AS m FROM user_activity
              WHERE user_id IS NOT NULL),
born AS (SELECT user_id, MIN(m) AS c FROM seen GROUP BY ALL),
kept AS (SELECT c, m - c AS month_offset, COUNT(*) AS active_users FROM seen JOIN born USING (user_id) GROUP BY ALL)
SELECT make_date(c // 12, c % 12 + 1, 1) AS cohort_month, CAST(month_offset AS INTEGER) AS month_offset,
       (SELECT COUNT(*) FROM born WHERE born.c = kept.c) AS cohort_size, active_users,
       {round_div('active_users', '(SELECT COUNT(*) FROM born WHERE born.c = kept.c)', 4)} AS retention_rate,
       {round_div('active_users', '(SELECT MAX(b.active_users) FROM kept b WHERE b.c = kept.c AND b.month_offset = kept.month_offset - 1)', 4)}
         AS month_over_month_rate
FROM kept""", "user_activity")

ORACLE["time_to_convert"] = with_shapes("""
WITH l AS (SELECT 'first_login' AS stage, hours_to_first_login AS hours FROM funnel
           UNION ALL SELECT 'activation', hours_to_activation FROM funnel
           UNION ALL SELECT 'conversion', hours_to_conversion FROM funnel)
SELECT stage, COUNT(*) AS users,
       quantile_cont(hours, 0.25) AS p25_hours, quantile_cont(hours, 0.5) AS p50_hours,
       quantile_cont(hours, 0.75) AS p75_hours
FROM l WHERE hours IS NOT NULL GROUP BY 1""", "funnel")

ORACLE["dau_rolling_avg"] = with_shapes(f"""
SELECT activity_date, plan_name, country_code, dau,
       {round_div('SUM(dau) OVER w', 'COUNT(dau) OVER w', 4)} AS dau_7d_avg
FROM dau_wau_mau
WINDOW w AS (PARTITION BY plan_name, country_code ORDER BY activity_date
             RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""", "dau_wau_mau")

ORACLE["value_quantile_sketches"] = """
WITH e AS (SELECT event_type, day(ts) AS d FROM events WHERE ts IS NOT NULL AND value IS NOT NULL),
p AS (SELECT 'all' AS period, event_type FROM e UNION ALL SELECT 'late', event_type FROM e WHERE d > 15),
n AS (SELECT period, event_type, COUNT(*) AS n FROM p GROUP BY ALL)
SELECT *, CAST(unnest([0.01, 0.25, 0.5, 0.75, 0.9, 0.99]) AS DOUBLE) AS share, TRUE AS within_error FROM n"""

ORACLE["rolling_distinct_error"] = with_shapes("""
SELECT activity_date, plan_name, country_code, wau, mau, TRUE AS wau_close, TRUE AS mau_close FROM dau_wau_mau
WHERE plan_name IS NOT NULL AND country_code IS NOT NULL""", "dau_wau_mau")

ORACLE["nested_claim_totals"] = with_shapes("""
SELECT claim_id, COUNT(*) AS n_lines, CAST(SUM(billed_amount) AS DECIMAL(18,2)) AS billed,
       CAST(SUM(paid_amount) AS DECIMAL(18,2)) AS paid,
       CAST(SUM(IF(claim_status = 'Adjusted', paid_amount, 0)) AS DECIMAL(18,2)) AS adjusted_paid,
       COUNT(*) FILTER (claim_status = 'Denied') > 0 AS any_denied,
       COALESCE(string_agg(DISTINCT denial_reason_code, ',' ORDER BY denial_reason_code), '') AS denial_codes
FROM fact_claim GROUP BY claim_id""", "fact_claim")

ORACLE["nested_status_mix"] = with_shapes("""
SELECT claim_status, COUNT(*) AS n_lines, CAST(SUM(paid_amount) AS DECIMAL(18,2)) AS paid FROM fact_claim GROUP BY 1""",
                                          "fact_claim")

_VAULT_HK = "md5(upper(trim(patient_id)))"
_VAULT_HD = ("md5(concat_ws('|', COALESCE(first_name, ''), COALESCE(last_name, ''), "
             "COALESCE(CAST(date_of_birth AS VARCHAR), ''), COALESCE(gender, ''), COALESCE(zip_code, ''), "
             "COALESCE(state_code, ''), COALESCE(payer_type, '')))")

shape("vault_sat", ["scd2_target", "scd2_staging"])(f"""
WITH s1 AS (SELECT {_VAULT_HK} AS hk_patient, DATE '2023-12-31' AS load_date, {_VAULT_HD} AS hash_diff,
                   payer_type FROM scd2_target),
st AS (SELECT {_VAULT_HK} AS hk_patient, {_VAULT_HD} AS hash_diff, payer_type FROM scd2_staging),
s2 AS (SELECT st.hk_patient, DATE '2024-01-01' AS load_date, st.hash_diff, st.payer_type
       FROM st LEFT JOIN s1 ON s1.hk_patient = st.hk_patient
       WHERE s1.hash_diff IS NULL OR s1.hash_diff <> st.hash_diff)
SELECT * FROM s1 UNION ALL SELECT * FROM s2""")

ORACLE["vault_satellite"] = with_shapes("SELECT * FROM vault_sat", "vault_sat")
ORACLE["vault_pit"] = with_shapes("""
WITH snaps AS (SELECT CAST(g AS DATE) AS snapshot_date
               FROM generate_series(DATE '2023-12-31', DATE '2024-01-02', INTERVAL 1 DAY) t(g)),
keys AS (SELECT DISTINCT hk_patient FROM vault_sat)
SELECT k.hk_patient, s.snapshot_date,
       (SELECT MAX(load_date) FROM vault_sat v
        WHERE v.hk_patient = k.hk_patient AND v.load_date <= s.snapshot_date) AS sat_load_date
FROM keys k, snaps s
WHERE EXISTS (SELECT 1 FROM vault_sat v WHERE v.hk_patient = k.hk_patient AND v.load_date <= s.snapshot_date)""",
                                "vault_sat")

# Every patient's attributes on each of the three load days, if sent.
shape("vault_sent", ["scd2_target", "patient_attrs"])("""
WITH days AS (SELECT * FROM (VALUES (0, DATE '2023-12-29'), (1, DATE '2024-01-01'), (2, DATE '2024-01-03')) v(n, day))
SELECT n, day, patient_id, md5(upper(trim(patient_id))) AS hk, first_name, last_name, gender,
       IF(n > 0 AND patient_key % 3 = 0, '00000', zip_code) AS zip_code,
       IF(n = 2 AND patient_key % 5 = 0, 'SELF', payer_type) AS payer_type, state_code,
       n > 0 OR patient_key % 4 <> 0 AS covered
FROM patient_attrs CROSS JOIN days WHERE n > 0 OR patient_key IN (SELECT patient_key FROM scd2_target)""")

# The current load of a satellite on a day: the newest load whose values
# differ from the load before.
ORACLE["vault_pit_satellites"] = with_shapes("""
WITH d AS (SELECT *, zip_code IS DISTINCT FROM LAG(zip_code) OVER w OR LAG(n) OVER w IS NULL AS new FROM vault_sent
           WINDOW w AS (PARTITION BY patient_id ORDER BY n)),
c AS (SELECT *, payer_type IS DISTINCT FROM LAG(payer_type) OVER w OR LAG(n) OVER w IS NULL AS new
      FROM vault_sent WHERE covered WINDOW w AS (PARTITION BY patient_id ORDER BY n)),
snaps AS (SELECT CAST(unnest(generate_series(DATE '2023-12-28', DATE '2024-01-04', INTERVAL 1 DAY)) AS DATE) AS snapshot_date),
x AS (SELECT DISTINCT patient_id, snapshot_date FROM vault_sent, snaps WHERE day <= snapshot_date),
pd AS (SELECT x.*, MAX(day) AS demographics_load_date, arg_max(zip_code, day) AS zip_code
       FROM x LEFT JOIN d ON d.patient_id = x.patient_id AND d.new AND d.day <= x.snapshot_date GROUP BY ALL),
pc AS (SELECT x.*, MAX(day) AS coverage_load_date, arg_max(payer_type, day) AS payer_type
       FROM x LEFT JOIN c ON c.patient_id = x.patient_id AND c.new AND c.day <= x.snapshot_date GROUP BY ALL)
SELECT * FROM pd JOIN pc USING (patient_id, snapshot_date)""", "vault_sent")

ORACLE["vault_link"] = with_shapes("""
WITH seen AS (
  SELECT 'P' || patient_key AS p, npi, unnest([DATE '2000-01-01', DATE '2002-01-01']) AS day, admit_date
  FROM fact_encounter JOIN dim_provider ON provider_key = attending_provider_key),
m AS (SELECT p, npi, day, MAX(admit_date) AS last_seen FROM seen WHERE admit_date < day GROUP BY ALL),
first AS (SELECT p, npi, MIN(day) AS linked_on FROM m GROUP BY ALL)
SELECT md5(p || '|' || npi) AS hk_link, md5(p) AS hk_patient_id, md5(npi) AS hk_npi, linked_on, MIN(day) AS sat_load_date, last_seen
FROM m JOIN first USING (p, npi) GROUP BY ALL""", "fact_encounter", "dim_provider")

ORACLE["events_continuous_agg"] = """
SELECT CAST(ts AS DATE) AS event_date, event_type, COUNT(*) AS events,
       CAST(SUM(CAST(value AS DECIMAL(14,2))) AS DECIMAL(18,2)) AS value_sum
FROM events GROUP BY 1, 2"""

ORACLE["events_late_files"] = ORACLE["events_continuous_agg"]

ORACLE["claims_run_ledger"] = with_shapes(f"""
WITH m AS (
  SELECT (SELECT COUNT(*) FROM claim_batch) AS landed,
         (SELECT COUNT(*) FROM claim_batch s JOIN claim_target t USING (claim_id, claim_line_number)
          WHERE COALESCE(t.claim_status <> s.claim_status OR t.paid_amount <> s.paid_amount
                         OR t.denial_reason_code <> s.denial_reason_code, FALSE))
         + (SELECT COUNT(*) FROM claim_batch s WHERE NOT EXISTS (
              SELECT 1 FROM claim_target t WHERE t.claim_id = s.claim_id
                                            AND t.claim_line_number = s.claim_line_number)) AS merged,
         (SELECT COUNT(*) FROM claim_merge_final WHERE paid_amount > billed_amount) AS bad,
         (SELECT COUNT(*) FROM claim_merge_final) AS total)
SELECT 'claims-19990102' AS run_id, 'claims_daily' AS pipeline_name,
       CASE WHEN status = 'FAIL' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       CAST(landed + merged + 1 AS BIGINT) AS total_rows,
       '[{{"step":"stage_load","status":"SUCCESS","rows":' || landed || '}},'
       || '{{"step":"transform","status":"SUCCESS","rows":' || merged || '}},'
       || '{{"step":"quality_gate","status":"' || CASE WHEN status = 'FAIL' THEN 'FAILED' ELSE 'SUCCESS' END
       || '","rows":1}}]' AS run_summary,
       CASE WHEN status = 'FAIL' THEN 'quality_gate' END AS failed_step,
       CASE WHEN status = 'FAIL' THEN 'Run claims-19990102 complete. FAILs: 1' END AS error_message
FROM (SELECT *, CASE WHEN bad = 0 THEN 'PASS'
                     WHEN {round_div('bad * 100', 'total', 4)} <= 0.1 THEN 'WARN' ELSE 'FAIL' END AS status
      FROM m)""", "claim_target", "claim_batch", "claim_merge_final")

# An array line is two payloads that are no objects.
ORACLE["claims_run_rejects"] = with_shapes("""
SELECT CASE claim_line_number WHEN 4 THEN 'malformed_json' WHEN 5 THEN 'uncastable_field' WHEN 6 THEN 'uncastable_field'
       ELSE IF(rendering_provider_key % 7 = 0, 'unresolved_provider', 'merged') END AS reason,
       CAST(SUM(IF(claim_line_number = 6, 2, 1)) AS BIGINT) AS n
FROM claim_batch GROUP BY 1""", "claim_batch")

# Stored encounters and every extracted one that is not stored.
ORACLE["encounter_append_watermarked"] = with_shapes(f"""
WITH keyed AS (SELECT *, {date_key('admit_date')} AS admit_date_key, {date_key('discharge_date')} AS discharge_date_key
               FROM fact_encounter)
SELECT {ENC_OUT} FROM keyed WHERE admit_date < DATE '2001-01-01' OR admit_date >= DATE '2000-12-25'""", "fact_encounter")

ORACLE["encounter_rejects"] = with_shapes("""
SELECT encounter_id, npi AS attending_npi, 'provider' AS missing_dimension
FROM fact_encounter JOIN dim_provider ON provider_key = attending_provider_key
WHERE admit_date >= DATE '2000-12-25' AND provider_key % 5 = 0""", "fact_encounter", "dim_provider")

shape("extracted_encounters", ["fact_encounter"])("""
SELECT *, attending_provider_key AS p, encounter_key % 2 AS half, admit_date < DATE '2001-01-01' AS stored
FROM fact_encounter WHERE admit_date >= DATE '2000-12-25'""")

# Stored rows keep their own load time; extracted ones have their run's.
ORACLE["encounter_equal_extract_times"] = with_shapes(f"""
WITH whole AS (
  SELECT *, CAST(admit_date + 1 AS TIMESTAMP) AS created_at FROM fact_encounter WHERE admit_date < DATE '2001-01-01'
  UNION ALL BY NAME
  SELECT * EXCLUDE (p, half, stored), TIMESTAMP '2001-09-01 02:00:00' + to_hours(half::INTEGER) AS created_at
  FROM extracted_encounters WHERE NOT stored)
SELECT {ENC_OUT}, created_at
FROM (SELECT *, {date_key('admit_date')} AS admit_date_key, {date_key('discharge_date')} AS discharge_date_key FROM whole)""",
                                                      "fact_encounter", "extracted_encounters")

ORACLE["encounter_reject_replay"] = with_shapes("""
SELECT encounter_id, 'loaded' AS state, 0 AS runs,
       IF(stored, CAST(admit_date + 1 AS TIMESTAMP), TIMESTAMP '2001-09-01 02:00:00' + to_hours(IF(p % 5 = 0, 2, 0))) AS at
FROM extracted_encounters WHERE stored OR p % 7 <> 0
UNION ALL BY NAME
SELECT encounter_id, 'waiting' AS state, 3 AS runs, TIMESTAMP '2001-09-01 02:00:00' AS at
FROM extracted_encounters WHERE p % 7 = 0""", "extracted_encounters")

ORACLE["incremental_activity_model"] = with_shapes("""
SELECT * EXCLUDE (_updated_at, engagement_tier), IF(activity_date < (SELECT MAX(activity_date) - 3 FROM user_activity
  WHERE activity_date <= DATE '2024-01-15'), NULL, engagement_tier) AS engagement_tier FROM user_activity""", "user_activity")
ORACLE["incremental_dau_model"] = with_shapes("SELECT * EXCLUDE (_updated_at) FROM dau_wau_mau", "dau_wau_mau")

ORACLE["encounter_calendar"] = with_shapes(f"""
SELECT year(admit_date)::SMALLINT AS admit_year, quarter(admit_date)::TINYINT AS admit_quarter,
       isodow(admit_date) < 6 AS admit_weekday, {_holiday_sql('admit_date')} AS admit_holiday,
       isodow(discharge_date) < 6 AS discharge_weekday, COUNT(*) AS stays, {avg_int('length_of_stay_days')} AS avg_los
FROM fact_encounter GROUP BY ALL""", "fact_encounter")

# Eastern time: five hours behind, four from the second Sunday of March, two
# o'clock, to the first of November, two o'clock.  A time that the clocks skip
# counts as the winter time it would be.
ORACLE["events_to_utc"] = """
WITH l AS (SELECT event_id, ts + to_hours(CAST(event_id * 7 % 8784 AS INTEGER)) AS local_ts FROM events WHERE ts IS NOT NULL),
d AS (SELECT *, make_date(year(local_ts), 3, 1) AS m, make_date(year(local_ts), 11, 1) AS n FROM l)
SELECT event_id, local_ts, local_ts + to_hours(IF(
  local_ts >= CAST(m + ((7 - isodow(m) % 7) % 7 + 7)::INTEGER AS TIMESTAMP) + INTERVAL 3 HOUR
  AND local_ts < CAST(n + ((7 - isodow(n) % 7) % 7)::INTEGER AS TIMESTAMP) + INTERVAL 2 HOUR, 4, 5)) AS utc_ts FROM d"""

ORACLE["report_heads"] = f"""
SELECT report, place::INTEGER AS place, a, b, c FROM (
  SELECT 'readmissions' AS report, row_number() OVER (ORDER BY patient_key, admit_date) - 1 AS place, CAST(patient_key AS VARCHAR) AS a,
         CAST(admit_date AS VARCHAR) AS b, CAST(patient_key AS VARCHAR) AS c FROM ({ORACLE["readmission_30d"]})
  UNION ALL
  SELECT 'progression', row_number() OVER (ORDER BY patient_key, icd10_code, encounter_date) - 1, CAST(patient_key AS VARCHAR),
         icd10_code, CAST(encounter_date AS VARCHAR) FROM ({ORACLE["chronic_progression"]}))
WHERE place < 200"""

ORACLE["fingerprint_keys"] = with_shapes("""
SELECT COUNT(*) AS n, COUNT(DISTINCT encounter_id) AS n_keys, COUNT(*) AS n_ids, TRUE AS same_again, TRUE AS well_formed
FROM fact_encounter""", "fact_encounter")

ORACLE["macro_values"] = """
WITH x AS (SELECT l_orderkey, l_linenumber, CAST(round(l_tax * 100) AS INTEGER) AS tax, CAST(round(l_discount * 100) AS INTEGER) AS off,
                  CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * 100 AS BIGINT) AS cents FROM lineitem)
SELECT l_orderkey, l_linenumber, cents, round(IF(off = 0, 0.0, CAST(tax AS DOUBLE) / off), 6) AS zero_if_zero,
       round(CAST(tax AS DOUBLE) / nullif(off, 0), 6) AS null_if_zero, CAST(cents / 100.0 AS DECIMAL(18,2)) AS dollars,
       CAST(((cents + 5) // 10) / 10.0 AS DECIMAL(18,1)) AS tens_of_cents FROM x"""

ORACLE["schema_synced_claims"] = with_shapes("""
WITH b AS (SELECT claim_id, claim_line_number, claim_status, paid_amount, 'web' AS channel FROM claims WHERE service_date >= DATE '1998-10-01'),
t AS (SELECT claim_id, claim_line_number, claim_status, paid_amount, NULL::VARCHAR AS channel FROM claims WHERE service_date < DATE '1999-01-01')
SELECT * FROM b UNION ALL SELECT * FROM t ANTI JOIN b USING (claim_id, claim_line_number)""", "claims")

ORACLE["claims_array_landing"] = with_shapes(
    "SELECT claim_id, claim_line_number, paid_amount, claim_status FROM claim_batch", "claim_batch")

ORACLE["dq_logged_check"] = f"""
SELECT 'run-x' AS run_id, 'discount_cap' AS check_name, 'validity' AS check_category, 'edw.fact_claim' AS target_table,
       'discount' AS target_column, n AS records_checked, bad AS records_failed, CAST({round_div('bad * 100', 'n', 4)} AS DECIMAL(8,4))
         AS failure_rate_pct, CAST(15 AS DECIMAL(8,4)) AS threshold_pct,
       CASE WHEN bad = 0 THEN 'PASS' WHEN {round_div('bad * 100', 'n', 4)} <= 15 THEN 'WARN' ELSE 'FAIL' END AS status,
       NULL::VARCHAR AS sample_failures, TIMESTAMP '1998-06-30 06:00:00' AS checked_at
FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (l_discount > 0.09) AS bad FROM lineitem)"""

# ── encounter run ────────────────────────────────────────────────────────
shape("encounter_run", ["extracted_encounters", "fact_encounter", "scd2_target", "scd2_staging"])(f"""
WITH known AS (SELECT patient_key, patient_id, row_hash FROM scd2_target),
x AS (SELECT encounter_key, stored, patient_key IN (SELECT patient_key FROM known) AS found FROM extracted_encounters),
s AS (SELECT patient_id, {ROW_HASH} AS h FROM scd2_staging),
m AS (SELECT s.patient_id, known.row_hash IS NOT NULL AS old, COALESCE(known.row_hash <> s.h, FALSE) AS changed
      FROM s LEFT JOIN known USING (patient_id)),
base AS (SELECT patient_key FROM fact_encounter WHERE admit_date < DATE '2001-01-01' AND patient_key IN (SELECT patient_key FROM known))
SELECT (SELECT COUNT(*) FROM x) AS landed, (SELECT COUNT(*) FROM x WHERE found AND NOT stored) AS added,
       (SELECT COUNT(*) FROM x WHERE found AND NOT stored AND encounter_key % 10 = 0) AS flawed,
       (SELECT COUNT(*) FROM x WHERE NOT found) AS lost,
       (SELECT COUNT(*) FROM m WHERE changed) AS expired, (SELECT COUNT(*) FROM m WHERE changed OR NOT old) AS inserted,
       (SELECT COUNT(*) FROM base) AS fact_rows, (SELECT COUNT(*) FROM known) AS dim_rows""")

# The first run stops at its flawed stays (if any was new and known).
ORACLE["encounters_run_ledger"] = with_shapes("""
WITH r AS (SELECT *, unnest([0, 1]) AS run FROM encounter_run),
q AS (SELECT *, run = 0 AND flawed > 0 AS bad, IF(run = 1 AND flawed = 0, 0, added) AS loaded,
             IF(run = 1 AND flawed = 0, 0, inserted + expired) AS moved FROM r)
SELECT 'encounters-' || run AS run_id, 'encounters_daily' AS pipeline_name, IF(bad, 'FAILED', 'SUCCESS') AS status,
       CAST(landed + loaded + moved + IF(bad, 7, 9) AS BIGINT) AS total_rows,
       '[{"step":"stage_load","status":"SUCCESS","rows":' || landed || '},{"step":"transform_encounters","status":"SUCCESS","rows":'
       || loaded || '},{"step":"transform_patients_scd2","status":"SUCCESS","rows":' || moved
       || '},{"step":"quality_gate","status":"' || IF(bad, 'FAILED","rows":7}]', 'SUCCESS","rows":7},{"step":"publish","status":"SUCCESS","rows":2}]')
         AS run_summary,
       IF(bad, 'quality_gate', NULL) AS failed_step, IF(bad, 'Run encounters-0 complete. FAILs: 1', NULL) AS error_message
FROM q""", "encounter_run")

ORACLE["encounters_run_tables"] = with_shapes("""
SELECT run, table_name, CAST(n AS BIGINT) AS n FROM (
  SELECT 0 AS run, unnest([{'t': 'fact_encounter', 'n': fact_rows + IF(flawed > 0, 0, added)},
                           {'t': 'dim_patient', 'n': dim_rows + IF(flawed > 0, 0, inserted)},
                           {'t': 'encounter_rejects', 'n': IF(flawed > 0, NULL, lost)}], recursive := true) FROM encounter_run
  UNION ALL
  SELECT 1, unnest([{'t': 'fact_encounter', 'n': fact_rows + added}, {'t': 'dim_patient', 'n': dim_rows + inserted},
                    {'t': 'encounter_rejects', 'n': lost}], recursive := true) FROM encounter_run) AS x(run, table_name, n)
WHERE n IS NOT NULL""", "encounter_run")

# ── message bundles ──────────────────────────────────────────────────────
shape("sent", ["fact_encounter", "patient_attrs"])("""
SELECT e.*, p.* EXCLUDE (patient_key), 'B' || encounter_key AS bundle_id, encounter_key % 43 = 0 AS lost
FROM fact_encounter e JOIN patient_attrs p USING (patient_key)""")

ORACLE["fhir_patients"] = with_shapes("""
SELECT patient_id, last_name AS family_name, first_name AS given_name, gender, date_of_birth AS birth_date,
       zip_code AS postal_code, COUNT(*) AS times_sent
FROM sent WHERE NOT lost AND encounter_key % 37 > 0 GROUP BY ALL""", "sent")

ORACLE["fhir_encounters"] = with_shapes("""
SELECT bundle_id, encounter_id, 'Patient/' || patient_id AS patient_ref, encounter_type AS class_code, admit_date,
       discharge_date, npi AS provider_npi, IF(encounter_key % 50 = 0, 'Expired', 'Home') AS disposition
FROM sent JOIN dim_provider ON provider_key = attending_provider_key WHERE NOT lost AND encounter_key % 41 > 0""",
                                        "sent", "dim_provider")

ORACLE["fhir_claims"] = with_shapes("""
SELECT bundle_id, 'C' || encounter_key AS claim_id, 'Patient/' || patient_id AS patient_ref,
       'Encounter/' || encounter_id AS encounter_ref,
       CAST((SELECT SUM(billed_amount) FROM claim_lines_all c WHERE c.encounter_key = s.encounter_key) AS DECIMAL(14,2)) AS total_billed
FROM sent s WHERE NOT lost""", "sent", "claim_lines_all")

ORACLE["fhir_claim_lines"] = with_shapes("""
SELECT 'B' || encounter_key AS bundle_id, claim_id, claim_line_number AS line_number, 'CPT' || procedure_key AS procedure_code,
       service_date, units_of_service AS quantity, billed_amount AS net_amount
FROM claim_lines_all WHERE encounter_key % 43 > 0 AND NOT (claim_line_number = 3 AND encounter_key % 11 = 0)""",
                                         "claim_lines_all")

ORACLE["fhir_rejects"] = with_shapes("""
SELECT IF(lost, NULL, bundle_id) AS bundle_id, IF(lost, 0, r.pos) AS pos, NULL::VARCHAR AS claim_id, r.reason FROM (
  SELECT *, unnest(IF(lost, [{'pos': 0, 'hit': TRUE, 'reason': 'malformed_json'}], [
    {'pos': 0, 'hit': encounter_key % 37 = 0, 'reason': 'missing_id'},
    {'pos': 1, 'hit': encounter_key % 41 = 0, 'reason': 'bad_field:admit_date'},
    {'pos': 3, 'hit': encounter_key % 31 = 0, 'reason': 'unknown_type'},
    {'pos': 3 + (encounter_key % 31 = 0)::INT, 'hit': encounter_key % 29 = 0, 'reason': 'no_resource'}])) AS r FROM sent)
WHERE r.hit
UNION ALL
SELECT 'B' || encounter_key, NULL, claim_id, 'bad_field:quantity' FROM claim_lines_all
WHERE encounter_key % 43 > 0 AND claim_line_number = 3 AND encounter_key % 11 = 0""", "sent", "claim_lines_all")

ORACLE["user_activity_stream"] = ORACLE["user_activity"]

ORACLE["encounter_readmit_flag"] = with_shapes("""
WITH ranked AS (
  SELECT encounter_id, discharge_date, LEAD(admit_date) OVER w AS next_admit_date,
         LEAD(encounter_type) OVER w AS next_encounter_type
  FROM fact_encounter WHERE encounter_type = 'IP'
  WINDOW w AS (PARTITION BY patient_key ORDER BY admit_date, encounter_id)),
flags AS (SELECT encounter_id, next_admit_date IS NOT NULL AND next_encounter_type = 'IP'
                 AND date_diff('day', discharge_date, next_admit_date) <= 30 AS f FROM ranked)
SELECT fe.encounter_id, fe.encounter_type, fe.admit_date, COALESCE(flags.f, FALSE) AS is_30day_readmit
FROM fact_encounter fe LEFT JOIN flags USING (encounter_id)""", "fact_encounter")

ORACLE["facility_dimension"] = """
SELECT n_name || ' General' AS facility_name, 'Hospital' AS facility_type, n_name AS address_city,
       r_name AS address_state, COUNT(*) AS provider_count, TRUE AS keys_dense
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY 1, 2, 3, 4"""
