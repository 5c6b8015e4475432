"""DuckDB text of the adapter (as CTEs) and of the exact-rounding helpers.

The driver registers the source tables as views; every oracle query starts
with these CTEs so the payments tables are derived the same way as on Spark.
"""

from __future__ import annotations

from ledgerlens.sources.adapter import (AGE_BASE, AGE_SPAN, CAMPAIGN_ROWS, CITIES_PER_STATE,
                                        COMMISSION_BY_CATEGORY, DEVICE_VERSIONS,
                                        MERCHANT_CITIES_PER_STATE, MERCHANT_STATES,
                                        NO_DEVICE_LINENUMBER, REGISTRATION_EPOCH,
                                        REGISTRATION_SPAN, REGISTRATION_STEP, RETURNFLAG_STATUS)


def R(num: str, den: str, digits: int = 2, scale: int = 1) -> str:
    """ROUND(scale * num / den, digits) half away from zero, exact, as DOUBLE."""
    a = f"CAST(CAST(({num}) AS DECIMAL(38,6)) * 1000000 AS HUGEINT)"
    b = f"CAST(CAST(({den}) AS DECIMAL(38,6)) * 1000000 AS HUGEINT)"
    f = scale * 10 ** digits
    return (f"(CASE WHEN {b} = 0 THEN NULL ELSE CAST((CASE WHEN ({a} < 0) <> ({b} < 0) THEN -1 ELSE 1 END)"
            f" * ((2 * abs({a}) * {f} + abs({b})) // (2 * abs({b}))) AS DOUBLE) / {10 ** digits} END)")


def M(x: str, digits: int = 0) -> str:
    """ROUND of an exact decimal, as DOUBLE."""
    return f"CAST(ROUND({x}, {digits}) AS DOUBLE)"


def PCT_TOTAL(x: str, digits: int = 2) -> str:
    return R(x, f"SUM({x}) OVER ()", digits, 100)


SUMS = "SUM(CASE WHEN status = 'SUCCESS' THEN amount END)"
CNTS = "COUNT(CASE WHEN status = 'SUCCESS' THEN amount END)"
FAILED = "COUNT(CASE WHEN status = 'FAILED' THEN 1 END)"

_commission = " ".join(f"WHEN '{k}' THEN {v}" for k, v in COMMISSION_BY_CATEGORY)
_status = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in RETURNFLAG_STATUS)
_failed_flag = [k for k, v in RETURNFLAG_STATUS if v == "FAILED"][0]


def _campaign_values() -> str:
    rows = []
    for cid, name, cat, s, e, rate, cap, attach in CAMPAIGN_ROWS:
        rows.append(f"('{cid}', '{name}', '{cat}', DATE '{s}', DATE '{e}', CAST({rate} AS DECIMAL(6,4)), "
                    f"CAST({cap} AS DECIMAL(18,2)), CAST({attach} AS DOUBLE))")
    return ",\n    ".join(rows)


ADAPTER = f"""
n_sup AS (SELECT count(*) AS n FROM supplier),
n_part AS (SELECT count(*) AS n FROM part),
dim_customers AS (
  SELECT c.c_custkey AS customer_id, c.c_name AS customer_name,
         CAST({AGE_BASE} + c.c_custkey % {AGE_SPAN} AS INTEGER) AS age,
         c.c_mktsegment AS gender,
         concat_ws('_', n.n_name, CAST(c.c_custkey % {CITIES_PER_STATE} AS VARCHAR)) AS city,
         n.n_name AS state,
         CAST(DATE '{REGISTRATION_EPOCH.isoformat()}' + CAST((c.c_custkey * {REGISTRATION_STEP}) % {REGISTRATION_SPAN} AS INTEGER) AS DATE) AS registration_date,
         c.c_custkey % (SELECT n FROM n_sup) AS primary_bank_id,
         CASE WHEN c.c_custkey % {DEVICE_VERSIONS} + 1 = {NO_DEVICE_LINENUMBER} THEN NULL
              ELSE concat_ws('-', CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'O' END,
                             CAST(c.c_custkey % {DEVICE_VERSIONS} + 1 AS VARCHAR)) END AS device_id
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
dim_merchants AS (
  SELECT p_partkey AS merchant_id, p_name AS merchant_name, p_type AS category,
         concat_ws('_', 'NATION_' || CAST(p_partkey % {MERCHANT_STATES} AS VARCHAR),
                   CAST(p_partkey % {MERCHANT_CITIES_PER_STATE} AS VARCHAR)) AS city,
         'NATION_' || CAST(p_partkey % {MERCHANT_STATES} AS VARCHAR) AS state,
         CAST(CASE p_type {_commission} END AS DECIMAL(6,4)) AS commission_rate,
         p_retailprice AS popularity
  FROM part),
dim_banks AS (
  SELECT s_suppkey AS bank_id, s_name AS bank_name, r_name AS bank_type, s_acctbal AS market_share,
         CAST(0.05 + (s_suppkey % 10) * 0.01 AS DOUBLE) AS base_failure_rate
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
dim_devices AS (
  SELECT s || '-' || CAST(v AS VARCHAR) AS device_id,
         CASE s WHEN 'F' THEN 'Android' WHEN 'O' THEN 'iOS' END AS os_name,
         CAST(v AS VARCHAR) AS os_version, CAST(NULL AS VARCHAR) AS device_model
  FROM (SELECT CASE WHEN i < {DEVICE_VERSIONS} THEN 'F' ELSE 'O' END AS s,
               CAST(i % {DEVICE_VERSIONS} + 1 AS INTEGER) AS v FROM range({2 * DEVICE_VERSIONS}) t(i))),
dim_campaigns AS (
  SELECT * FROM (VALUES
    {_campaign_values()}
  ) t(campaign_id, campaign_name, target_category, start_date, end_date, cashback_rate, max_cashback, attach_rate)),
txn_a AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
         o_custkey AS customer_id, l_partkey AS merchant_id, l_suppkey AS bank_id,
         CASE WHEN l_linenumber = {NO_DEVICE_LINENUMBER} THEN NULL
              ELSE l_linestatus || '-' || CAST(l_linenumber AS VARCHAR) END AS device_id,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         CASE l_returnflag {_status} END AS status,
         CASE WHEN l_returnflag = '{_failed_flag}' THEN o_orderpriority END AS failure_reason,
         o_orderstatus AS payment_mode,
         CAST(l_shipdate AS TIMESTAMP) AS txn_timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
txn_b AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, user_id AS customer_id,
         event_id % (SELECT n FROM n_part) AS merchant_id,
         event_id % (SELECT n FROM n_sup) AS bank_id,
         CASE WHEN event_id % 7 + 1 = {NO_DEVICE_LINENUMBER} THEN NULL
              ELSE (CASE WHEN event_id % 2 = 0 THEN 'F' ELSE 'O' END) || '-' || CAST(event_id % 7 + 1 AS VARCHAR) END AS device_id,
         CAST(value AS DECIMAL(18,2)) AS amount,
         CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_type = 'signup' THEN 'PENDING' ELSE 'SUCCESS' END AS status,
         CASE WHEN event_type = 'error'
              THEN CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS VARCHAR) END AS failure_reason,
         event_type AS payment_mode,
         CAST(ts AS TIMESTAMP) AS txn_timestamp
  FROM events),
{{enriched}}
"""


def _enriched(name: str, txn: str) -> str:
    return f"""{name} AS (
  SELECT t.transaction_id, t.txn_timestamp, CAST(t.txn_timestamp AS DATE) AS txn_date,
         CAST(year(t.txn_timestamp) AS INTEGER) AS txn_year, CAST(month(t.txn_timestamp) AS INTEGER) AS txn_month,
         strftime(t.txn_timestamp, '%Y-%m') AS txn_year_month,
         CAST(hour(t.txn_timestamp) AS INTEGER) AS txn_hour,
         CAST(dayofweek(t.txn_timestamp) AS INTEGER) AS txn_dow,
         CASE WHEN dayofweek(t.txn_timestamp) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
         t.amount, t.status, CASE WHEN t.status = 'SUCCESS' THEN 1 ELSE 0 END AS is_success,
         t.failure_reason, t.payment_mode,
         CASE WHEN t.status = 'SUCCESS' THEN ROUND(t.amount * m.commission_rate, 2) ELSE CAST(0 AS DECIMAL(18,2)) END AS revenue,
         t.customer_id, c.state AS customer_state, c.city AS customer_city, c.gender AS customer_gender,
         c.age AS customer_age, t.merchant_id, m.merchant_name, m.category AS merchant_category,
         m.commission_rate, t.bank_id, b.bank_name, b.bank_type, t.device_id, d.os_name, d.os_version
  FROM {txn} t
  JOIN dim_customers c ON c.customer_id = t.customer_id
  JOIN dim_merchants m ON m.merchant_id = t.merchant_id
  JOIN dim_banks b ON b.bank_id = t.bank_id
  LEFT JOIN dim_devices d ON d.device_id = t.device_id)"""


CTES = ADAPTER.replace("{enriched}", _enriched("enr_a", "txn_a") + ",\n" + _enriched("enr_b", "txn_b"))


def with_adapter(body: str, extra_ctes: str = "") -> str:
    """Full oracle text: adapter CTEs (+ query CTEs) followed by the final SELECT."""
    ctes = CTES.rstrip().rstrip(",")
    if extra_ctes:
        ctes = ctes + ",\n" + extra_ctes.strip().rstrip(",")
    return f"WITH {ctes}\n{body.strip()}"
