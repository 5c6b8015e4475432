"""DuckDB text of the load over files: the same defects planted, audited and cleaned in SQL."""

from __future__ import annotations

from ledgerlens.oracle.extended import FIRST_ORDER, STATUSES, TXN_COLS, W
from ledgerlens.plans.loading import DEFECTS, MODULUS
from ledgerlens.plans.quality import AUDIT_CHECKS, CLEAN_STEPS

_D = DEFECTS
_TIME = "'%Y-%m-%d %H:%M:%S'"
_COLS = ", ".join(TXN_COLS)
CTES = f"""
marked AS (
  SELECT transaction_id, CAST(customer_id AS VARCHAR) AS customer_id, CAST(merchant_id AS VARCHAR) AS merchant_id,
         CAST(bank_id AS VARCHAR) AS bank_id, device_id, CAST(amount AS VARCHAR) AS amount, status, failure_reason, payment_mode,
         txn_timestamp AS ts, (customer_id + merchant_id) % {MODULUS} AS k
  FROM txn_a),
with_defects AS (
  SELECT transaction_id, CASE WHEN k <> {_D['no_customer']} THEN customer_id END AS customer_id, merchant_id, bank_id, device_id,
         CASE k WHEN {_D['bad_amount']} THEN 'oops' WHEN {_D['negative_amount']} THEN '-' || amount WHEN {_D['no_amount']} THEN NULL
                WHEN {_D['blanks_around_amount']} THEN ' ' || amount || ' ' ELSE amount END AS amount,
         CASE k WHEN {_D['unknown_status']} THEN 'UNKNOWN' WHEN {_D['lower_case_status']} THEN ' ' || lower(status) || ' ' ELSE status END AS status,
         CASE k WHEN {_D['reason_without_failure']} THEN 'PLANTED' ELSE failure_reason END AS failure_reason, payment_mode,
         CASE k WHEN {_D['bad_timestamp']} THEN 'not a date' WHEN {_D['no_timestamp']} THEN NULL ELSE strftime(ts, {_TIME}) END AS txn_timestamp,
         k, strftime(ts + INTERVAL 1 DAY, {_TIME}) AS later
  FROM marked),
raw AS (
  SELECT {_COLS} FROM with_defects
  UNION ALL SELECT {_COLS} FROM with_defects WHERE k = {_D['copy']}
  UNION ALL SELECT {_COLS} FROM (SELECT * REPLACE ('1.00' AS amount, later AS txn_timestamp) FROM with_defects WHERE k = {_D['same_id_later']})),
raw_first AS (
  SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {', '.join(f'{c} NULLS FIRST' for c in FIRST_ORDER)}) = 1),
raw_typed AS (
  SELECT * REPLACE (TRY_CAST(trim(amount) AS DECIMAL(18,2)) AS amount, trim(upper(status)) AS status, TRY_CAST(txn_timestamp AS TIMESTAMP) AS txn_timestamp)
  FROM raw_first),
raw_tagged AS (
  SELECT *, CASE WHEN txn_timestamp IS NULL THEN 'dropped_bad_timestamps' WHEN amount IS NULL OR amount <= 0 THEN 'dropped_bad_amounts'
                 WHEN status IS NULL OR status NOT IN ({STATUSES}) THEN 'dropped_bad_status' END AS rule
  FROM raw_typed),
loaded AS (SELECT {_COLS} FROM raw_tagged WHERE rule IS NULL),
loaded_fact AS (
  SELECT l.*, strftime(l.txn_timestamp, '%Y-%m') AS ym, c.customer_id AS known_customer, b.bank_type,
         CASE WHEN l.status = 'SUCCESS' THEN ROUND(l.amount * m.commission_rate, 2) ELSE CAST(0 AS DECIMAL(18,2)) END AS revenue,
         m.merchant_id IS NOT NULL AND c.customer_id IS NOT NULL AND b.bank_id IS NOT NULL AS complete
  FROM loaded l
  LEFT JOIN dim_merchants m ON CAST(m.merchant_id AS VARCHAR) = l.merchant_id
  LEFT JOIN dim_customers c ON CAST(c.customer_id AS VARCHAR) = l.customer_id
  LEFT JOIN dim_banks b ON CAST(b.bank_id AS VARCHAR) = l.bank_id)
"""


def build() -> dict[str, str]:
    q = {}
    counts = {
        "rows": "SELECT COUNT(*) FROM raw",
        "duplicate_txn_ids": "SELECT COUNT(*) - COUNT(DISTINCT transaction_id) FROM raw",
        "full_duplicate_rows": f"SELECT (SELECT COUNT(*) FROM raw) - COUNT(*) FROM (SELECT DISTINCT {_COLS} FROM raw)",
        "missing_customer_id": "SELECT COUNT(*) FROM raw WHERE customer_id IS NULL",
        "missing_amount": "SELECT COUNT(*) FROM raw WHERE amount IS NULL",
        "non_positive_amount": "SELECT COUNT(*) FROM raw WHERE TRY_CAST(trim(amount) AS DOUBLE) <= 0",
        "invalid_timestamps": "SELECT COUNT(*) FROM raw WHERE TRY_CAST(txn_timestamp AS TIMESTAMP) IS NULL",
        "invalid_status": f"SELECT COUNT(*) FROM raw WHERE status IS NULL OR status NOT IN ({STATUSES})",
        "reason_without_failure": "SELECT COUNT(*) FROM raw WHERE status IS DISTINCT FROM 'FAILED' AND failure_reason IS NOT NULL",
        "failure_without_reason": "SELECT COUNT(*) FROM raw WHERE status = 'FAILED' AND failure_reason IS NULL",
    }
    q["s1_raw_audit"] = W("\nUNION ALL ".join(f"SELECT '{k}' AS \"check\", CAST(({counts[k]}) AS BIGINT) AS value" for k in AUDIT_CHECKS), CTES)
    steps = ", ".join(f"({i}, '{s}')" for i, s in enumerate(CLEAN_STEPS))
    q["s1_raw_cleaning"] = W(f"""
SELECT CAST(s.step AS INTEGER) AS step, s.action, CAST(COALESCE(c.n, 0) AS BIGINT) AS rows_dropped
FROM (VALUES {steps}) s(step, action)
LEFT JOIN (SELECT '{CLEAN_STEPS[0]}' AS a, (SELECT COUNT(*) FROM raw) - (SELECT COUNT(*) FROM raw_first) AS n
           UNION ALL SELECT rule, COUNT(*) FROM raw_tagged WHERE rule IS NOT NULL GROUP BY rule) c ON c.a = s.action""", CTES)
    tables = {"banks": ("dim_banks", "bank_id"), "devices": ("dim_devices", "device_id"), "merchants": ("dim_merchants", "merchant_id"),
              "campaigns": ("dim_campaigns", "campaign_id"), "customers": ("dim_customers", "customer_id"),
              "transactions": ("loaded", "transaction_id"), "cashback": ("cashback", "cashback_id")}
    q["s2_loaded_tables"] = W("\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST(COUNT(*) AS BIGINT) AS n, CAST(COUNT(DISTINCT {key}) AS BIGINT) AS ids, TRUE AS typed FROM {src}"
        for name, (src, key) in tables.items()), CTES)
    q["s4_feature_files"] = W(f"""
SELECT 'transactions_features' AS file, ym AS month, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(revenue) AS DOUBLE) AS revenue,
       strftime(MIN(txn_timestamp), {_TIME}) AS first_txn, strftime(MAX(txn_timestamp), {_TIME}) AS last_txn
FROM loaded_fact GROUP BY ym
UNION ALL
SELECT 'customer_features', NULL, CAST(COUNT(DISTINCT customer_id) + MAX(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END) AS BIGINT), CAST(SUM(revenue) AS DOUBLE), NULL, NULL
FROM loaded_fact""", CTES)
    dims = "\n".join(f"UNION ALL SELECT 'dim_{k}', CAST(COUNT(*) AS BIGINT), NULL FROM dim_{k}" for k in ("customers", "merchants", "banks", "devices"))
    q["s5_star_files"] = W(f"""
SELECT 'fact_transactions' AS file, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(revenue) AS DOUBLE) AS revenue FROM loaded_fact WHERE complete
UNION ALL SELECT 'dim_date', CAST(date_diff('day', MIN(txn_timestamp), MAX(txn_timestamp)) + 1 AS BIGINT), NULL FROM loaded
{dims}""", CTES)
    q["s6_view_answer"] = W(f"""
SELECT txn_year_month, bank_type, n, total_txns, gpv
FROM (SELECT ym AS txn_year_month, bank_type, CAST(COUNT(*) AS BIGINT) AS n FROM loaded_fact WHERE complete GROUP BY ALL)
JOIN (SELECT ym AS txn_year_month, CAST(COUNT(*) AS BIGINT) AS total_txns, CAST(SUM(CASE WHEN status = 'SUCCESS' THEN amount ELSE 0 END) AS DOUBLE) AS gpv
      FROM loaded_fact WHERE complete GROUP BY ALL) USING (txn_year_month)""", CTES)
    return q
