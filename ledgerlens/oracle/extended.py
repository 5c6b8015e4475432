"""DuckDB oracle text for views V3/V4, quality, features, measures, visuals,
statistics (statistic parts only; p-values are not SQL) and cashback."""

from __future__ import annotations

from ledgerlens.functions import exprs as X
from ledgerlens.functions.dist import norm_ppf
from ledgerlens.oracle.base import CNTS, M, R, SUMS, with_adapter
from ledgerlens.plans.quality import AUDIT_CHECKS, CLEAN_STEPS
from ledgerlens.plans.stats import N12_FEATURES, T10_FEATURES
from ledgerlens.sources.schemas import FOREIGN_KEYS

STATUSES = ", ".join(f"'{s}'" for s in X.VALID_STATUSES)
TXN_COLS = ("transaction_id", "customer_id", "merchant_id", "bank_id", "device_id", "amount", "status",
            "failure_reason", "payment_mode", "txn_timestamp")
FIRST_ORDER = ("txn_timestamp", "merchant_id", "bank_id", "amount", "customer_id", "device_id", "status",
               "failure_reason", "payment_mode")


def _pandas_band(edges) -> str:
    labels = X.pandas_band_labels(edges)
    parts = " ".join(f"WHEN amount <= {e} THEN '{lab}'" for e, lab in zip(edges, labels))
    return f"CASE WHEN amount <= 0 THEN NULL {parts} ELSE '{labels[-1]}' END"


def _daypart() -> str:
    parts = " ".join(f"WHEN txn_hour <= {u} THEN '{lab}'" for lab, u in X.DAYPARTS)
    return f"CASE {parts} END"


def _segment() -> str:
    return ("CASE WHEN r_score >= 4 AND f_score >= 4 THEN 'Champions' "
            "WHEN r_score >= 4 AND f_score < 4 THEN 'Promising / New' "
            "WHEN r_score <= 2 AND f_score >= 4 THEN 'At Risk (was loyal)' "
            "WHEN r_score <= 2 AND f_score < 3 THEN 'Hibernating / Churned' ELSE 'Needs Attention' END")


def _days(a: str, b: str) -> str:
    """Whole days from a to b, floored (timedelta.days)."""
    return f"CAST(floor(date_diff('microsecond', {a}, {b}) / 86400000000.0) AS BIGINT)"


def _qcut(key: str, k: int = 5) -> str:
    r = f"ROW_NUMBER() OVER (ORDER BY {key}, customer_id)"
    n = "COUNT(*) OVER ()"
    return (f"(CASE WHEN {n} <= 1 THEN 1 ELSE GREATEST(1, ({k} * ({r} - 1) + ({n} - 1) - 1) // ({n} - 1)) END)")


ORDER_FIRST = ", ".join(f"{c} NULLS FIRST" for c in FIRST_ORDER)

FEATURE_CTES = f"""
dedup AS (
  SELECT {', '.join(TXN_COLS)} FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY {ORDER_FIRST}) AS rn FROM txn_a)
  WHERE rn = 1),
tagged AS (
  SELECT transaction_id, customer_id, merchant_id, bank_id, device_id, amount, trim(upper(status)) AS status,
         failure_reason, payment_mode, txn_timestamp, txn_timestamp AS txn_dt,
         CASE WHEN txn_timestamp IS NULL THEN 'dropped_bad_timestamps'
              WHEN amount IS NULL OR amount <= 0 THEN 'dropped_bad_amounts'
              WHEN trim(upper(status)) IS NULL OR trim(upper(status)) NOT IN ({STATUSES}) THEN 'dropped_bad_status'
         END AS rule
  FROM dedup),
clean AS (SELECT * EXCLUDE (rule) FROM tagged WHERE rule IS NULL),
frame AS (
  SELECT t.*, m.merchant_name, m.category AS merchant_category, m.commission_rate, m.state AS merchant_state,
         m.city AS merchant_city, c.age, c.gender, c.state AS customer_state, c.city AS customer_city,
         c.registration_date, b.bank_name, b.bank_type, d.os_name, d.os_version
  FROM clean t
  LEFT JOIN dim_merchants m ON m.merchant_id = t.merchant_id
  LEFT JOIN dim_customers c ON c.customer_id = t.customer_id
  LEFT JOIN dim_banks b ON b.bank_id = t.bank_id
  LEFT JOIN dim_devices d ON d.device_id = t.device_id),
tf0 AS (
  SELECT *, CAST(hour(txn_dt) AS INTEGER) AS txn_hour, CAST(day(txn_dt) AS INTEGER) AS txn_day,
         CAST(month(txn_dt) AS INTEGER) AS txn_month, CAST(year(txn_dt) AS INTEGER) AS txn_year,
         strftime(txn_dt, '%Y-%m') AS txn_year_month, CAST(isodow(txn_dt) - 1 AS INTEGER) AS txn_dow,
         dayname(txn_dt) AS txn_day_name,
         CASE WHEN isodow(txn_dt) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END AS is_success,
         CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END AS is_failed,
         CASE WHEN status = 'SUCCESS' THEN ROUND(amount * commission_rate, 2) ELSE CAST(0 AS DECIMAL(18,2)) END AS revenue,
         CASE WHEN CAST(amount AS DOUBLE) >= (SELECT quantile_cont(CAST(amount AS DOUBLE), 0.9) FROM frame)
              THEN 1 ELSE 0 END AS high_value_flag,
         {_pandas_band(X.PANDAS_BAND_EDGES)} AS ticket_band
  FROM frame),
tfeat AS (SELECT *, {_daypart()} AS daypart FROM tf0),
cbase AS (
  SELECT customer_id, COUNT(*) AS n_txns, SUM(is_success) AS n_success, SUM(is_failed) AS n_failed,
         MIN(txn_dt) AS first_txn, MAX(txn_dt) AS last_txn, COUNT(DISTINCT merchant_id) AS distinct_merchants,
         SUM(high_value_flag) AS high_value_txns,
         SUM(CASE WHEN is_success = 1 THEN amount END) AS spend,
         COUNT(CASE WHEN is_success = 1 THEN amount END) AS nspend,
         SUM(revenue) AS revenue_contributed
  FROM tfeat GROUP BY customer_id),
cf0 AS (
  SELECT b.customer_id, CAST(b.n_txns AS BIGINT) AS n_txns, CAST(b.n_success AS BIGINT) AS n_success,
         CAST(b.n_failed AS BIGINT) AS n_failed, b.first_txn, b.last_txn,
         CAST(b.distinct_merchants AS BIGINT) AS distinct_merchants, CAST(b.high_value_txns AS BIGINT) AS high_value_txns,
         COALESCE(b.spend, 0) AS lifetime_spend,
         COALESCE(CAST(b.spend AS DOUBLE) / CAST(NULLIF(b.nspend, 0) AS DOUBLE), 0.0) AS avg_ticket,
         b.revenue_contributed,
         round_even(CAST(b.n_success AS DOUBLE) * 10000 / b.n_txns, 0) / 10000 AS success_rate,
         round_even(CAST(b.high_value_txns AS DOUBLE) * 10000 / b.n_txns, 0) / 10000 AS high_value_share,
         {_days('b.last_txn', '(SELECT MAX(txn_dt) FROM tfeat)')} AS recency_days,
         {_days('b.first_txn', 'b.last_txn')} AS active_lifespan_days,
         CASE WHEN {_days('b.last_txn', '(SELECT MAX(txn_dt) FROM tfeat)')} > {X.INACTIVE_DAYS} THEN 1 ELSE 0 END AS is_inactive,
         c.registration_date,
         {_days('CAST(c.registration_date AS TIMESTAMP)', '(SELECT MAX(txn_dt) FROM tfeat)')} AS tenure_days,
         c.age, c.gender, c.state
  FROM cbase b LEFT JOIN dim_customers c ON c.customer_id = b.customer_id),
cf1 AS (
  SELECT *, CAST(6 - {_qcut('recency_days')} AS INTEGER) AS r_score,
         CAST({_qcut('n_txns')} AS INTEGER) AS f_score,
         CAST({_qcut('lifetime_spend')} AS INTEGER) AS m_score
  FROM cf0),
cfeat AS (SELECT *, {_segment()} AS segment FROM cf1),
elig AS (
  SELECT t.transaction_id, t.amount, t.txn_timestamp, c.campaign_id, c.cashback_rate, c.max_cashback, c.attach_rate
  FROM clean t JOIN dim_merchants m ON m.merchant_id = t.merchant_id
  JOIN dim_campaigns c ON m.category = c.target_category
   AND t.txn_timestamp >= CAST(c.start_date AS TIMESTAMP)
   AND t.txn_timestamp < CAST(c.end_date + 1 AS TIMESTAMP)
  WHERE t.status = 'SUCCESS'),
cashback AS (
  SELECT campaign_id || ':' || transaction_id AS cashback_id, transaction_id, campaign_id,
         CAST(LEAST(ROUND(amount * cashback_rate, 2), max_cashback) AS DECIMAL(18,2)) AS cashback_amount,
         CAST(txn_timestamp AS DATE) AS cashback_date
  FROM elig
  WHERE CAST(('0x' || substr(md5(campaign_id || ':' || transaction_id), 1, 8)) AS BIGINT) % 10000
        < ROUND(attach_rate * 10000))
"""


def W(body: str, extra: str = "") -> str:
    ctes = FEATURE_CTES.strip().rstrip(",")
    if extra:
        ctes = ctes + ",\n" + extra.strip().rstrip(",")
    return with_adapter(body, ctes)


def _dbl(cols, decimals=()) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in decimals else c for c in cols)


def _hist(values_sql: str, bins: int) -> str:
    """Histogram query over a CTE-like subquery yielding column v (double)."""
    return f"""
SELECT bin, ROUND(lo + (bin - 1) * ((hi - lo) / {bins}.0), 6) AS bin_start,
       ROUND(lo + bin * ((hi - lo) / {bins}.0), 6) AS bin_end, CAST(COUNT(*) AS BIGINT) AS count
FROM (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE LEAST(FLOOR((v - lo) * CAST({bins} AS DOUBLE) / (hi - lo)) + 1, {bins}) END AS INTEGER) AS bin, lo, hi
      FROM (SELECT v, MIN(v) OVER () AS lo, MAX(v) OVER () AS hi FROM ({values_sql}) WHERE v IS NOT NULL))
GROUP BY bin, lo, hi ORDER BY bin"""


def _describe(src: str) -> str:
    x = "CAST(amount AS DOUBLE)"
    return f"""
SELECT CAST(COUNT(*) AS BIGINT) AS count, {R('SUM(amount)', 'COUNT(*)', 6)} AS mean,
       ROUND(stddev_samp({x}), 6) AS std, CAST(MIN(amount) AS DOUBLE) AS min,
       ROUND(quantile_cont({x}, 0.25), 6) AS q25, ROUND(quantile_cont({x}, 0.5), 6) AS q50,
       ROUND(quantile_cont({x}, 0.75), 6) AS q75, CAST(MAX(amount) AS DOUBLE) AS max
FROM {src}"""


def _corr(features, dropna: bool) -> str:
    src = "cfeat"
    if dropna:
        src = "(SELECT * FROM cfeat WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in features) + ")"
    parts = []
    for a in features:
        for b in features:
            if a == b:
                parts.append(f"SELECT '{a}' AS x, '{b}' AS y, 1.0::DOUBLE AS r")
            else:
                parts.append(f"SELECT '{a}' AS x, '{b}' AS y, "
                             f"ROUND(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS r FROM {src}")
    return "\nUNION ALL ".join(parts)


def _filliben(points: int = 99):
    m = [0.0] * points
    m[-1] = 0.5 ** (1.0 / points)
    m[0] = 1 - m[-1]
    for i in range(2, points):
        m[i - 1] = (i - 0.3175) / (points + 0.365)
    return m


def build(edges_a=(5000, 15000, 30000, 60000, 90000), slicers=None, slicers_b=None, drill_merchant=7,
          reasons=(), categories=()) -> dict[str, str]:
    q: dict[str, str] = {}
    dec_txn = ("amount",)
    # ---------------- views
    q["v3_analysis_frame"] = W(f"SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, "
                               f"CAST(commission_rate AS DOUBLE) AS commission_rate) FROM frame")
    q["v4_dim_date"] = with_adapter("""
SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, strftime(d, '%b') AS month_name, strftime(d, '%Y-%m') AS year_month,
       CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week, strftime(d, '%a') AS day_name,
       CAST(weekofyear(d) AS INTEGER) AS week_of_year, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend
FROM generate_series((SELECT CAST(MIN(txn_timestamp) AS DATE) FROM txn_a),
                     (SELECT CAST(MAX(txn_timestamp) AS DATE) FROM txn_a), INTERVAL 1 DAY) g(d)""")
    # ---------------- quality
    full_cols = ", ".join(TXN_COLS)
    audit_rows = {
        "rows": "SELECT COUNT(*) FROM txn_a",
        "duplicate_txn_ids": "SELECT COALESCE(SUM(c - 1), 0) FROM (SELECT COUNT(*) AS c FROM txn_a GROUP BY transaction_id)",
        "full_duplicate_rows": f"SELECT COALESCE(SUM(c - 1), 0) FROM (SELECT COUNT(*) AS c FROM txn_a GROUP BY {full_cols})",
        "missing_customer_id": "SELECT COUNT(*) FROM txn_a WHERE customer_id IS NULL",
        "missing_amount": "SELECT COUNT(*) FROM txn_a WHERE amount IS NULL",
        "non_positive_amount": "SELECT COUNT(*) FROM txn_a WHERE amount <= 0",
        "invalid_timestamps": "SELECT COUNT(*) FROM txn_a WHERE txn_timestamp IS NULL",
        "invalid_status": f"SELECT COUNT(*) FROM txn_a WHERE status IS NULL OR status NOT IN ({STATUSES})",
        "reason_without_failure": "SELECT COUNT(*) FROM txn_a WHERE (status IS NULL OR status <> 'FAILED') AND failure_reason IS NOT NULL",
        "failure_without_reason": "SELECT COUNT(*) FROM txn_a WHERE status = 'FAILED' AND failure_reason IS NULL",
    }
    audit = "\nUNION ALL ".join(f"SELECT '{k}' AS \"check\", CAST(({audit_rows[k]}) AS BIGINT) AS value"
                                for k in AUDIT_CHECKS)
    q["c1_quality_audit"] = W(audit)
    q["c2_dedupe_first"] = W(f"SELECT {_dbl(TXN_COLS, dec_txn)} FROM dedup")
    steps = ", ".join(f"({i}, '{s}')" for i, s in enumerate(CLEAN_STEPS))
    q["c6_cleaning_actions"] = W(f"""
SELECT CAST(s.step AS INTEGER) AS step, s.action, CAST(COALESCE(c.n, 0) AS BIGINT) AS rows_dropped
FROM (VALUES {steps}) s(step, action)
LEFT JOIN (SELECT 'dropped_duplicate_ids' AS a, (SELECT COUNT(*) FROM txn_a) - (SELECT COUNT(*) FROM dedup) AS n
           UNION ALL SELECT rule, COUNT(*) FROM tagged WHERE rule IS NOT NULL GROUP BY rule) c ON c.a = s.action""")
    q["c7_audit_issues"] = W(f"SELECT * FROM ({audit}) WHERE \"check\" <> 'rows' AND value > 0")
    q["c7b_total_issues"] = W(f"""SELECT CAST(COUNT(*) AS BIGINT) AS issues_found, CAST(COALESCE(SUM(value), 0) AS BIGINT) AS issue_rows
FROM ({audit}) WHERE "check" <> 'rows' AND value > 0""")
    tbl = {"banks": "dim_banks", "devices": "dim_devices", "merchants": "dim_merchants", "campaigns": "dim_campaigns",
           "customers": "dim_customers", "transactions": "txn_a", "cashback": "cashback"}
    orphans = "\nUNION ALL ".join(
        f"SELECT '{ch}' AS child_table, '{cc}' AS child_column, '{pa}' AS parent_table, "
        f"CAST(COUNT(*) AS BIGINT) AS orphans FROM {tbl[ch]} x WHERE x.{cc} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {tbl[pa]} p WHERE p.{pc} = x.{cc})"
        for ch, cc, pa, pc in FOREIGN_KEYS)
    q["c8_orphans"] = W(orphans)
    q["c9_load_kpis"] = with_adapter(f"""
SELECT CAST(COUNT(*) AS BIGINT) AS txns, {R("COUNT(CASE WHEN status = 'SUCCESS' THEN 1 END)", 'COUNT(*)', 2, 100)} AS success_rate_pct,
       {M(SUMS)} AS gpv, {M('SUM(revenue)')} AS revenue, CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS active_customers
FROM enr_a""")
    q["c10_worst_banks"] = with_adapter(f"""
SELECT bank_name, CAST(n AS BIGINT) AS txns, {R('s', 'n', 2, 100)} AS success_rate_pct FROM (
  SELECT bank_id, MIN(bank_name) AS bank_name, COUNT(*) AS n, COUNT(CASE WHEN status = 'SUCCESS' THEN 1 END) AS s
  FROM enr_a GROUP BY bank_id)
ORDER BY CAST(s AS DOUBLE) / CAST(n AS DOUBLE), bank_id LIMIT 5""")
    keys = ("transaction_id", "customer_id", "merchant_id", "bank_id")
    nulls = ", ".join(f"CAST(COUNT(*) FILTER (WHERE {k} IS NULL) AS BIGINT) AS null_{k}" for k in keys)
    allz = " AND ".join(f"COUNT(*) FILTER (WHERE {k} IS NULL) = 0" for k in keys)
    q["c11_key_completeness"] = with_adapter(f"""
SELECT {nulls}, CAST(MIN(amount) AS DOUBLE) AS min_amount, CAST(MAX(amount) AS DOUBLE) AS max_amount,
       ({allz} AND MIN(amount) >= 0.01) AS passed
FROM txn_a""")
    q["s7_row_counts"] = W("\nUNION ALL ".join(
        f"SELECT '{k}' AS table_name, CAST(COUNT(*) AS BIGINT) AS n FROM {v}" for k, v in tbl.items()))
    q["s3_round_trip"] = W("\nUNION ALL ".join(
        f"SELECT '{k}' AS table_name, CAST(COUNT(*) AS BIGINT) AS n, CAST(COUNT(*) AS BIGINT) AS n_back, TRUE AS same FROM {v}" for k, v in tbl.items()))
    # ---------------- features
    q["f10_transaction_features"] = W(
        "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, CAST(commission_rate AS DOUBLE) AS commission_rate, "
        "CAST(revenue AS DOUBLE) AS revenue) FROM tfeat")
    q["u8_customer_features"] = W(
        "SELECT * REPLACE (CAST(lifetime_spend AS DOUBLE) AS lifetime_spend, "
        "CAST(revenue_contributed AS DOUBLE) AS revenue_contributed) FROM cfeat")
    # ---------------- measures
    def kpi_cols() -> str:
        n, s = "COUNT(*)", "COUNT(*) FILTER (WHERE is_success = 1)"
        f = "COUNT(*) FILTER (WHERE status = 'FAILED')"
        dc = "COUNT(DISTINCT customer_id)"
        dm = "COUNT(DISTINCT merchant_id)"
        mobile = "COUNT(*) FILTER (WHERE os_name IN ('Android', 'iOS'))"
        cols = [
            f"CAST({n} AS BIGINT) AS total_transactions",
            f"CAST({s} AS BIGINT) AS successful_transactions",
            f"CAST({f} AS BIGINT) AS failed_transactions",
            "CAST(COUNT(*) FILTER (WHERE is_success = 0) AS BIGINT) AS failed_transactions_readme",
            "CAST(COUNT(*) FILTER (WHERE status = 'PENDING') AS BIGINT) AS pending_transactions",
            f"{R(s, n, 6)} AS success_rate",
            f"COALESCE({R(s, n, 4, 100)}, 0.0) AS success_rate_pct",
            f"COALESCE({R(f, n, 4, 100)}, 0.0) AS failure_rate_pct",
            "CAST(SUM(amount) AS DOUBLE) AS total_amount",
            f"CAST({SUMS} AS DOUBLE) AS gpv",
            "CAST(SUM(revenue) AS DOUBLE) AS total_revenue",
            f"{R(SUMS, CNTS, 4)} AS avg_ticket_size",
            f"COALESCE({R('SUM(amount)', n, 4)}, 0.0) AS avg_transaction_amount",
            f"CAST({dc} AS BIGINT) AS active_customers",
            f"CAST({dm} AS BIGINT) AS active_merchants",
            f"COALESCE({R(n, dc, 4)}, 0.0) AS avg_txns_per_customer",
            f"{R('SUM(revenue)', dc, 4)} AS arpu",
            f"{R(SUMS, dc, 4)} AS avg_spend_per_customer",
            "CAST(SUM(CASE WHEN status = 'FAILED' THEN amount END) AS DOUBLE) AS failed_gpv",
            "CAST(SUM(CASE WHEN status = 'FAILED' THEN amount * commission_rate END) AS DOUBLE) AS est_revenue_lost",
            f"COALESCE({R(n, dm, 4)}, 0.0) AS txns_per_merchant",
            "CAST(COUNT(DISTINCT CASE WHEN is_success = 1 THEN merchant_id END) AS BIGINT) AS merchants_with_success",
            "CAST(COUNT(DISTINCT bank_id) AS BIGINT) AS total_banks",
            "CAST(COUNT(DISTINCT device_id) AS BIGINT) AS total_devices",
            f"{R(mobile, n, 4, 100)} AS mobile_txn_pct",
            f"{R('COUNT(*) FILTER (WHERE is_weekend = 1)', n, 4, 100)} AS weekend_txn_pct",
            f"{R('SUM(commission_rate)', 'COUNT(commission_rate)', 8)} AS avg_commission_rate",
            f"COALESCE({R('SUM(revenue)', n, 4)}, 0.0) AS revenue_per_transaction",
        ]
        return ",\n       ".join(cols)
    q["m_kpi_card"] = with_adapter(f"SELECT {kpi_cols()} FROM enr_a")
    q["m_customer_card"] = W(f"""
SELECT CAST(COUNT(*) AS BIGINT) AS total_customers_cf,
       CAST(COUNT(*) FILTER (WHERE is_inactive = 1) AS BIGINT) AS inactive_customers,
       {R('COUNT(*) FILTER (WHERE is_inactive = 1)', 'COUNT(*)', 4, 100)} AS inactive_rate_pct,
       {R('SUM(lifetime_spend)', 'COUNT(lifetime_spend)', 4)} AS avg_clv,
       {R('SUM(recency_days)', 'COUNT(recency_days)', 4)} AS avg_recency_days,
       CAST(COUNT(DISTINCT CASE WHEN f_score >= 3 THEN customer_id END) AS BIGINT) AS high_value_customers,
       CAST(COUNT(DISTINCT CASE WHEN f_score <= 1 THEN customer_id END) AS BIGINT) AS churn_risk_customers,
       {R('SUM(f_score)', 'COUNT(f_score)', 4)} AS avg_rfm_score,
       COALESCE({R('COUNT(DISTINCT CASE WHEN f_score >= 3 THEN customer_id END)', '(SELECT COUNT(DISTINCT customer_id) FROM enr_a)', 4, 100)}, 0.0) AS high_value_customer_pct
FROM cfeat""")
    for name, value, agg in (("m14_gpv_previous_month", "gpv", SUMS),
                             ("m15_revenue_previous_month", "revenue", "SUM(revenue)"),
                             ("m16_transactions_previous_month", "transactions", "COUNT(*)")):
        q[name] = with_adapter(f"""
SELECT strftime(m.ms, '%Y-%m') AS year_month, CAST(m.v AS DOUBLE) AS {value}, CAST(p.v AS DOUBLE) AS {value}_pm,
       {R('m.v - p.v', 'p.v', 4, 100)} AS {value}_mom_pct
FROM mm m LEFT JOIN mm p ON CAST(p.ms + INTERVAL 1 MONTH AS DATE) = m.ms ORDER BY 1""",
                               f"mm AS (SELECT CAST(date_trunc('month', txn_date) AS DATE) AS ms, {agg} AS v FROM enr_a GROUP BY 1)")
    ytd = "OVER (PARTITION BY txn_year ORDER BY txn_month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    q["m17_year_to_date"] = with_adapter(f"""
SELECT txn_year, txn_month, CAST(SUM(rev) {ytd} AS DOUBLE) AS revenue_ytd,
       CAST(COALESCE(SUM(gpv) {ytd}, 0) AS DOUBLE) AS gpv_ytd, CAST(SUM(n) {ytd} AS BIGINT) AS transactions_ytd
FROM (SELECT txn_year, txn_month, SUM(revenue) AS rev, {SUMS} AS gpv, COUNT(*) AS n FROM enr_a GROUP BY 1, 2)
ORDER BY 1, 2""")
    q["m20_cumulative_revenue_in_range"] = with_adapter("""
SELECT txn_date, CAST(rev AS DOUBLE) AS revenue,
       CAST(SUM(rev) OVER (ORDER BY txn_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumulative_revenue
FROM (SELECT txn_date, SUM(revenue) AS rev FROM enr_a
      WHERE txn_date >= DATE '1996-01-01' AND txn_date <= DATE '1997-12-31' GROUP BY txn_date) ORDER BY txn_date""")
    q["m21_repeat_customers"] = with_adapter(f"""
SELECT merchant_category, CAST(COUNT(*) FILTER (WHERE n > 1) AS BIGINT) AS repeat_customers,
       {R('COUNT(*) FILTER (WHERE n > 1)', 'COUNT(*)', 4, 100)} AS repeat_rate_pct
FROM (SELECT merchant_category, customer_id, COUNT(*) AS n FROM enr_a GROUP BY 1, 2) GROUP BY 1""")
    q["m25_new_customers_by_date"] = with_adapter("""
SELECT CAST(g.d AS DATE) AS date, CAST(COALESCE(r.n, 0) AS BIGINT) AS new_customers
FROM generate_series((SELECT CAST(MIN(txn_timestamp) AS DATE) FROM txn_a),
                     (SELECT CAST(MAX(txn_timestamp) AS DATE) FROM txn_a), INTERVAL 1 DAY) g(d)
LEFT JOIN (SELECT registration_date, COUNT(DISTINCT customer_id) AS n FROM dim_customers GROUP BY 1) r
  ON r.registration_date = CAST(g.d AS DATE) ORDER BY 1""")
    q["m30_merchant_revenue_rank"] = with_adapter("""
SELECT merchant_id, CAST(SUM(revenue) AS DOUBLE) AS revenue,
       CAST(RANK() OVER (ORDER BY SUM(revenue) DESC) AS INTEGER) AS merchant_revenue_rank
FROM enr_a GROUP BY merchant_id""")
    q["m33_peak_hour"] = with_adapter("""
SELECT (SELECT txn_hour FROM h ORDER BY n DESC, txn_hour DESC LIMIT 1) AS peak_hour,
       (SELECT CAST(MAX(n) AS BIGINT) FROM h) AS peak_hour_txns""",
                                      "h AS (SELECT txn_hour, COUNT(*) AS n FROM enr_b GROUP BY 1)")
    q["m35_active_customers_30d"] = with_adapter("""
SELECT CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS active_customers_30d FROM enr_a
WHERE txn_date >= (SELECT CAST(MAX(txn_timestamp) AS DATE) FROM txn_a) - 30""")
    q["m38_top_merchant_revenue"] = with_adapter("""
SELECT CAST(MAX(r) AS DOUBLE) AS top_merchant_revenue FROM (SELECT SUM(revenue) AS r FROM enr_a GROUP BY merchant_id)""")
    q["m40_most_common_failure_reason"] = with_adapter("""
SELECT failure_reason AS most_common_failure_reason, CAST(n AS BIGINT) AS occurrences FROM (
  SELECT failure_reason, COUNT(*) AS n FROM enr_a WHERE failure_reason IS NOT NULL GROUP BY 1)
ORDER BY n DESC, failure_reason DESC LIMIT 1""")
    q["m42_base_failure_rate_avg"] = with_adapter(
        "SELECT ROUND(AVG(base_failure_rate), 10) AS base_failure_rate_avg FROM dim_banks")
    q["m43_bank_success_rate"] = with_adapter(f"""
SELECT bank_name, CAST(COUNT(*) AS BIGINT) AS total_transactions,
       COALESCE({R('COUNT(*) FILTER (WHERE is_success = 1)', 'COUNT(*)', 4, 100)}, 0.0) AS success_rate_pct
FROM enr_a GROUP BY bank_name""")
    from ledgerlens.oracle.kpis import _band
    q["m50_ticket_band_column"] = with_adapter(
        f"SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, {_band(edges_a)} AS ticket_band, "
        f"'{X.COUNTRY}' AS country FROM enr_a")
    sl = slicers or {}
    where = " AND ".join(
        f"{k} IN ({', '.join(repr(v) if isinstance(v, str) else str(v) for v in vals)})" for k, vals in sl.items()) or "TRUE"
    q["x1_sliced_measures"] = with_adapter(f"""
SELECT txn_year, merchant_category, CAST(COUNT(*) AS BIGINT) AS total_transactions, CAST({SUMS} AS DOUBLE) AS gpv,
       CAST(SUM(revenue) AS DOUBLE) AS total_revenue,
       COALESCE({R('COUNT(*) FILTER (WHERE is_success = 1)', 'COUNT(*)', 4, 100)}, 0.0) AS success_rate_pct,
       CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS active_customers
FROM enr_a WHERE {where} GROUP BY 1, 2""")
    q["x2_drill_through_merchant"] = with_adapter(f"""
SELECT transaction_id, txn_timestamp, customer_id, merchant_name, bank_name, CAST(amount AS DOUBLE) AS amount,
       status, failure_reason FROM enr_a WHERE merchant_id = {drill_merchant}""")
    q["x3_visual_top_n"] = with_adapter("""
SELECT customer_state, CAST(SUM(revenue) AS DOUBLE) AS total_revenue, CAST(COUNT(*) AS BIGINT) AS total_transactions
FROM enr_a GROUP BY 1 ORDER BY total_revenue DESC NULLS LAST, customer_state LIMIT 5""")
    # ---------------- visuals
    q["p1_revenue_by_payment_mode"] = with_adapter(
        "SELECT payment_mode, CAST(SUM(revenue) AS DOUBLE) AS revenue FROM enr_a GROUP BY 1")
    q["p2_revenue_by_quarter"] = with_adapter(
        "SELECT txn_year, CAST(quarter(txn_date) AS INTEGER) AS quarter, CAST(SUM(revenue) AS DOUBLE) AS revenue "
        "FROM enr_a GROUP BY 1, 2")
    q["p3_customers_per_segment"] = W("SELECT segment, CAST(COUNT(*) AS BIGINT) AS customers FROM cfeat GROUP BY 1")
    q["p4_rfm_scatter"] = W("SELECT customer_id, n_txns, CAST(lifetime_spend AS DOUBLE) AS lifetime_spend, "
                            "segment, recency_days FROM cfeat")
    q["p5_clv_top"] = W("SELECT customer_id, CAST(lifetime_spend AS DOUBLE) AS lifetime_spend, n_txns, segment, state "
                        "FROM cfeat ORDER BY lifetime_spend DESC, customer_id LIMIT 20")
    q["p6_customers_by_gender"] = W(
        "SELECT gender, CAST(COUNT(*) AS BIGINT) AS customers, "
        "CAST(COUNT(*) FILTER (WHERE f_score >= 3) AS BIGINT) AS high_value_customers FROM cfeat GROUP BY 1")
    q["p7_recency_histogram"] = W(_hist("SELECT CAST(recency_days AS DOUBLE) AS v FROM cfeat", 20))
    q["p8_new_customers_by_month"] = with_adapter(
        "SELECT strftime(registration_date, '%Y-%m') AS year_month, "
        "CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS new_customers FROM dim_customers GROUP BY 1")
    q["p9_category_merchant_hierarchy"] = with_adapter(f"""
SELECT merchant_category, merchant_id, CASE WHEN lvl = 1 THEN 'category' ELSE 'merchant' END AS level, gpv FROM (
  SELECT merchant_category, merchant_id, CAST({SUMS} AS DOUBLE) AS gpv,
         GROUPING(merchant_category, merchant_id) AS lvl
  FROM enr_a GROUP BY ROLLUP (merchant_category, merchant_id)) WHERE lvl < 3""")
    q["p10_category_matrix"] = with_adapter(f"""
SELECT merchant_category, CAST(SUM(revenue) AS DOUBLE) AS revenue, CAST({SUMS} AS DOUBLE) AS gpv,
       {R('SUM(is_success)', 'COUNT(*)', 4, 100)} AS success_rate_pct, {R(SUMS, CNTS, 4)} AS avg_ticket
FROM enr_a GROUP BY 1""")
    q["p11_merchant_scatter"] = with_adapter(f"""
SELECT g.merchant_id, CAST(g.n AS BIGINT) AS txns, {R('g.s', 'g.n', 4, 100)} AS success_rate_pct, m.popularity
FROM (SELECT merchant_id, COUNT(*) AS n, SUM(is_success) AS s FROM enr_a GROUP BY 1) g
JOIN dim_merchants m ON m.merchant_id = g.merchant_id""")
    days = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
    q["p12_month_weekday_heatmap"] = with_adapter(
        "SELECT txn_year_month, " + ", ".join(
            f"CAST(COUNT(*) FILTER (WHERE strftime(txn_date, '%a') = '{d}') AS BIGINT) AS \"{d}\"" for d in days)
        + " FROM enr_a GROUP BY 1")
    q["p13_bank_type_reason_matrix"] = with_adapter(
        "SELECT bank_type, " + ", ".join(
            f"CAST(COUNT(*) FILTER (WHERE failure_reason = '{r}') AS BIGINT) AS \"{r}\"" for r in reasons)
        + ", CAST(COUNT(*) FILTER (WHERE failure_reason IS NULL OR failure_reason NOT IN (" + ", ".join(f"'{r}'" for r in reasons)
        + ")) AS BIGINT) AS other FROM enr_a WHERE status = 'FAILED' GROUP BY 1")
    q["p14_state_category_matrix"] = with_adapter(
        "SELECT customer_state, " + ", ".join(
            f"CAST(SUM(CASE WHEN merchant_category = '{c}' THEN amount END) AS DOUBLE) AS \"{c}\"" for c in categories)
        + ", CAST(SUM(CASE WHEN merchant_category IS NULL OR merchant_category NOT IN (" + ", ".join(f"'{c}'" for c in categories)
        + ") THEN amount END) AS DOUBLE) AS other FROM enr_a WHERE status = 'SUCCESS' GROUP BY 1")
    q["p15_top5_merchants"] = with_adapter("""
SELECT merchant_id, MIN(merchant_name) AS merchant_name, CAST(SUM(revenue) AS DOUBLE) AS revenue
FROM enr_a GROUP BY merchant_id ORDER BY SUM(revenue) DESC, merchant_id LIMIT 5""")
    q["p15_success_failed_split"] = with_adapter(
        "SELECT status, CAST(COUNT(*) AS BIGINT) AS txns FROM enr_a GROUP BY 1")
    q["p15_revenue_trend"] = with_adapter(
        "SELECT txn_year_month, CAST(SUM(revenue) AS DOUBLE) AS revenue FROM enr_a GROUP BY 1")
    q["p16_txns_by_city"] = with_adapter(
        "SELECT customer_city, CAST(COUNT(*) AS BIGINT) AS txns FROM enr_a GROUP BY 1")
    q["p16_avg_amount_by_age"] = with_adapter(
        f"SELECT customer_age, {R('SUM(amount)', 'COUNT(*)', 4)} AS avg_amount FROM enr_a GROUP BY 1")
    q["p17_commission_by_merchant"] = with_adapter(
        f"SELECT merchant_id, {R('SUM(commission_rate)', 'COUNT(commission_rate)', 8)} AS avg_commission_rate "
        "FROM enr_a GROUP BY 1")
    q["p17_txns_by_category"] = with_adapter(
        "SELECT merchant_category, CAST(COUNT(*) AS BIGINT) AS txns FROM enr_a GROUP BY 1")
    q["p18_bank_volume_share"] = with_adapter("""
SELECT g.bank_id, b.bank_name, CAST(g.n AS BIGINT) AS txns, b.market_share
FROM (SELECT bank_id, COUNT(*) AS n FROM enr_a GROUP BY 1) g JOIN dim_banks b ON b.bank_id = g.bank_id""")
    q["p18_os_share"] = with_adapter(f"""
SELECT os_name, CAST(COUNT(*) AS BIGINT) AS txns, {R('COUNT(*)', 'SUM(COUNT(*)) OVER ()', 4, 100)} AS pct
FROM enr_a GROUP BY 1""")
    q["p19_transaction_detail"] = with_adapter("""
SELECT e.txn_date, e.transaction_id, c.customer_name, e.merchant_name, CAST(e.amount AS DOUBLE) AS amount, e.status
FROM enr_a e JOIN dim_customers c ON c.customer_id = e.customer_id
WHERE e.txn_date > DATE '1996-06-30' OR (e.txn_date = DATE '1996-06-30' AND e.transaction_id > '99999')
ORDER BY e.txn_date, e.transaction_id, e.merchant_id, e.amount LIMIT 100""")
    q["p20_failure_rate_by_date"] = with_adapter(f"""
SELECT txn_date, CAST(COUNT(*) AS BIGINT) AS txns,
       {R("COUNT(*) FILTER (WHERE status = 'FAILED')", 'COUNT(*)', 4, 100)} AS failure_rate_pct
FROM enr_a GROUP BY 1""")
    q["p21_bank_reason_failures"] = with_adapter(
        "SELECT bank_name, failure_reason, CAST(COUNT(*) AS BIGINT) AS failures FROM enr_a "
        "WHERE status = 'FAILED' GROUP BY 1, 2")
    q["p22_regional_table"] = with_adapter(f"""
SELECT customer_state, customer_city, CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS customers,
       CAST(COUNT(*) AS BIGINT) AS txns, CAST(SUM(revenue) AS DOUBLE) AS revenue,
       {R('SUM(is_success)', 'COUNT(*)', 4, 100)} AS success_rate_pct
FROM enr_a GROUP BY 1, 2""")
    q["p23_top10_revenue_share"] = with_adapter(f"""
SELECT CAST(SUM(r) AS DOUBLE) AS top10_revenue, {R('SUM(r)', '(SELECT SUM(revenue) FROM enr_a)', 4, 100)} AS top10_share_pct
FROM (SELECT SUM(revenue) AS r FROM enr_a GROUP BY merchant_id ORDER BY r DESC, merchant_id LIMIT 10)""")
    # ---------------- exploratory (features path)
    xd = "CAST(amount AS DOUBLE)"
    q["n1_describe_amount"] = W(_describe("tfeat"))
    q["n2_amount_histogram_p99"] = W(_hist(
        f"SELECT LEAST({xd}, (SELECT quantile_cont({xd}, 0.99) FROM tfeat)) AS v FROM tfeat", 60))
    q["n3_log10_histogram"] = W(_hist(f"SELECT log10({xd}) AS v FROM tfeat", 60))
    q["n4_status_share"] = W(f"""
SELECT status, CAST(COUNT(*) AS BIGINT) AS txns, {R('COUNT(*)', 'SUM(COUNT(*)) OVER ()', 4, 100)} AS pct
FROM tfeat GROUP BY 1""")
    q["n5_monthly_eda"] = W(f"""
SELECT txn_year_month, CAST(COUNT(*) AS BIGINT) AS txns, CAST(SUM(amount * is_success) AS DOUBLE) AS gpv,
       {R('SUM(is_success)', 'COUNT(*)', 6)} AS success_mean FROM tfeat GROUP BY 1""")
    q["n6_txns_by_hour"] = W("SELECT txn_hour, CAST(COUNT(*) AS BIGINT) AS txns FROM tfeat GROUP BY 1")
    names = ", ".join(f"({i}, '{n}')" for i, n in enumerate(X.WEEKDAY_NAMES))
    q["n7_txns_by_weekday"] = W(f"""
SELECT CAST(s.day_index AS INTEGER) AS day_index, s.txn_day_name, g.txns
FROM (VALUES {names}) s(day_index, txn_day_name)
LEFT JOIN (SELECT txn_day_name, CAST(COUNT(*) AS BIGINT) AS txns FROM tfeat GROUP BY 1) g
  ON g.txn_day_name = s.txn_day_name""")
    q["n8_category_eda"] = W(f"""
SELECT merchant_category, CAST(SUM(revenue) AS DOUBLE) AS revenue, CAST(SUM(amount * is_success) AS DOUBLE) AS gpv,
       CAST(COUNT(*) AS BIGINT) AS txns, {R('SUM(is_success)', 'COUNT(*)', 1, 100)} AS success_rate_pct
FROM tfeat GROUP BY 1""")
    q["n9_state_eda"] = W(f"""
SELECT customer_state, CAST(SUM(amount * is_success) AS DOUBLE) AS gpv,
       {R('SUM(is_success)', 'COUNT(*)', 2, 100)} AS success_rate_pct,
       CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS customers FROM tfeat GROUP BY 1""")
    q["n10_bank_failure_mean"] = W(
        f"SELECT bank_name, {R('SUM(is_failed)', 'COUNT(*)', 6, 100)} AS failure_rate_pct FROM tfeat GROUP BY 1")
    q["n11_failure_reason_counts"] = W(
        "SELECT failure_reason, CAST(COUNT(*) AS BIGINT) AS count FROM tfeat WHERE is_failed = 1 GROUP BY 1")
    q["n12_correlation_matrix"] = W(_corr(N12_FEATURES, dropna=False))
    q["n13_first_rows"] = W("""
SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, txn_hour, txn_day_name, is_weekend, high_value_flag,
       ticket_band, daypart, CAST(revenue AS DOUBLE) AS revenue, merchant_category
FROM tfeat ORDER BY transaction_id LIMIT 5""")
    q["n14_append_frames"] = with_adapter("""
SELECT transaction_id, customer_id, CAST(amount AS DOUBLE) AS amount FROM txn_a
UNION ALL SELECT transaction_id, customer_id, CAST(amount AS DOUBLE) AS amount FROM txn_b""")
    # ---------------- statistics (statistic parts)
    succ = "(SELECT * FROM tfeat WHERE is_success = 1)"
    q["t1_describe_successful"] = W(_describe(succ))
    q["t2_shape"] = W(f"""
SELECT ROUND(skewness({xd}) * (COUNT(*) - 2) / sqrt(COUNT(*) * (COUNT(*) - 1.0)), 6) AS skewness,
       ROUND(kurtosis_pop({xd}), 6) AS kurtosis,
       ROUND(skewness(ln({xd})) * (COUNT(*) - 2) / sqrt(COUNT(*) * (COUNT(*) - 1.0)), 6) AS skewness_log
FROM {succ}""")
    q["t3_log_histogram"] = W(_hist(f"SELECT ln({xd}) AS v FROM {succ}", 60))
    m = _filliben(99)
    probs = "[" + ", ".join(repr(p) for p in m) + "]"
    spine = ", ".join(f"({i + 1}, {p!r}, {norm_ppf(p)!r})" for i, p in enumerate(m))
    q["t4_qq_points"] = W(f"""
SELECT s.point, ROUND(s.prob, 6) AS prob, ROUND(s.theoretical, 6) AS theoretical, ROUND(u.sample, 6) AS sample
FROM (VALUES {spine}) s(point, prob, theoretical)
JOIN (SELECT unnest(q) AS sample, generate_subscripts(q, 1) AS point
      FROM (SELECT quantile_cont(ln({xd}), {probs}) AS q FROM {succ})) u ON u.point = s.point""")
    q["t5_iqr_outliers"] = W(f"""
SELECT ROUND(q1, 6) AS q1, ROUND(q3, 6) AS q3, ROUND(q3 - q1, 6) AS iqr,
       ROUND(q1 - (q3 - q1) * 1.5, 6) AS lower_fence, ROUND(q3 + (q3 - q1) * 1.5, 6) AS upper_fence,
       CAST(k AS BIGINT) AS outliers, {R('k', 'n', 4, 100)} AS outlier_pct
FROM (SELECT q1, q3, (SELECT COUNT(*) FROM {succ} WHERE {xd} < q1 - (q3 - q1) * 1.5 OR {xd} > q3 + (q3 - q1) * 1.5) AS k,
             (SELECT COUNT(*) FROM {succ}) AS n
      FROM (SELECT quantile_cont({xd}, 0.25) AS q1, quantile_cont({xd}, 0.75) AS q3 FROM {succ}))""")
    q["t6_zscore_outliers"] = W(f"""
SELECT ROUND(mu, 6) AS mean, ROUND(sd, 6) AS std_pop, CAST(k AS BIGINT) AS outliers, {R('k', 'n', 4, 100)} AS outlier_pct
FROM (SELECT mu, sd, (SELECT COUNT(*) FROM {succ} WHERE abs(({xd} - mu) / sd) > 3.0) AS k,
             (SELECT COUNT(*) FROM {succ}) AS n
      FROM (SELECT AVG({xd}) AS mu, stddev_pop({xd}) AS sd FROM {succ}))""")
    q["t7_boxplot_stats"] = W(f"""
SELECT ROUND(cap, 6) AS clip_at, ROUND(MIN(x) FILTER (WHERE x >= q1 - (q3 - q1) * 1.5), 6) AS whisker_low,
       ROUND(q1, 6) AS q1, ROUND(med, 6) AS median, ROUND(q3, 6) AS q3,
       ROUND(MAX(x) FILTER (WHERE x <= q3 + (q3 - q1) * 1.5), 6) AS whisker_high,
       CAST(COUNT(*) FILTER (WHERE x < q1 - (q3 - q1) * 1.5 OR x > q3 + (q3 - q1) * 1.5) AS BIGINT) AS fliers
FROM (SELECT x, cap, quantile_cont(x, 0.25) OVER () AS q1, quantile_cont(x, 0.5) OVER () AS med,
             quantile_cont(x, 0.75) OVER () AS q3
      FROM (SELECT LEAST({xd}, (SELECT quantile_cont({xd}, 0.999) FROM {succ})) AS x,
                   (SELECT quantile_cont({xd}, 0.999) FROM {succ}) AS cap FROM {succ}))
GROUP BY cap, q1, med, q3""")
    q["t7b_abs_z_histogram"] = W(_hist(
        f"SELECT LEAST(abs(({xd} - (SELECT AVG({xd}) FROM {succ})) / (SELECT stddev_pop({xd}) FROM {succ})), 6.0) AS v "
        f"FROM {succ}", 60))
    q["t8_mean_ci_stat"] = W(f"""
SELECT CAST(COUNT(*) AS BIGINT) AS n, {R('SUM(amount)', 'COUNT(*)', 6)} AS mean, ROUND(stddev_samp({xd}), 6) AS std,
       ROUND(stddev_samp({xd}) / sqrt(COUNT(*)), 6) AS sem FROM {succ}""")
    q["t10_correlation_dropna"] = W(_corr(T10_FEATURES, dropna=True))
    q["t11_pearson_stat"] = W("""
SELECT 'n_txns' AS x, ROUND(corr(CAST(n_txns AS DOUBLE), CAST(lifetime_spend AS DOUBLE)), 6) AS r, CAST(COUNT(*) AS BIGINT) AS n FROM cfeat
UNION ALL
SELECT 'tenure_days', ROUND(corr(CAST(COALESCE(tenure_days, 0) AS DOUBLE), CAST(lifetime_spend AS DOUBLE)), 6), CAST(COUNT(*) AS BIGINT) FROM cfeat""")
    # Sums of cents around the whole-cent mean of each group.
    weekend = f"""
wk AS (SELECT is_weekend, CAST(COUNT(*) AS DOUBLE) AS n, SUM(CAST(amount * 100 AS HUGEINT)) AS sx,
              SUM(CAST(amount * 100 AS HUGEINT)) // COUNT(*) AS c FROM {succ} GROUP BY 1),
wd AS (SELECT wk.is_weekend, n, sx, SUM(CAST(amount * 100 AS HUGEINT) - c) AS sd, SUM((CAST(amount * 100 AS HUGEINT) - c) * (CAST(amount * 100 AS HUGEINT) - c)) AS sdd
       FROM {succ} AS f JOIN wk ON wk.is_weekend = f.is_weekend GROUP BY ALL),
wm AS (SELECT is_weekend, n, CAST(sx AS DOUBLE) / 100 / n AS mean,
              (CAST(sdd AS DOUBLE) - CAST(sd AS DOUBLE) * CAST(sd AS DOUBLE) / n) / (n - 1) / 10000 AS var FROM wd),
welch AS (SELECT (a.mean - b.mean) / sqrt(a.var / a.n + b.var / b.n) AS t,
                 (a.var / a.n + b.var / b.n) * (a.var / a.n + b.var / b.n)
                 / (a.var / a.n * (a.var / a.n) / (a.n - 1) + b.var / b.n * (b.var / b.n) / (b.n - 1)) AS df,
                 (a.mean - b.mean) / sqrt((a.var + b.var) / 2) AS cohens_d
          FROM wm a, wm b WHERE a.is_weekend = 1 AND b.is_weekend = 0)"""
    q["t12_weekend_groups"] = W("SELECT is_weekend, CAST(n AS BIGINT) AS n, ROUND(mean, 6) AS mean, ROUND(var, 6) AS var FROM wm", weekend)
    q["t12_welch_stat"] = W("SELECT ROUND(t, 6) AS t, ROUND(df, 4) AS df, ROUND(cohens_d, 6) AS cohens_d FROM welch", weekend)
    mw = f"""
SELECT CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, ROUND(r1 - n1 * (n1 + 1) / 2.0, 6) AS u_statistic,
       ROUND(sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1)))), 6) AS sigma
FROM (SELECT SUM(c1 * (cum - (t - 1) / 2.0)) AS r1, CAST(SUM(c1) AS DOUBLE) AS n1, CAST(SUM(c2) AS DOUBLE) AS n2,
             SUM(POWER(CAST(t AS DOUBLE), 3) - t) AS ties
      FROM (SELECT c1, c2, t, SUM(t) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
            FROM (SELECT amount AS v, COUNT(*) FILTER (WHERE is_weekend = 1) AS c1,
                         COUNT(*) FILTER (WHERE is_weekend = 0) AS c2, COUNT(*) AS t
                  FROM {succ} GROUP BY amount)))"""
    q["t13_mann_whitney_stat"] = W(mw)
    anova = f"""
SELECT CAST(k AS BIGINT) AS groups, CAST(k - 1 AS BIGINT) AS df_between, CAST(nn - k AS BIGINT) AS df_within,
       ROUND(((s2n - sx * sx / nn) / (k - 1)) / (ssw / (nn - k)), 4) AS f_statistic
FROM (SELECT SUM(n) AS nn, SUM(sx) AS sx, COUNT(*) AS k, SUM(sx * sx / n) AS s2n,
             SUM(COALESCE(v, 0.0) * (n - 1)) AS ssw
      FROM (SELECT merchant_category, COUNT(*) AS n, SUM({xd}) AS sx, var_samp({xd}) AS v FROM {succ} GROUP BY 1))"""
    q["t15_anova_stat"] = W(anova)
    q["t16_category_ticket_stats"] = W(f"""
SELECT merchant_category, CAST(COUNT(*) AS BIGINT) AS n, {R('SUM(amount)', 'COUNT(*)', 0)} AS mean_ticket,
       ROUND(quantile_cont({xd}, 0.25), 6) AS q1, ROUND(quantile_cont({xd}, 0.5), 6) AS median,
       ROUND(quantile_cont({xd}, 0.75), 6) AS q3,
       ROUND((SELECT quantile_cont({xd}, 0.95) FROM {succ}), 6) AS display_limit_p95
FROM {succ} GROUP BY 1""")
    sts = sorted(X.VALID_STATUSES)
    q["t17_bank_type_status_table"] = W(
        "SELECT bank_type, " + ", ".join(
            f"CAST(COUNT(*) FILTER (WHERE status = '{s}') AS BIGINT) AS \"{s}\"" for s in sts)
        + " FROM tfeat WHERE bank_type IS NOT NULL GROUP BY 1")
    def chi(row: str, col: str, tag: str = "") -> str:
        """CTEs down to chi<tag>(chi2, dof, n, kr, kc) of a contingency table."""
        return f"""
lt{tag} AS (SELECT CAST({row} AS VARCHAR) AS r, CAST({col} AS VARCHAR) AS c, COUNT(*) AS o FROM tfeat
       WHERE {row} IS NOT NULL AND {col} IS NOT NULL GROUP BY 1, 2),
rt{tag} AS (SELECT r, SUM(o) AS total FROM lt{tag} GROUP BY r),
ct{tag} AS (SELECT c, SUM(o) AS total FROM lt{tag} GROUP BY c),
nn{tag} AS (SELECT SUM(o) AS n FROM lt{tag}),
cells{tag} AS (SELECT CAST(l.o AS DOUBLE) AS o, CAST(a.total AS DOUBLE) * CAST(b.total AS DOUBLE) / CAST((SELECT n FROM nn{tag}) AS DOUBLE) AS e
          FROM lt{tag} l JOIN rt{tag} a ON a.r = l.r JOIN ct{tag} b ON b.c = l.c),
st{tag} AS (SELECT (SELECT COUNT(*) FROM rt{tag}) AS kr, (SELECT COUNT(*) FROM ct{tag}) AS kc, (SELECT n FROM nn{tag}) AS n,
              (SELECT SUM(o * o / e) FROM cells{tag}) AS s, (SELECT MAX(abs(o - e)) FROM cells{tag}) AS d,
              (SELECT SUM(1.0 / total) FROM rt{tag}) AS ir, (SELECT SUM(1.0 / total) FROM ct{tag}) AS ic),
chi{tag} AS (SELECT CASE WHEN (kr - 1) * (kc - 1) = 1
                    THEN GREATEST(d - 0.5, 0.0) * GREATEST(d - 0.5, 0.0) * CAST(n AS DOUBLE) * ir * ic
                    ELSE s - CAST(n AS DOUBLE) END AS chi2,
               CAST((kr - 1) * (kc - 1) AS BIGINT) AS dof, CAST(n AS BIGINT) AS n, kr, kc FROM st{tag})"""
    q["t18_chi_square_stat"] = W("""
SELECT ROUND(chi2, 6) AS chi2, dof, n, ROUND(sqrt(chi2 / (n * (LEAST(kr, kc) - 1))), 6) AS cramers_v FROM chi""",
                                 chi("bank_type", "status"))
    q["t19_failure_rate_by_bank_type"] = W(
        f"SELECT bank_type, {R('SUM(is_failed)', 'COUNT(*)', 2, 100)} AS failure_rate_pct FROM tfeat GROUP BY 1")
    q["t20_os_failure_table"] = W(f"""
SELECT os_name, CAST(COUNT(*) FILTER (WHERE is_failed = 0) AS BIGINT) AS failed_0,
       CAST(COUNT(*) FILTER (WHERE is_failed = 1) AS BIGINT) AS failed_1,
       {R('COUNT(*) FILTER (WHERE is_failed = 1)', 'COUNT(*)', 2, 100)} AS failure_rate_pct
FROM tfeat WHERE os_name IS NOT NULL GROUP BY 1""")
    q["t20_os_chi_square_stat"] = W("SELECT ROUND(chi2, 6) AS chi2, dof, n FROM chi", chi("os_name", "is_failed"))
    # Fixed critical values at 5 %: normal 1.959963984540054, with the first terms of its expansion for t;
    # chi-square 9.487729 (4) and 3.841459 (1); the F limit from chi-square / df for the categories at hand.
    t_star = "1.959963984540054 + (POWER(1.959963984540054, 3) + 1.959963984540054) / (4.0 * {df})"
    q["t8_mean_ci"] = W(f"""
SELECT n, mean, ROUND(sd, 6) AS std, ROUND(sem, 6) AS sem, ROUND(mean - tq * sem, 4) AS ci_low, ROUND(mean + tq * sem, 4) AS ci_high
FROM (SELECT *, {t_star.format(df='(n - 1)')} + (5 * POWER(1.959963984540054, 5) + 16 * POWER(1.959963984540054, 3) + 3 * 1.959963984540054) / (96.0 * (n - 1) * (n - 1)) AS tq
      FROM (SELECT CAST(COUNT(*) AS BIGINT) AS n, {R('SUM(amount)', 'COUNT(*)', 6)} AS mean, stddev_samp({xd}) AS sd, stddev_samp({xd}) / sqrt(COUNT(*)) AS sem FROM {succ}))""")
    both = weekend + ",\n" + chi("bank_type", "status").strip() + ",\n" + chi("os_name", "is_failed", "_os").strip()
    q["t21_decisions"] = W(f"""
SELECT 'welch' AS test, abs(t) > {t_star.format(df='df')} AS reject_h0 FROM welch
UNION ALL SELECT 'mann_whitney', (GREATEST(u_statistic, CAST(n1 AS DOUBLE) * n2 - u_statistic) - CAST(n1 AS DOUBLE) * n2 / 2.0 - 0.5) / sigma > 1.959963984540054 FROM ({mw})
UNION ALL SELECT 'anova', f_statistic > CASE df_between WHEN 4 THEN 2.3719 WHEN 5 THEN 2.2141 ELSE NULL END FROM ({anova})
UNION ALL SELECT 'bank_type_chi_square', chi2 > CASE dof WHEN 2 THEN 5.991465 WHEN 4 THEN 9.487729 WHEN 6 THEN 12.591587 WHEN 8 THEN 15.507313 ELSE NULL END FROM chi
UNION ALL SELECT 'os_chi_square', chi2 > CASE dof WHEN 1 THEN 3.841459 WHEN 2 THEN 5.991465 ELSE NULL END FROM chi_os
UNION ALL SELECT 'pearson_' || x, abs(r) * sqrt((n - 2) / (1 - r * r)) > {t_star.format(df='(n - 2)')}
FROM (SELECT 'n_txns' AS x, corr(CAST(n_txns AS DOUBLE), CAST(lifetime_spend AS DOUBLE)) AS r, COUNT(*) AS n FROM cfeat
      UNION ALL SELECT 'tenure_days', corr(CAST(COALESCE(tenure_days, 0) AS DOUBLE), CAST(lifetime_spend AS DOUBLE)), COUNT(*) FROM cfeat)""",
                           both)
    q["f9_success_amount"] = W("SELECT transaction_id, CAST(amount * is_success AS DOUBLE) AS success_amount FROM tfeat")
    q["x5_sorted_labels"] = with_adapter("""
SELECT 'weekday' AS label_kind, strftime(txn_date, '%a') AS label, CAST(dayofweek(txn_date) AS INTEGER) AS sort_by, CAST(COUNT(*) AS BIGINT) AS txns FROM enr_a GROUP BY ALL
UNION ALL SELECT 'month', strftime(txn_date, '%b'), CAST(month(txn_date) AS INTEGER), CAST(COUNT(*) AS BIGINT) FROM enr_a GROUP BY ALL""")
    q["x1b_month_mode_state"] = with_adapter(f"""
SELECT payment_mode, CAST(COUNT(*) AS BIGINT) AS total_transactions, CAST(SUM(CASE WHEN status = 'SUCCESS' THEN amount END) AS DOUBLE) AS gpv
FROM enr_a WHERE month(txn_date) IN ({', '.join(map(str, slicers_b['txn_month']))}) AND year(txn_date) = {slicers_b['txn_year']} GROUP BY 1""")
    # ---------------- cashback
    q["b3_cashback_table"] = W("SELECT * REPLACE (CAST(cashback_amount AS DOUBLE) AS cashback_amount) FROM cashback")
    q["b4_cashback_summary"] = W("""
SELECT g.campaign_id, c.campaign_name, g.cashback_month, CAST(g.n AS BIGINT) AS cashbacks, CAST(g.amt AS DOUBLE) AS cashback_total
FROM (SELECT campaign_id, strftime(cashback_date, '%Y-%m') AS cashback_month, COUNT(*) AS n, SUM(cashback_amount) AS amt
      FROM cashback GROUP BY 1, 2) g LEFT JOIN dim_campaigns c ON c.campaign_id = g.campaign_id""")
    q["b4_cashback_total"] = W("""
SELECT CAST(COUNT(*) AS BIGINT) AS cashbacks, CAST(COALESCE(SUM(cashback_amount), 0) AS DOUBLE) AS cashback_total
FROM cashback""")
    return q
