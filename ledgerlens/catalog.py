"""Registry of every implemented query: name -> (spark, sf_dir) -> DataFrame.

Parameters that depend on the fixture (FIXTURES.md part 2.4) are set here;
the plan functions keep the reference defaults.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.plans import customers as Q2
from ledgerlens.plans import executive as Q1
from ledgerlens.plans import failures as Q5
from ledgerlens.plans import merchants as Q3
from ledgerlens.plans import regional as Q6
from ledgerlens.plans import trends as Q4
from ledgerlens.plans import views as V
from ledgerlens.session import ensure_checkpoint_dir
from ledgerlens.sources.adapter import ROW_KEY, Tables, tables

# Fixture parameters (FIXTURES.md 2.4).
EDGES_A = (5000, 15000, 30000, 60000, 90000)
EDGES_B = (5, 20, 50, 100, 200)
Q35_MIN_TXNS = 20
COHORT_START = "1995-01"
COHORTS = 24
SINCE = "2000-01-01"

QueryFn = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return tables(spark, sf_dir)


def _ea(fn):
    """Query over the enriched fact A."""
    return lambda spark, sf: fn(V.enriched(_t(spark, sf), "A"))


def _eb(fn):
    """Query over the enriched fact B (time of day)."""
    return lambda spark, sf: fn(V.enriched(_t(spark, sf), "B"))


def _enriched_out(spark, sf):
    e = V.enriched(_t(spark, sf), "A")
    return e.select(*[F.col(c).cast("double").alias(c) if c in ("amount", "revenue", "commission_rate")
                      else F.col(c) for c in V.ENRICHED_COLUMNS])


def _q21(spark, sf):
    t = _t(spark, sf)
    return Q2.clv_leaderboard(V.enriched(t, "A"), t.customers, Q2.newest_date(t.transactions_a))


def _q23(spark, sf):
    t = _t(spark, sf)
    return Q2.rfm_segments(V.enriched(t, "A"), Q2.newest_date(t.transactions_a))


def _q24(spark, sf):
    t = _t(spark, sf)
    return Q2.inactive_customers(t.transactions_a, t.customers)


def _q25(spark, sf):
    t = _t(spark, sf)
    return Q2.cohort_retention(t.transactions_a, t.customers, start=COHORT_START, n=COHORTS)


def _q58(spark, sf):
    t = _t(spark, sf)
    return Q5.gpv_lost(V.enriched(t, "A"), t.merchants)


def _r2(spark, sf):
    t = _t(spark, sf)
    return Q6.city_segmentation(V.enriched(t, "A"), t.customers, since=SINCE)


def _b1(spark, sf):
    from ledgerlens.plans import cashback as B
    e = V.enriched(_t(spark, sf), "A")
    return B.campaign_totals(B.eligible(e, None, B.monthly_campaigns(e)))


def registry() -> dict[str, QueryFn]:
    q: dict[str, QueryFn] = {
        "v1_enriched_fact": _enriched_out,
        "v2_monthly_summary": _ea(V.monthly_summary),
        # 01 executive
        "q1_1_headline_kpis": _ea(Q1.headline_kpis),
        "q1_2_monthly_trend": _ea(Q1.monthly_trend),
        "q1_3_mom_growth": _ea(Q1.mom_growth),
        "q1_4_quarterly_summary": _ea(Q1.quarterly_summary),
        "q1_5_payment_mode_mix": _ea(Q1.payment_mode_mix),
        # 02 customers
        "q2_1_clv_leaderboard": _q21,
        "q2_2_repeat_rate": lambda s, sf: Q2.repeat_rate(_t(s, sf).transactions_a),
        "q2_3_rfm_segments": _q23,
        "q2_4_inactive_customers": _q24,
        "q2_5_cohort_retention": _q25,
        "q2_6_demographics": _ea(Q2.demographics),
        # 03 merchants
        "q3_1_top_merchants": _ea(Q3.top_merchants),
        "q3_2_category_performance": _ea(Q3.category_performance),
        "q3_3_top_merchant_per_category": _ea(Q3.top_merchant_per_category),
        "q3_4_pareto": _ea(Q3.pareto),
        "q3_5_merchant_success_rates": _ea(lambda e: Q3.merchant_success_rates(e, min_txns=Q35_MIN_TXNS)),
        "r1_top_merchants": _ea(Q3.readme_top_merchants),
        # 04 trends
        "q4_1_hourly_distribution": _eb(Q4.hourly_distribution),
        "q4_2_weekday_pattern": _eb(Q4.weekday_pattern),
        "q4_3_daily_volume": _eb(Q4.daily_volume),
        "q4_4_cumulative_revenue": _ea(Q4.cumulative_revenue),
        "q4_5_daily_active_users": _eb(Q4.daily_active_users),
        "q4_6_stickiness": _ea(Q4.stickiness),
        "q4_6b_true_stickiness": _ea(Q4.true_stickiness),
        # 05 failures
        "q5_1_status_breakdown": _ea(Q5.status_breakdown),
        "q5_2_bank_failure_rank": _ea(Q5.bank_failure_rank),
        "q5_3_failure_reasons": _ea(Q5.failure_reasons),
        "q5_4_reason_mix_by_bank_type": _ea(Q5.reason_mix_by_bank_type),
        "q5_5_failure_by_os": _ea(Q5.failure_by_os),
        "q5_6_failure_by_ticket_band": _ea(lambda e: Q5.failure_by_ticket_band(e, EDGES_A)),
        "q5_7_failure_by_hour": _eb(Q5.failure_by_hour),
        "q5_8_gpv_lost": _q58,
        # 06 regional
        "q6_1_state_scorecard": _ea(Q6.state_scorecard),
        "q6_2_top_cities": _ea(Q6.top_cities),
        "q6_3_state_revenue_share": _ea(Q6.state_revenue_share),
        "q6_4_top_category_per_state": _ea(Q6.top_category_per_state),
        "q6_5_state_success_rates": _ea(Q6.state_success_rates),
        "r2_city_segmentation": _r2,
        # variants the survey asks for next to the as-written queries
        "q2_5b_cohort_with_signups": lambda s, sf: Q2.cohort_retention(
            _t(s, sf).transactions_a, _t(s, sf).customers, start=COHORT_START, n=COHORTS, with_signups=True),
        "q3_5b_worst_merchants": _ea(lambda e: Q3.merchant_success_rates(e, min_txns=Q35_MIN_TXNS, ascending=True)),
        "q4_3b_daily_volume_spine": _eb(Q4.daily_volume_spine),
        # mechanisms that the rows above need at scale
        "q4_3c_moving_ticket": lambda s, sf: Q4.moving_ticket(_t(s, sf).transactions_a),
        "q4_6c_sketched_active_users": _ea(Q4.sketched_active_users),
        "b1_overlapping_campaigns": _b1,
    }
    q.update(extended_registry())
    return q


def oracle() -> dict[str, str]:
    from ledgerlens.oracle import kpis
    from ledgerlens.oracle import extended
    from ledgerlens.oracle import loading
    out = kpis.build(edges_a=EDGES_A, q35_min=Q35_MIN_TXNS, cohort_start=COHORT_START,
                     cohorts=COHORTS, since=SINCE)
    out.update(extended.build(edges_a=EDGES_A, slicers=SLICERS_X1, slicers_b=SLICERS_X1B, drill_merchant=DRILL_MERCHANT,
                              reasons=FAILURE_REASONS_A, categories=CATEGORIES_A))
    out.update(loading.build())
    return out


# --------------------------------------------------------------------------
# Families beyond the 35 SQL queries.
# --------------------------------------------------------------------------
from ledgerlens.plans import cashback as B  # noqa: E402
from ledgerlens.plans import lattice as LA  # noqa: E402
from ledgerlens.plans import features as FE  # noqa: E402
from ledgerlens.plans import loading as LD  # noqa: E402
from ledgerlens.plans import measures as M  # noqa: E402
from ledgerlens.plans import quality as C  # noqa: E402
from ledgerlens.plans import stats as ST  # noqa: E402
from ledgerlens.plans import visuals as P  # noqa: E402
from ledgerlens.sources import io as IO  # noqa: E402

# Reasons and categories of the fixture, listed for pivots (no discovery job).
FAILURE_REASONS_A = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
CATEGORIES_A = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
SLICERS_X1B = {"txn_month": [1, 2, 3], "customer_state": [], "txn_year": 1996}
SLICERS_X1 = {"txn_year": [1996, 1997], "merchant_category": ["ECONOMY", "PROMO", "STANDARD"]}
DRILL_MERCHANT = 7


def _double_decimals(df: DataFrame) -> DataFrame:
    from pyspark.sql import types as T
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def analysis_frame(t: Tables) -> DataFrame:
    """V3 (cleaned, left-joined), planned from the sources: readers move the columns that they read."""
    return t._memo("v3", lambda: V.analysis_frame(t, "A"))


def txn_features(t: Tables, high_value: bool = True, write: bool = False) -> DataFrame:
    """F10 where ``build_store`` wrote it (``write``), else planned; without ``high_value`` F6 may be left out."""
    from ledgerlens.plans.store import materialized
    return t._memo(("tfeat", high_value, write), lambda: materialized(
        t.spark, "transactions_features", V.source_paths(t, "A"),
        lambda: FE.engineer_transaction_features(analysis_frame(t), high_value=high_value), partition_by="txn_year_month", write=write))


def customer_features(t: Tables, write: bool = False, from_txn: DataFrame | None = None) -> DataFrame:
    """U8 where ``build_store`` wrote it (``write``), else from ``from_txn``, stored rows, if given, or the planned F10."""
    from ledgerlens.plans.store import materialized
    return t._memo(("cfeat", write), lambda: materialized(
        t.spark, "customer_features", V.source_paths(t, "A"),
        lambda: FE.engineer_customer_features(txn_features(t) if from_txn is None else from_txn, t.customers, stored=from_txn is not None), write=write))


def _decisions(spark, sf):
    """All tests and the customer features read the columns that they share of F10, written once; F6 is found there too."""
    from ledgerlens.plans.store import kept
    t = _t(spark, sf)
    shared = dict.fromkeys([*ST.DECISION_INPUTS, *FE.CUSTOMER_FEATURE_INPUTS])
    tf = kept(txn_features(t, high_value=False).select(*[c for c in shared if c != "high_value_flag"]), "decision-inputs")
    return ST.decisions(tf, customer_features(t, from_txn=FE.with_high_value(tf, tf)))


def _lattice(t: Tables) -> LA.Lattice:
    return LA.Lattice(V.enriched(t, "A"), "A", V.source_paths(t, "A"))


def _la(fn):
    """Query over the aggregate lattice of the enriched fact A."""
    return lambda spark, sf: fn(_lattice(_t(spark, sf)))


def _tf(fn, high_value: bool = False):
    return lambda spark, sf: fn(txn_features(_t(spark, sf), high_value))


def _cf(fn):
    return lambda spark, sf: fn(customer_features(_t(spark, sf)))


def _cashback_of(t: Tables, cleaned: DataFrame, campaigns: DataFrame) -> DataFrame:
    """B1-B3 over V3 of those rows that can qualify: the dimensions are joined to few rows."""
    return B.cashback_from_frame(V.joined(t, B.on_campaign_days(cleaned, campaigns)), campaigns)


def _cashback(t: Tables) -> DataFrame:
    return t._memo("cashback", lambda: _cashback_of(t, V.cleaned(t), t.campaigns))


def _all_tables(t: Tables) -> dict[str, DataFrame]:
    return {"banks": t.banks, "devices": t.devices, "merchants": t.merchants, "campaigns": t.campaigns,
            "customers": t.customers, "transactions": t.transactions_a, "cashback": _cashback(t)}


def _loaded(t: Tables) -> dict[str, DataFrame]:
    """The tables as loaded from cleaned files, written anew for each ``Tables``.

    The raw files and the cashback both read fact A: its rows are written once, each with its place among those of its id (C2).
    """
    def build():
        from ledgerlens.plans.store import kept
        rows = kept(C.numbered_in_place(t.fact_a(), ROW_KEY).drop(*ROW_KEY, "amount_cents"), "fact")
        firsts = C.clean_rows(rows.where("__nth = 1").drop("__nth"))
        return LD.load(t.spark, _all_tables(t) | {"transactions": rows.drop("__nth"), "cashback": _cashback_of(t, firsts, t.campaigns)})
    return t._memo("loaded", build)


def build_store(spark: SparkSession, sf_dir: str) -> None:
    """Write the stored tables for the present inputs in one explicit step; queries that find none plan from the sources."""
    t = _t(spark, sf_dir)
    for fact in "AB":
        V.enriched(t, fact, write=True)
    txn_features(t, write=True)
    customer_features(t, write=True)


def extended_registry() -> dict[str, QueryFn]:
    def tx(spark, sf):
        return _t(spark, sf).transactions_a

    q: dict[str, QueryFn] = {
        # views
        "v3_analysis_frame": lambda s, sf: _double_decimals(
            analysis_frame(_t(s, sf)).drop("amount_cents", "commission_bp")),
        "v4_dim_date": lambda s, sf: V.dim_date_for(_t(s, sf).transactions_a),
        # quality
        "c1_quality_audit": lambda s, sf: C.data_quality_report(tx(s, sf)),
        "c2_dedupe_first": lambda s, sf: _double_decimals(C.dedupe_first(tx(s, sf)).drop("amount_cents")),
        "c6_cleaning_actions": lambda s, sf: C.cleaning_actions(tx(s, sf)),
        "c7_audit_issues": lambda s, sf: C.audit_issues(C.data_quality_report(tx(s, sf))),
        "c7b_total_issues": lambda s, sf: C.total_issues(C.data_quality_report(tx(s, sf))),
        "c8_orphans": lambda s, sf: C.orphan_counts(_all_tables(_t(s, sf))),
        "c9_load_kpis": _ea(C.load_kpis),
        "c10_worst_banks": _ea(C.worst_banks),
        "c11_key_completeness": lambda s, sf: C.key_completeness(tx(s, sf), min_amount=0.01),
        # sources
        "s7_row_counts": lambda s, sf: IO.row_counts(_all_tables(_t(s, sf))),
        "s3_round_trip": lambda s, sf: IO.round_trip(_all_tables(_t(s, sf)), f"{ensure_checkpoint_dir(s)}/round-trip-{uuid.uuid4().hex}"),
        # the load over files with planted defects
        "s1_raw_audit": lambda s, sf: C.data_quality_report(LD.raw_files(s, tx(s, sf))),
        "s1_raw_cleaning": lambda s, sf: C.cleaning_actions(LD.raw_files(s, tx(s, sf))),
        "s2_loaded_tables": lambda s, sf: LD.loaded_tables(_loaded(_t(s, sf))),
        "s4_feature_files": lambda s, sf: LD.feature_files(s, _loaded(_t(s, sf))),
        "s5_star_files": lambda s, sf: LD.star_files(s, _loaded(_t(s, sf))),
        "s6_view_answer": lambda s, sf: LD.view_answer(s, _loaded(_t(s, sf))),
        # features
        "f9_success_amount": lambda s, sf: FE.success_amount(txn_features(_t(s, sf), high_value=False)).select(
            "transaction_id", F.col("success_amount").cast("double").alias("success_amount")),
        "f10_transaction_features": lambda s, sf: _double_decimals(
            txn_features(_t(s, sf)).drop("amount_cents", "revenue_cents")),
        "u8_customer_features": lambda s, sf: _double_decimals(customer_features(_t(s, sf))),
        # measures
        "m_kpi_card": _ea(M.kpi_card),
        "m_customer_card": lambda s, sf: M.customer_card(customer_features(_t(s, sf)), V.enriched(_t(s, sf), "A")),
        "m14_gpv_previous_month": _ea(lambda e: M.previous_month(e, "gpv")),
        "m15_revenue_previous_month": _ea(lambda e: M.previous_month(e, "revenue")),
        "m16_transactions_previous_month": _ea(lambda e: M.previous_month(e, "transactions")),
        "m17_year_to_date": _ea(M.year_to_date),
        "m20_cumulative_revenue_in_range": _ea(lambda e: M.cumulative_revenue_in_range(e, "1996-01-01", "1997-12-31")),
        "m21_repeat_customers": _ea(lambda e: M.repeat_customers(e, by=["merchant_category"])),
        "m25_new_customers_by_date": lambda s, sf: M.new_customers_by_date(
            V.dim_date_for(_t(s, sf).transactions_a), _t(s, sf).customers),
        "m30_merchant_revenue_rank": _ea(M.merchant_revenue_rank),
        "m33_peak_hour": _eb(M.peak_hour),
        "m35_active_customers_30d": lambda s, sf: M.active_customers_last_days(
            V.enriched(_t(s, sf), "A"), Q2.newest_date(_t(s, sf).transactions_a)),
        "m38_top_merchant_revenue": _ea(M.top_merchant_revenue),
        "m40_most_common_failure_reason": _ea(M.most_common_failure_reason),
        "m42_base_failure_rate_avg": lambda s, sf: M.base_failure_rate_avg(_t(s, sf).banks),
        "m43_bank_success_rate": _ea(M.bank_success_rate),
        "m50_ticket_band_column": _ea(lambda e: _double_decimals(M.ticket_band_column(e, EDGES_A))),
        "x1_sliced_measures": _la(lambda lattice: lattice.answer(
            ["total_transactions", "gpv", "total_revenue", "success_rate_pct", "active_customers"],
            by=["txn_year", "merchant_category"], slicers=SLICERS_X1)),
        "x1b_month_mode_state": _la(lambda lattice: lattice.answer(
            ["total_transactions", "gpv"], by=["payment_mode"], slicers=SLICERS_X1B)),
        "x5_sorted_labels": _ea(lambda e: M.sorted_labels(e)),
        "x2_drill_through_merchant": _ea(lambda e: _double_decimals(M.drill_through(e, "merchant_id", DRILL_MERCHANT))),
        "x3_visual_top_n": _ea(lambda e: M.visual_top_n(
            M.measure_query(e, ["total_revenue", "total_transactions"], by=["customer_state"]),
            "total_revenue", "customer_state", 5)),
        # visuals
        "p1_revenue_by_payment_mode": _la(LA.revenue_by_payment_mode),
        "p2_revenue_by_quarter": _la(LA.revenue_by_quarter),
        "p3_customers_per_segment": _cf(P.customers_per_segment),
        "p4_rfm_scatter": _cf(P.rfm_scatter),
        "p5_clv_top": _cf(P.clv_top),
        "p6_customers_by_gender": _cf(P.customers_by_gender),
        "p7_recency_histogram": _cf(P.recency_histogram),
        "p8_new_customers_by_month": lambda s, sf: P.new_customers_by_month(_t(s, sf).customers),
        "p9_category_merchant_hierarchy": _ea(P.category_merchant_hierarchy),
        "p10_category_matrix": _ea(P.category_matrix),
        "p11_merchant_scatter": lambda s, sf: P.merchant_scatter(V.enriched(_t(s, sf), "A"), _t(s, sf).merchants),
        "p12_month_weekday_heatmap": _ea(P.month_weekday_heatmap),
        "p13_bank_type_reason_matrix": _ea(lambda e: P.bank_type_reason_matrix(e, FAILURE_REASONS_A)),
        "p14_state_category_matrix": _ea(lambda e: P.state_category_matrix(e, CATEGORIES_A)),
        "p15_top5_merchants": _ea(P.top_merchants_revenue),
        "p15_success_failed_split": _ea(P.success_failed_split),
        "p15_revenue_trend": _ea(P.revenue_trend),
        "p16_txns_by_city": _ea(P.txns_by_city),
        "p16_avg_amount_by_age": _ea(P.avg_amount_by_age),
        "p17_commission_by_merchant": _ea(P.commission_by_merchant),
        "p17_txns_by_category": _ea(P.txns_by_category),
        "p18_bank_volume_share": lambda s, sf: LA.bank_volume_share(_lattice(_t(s, sf)), _t(s, sf).banks),
        "p18_os_share": _la(LA.os_share),
        "p19_transaction_detail": lambda s, sf: P.transaction_detail(
            V.enriched(_t(s, sf), "A"), _t(s, sf).customers, after=("1996-06-30", "99999")),
        "p20_failure_rate_by_date": _ea(P.failure_rate_by_date),
        "p21_bank_reason_failures": _ea(P.bank_reason_failures),
        "p22_regional_table": _ea(P.regional_table),
        "p23_top10_revenue_share": _ea(P.top_n_share),
        # exploratory
        "n1_describe_amount": _tf(ST.describe),
        "n2_amount_histogram_p99": _tf(ST.amount_histogram_p99),
        "n3_log10_histogram": _tf(ST.log10_histogram),
        "n4_status_share": _tf(ST.status_share),
        "n5_monthly_eda": _tf(ST.monthly_eda),
        "n6_txns_by_hour": _tf(ST.txns_by_hour),
        "n7_txns_by_weekday": _tf(ST.txns_by_weekday),
        "n8_category_eda": _tf(ST.category_eda),
        "n9_state_eda": _tf(ST.state_eda),
        "n10_bank_failure_mean": _tf(ST.bank_failure_mean),
        "n11_failure_reason_counts": _tf(ST.failure_reason_counts),
        "n12_correlation_matrix": _cf(ST.correlation_matrix),
        "n13_first_rows": _tf(lambda tf: _double_decimals(ST.first_rows(
            tf, ["transaction_id", "amount", "txn_hour", "txn_day_name", "is_weekend", "high_value_flag",
                 "ticket_band", "daypart", "revenue", "merchant_category"], ["transaction_id"])), high_value=True),
        "n14_append_frames": lambda s, sf: ST.append_frames(
            _t(s, sf).transactions_a.select("transaction_id", "customer_id", "amount"),
            _t(s, sf).transactions_b.select("transaction_id", "customer_id", "amount")).select(
            "transaction_id", "customer_id", F.col("amount").cast("double")),
        # statistics
        "t1_describe_successful": _tf(lambda tf: ST.describe(ST.successful_amounts(tf))),
        "t2_shape": _tf(ST.shape_stats),
        "t3_log_histogram": _tf(ST.log_histogram),
        "t4_qq_points": _tf(ST.qq_points),
        "t5_iqr_outliers": _tf(ST.iqr_outliers),
        "t6_zscore_outliers": _tf(ST.zscore_outliers),
        "t7_boxplot_stats": _tf(ST.boxplot_stats),
        "t7b_abs_z_histogram": _tf(ST.abs_z_histogram),
        "t8_mean_ci_stat": _tf(ST.mean_ci_stat),
        "t8_mean_ci": _tf(ST.mean_ci),
        "t9_bootstrap_ci": _tf(ST.bootstrap_ci),
        "t10_correlation_dropna": _cf(lambda cf: ST.correlation_matrix(cf, ST.T10_FEATURES, dropna=True)),
        "t11_pearson_stat": _cf(ST.pearson_pairs_stat),
        "t11_pearson_test": _cf(ST.pearson_pairs),
        "t12_weekend_groups": _tf(ST.weekend_groups),
        "t12_welch_stat": _tf(ST.welch_stat),
        "t12_welch_test": _tf(ST.welch_test),
        "t13_mann_whitney_stat": _tf(ST.mann_whitney_stat),
        "t13_mann_whitney_test": _tf(ST.mann_whitney),
        "t15_anova_stat": _tf(ST.anova_stat),
        "t15_anova_test": _tf(ST.anova),
        "t16_category_ticket_stats": _tf(ST.category_ticket_stats),
        "t17_bank_type_status_table": _tf(ST.bank_type_status_table),
        "t18_chi_square_stat": _tf(ST.bank_type_chi_square_stat),
        "t18_chi_square_test": _tf(ST.bank_type_chi_square),
        "t19_failure_rate_by_bank_type": _tf(ST.failure_rate_by_bank_type),
        "t20_os_failure_table": _tf(ST.os_failure_table),
        "t20_os_chi_square_stat": _tf(ST.os_chi_square_stat),
        "t20_os_chi_square_test": _tf(ST.os_chi_square),
        "t21_decisions": _decisions,
        # cashback
        "b3_cashback_table": lambda s, sf: _double_decimals(_cashback(_t(s, sf))),
        "b4_cashback_summary": lambda s, sf: B.cashback_summary(_cashback(_t(s, sf)), _t(s, sf).campaigns),
        "b4_cashback_total": lambda s, sf: B.cashback_total(_cashback(_t(s, sf))),
    }
    return q
