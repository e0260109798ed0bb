"""Queries for the forward label, lag features, fills and the panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanloom import schema as S
from loanloom.functions import exprs as E
from loanloom.operators import aggregates as A
from loanloom.operators import features as X
from loanloom.operators.ordered import ordered_groups
from loanloom.operators.ranking import exact_medians
from loanloom.plans.oracle import clip, r
from loanloom.plans.panel import build_panel
from loanloom.plans.registry import query
from loanloom.sources import roles as R


def _lag0(c, n):
    return f"coalesce(lag({c}, {n}) OVER w, 0)"


def _sum3(c):
    return f"({c} + {_lag0(c, 1)} + {_lag0(c, 2)})"


FEATURE_VIEWS = {
    "rep_flags": """
SELECT *, CASE dpd_bucket WHEN 'Current' THEN 0 WHEN 'DPD_1-30' THEN 1 WHEN 'DPD_31-60' THEN 2 WHEN 'DPD_61-90' THEN 3 ELSE 4 END AS b,
  CASE loan_status WHEN 'Standard' THEN 0 WHEN 'SMA-1' THEN 1 WHEN 'SMA-2' THEN 2 WHEN 'NPA' THEN 3 ELSE 4 END AS s,
  CASE WHEN payment_status = 'Missed' THEN 1 ELSE 0 END AS ms, CASE WHEN payment_status IN ('Late-1-30','Late-31-60') THEN 1 ELSE 0 END AS lt,
  CASE WHEN payment_status = 'Partial' THEN 1 ELSE 0 END AS pt, CASE WHEN payment_status = 'Paid-On-Time' THEN 1 ELSE 0 END AS ot
FROM repayments""",
    "rep_feats": f"""
SELECT loan_id, installment_no, CAST(month(due_date) AS INTEGER) AS cal_month,
  CAST(CASE WHEN lead(b) OVER w >= 2 THEN 1 ELSE 0 END AS INTEGER) AS target,
  b AS dpd_bucket_encoded, s AS sma_encoded, (s - {_lag0('s', 2)}) / 2e0 AS sma_trend,
  greatest(s, {_lag0('s', 1)}, {_lag0('s', 2)}) AS max_sma_last_3m,
  {_sum3('ms')} AS missed_payment_last_3m, {_sum3('lt')} AS late_payment_last_3m,
  CASE WHEN {_sum3('pt')} > 0 THEN 1 ELSE 0 END AS partial_payment_flag,
  {r(clip('amount_paid / nullif(emi_due, 0)', '0e0', '1e0', '0e0'), 6)} AS payment_ratio_last_month,
  greatest(dpd, {_lag0('dpd', 1)}, {_lag0('dpd', 2)}) AS max_dpd_last_3m, (dpd - {_lag0('dpd', 2)}) / 2e0 AS dpd_trend_slope,
  ms + {_lag0('ms', 1)} AS consecutive_missed, 3 - {_sum3('ot')} AS months_no_on_time,
  CASE WHEN month(due_date) IN (4,10,11) THEN 1 ELSE 0 END AS is_festival_month
FROM rep_flags WINDOW w AS (PARTITION BY loan_id ORDER BY installment_no)""",
    "obs": "SELECT * FROM rep_feats WHERE installment_no >= 4 AND dpd_bucket_encoded <= 1",
    "med": """
SELECT median(balance_volatility) AS bv, median(cash_flow_consistency) AS cf, median(CAST(income_shock_flag AS DOUBLE)) AS inc,
  median(CAST(spending_shock_flag AS DOUBLE)) AS sp, median(emi_obligation_ratio) AS eo, median(CAST(avg_monthly_inflow AS DOUBLE)) AS inf
FROM signals""",
    "sig_lags": """
SELECT s.*, coalesce(lag(balance_volatility,1) OVER w, bv) AS bv1, coalesce(lag(balance_volatility,2) OVER w, bv) AS bv2,
  coalesce(lag(cash_flow_consistency,1) OVER w, cf) AS cf1, coalesce(lag(cash_flow_consistency,2) OVER w, cf) AS cf2,
  coalesce(lag(income_shock_flag,1) OVER w, inc) AS in1, coalesce(lag(income_shock_flag,2) OVER w, inc) AS in2,
  coalesce(lag(spending_shock_flag,1) OVER w, sp) AS sp1, coalesce(lag(spending_shock_flag,2) OVER w, sp) AS sp2,
  coalesce(lag(emi_obligation_ratio,1) OVER w, eo) AS eo1, coalesce(lag(emi_obligation_ratio,2) OVER w, eo) AS eo2,
  coalesce(lag(avg_monthly_inflow,1) OVER w, inf) AS if1, coalesce(lag(avg_monthly_inflow,2) OVER w, inf) AS if2
FROM signals s CROSS JOIN med WINDOW w AS (PARTITION BY loan_id ORDER BY month)""",
    "sig_feats": f"""
SELECT loan_id, month, {r('(balance_volatility + bv1 + bv2) / 3', 6)} AS rolling_30d_balance_volatility,
  {r('(balance_volatility - bv2) / 2', 6)} AS volatility_acceleration, {r('(cash_flow_consistency - cf2) / 2', 6)} AS cash_flow_trend,
  {r('greatest(income_shock_flag, in1, in2)', 6)} AS income_shock_flag_3m, {r('income_shock_flag + in1 + in2', 6)} AS income_shock_count,
  {r('greatest(spending_shock_flag, sp1)', 6)} AS spending_shock_flag_3m,
  CASE WHEN greatest(income_shock_flag, in1, in2) >= 1 AND greatest(spending_shock_flag, sp1) >= 1 THEN 1 ELSE 0 END AS both_shocks_flag,
  {r('(emi_obligation_ratio + eo1) / 2', 6)} AS avg_emi_obligation_ratio, {r('least(cash_flow_consistency, cf1, cf2)', 6)} AS min_cash_flow_3m,
  {r(clip('(avg_monthly_inflow - if2) / nullif(if2, 0)', '-1e0', '1e0', '0e0'), 6)} AS inflow_trend,
  active_loan_accounts
FROM sig_lags""",
    "orig_feats": f"""
SELECT loan_id, customer_id, bureau_score, monthly_income, employment_stability_score, new_to_credit_flag, existing_customer,
  CASE risk_tier WHEN 'Prime' THEN 0 WHEN 'Near-Prime' THEN 1 WHEN 'Subprime' THEN 2 WHEN 'Thin-File' THEN 3 ELSE 2 END AS risk_tier_encoded,
  CASE origination_risk_grade WHEN 'A+' THEN 0 WHEN 'B' THEN 4 WHEN 'B-' THEN 5 WHEN 'C' THEN 7 WHEN 'D' THEN 8 ELSE 4 END AS grade_encoded,
  CASE acquisition_channel WHEN 'Organic-App' THEN 0e0 WHEN 'Referral' THEN 0e0 WHEN 'NBFC-Embedded' THEN 1.5e0
    WHEN 'DSA-Agent' THEN 2e0 WHEN 'Paid-Digital' THEN 2e0 ELSE 1e0 END AS channel_risk_score,
  CASE employment_type WHEN 'Salaried-Govt' THEN 0 WHEN 'Salaried-Private' THEN 1 WHEN 'Self-Employed-Prof' THEN 2
    WHEN 'Self-Employed-Business' THEN 3 WHEN 'Gig-Worker' THEN 4 WHEN 'Daily-Wage' THEN 5 WHEN 'Student' THEN 5
    WHEN 'Unemployed' THEN 6 ELSE 3 END AS employment_risk,
  CASE product_type WHEN 'Education-Loan' THEN 0.8e0 WHEN 'Consumer-Durable' THEN 1.2e0 WHEN 'SME-Working-Capital' THEN 1.5e0
    WHEN 'BNPL' THEN 2e0 ELSE 1e0 END AS product_risk,
  CASE gender WHEN 'Female' THEN 1 WHEN 'Other' THEN 2 ELSE 0 END AS gender_encoded,
  apr, tenure_months, ticket_size, emi_amount,
  {r(clip('emi_amount / nullif(monthly_income, 0)', '0e0', '1e0', '0.5e0'), 6)} AS emi_to_income_ratio,
  {r(clip('ticket_size / nullif(monthly_income * 12, 0)', '0e0', '5e0', '1e0'), 6)} AS ticket_to_income_ratio,
  {r(clip('processing_fee / nullif(ticket_size, 0)', '0e0', '0.05e0', '0.02e0'), 6)} AS processing_fee_pct,
  approval_turnaround_days, origination_date
FROM loans JOIN customers USING (customer_id)""",
    "last_feats": "SELECT * FROM sig_feats QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY month DESC) = 1",
}


def _feature_query(name, columns, digits=6):
    """Register selected repayment features over every instalment."""
    cols = ["loan_id", "installment_no", *columns]

    @query(name, f"SELECT {', '.join(cols)} FROM rep_feats", views=FEATURE_VIEWS, digits=digits)
    def run(spark, d):
        return X.repayment_features(R.repayments(spark, d)).select(*cols)


def _signal_query(name, columns, digits=6):
    cols = ["loan_id", "month", *columns]
    exprs = ["loan_id", "month", *[f"CAST({c} AS DOUBLE) AS {c}" for c in columns]]

    @query(name, f"SELECT {', '.join(exprs)} FROM sig_feats", views=FEATURE_VIEWS, digits=digits)
    def run(spark, d):
        df = X.signal_features(R.signals(spark, d))
        return df.select("loan_id", "month", *[F.col(c).cast("double").alias(c) for c in columns]).select(*cols)


@query("win1_lag_features", f"""
SELECT loan_id, installment_no, {_lag0('dpd', 1)} AS dpd_1m, {_lag0('dpd', 2)} AS dpd_2m FROM repayments
WINDOW w AS (PARTITION BY loan_id ORDER BY installment_no)""")
def win1(spark, d):
    g = ordered_groups(R.repayments(spark, d).select("loan_id", "installment_no", "dpd"), "loan_id", ["installment_no"], 2)
    w = g.window()
    return g.finish(g.frame.withColumns({"dpd_1m": X.lag0("dpd", 1, w), "dpd_2m": X.lag0("dpd", 2, w)})).drop("dpd")


@query("win2_lead", """
SELECT loan_id, installment_no, lead(dpd) OVER (PARTITION BY loan_id ORDER BY installment_no) AS next_dpd FROM repayments""")
def win2(spark, d):
    g = ordered_groups(R.repayments(spark, d).select("loan_id", "installment_no", "dpd"), "loan_id", ["installment_no"], 0, 1)
    return g.finish(g.frame.withColumn("next_dpd", F.lead("dpd", 1).over(g.window()))).drop("dpd")


@query("win3_lag_median", f"""
SELECT loan_id, month, {r('bv1', 6)} AS balance_volatility_1m, {r('bv2', 6)} AS balance_volatility_2m,
  {r('cf1', 6)} AS cash_flow_consistency_1m, {r('if2', 6)} AS avg_monthly_inflow_2m FROM sig_lags""", views=FEATURE_VIEWS, digits=6)
def win3(spark, d):
    return X.lag_median(R.signals(spark, d)).select(
        "loan_id", "month", "balance_volatility_1m", "balance_volatility_2m", "cash_flow_consistency_1m",
        "avg_monthly_inflow_2m",
    )


@query("win5_final_status", "SELECT loan_id, final_status FROM rollup")
def win5(spark, d):
    return A.loan_rollup(R.repayments(spark, d)).select("loan_id", "final_status")


@query("flt2_eligible", "SELECT loan_id, installment_no, target, dpd_bucket_encoded FROM obs", views=FEATURE_VIEWS)
def flt2(spark, d):
    return X.eligible(X.repayment_features(R.repayments(spark, d))).select(
        "loan_id", "installment_no", "target", "dpd_bucket_encoded"
    )


@query("fe2_status_flags", "SELECT loan_id, installment_no, ms AS is_missed, lt AS is_late, pt AS is_partial, ot AS is_on_time FROM rep_flags",
       views=FEATURE_VIEWS)
def fe2(spark, d):
    return R.repayments(spark, d).select(
        "loan_id", "installment_no", *[c.alias(n) for n, c in X.status_flags().items()]
    )


_feature_query("lbl1_forward_label", ["target"])
_feature_query("fe1_ordinal_encoding", ["dpd_bucket_encoded", "sma_encoded"])
_feature_query("fe3_rolling_counts", ["missed_payment_last_3m", "late_payment_last_3m"])
_feature_query("fe4_partial_flag", ["partial_payment_flag"])
_feature_query("fe5_payment_ratio", ["payment_ratio_last_month"])
_feature_query("fe6_rolling_max", ["max_dpd_last_3m", "max_sma_last_3m"])
_feature_query("fe7_slopes", ["dpd_trend_slope", "sma_trend"])
_signal_query("fe7_signal_slopes", ["cash_flow_trend", "volatility_acceleration"])
_feature_query("fe8_consecutive_missed", ["consecutive_missed"])
_feature_query("fe9_months_no_on_time", ["months_no_on_time"])
_feature_query("fe10_festival_month", ["cal_month", "is_festival_month"])
_signal_query("fe11_rolling_volatility", ["rolling_30d_balance_volatility"])
_signal_query("fe12_min_cash_flow", ["min_cash_flow_3m"])
_signal_query("fe13_income_shock", ["income_shock_flag_3m", "income_shock_count"])
_signal_query("fe14_spending_shock", ["spending_shock_flag_3m"])
_signal_query("fe15_both_shocks", ["both_shocks_flag"])
_signal_query("fe16_emi_obligation", ["avg_emi_obligation_ratio"])
_signal_query("fe17_inflow_trend", ["inflow_trend"])


def _orig_query(name, columns, digits=6):
    cols = ["loan_id", *columns]

    @query(name, f"SELECT {', '.join(cols)} FROM orig_feats", views=FEATURE_VIEWS, digits=digits)
    def run(spark, d):
        return X.origination_features(R.loans(spark, d), R.customers(spark, d)).select(*cols)


_orig_query("fe18_origination_encodings", [
    "risk_tier_encoded", "grade_encoded", "channel_risk_score", "employment_risk", "product_risk", "gender_encoded",
])
_orig_query("fe19_emi_to_income", ["emi_to_income_ratio"])
_orig_query("fe20_ticket_to_income", ["ticket_to_income_ratio"])
_orig_query("fe21_processing_fee", ["processing_fee_pct"])


@query("fe22_loan_age", "SELECT loan_id, installment_no, coalesce(installment_no, 6) AS months_since_origination FROM obs", views=FEATURE_VIEWS)
def fe22(spark, d):
    obs = X.eligible(X.repayment_features(R.repayments(spark, d))).select("loan_id", "installment_no")
    aged = obs.withColumn("months_since_origination", F.col("installment_no"))
    return X.fill_constants(aged, {"months_since_origination": 6})


@query("imp1_constant_fill", """
SELECT loan_id, installment_no, coalesce(volatility_acceleration, 0e0) AS volatility_acceleration,
  coalesce(CAST(active_loan_accounts AS DOUBLE), 1e0) AS active_loan_accounts
FROM obs LEFT JOIN (SELECT loan_id, month AS installment_no, volatility_acceleration, active_loan_accounts FROM sig_feats)
  USING (loan_id, installment_no)""", views=FEATURE_VIEWS, digits=6)
def imp1(spark, d):
    obs = X.eligible(X.repayment_features(R.repayments(spark, d))).select("loan_id", "installment_no")
    sig = X.signal_features(R.signals(spark, d)).withColumnRenamed("month", "installment_no").select(
        "loan_id", "installment_no", "volatility_acceleration", F.col("active_loan_accounts").cast("double").alias("active_loan_accounts")
    )
    return X.fill_constants(obs.join(sig, ["loan_id", "installment_no"], "left"), {
        "volatility_acceleration": 0.0, "active_loan_accounts": 1.0,
    })


@query("imp2_source_median_fill", f"""
SELECT loan_id, installment_no, {r('coalesce(rolling_30d_balance_volatility, (SELECT bv FROM med))', 6)} AS rolling_30d_balance_volatility
FROM obs LEFT JOIN (SELECT loan_id, month AS installment_no, rolling_30d_balance_volatility FROM sig_feats) USING (loan_id, installment_no)""",
       views=FEATURE_VIEWS, digits=6)
def imp2(spark, d):
    obs = X.eligible(X.repayment_features(R.repayments(spark, d))).select("loan_id", "installment_no")
    signals = R.signals(spark, d)
    sig = X.signal_features(signals).withColumnRenamed("month", "installment_no").select(
        "loan_id", "installment_no", "rolling_30d_balance_volatility"
    )
    joined = obs.join(sig, ["loan_id", "installment_no"], "left")
    return X.fill_medians(joined, signals, {"rolling_30d_balance_volatility": "balance_volatility"})


@query("imp3_panel_median_fill", f"""
SELECT loan_id, installment_no, {r('coalesce(score, (SELECT median(CASE WHEN bureau_score > 0 THEN bureau_score END) FROM obs JOIN orig_feats USING (loan_id)))', 4)} AS bureau_score
FROM (SELECT loan_id, installment_no, CASE WHEN bureau_score > 0 THEN bureau_score END AS score FROM obs JOIN orig_feats USING (loan_id))""",
       views=FEATURE_VIEWS)
def imp3(spark, d):
    obs = X.eligible(X.repayment_features(R.repayments(spark, d))).select("loan_id", "installment_no")
    orig = X.origination_features(R.loans(spark, d), R.customers(spark, d)).select(
        "loan_id", F.when(F.col("bureau_score") > 0, F.col("bureau_score")).alias("bureau_score")
    )
    panel = obs.join(orig, "loan_id", "left")
    return X.fill_medians(panel, panel, ["bureau_score"])


@query("imp4_null_audit", """
SELECT count(*) FILTER (WHERE cash_flow_consistency IS NULL) AS cash_flow_consistency,
  count(*) FILTER (WHERE final_loan_status IS NULL) AS final_loan_status,
  count(*) FILTER (WHERE cash_flow_consistency IS NULL) + count(*) FILTER (WHERE final_loan_status IS NULL) AS total_nulls
FROM master LEFT JOIN signals USING (loan_id)""")
def imp4(spark, d):
    joined = R.master(spark, d).join(R.signals(spark, d).select("loan_id", "cash_flow_consistency"), "loan_id", "left")
    return A.null_audit(joined, ["cash_flow_consistency", "final_loan_status"])


@query("agg21_exact_median", f"""
SELECT {r('bv', 4)} AS balance_volatility, {r('cf', 4)} AS cash_flow_consistency, {r('eo', 4)} AS emi_obligation_ratio FROM med""",
       views=FEATURE_VIEWS)
def agg21(spark, d):
    return exact_medians(R.signals(spark, d), ["balance_volatility", "cash_flow_consistency", "emi_obligation_ratio"])


def _panel_sql(monthly: bool = False) -> str:
    rep = [c for c in S.REPAYMENT_FEATURES]
    medians = {"rolling_30d_balance_volatility": "bv", "avg_emi_obligation_ratio": "eo", "min_cash_flow_3m": "cf"}
    signal = [
        f"{r(f'coalesce(z.{c}, (SELECT {medians[c]} FROM med))', 6)} AS {c}" if c in medians
        else f"CAST(coalesce(z.{c}, {1 if c == 'active_loan_accounts' else 0}) AS DOUBLE) AS {c}"
        for c in S.SIGNAL_FEATURES
    ]
    orig = [f"CAST(o.{c} AS DOUBLE) AS {c}" for c in S.ORIGINATION_FEATURES if c != "months_since_origination"]
    return (
        "SELECT p.loan_id, p.installment_no, p.target, "
        + ", ".join([f"CAST(p.{c} AS DOUBLE) AS {c}" for c in rep] + signal + orig)
        + ", CAST(p.installment_no AS DOUBLE) AS months_since_origination "
        + ("FROM obs p LEFT JOIN sig_feats z ON z.loan_id = p.loan_id AND z.month = p.installment_no " if monthly
           else "FROM obs p LEFT JOIN last_feats z ON z.loan_id = p.loan_id ")
        + "LEFT JOIN orig_feats o ON o.loan_id = p.loan_id"
    )


@query("pan1_panel_monthly", _panel_sql(monthly=True), views=FEATURE_VIEWS, digits=6)
def pan1_monthly(spark, d):
    return _panel(spark, d, "month")


@query("pan1_panel", _panel_sql(), views=FEATURE_VIEWS, digits=6)
def pan1(spark, d):
    return _panel(spark, d, "auto")


def _panel(spark, d, mode):
    panel = build_panel(R.repayments(spark, d), R.signals(spark, d), R.loans(spark, d), R.customers(spark, d), mode=mode)
    return panel.select("loan_id", "installment_no", "target", *[F.col(c).cast("double").alias(c) for c in S.FEATURES])


@query("fe19_clip_without_default", f"""
SELECT loan_id, {r(clip('emi_amount / nullif(monthly_income, 0)', '0e0', '1e0'), 6)} AS clipped FROM master""", digits=6)
def clip_ratio(spark, d):
    return R.master(spark, d).select("loan_id", E.clip(E.ratio("emi_amount", "monthly_income"), 0.0, 1.0).alias("clipped"))
