"""Queries for joins, coverage and domain alignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanloom import schema as S
from loanloom.operators import aggregates as A
from loanloom.operators import joins as J
from loanloom.operators.ordered import latest_per
from loanloom.plans.oracle import r
from loanloom.plans.registry import query
from loanloom.sources import roles as R

SIGNAL_COLUMNS = ["loan_id", "month", "cash_flow_consistency", "balance_volatility"]
LATEST_SIGNAL = {"last_signal": """
SELECT loan_id, cash_flow_consistency, balance_volatility FROM signals
QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY month DESC) = 1"""}


@query("jn1_originations", """
SELECT loan_id, l.customer_id, risk_tier, bureau_score, apr FROM loans l LEFT JOIN customers c USING (customer_id)""")
def jn1(spark, d):
    return J.originations(R.loans(spark, d), R.customers(spark, d)).select(
        "loan_id", "customer_id", "risk_tier", "bureau_score", "apr"
    )


@query("jn2_master", """
SELECT loan_id, customer_id, risk_tier, ticket_size, final_loan_status, default_flag, max_dpd, customer_ltv,
  risk_adjusted_return, is_profitable, loss_given_default FROM master""")
def jn2(spark, d):
    return R.master(spark, d).select(
        "loan_id", "customer_id", "risk_tier", "ticket_size", *J.MASTER_OUTCOMES
    )


@query("jn2_master_wide", """
SELECT m.loan_id, m.customer_id, m.risk_tier, o.total_amount_paid, o.recovery_amount, m.default_flag
FROM master m LEFT JOIN outcomes o USING (loan_id)""", digits=2)
def jn2_wide(spark, d):
    wide = J.build_master(R.loans(spark, d), R.customers(spark, d), R.outcomes(spark, d), wide=True)
    return wide.select("loan_id", "customer_id", "risk_tier", "total_amount_paid", "recovery_amount", "default_flag")


def _obs(spark, d):
    return R.repayments(spark, d).select("loan_id", "installment_no", "dpd")


@query("jn3_attach_signals", """
SELECT p.loan_id, p.installment_no, dpd, cash_flow_consistency, balance_volatility
FROM repayments p LEFT JOIN signals s ON p.loan_id = s.loan_id AND p.installment_no = s.month""")
def jn3(spark, d):
    return J.attach_signals(_obs(spark, d), R.signals(spark, d).select(*SIGNAL_COLUMNS), mode="month")


@query("jn4_attach_latest_signal", """
SELECT loan_id, installment_no, dpd, cash_flow_consistency, balance_volatility FROM repayments LEFT JOIN last_signal USING (loan_id)""",
       views=LATEST_SIGNAL)
def jn4(spark, d):
    return J.attach_signals(_obs(spark, d), R.signals(spark, d).select(*SIGNAL_COLUMNS), mode="latest")


@query("jn5_attach_origination", """
SELECT p.loan_id, installment_no, dpd, apr, tenure_months, bureau_score FROM repayments p LEFT JOIN master USING (loan_id)""")
def jn5(spark, d):
    orig = J.originations(R.loans(spark, d), R.customers(spark, d))
    return J.attach_origination(_obs(spark, d), orig.select("loan_id", "apr", "tenure_months", "bureau_score"))


@query("jn6_match_rate", f"""
SELECT count(*) AS n_keys, count(month) AS n_matched, {r('count(month) * 100e0 / count(*)')} AS match_rate_pct
FROM repayments p LEFT JOIN signals s ON p.loan_id = s.loan_id AND p.installment_no = s.month""")
def jn6(spark, d):
    monthly = R.signals(spark, d).withColumnRenamed("month", "installment_no")
    return J.match_rate(_obs(spark, d), monthly, ["loan_id", "installment_no"])


@query("jn6_unmatched_keys", """
SELECT DISTINCT loan_id, installment_no FROM repayments p
WHERE NOT EXISTS (SELECT 1 FROM signals s WHERE s.loan_id = p.loan_id AND s.month = p.installment_no)""")
def jn6_unmatched(spark, d):
    monthly = R.signals(spark, d).withColumnRenamed("month", "installment_no")
    return J.unmatched_keys(_obs(spark, d), monthly, ["loan_id", "installment_no"])


@query("jn7_adaptive_key", """
SELECT loan_id, installment_no, dpd,
  CASE WHEN rate >= 50 THEN s.cash_flow_consistency ELSE z.cash_flow_consistency END AS cash_flow_consistency,
  CASE WHEN rate >= 50 THEN s.balance_volatility ELSE z.balance_volatility END AS balance_volatility
FROM repayments p LEFT JOIN (SELECT loan_id AS l, month, cash_flow_consistency, balance_volatility FROM signals) s
  ON p.loan_id = s.l AND p.installment_no = s.month
LEFT JOIN (SELECT loan_id AS zl, cash_flow_consistency, balance_volatility FROM last_signal) z ON p.loan_id = z.zl
CROSS JOIN (SELECT count(month) * 100e0 / count(*) AS rate FROM repayments p LEFT JOIN signals s
  ON p.loan_id = s.loan_id AND p.installment_no = s.month)""", views=LATEST_SIGNAL)
def jn7(spark, d):
    return J.attach_signals(_obs(spark, d), R.signals(spark, d).select(*SIGNAL_COLUMNS), mode="auto")


@query("jn8_lookup", """
SELECT p.loan_id, installment_no, ticket_size, monthly_income FROM repayments p
JOIN loans USING (loan_id) JOIN customers USING (customer_id)""")
def jn8(spark, d):
    lookup = R.loans(spark, d).join(R.customers(spark, d), "customer_id").select("loan_id", "ticket_size", "monthly_income")
    return R.repayments(spark, d).select("loan_id", "installment_no").join(lookup, "loan_id")


@query("jn9_attach_aggregate", f"""
SELECT acquisition_channel, n_loans, exit_rate_pct FROM
 (SELECT acquisition_channel, count(*) AS n_loans FROM active GROUP BY 1)
 LEFT JOIN (SELECT acquisition_channel, {r('avg(cooling_off_exit) * 100')} AS exit_rate_pct FROM master GROUP BY 1) USING (acquisition_channel)""")
def jn9(spark, d):
    m = R.master(spark, d)
    return A.channel_stats_with_exits(J.active_loans(m), m).select("acquisition_channel", "n_loans", "exit_rate_pct")


DOMAIN_SQL = "(VALUES " + ", ".join(f"({i}, '{g}')" for i, g in enumerate(S.GRADES)) + ") AS dom(ord, origination_risk_grade)"


@query("jn10_reindex", f"""
SELECT origination_risk_grade, n_loans FROM {DOMAIN_SQL}
LEFT JOIN (SELECT origination_risk_grade, count(*) AS n_loans FROM active GROUP BY 1) USING (origination_risk_grade)""")
def jn10(spark, d):
    stats = A.segment_stats(R.active(spark, d), "origination_risk_grade", ("n_loans",))
    return J.reindex_to(stats, "origination_risk_grade", S.GRADES)


@query("jn11_reindex_drop", f"""
SELECT origination_risk_grade, n_loans FROM {DOMAIN_SQL}
JOIN (SELECT origination_risk_grade, count(*) AS n_loans FROM active GROUP BY 1) USING (origination_risk_grade)""")
def jn11(spark, d):
    stats = A.segment_stats(R.active(spark, d), "origination_risk_grade", ("n_loans",))
    return J.reindex_to(stats, "origination_risk_grade", S.GRADES, drop=True)


@query("win4_latest_per_loan", """
SELECT loan_id, month, cash_flow_consistency, balance_volatility FROM signals
QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY month DESC) = 1""")
def win4(spark, d):
    return latest_per(R.signals(spark, d).select(*SIGNAL_COLUMNS), "loan_id", ["month"])


@query("agg15_distinct_keys", "SELECT DISTINCT loan_id FROM repayments")
def agg15(spark, d):
    return A.distinct_keys(R.repayments(spark, d), "loan_id")


@query("agg15_first_per_key", """
SELECT loan_id, installment_no, dpd FROM repayments WHERE is_defaulted = 1
QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY installment_no) = 1""")
def agg15_first(spark, d):
    defaults = _obs(spark, d).join(
        R.repayments(spark, d).where("is_defaulted = 1").select("loan_id", "installment_no"),
        ["loan_id", "installment_no"],
    )
    return latest_per(defaults, "loan_id", ["installment_no"], first=True)
