"""Plain SQL counterparts: the role views as CTEs, and the rounding both sides share."""

from __future__ import annotations


def r(expr: str, digits: int = 4) -> str:
    """Decimal half-up rounding, as Spark's ``round`` does it on doubles."""
    return f"CAST(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,{digits})) AS DOUBLE)"


def clip(expr: str, lo: str, hi: str, default: str = "NULL") -> str:
    """Clamp to [lo, hi]; ``greatest`` and ``least`` alone would skip nulls."""
    return f"CASE WHEN ({expr}) IS NULL THEN {default} ELSE greatest({lo}, least({hi}, {expr})) END"


def months(col: str) -> str:
    return f"strftime({col}, '%Y-%m')"


BUCKET_SQL = (
    "CASE WHEN {0} = 0 THEN 'Current' WHEN {0} <= 30 THEN 'DPD_1-30' WHEN {0} <= 60 THEN 'DPD_31-60' "
    "WHEN {0} <= 90 THEN 'DPD_61-90' ELSE 'DPD_90+' END"
)
MARGIN_SQL = (
    "(ticket_size * apr * (tenure_months / 12e0) + processing_fee - (cost_of_acquisition + ticket_size * 0.02e0))"
)

VIEWS = {
    "customers": """
SELECT c_custkey AS customer_id,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Prime' WHEN 'BUILDING' THEN 'Near-Prime'
    WHEN 'FURNITURE' THEN 'Subprime' WHEN 'HOUSEHOLD' THEN 'Thin-File' ELSE 'Unrated' END AS risk_tier,
  n_name AS city,
  CASE WHEN r_name IN ('AMERICA','EUROPE') THEN 'Metro' WHEN r_name = 'ASIA' THEN 'Tier-2' ELSE 'Tier-3' END AS geo_tier,
  r_name AS state, CAST(c_custkey % 40 + 21 AS INTEGER) AS age,
  CASE c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Other' END AS gender,
  CASE c_nationkey % 9 WHEN 0 THEN 'Salaried-Govt' WHEN 1 THEN 'Salaried-Private' WHEN 2 THEN 'Self-Employed-Prof'
    WHEN 3 THEN 'Self-Employed-Business' WHEN 4 THEN 'Gig-Worker' WHEN 5 THEN 'Daily-Wage' WHEN 6 THEN 'Unemployed'
    WHEN 7 THEN 'Student' ELSE 'Freelance' END AS employment_type,
  CAST(c_nationkey % 10 + 1 AS INTEGER) AS employment_stability_score,
  c_acctbal AS monthly_income,
  CAST(CASE WHEN (c_custkey * 37) % 901 < 300 THEN 0 ELSE (c_custkey * 37) % 901 END AS INTEGER) AS bureau_score,
  CAST(CASE WHEN (c_custkey * 37) % 901 < 300 THEN 1 ELSE 0 END AS INTEGER) AS new_to_credit_flag,
  CAST(c_custkey % 2 AS INTEGER) AS existing_customer,
  CASE c_custkey % 5 WHEN 3 THEN 'Video-KYC' WHEN 4 THEN 'Physical' ELSE 'Aadhaar-OTP' END AS kyc_type
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "loan_base": """
SELECT o_orderkey AS loan_id, o_custkey AS customer_id,
  CASE o_orderkey % 7 WHEN 0 THEN 'Personal-Loan' WHEN 1 THEN 'SME-Working-Capital' WHEN 2 THEN 'BNPL'
    WHEN 3 THEN 'Two-Wheeler-Loan' WHEN 4 THEN 'Consumer-Durable' WHEN 5 THEN 'Education-Loan' ELSE 'Gold-Loan' END AS product_type,
  o_totalprice AS ticket_size, CAST((o_orderkey * 7) % 60 + 1 AS INTEGER) AS tenure_months,
  CASE WHEN o_orderkey % 50 = 0 THEN 0e0 ELSE (o_custkey % 25 + 8) / 100e0 END AS apr,
  CAST(floor(o_totalprice * (o_orderkey % 6 + 1) / 200e0) AS INTEGER) AS processing_fee,
  CAST(o_orderdate AS DATE) AS origination_date,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'A+' WHEN '2-HIGH' THEN 'B' WHEN '3-MEDIUM' THEN 'B-'
    WHEN '4-NOT SPECIFIED' THEN 'C' ELSE 'D' END AS origination_risk_grade,
  CASE o_custkey % 8 WHEN 0 THEN 'Organic-App' WHEN 1 THEN 'Referral' WHEN 2 THEN 'Paid-Digital' WHEN 3 THEN 'DSA-Agent'
    WHEN 4 THEN 'Bank-Partnership' WHEN 5 THEN 'Corporate-Tie-Up' WHEN 6 THEN 'NBFC-Embedded' ELSE 'Walk-In' END AS acquisition_channel,
  CAST(o_orderkey % 19 * 100 + 400 AS INTEGER) AS cost_of_acquisition,
  CAST(o_orderkey % 5 + CASE WHEN o_orderkey % 5 = 4 THEN 1 ELSE 0 END AS INTEGER) AS approval_turnaround_days,
  CAST(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS INTEGER) AS cooling_off_exit
FROM orders""",
    "loans": f"""
SELECT *, {r('''CASE WHEN apr > 0 AND product_type <> 'BNPL'
    THEN ticket_size * (apr / 12e0) * pow(apr / 12e0 + 1e0, tenure_months) / (pow(apr / 12e0 + 1e0, tenure_months) - 1e0)
    ELSE ticket_size / tenure_months END''', 2)} AS emi_amount FROM loan_base""",
    "lines": """
SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey) AS INTEGER) AS installment_no,
  CAST(round(l_discount * 1000) AS INTEGER) AS d
FROM lineitem""",
    "repayments": f"""
SELECT l_orderkey AS loan_id, installment_no, CAST(l_shipdate AS DATE) AS due_date, CAST(l_shipdate AS DATE) + d AS payment_date,
  l_extendedprice AS emi_due, floor(l_extendedprice * (100 - round(l_discount * 100))) / 100e0 AS amount_paid,
  CASE WHEN l_returnflag = 'A' THEN 'Paid-On-Time' WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'Late-1-30'
    WHEN l_returnflag = 'N' THEN 'Late-31-60' WHEN l_linestatus = 'O' THEN 'Partial' ELSE 'Missed' END AS payment_status,
  d AS dpd, {BUCKET_SQL.format('d')} AS dpd_bucket,
  CASE WHEN d > 90 AND l_linestatus = 'F' THEN 'Defaulted' WHEN d > 90 THEN 'NPA' WHEN d > 30 THEN 'SMA-2'
    WHEN d > 0 THEN 'SMA-1' ELSE 'Standard' END AS loan_status,
  CAST(CASE WHEN d > 90 AND l_linestatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS is_defaulted
FROM lines""",
    "user_days": f"""
SELECT user_id AS customer_id, CAST(extract(day FROM ts) AS INTEGER) AS month,
  count(DISTINCT event_type) / 5e0 AS cash_flow_consistency,
  {r('stddev_pop(value) / nullif(avg(value), 0)')} AS balance_volatility,
  max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS income_shock_flag,
  max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS spending_shock_flag,
  CAST(round(sum(value) * 100) AS BIGINT) AS avg_monthly_inflow,
  {r(clip('max(value) / nullif(sum(value), 0)', '0.01e0', '0.9e0'), 3)} AS emi_obligation_ratio,
  CAST(count(*) AS INTEGER) AS active_loan_accounts
FROM events GROUP BY 1, 2""",
    "signals": """
SELECT loan_id, customer_id, month, cash_flow_consistency, balance_volatility, income_shock_flag, spending_shock_flag,
  avg_monthly_inflow, emi_obligation_ratio, active_loan_accounts
FROM loan_base JOIN user_days USING (customer_id) WHERE cooling_off_exit = 0""",
    "rollup": """
SELECT loan_id, sum(amount_paid) AS total_paid, count(*) AS installments, max(dpd) AS max_dpd,
  max(is_defaulted) AS is_defaulted, arg_max(loan_status, installment_no) AS final_status
FROM repayments GROUP BY 1""",
    "outcome_base": """
SELECT l.*, total_paid, installments, max_dpd, is_defaulted, final_status,
  CASE WHEN is_defaulted = 1 THEN CAST(trunc((ticket_size - total_paid) * (loan_id % 41 / 100e0 + 0.25e0)) AS INTEGER) ELSE 0 END AS rec
FROM loans l LEFT JOIN rollup USING (loan_id) WHERE cooling_off_exit = 1 OR installments IS NOT NULL""",
    "outcome_loss": """
SELECT *, CASE WHEN is_defaulted = 1 THEN greatest(0e0, ticket_size - total_paid - rec) ELSE 0e0 END AS loss FROM outcome_base""",
    "outcomes": f"""
SELECT loan_id, customer_id,
  CASE WHEN cooling_off_exit = 1 THEN 'Cooling-Off-Exit' ELSE final_status END AS final_loan_status,
  CASE WHEN cooling_off_exit = 1 THEN 0 ELSE is_defaulted END AS default_flag,
  CASE WHEN cooling_off_exit = 1 THEN 0 ELSE max_dpd END AS max_dpd,
  CASE WHEN cooling_off_exit = 1 THEN 0e0 ELSE {r('total_paid', 2)} END AS total_amount_paid,
  CASE WHEN cooling_off_exit = 1 THEN 0 ELSE rec END AS recovery_amount,
  CASE WHEN cooling_off_exit = 1 THEN 0e0 ELSE {r('loss', 2)} END AS loss_given_default,
  CASE WHEN cooling_off_exit = 1 THEN 0e0 ELSE {r(MARGIN_SQL + ' - loss', 2)} END AS customer_ltv,
  CASE WHEN cooling_off_exit = 1 THEN 0e0
    ELSE {r('(' + MARGIN_SQL + ' - ticket_size * 0.5e0 * is_defaulted) / nullif(ticket_size, 0)', 4)} END AS risk_adjusted_return,
  CASE WHEN cooling_off_exit = 1 THEN 0 WHEN {r(MARGIN_SQL + ' - loss', 2)} > 0 THEN 1 ELSE 0 END AS is_profitable
FROM outcome_loss""",
    "master": """
SELECT l.*, c.* EXCLUDE (customer_id), final_loan_status, default_flag, max_dpd, customer_ltv, risk_adjusted_return,
  is_profitable, loss_given_default
FROM loans l LEFT JOIN customers c USING (customer_id) LEFT JOIN outcomes o USING (loan_id)""",
    "active": "SELECT * FROM master WHERE cooling_off_exit = 0",
    "active_out": """
SELECT a.*, o.recovery_amount FROM active a LEFT JOIN outcomes o USING (loan_id)""",
    "scored": f"""
SELECT l_orderkey AS loan_id, installment_no, CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS target,
  {r('l_quantity / 50e0 * 0.6e0 + l_discount * 4', 4)} AS pred_prob
FROM lines""",
    "scored_tier": """
SELECT s.*, CASE risk_tier WHEN 'Prime' THEN 0 WHEN 'Near-Prime' THEN 1 WHEN 'Subprime' THEN 2 WHEN 'Thin-File' THEN 3 ELSE 4 END AS risk_tier_encoded
FROM scored s LEFT JOIN loans l USING (loan_id) LEFT JOIN customers c USING (customer_id)""",
    "latest": """
SELECT * FROM scored_tier QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY installment_no DESC) = 1""",
    "bucketed": """
SELECT *, CASE WHEN pred_prob >= 0.45e0 THEN 'RED' WHEN pred_prob >= 0.2e0 THEN 'AMBER' ELSE 'GREEN' END AS risk_bucket FROM latest""",
    "pts": """
SELECT pred_prob AS threshold, sum(target) AS pos, sum(1 - target) AS neg FROM scored GROUP BY 1""",
    "curve": """
SELECT threshold, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg,
  CAST(sum(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp, CAST(sum(neg) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp,
  CAST(sum(pos) OVER () AS BIGINT) AS n_pos, CAST(sum(neg) OVER () AS BIGINT) AS n_neg FROM pts""",
    "rates": "SELECT *, tp / n_pos AS tpr, fp / n_neg AS fpr FROM curve",
    "cells": """
SELECT count(*) FILTER (WHERE pred_prob < 0.45e0 AND target = 0) AS tn, count(*) FILTER (WHERE pred_prob >= 0.45e0 AND target = 0) AS fp,
  count(*) FILTER (WHERE pred_prob < 0.45e0 AND target = 1) AS fn, count(*) FILTER (WHERE pred_prob >= 0.45e0 AND target = 1) AS tp FROM scored""",
}


def with_views(tail: str, extra: dict[str, str] | None = None) -> str:
    """A full query: every role view as a CTE in front of ``tail``."""
    views = {**VIEWS, **(extra or {})}
    ctes = ",\n".join(f"{name} AS ({body.strip()})" for name, body in views.items())
    return f"WITH {ctes}\n{tail.strip()}"
