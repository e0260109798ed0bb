"""Queries for policy rules."""

from __future__ import annotations


from loanloom import schema as S
from loanloom.functions import exprs as E
from loanloom.operators import aggregates as A
from loanloom.operators import features as X
from loanloom.operators import policy as P
from loanloom.operators import scorecard as C
from loanloom.operators.ordered import latest_per
from loanloom.plans.feature_queries import FEATURE_VIEWS
from loanloom.plans.oracle import clip, months, r
from loanloom.plans.registry import query
from loanloom.plans.statistic_queries import MOVES
from loanloom.sources import roles as R


@query("pol1_kpi_status", f"""
SELECT kpi, {r('value')} AS value, CASE WHEN better = 'low' THEN CASE WHEN value < green THEN 'GREEN' WHEN value > red THEN 'RED' ELSE 'AMBER' END
  ELSE CASE WHEN value > green THEN 'GREEN' WHEN value < red THEN 'RED' ELSE 'AMBER' END END AS status
FROM (SELECT 'default_rate_pct' AS kpi, avg(default_flag) * 100 AS value FROM active
 UNION ALL SELECT 'avg_ltv', avg(customer_ltv) FROM active UNION ALL SELECT 'profitable_pct', avg(is_profitable) * 100 FROM active
 UNION ALL SELECT 'collection_efficiency_pct', avg(e) FROM (SELECT sum(amount_paid) * 100 / sum(emi_due) AS e FROM repayments GROUP BY {months('due_date')}))
JOIN (VALUES ('default_rate_pct','low',9e0,12e0), ('collection_efficiency_pct','high',99.5e0,98e0), ('profitable_pct','high',72e0,68e0),
 ('avg_ltv','high',30000e0,25000e0)) AS t(kpi, better, green, red) USING (kpi)""")
def pol1(spark, d):
    return P.portfolio_status(R.active(spark, d), R.repayments(spark, d))


def _flags_sql(rows, limits):
    table = ", ".join(f"('{k}', '{rel}', {t}e0)" for k, rel, t in limits)
    return f"""
SELECT kpi, {r('value')} AS value, threshold, CASE WHEN (relation = '>' AND value > threshold) OR (relation = '>=' AND value >= threshold)
  OR (relation = '<=' AND value <= threshold) THEN 1 ELSE 0 END AS flagged
FROM ({' UNION ALL '.join(rows)}) JOIN (VALUES {table}) AS t(kpi, relation, threshold) USING (kpi)"""


@query("pol2_origination_flags", _flags_sql([
    "SELECT 'paid_digital_share_pct' AS kpi, avg(CASE WHEN acquisition_channel = 'Paid-Digital' THEN 1 ELSE 0 END) * 100 AS value FROM master",
    "SELECT 'referral_organic_share_pct', avg(CASE WHEN acquisition_channel IN ('Referral','Organic-App') THEN 1 ELSE 0 END) * 100 FROM master",
    "SELECT 'subprime_share_pct', avg(CASE WHEN risk_tier = 'Subprime' THEN 1 ELSE 0 END) * 100 FROM master",
    "SELECT 'avg_turnaround_days', avg(approval_turnaround_days) FROM master",
    "SELECT 'max_channel_exit_pct', max(e) FROM (SELECT avg(cooling_off_exit) * 100 AS e FROM master GROUP BY acquisition_channel)",
], S.ORIGINATION_LIMITS))
def pol2(spark, d):
    return P.origination_flags(R.master(spark, d))


@query("pol3_ews_flags", _flags_sql([
    "SELECT 'red_share_pct' AS kpi, count(*) FILTER (WHERE risk_bucket = 'RED') * 100e0 / count(*) AS value FROM bucketed",
    "SELECT 'red_delinquency_pct', avg(target) * 100 FROM bucketed WHERE risk_bucket = 'RED'",
    "SELECT 'co_shock_pct', avg(CASE WHEN income_shock_flag = 1 AND spending_shock_flag = 1 THEN 1 ELSE 0 END) * 100 FROM signals",
    "SELECT 'dpd_1_30_roll_pct', sum(n) FILTER (WHERE to_bucket NOT IN ('Current','DPD_1-30')) * 100e0 / sum(n) FROM moves WHERE from_bucket = 'DPD_1-30'",
    "SELECT 'cash_flow_fall', (SELECT lag(m) OVER (ORDER BY month) - m FROM (SELECT month, avg(cash_flow_consistency) AS m FROM signals GROUP BY 1) ORDER BY month DESC LIMIT 1)",
], S.WARNING_LIMITS), views=MOVES)
def pol3(spark, d):
    summary = C.scorecard_summary(C.with_bucket(C.latest_scores(R.scored_with_tier(spark, d))))
    return P.ews_flags(summary, R.signals(spark, d), R.repayments(spark, d))


@query("pol4_escalations", """
SELECT loan_id, month, cash_flow_consistency, balance_volatility, emi_obligation_ratio FROM
 (SELECT *, lag(cash_flow_consistency) OVER w AS c1, lag(cash_flow_consistency, 2) OVER w AS c2, lag(balance_volatility) OVER w AS b1,
  lag(balance_volatility, 2) OVER w AS b2, lag(emi_obligation_ratio) OVER w AS e1, lag(emi_obligation_ratio, 2) OVER w AS e2
  FROM signals WINDOW w AS (PARTITION BY loan_id ORDER BY month))
WHERE cash_flow_consistency < c1 AND c1 < c2 AND balance_volatility > b1 AND b1 > b2 AND emi_obligation_ratio > 0.5 AND least(e1, e2) <= 0.5""")
def pol4(spark, d):
    return P.escalations(R.signals(spark, d))


@query("pol5_approval_stance", f"""
SELECT loan_id, CASE WHEN risk_tier = 'Prime' THEN 'approve'
  WHEN risk_tier = 'Near-Prime' AND foir < 0.4 AND employment_stability_score > 5 THEN 'approve'
  WHEN risk_tier = 'Subprime' AND bureau_score > 540 AND foir < 0.35 AND coalesce(income_shock_flag_3m, 0) = 0 THEN 'approve selectively'
  WHEN risk_tier = 'Thin-File' AND cash_flow_consistency > 0.6 AND coalesce(both_shocks_flag, 0) = 0 THEN 'approve on account data'
  WHEN risk_tier IN ('Prime','Near-Prime','Subprime','Thin-File') THEN 'decline' ELSE 'refer' END AS stance,
  CASE WHEN employment_type IN ('Gig-Worker','Daily-Wage') THEN 1 ELSE 0 END AS extra_scrutiny
FROM (SELECT *, {r(clip(r('emi_amount / nullif(monthly_income, 0)', 3), '0.01e0', '0.9e0'), 3)} AS foir FROM master)
LEFT JOIN (SELECT loan_id, income_shock_flag_3m, both_shocks_flag FROM last_feats) USING (loan_id)
LEFT JOIN (SELECT loan_id, cash_flow_consistency FROM signals QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY month DESC) = 1) USING (loan_id)""",
       views=FEATURE_VIEWS)
def pol5(spark, d):
    recent = X.latest_shocks(R.signals(spark, d), ["cash_flow_consistency"])
    loans = R.master(spark, d).withColumn("foir", E.foir()).join(recent, "loan_id", "left")
    return P.approval_stance(loans).select("loan_id", "stance", "extra_scrutiny")


@query("pol6_apr_adjustment", f"""
SELECT loan_id, coalesce(bps_low, 0) AS bps_low, coalesce(bps_high, 0) AS bps_high, {r('apr + coalesce(bps_low, 0) / 10000e0', 6)} AS apr_low,
  {r('apr + coalesce(bps_high, 0) / 10000e0', 6)} AS apr_high FROM loans
LEFT JOIN (VALUES {', '.join(f"('{c}', {lo}, {hi})" for c, lo, hi in S.APR_ADJUSTMENT_BPS)}) AS t(acquisition_channel, bps_low, bps_high) USING (acquisition_channel)""",
       digits=6)
def pol6(spark, d):
    return P.apr_adjustment(R.loans(spark, d)).select("loan_id", "bps_low", "bps_high", "apr_low", "apr_high")


@query("pol7_tenure_breach", """
SELECT loan_id, tenure_cap, CASE WHEN tenure_months > tenure_cap THEN 1 ELSE 0 END AS tenure_breach FROM
 (SELECT *, CASE WHEN product_type IN ('BNPL','Consumer-Durable') AND risk_tier = 'Subprime' THEN 18
   WHEN product_type = 'Personal-Loan' AND risk_tier = 'Near-Prime' THEN 36 WHEN product_type = 'Personal-Loan' AND risk_tier = 'Subprime' THEN 24
   WHEN product_type = 'SME-Working-Capital' THEN 18 WHEN product_type = 'Education-Loan' THEN 60 END AS tenure_cap FROM master)""")
def pol7(spark, d):
    return P.tenure_breach(R.master(spark, d)).select("loan_id", "tenure_cap", "tenure_breach")


@query("pol8_ticket_breach", """
SELECT loan_id, ticket_cap, CASE WHEN ticket_size > ticket_cap THEN 1 ELSE 0 END AS ticket_breach FROM
 (SELECT *, CASE risk_tier WHEN 'Prime' THEN 300000 WHEN 'Near-Prime' THEN 150000 WHEN 'Subprime' THEN 75000 WHEN 'Thin-File' THEN 30000 END AS ticket_cap FROM master)""")
def pol8(spark, d):
    return P.ticket_breach(R.master(spark, d)).select("loan_id", "ticket_cap", "ticket_breach")


@query("pol9_growth_quadrant", f"""
SELECT product_type, {r('dr')} AS default_rate_pct, {r('pr')} AS profitable_pct,
  CASE WHEN dr <= md AND pr >= mp THEN 'grow aggressively' WHEN pr >= mp THEN 'grow selectively' WHEN dr <= md THEN 'manage carefully' ELSE 'restrict or reprice' END AS quadrant
FROM (SELECT *, avg(dr) OVER () AS md, avg(pr) OVER () AS mp FROM
 (SELECT product_type, avg(default_flag) * 100 AS dr, avg(is_profitable) * 100 AS pr FROM active GROUP BY 1))""")
def pol9(spark, d):
    stats = A.segment_stats(R.active(spark, d), "product_type", ("default_rate_pct", "profitable_pct"))
    return P.growth_quadrant(stats)


@query("pol10_double_penalty", f"""
SELECT acquisition_channel, {r('c')} AS avg_cac, {r('dr')} AS default_rate_pct, CASE WHEN c > mc AND dr > md THEN 1 ELSE 0 END AS double_penalty
FROM (SELECT *, avg(c) OVER () AS mc, avg(dr) OVER () AS md FROM
 (SELECT acquisition_channel, avg(cost_of_acquisition) AS c, avg(default_flag) * 100 AS dr FROM active GROUP BY 1))""")
def pol10(spark, d):
    return P.double_penalty(A.segment_stats(R.active(spark, d), "acquisition_channel", ("avg_cac", "default_rate_pct")))


@query("pol11_mix_shift", f"""
SELECT {r('sum(c * n) / sum(n)')} AS cac_before, {r('sum(c * m) / sum(m)')} AS cac_after, {r('sum(dr * n) / sum(n)')} AS default_before_pct,
  {r('sum(dr * m) / sum(m)')} AS default_after_pct FROM
 (SELECT *, n + CASE acquisition_channel WHEN 'Paid-Digital' THEN -moved WHEN 'Referral' THEN moved ELSE 0 END AS m FROM
  (SELECT *, least(sum(n) OVER () * 0.1, sum(n) FILTER (WHERE acquisition_channel = 'Paid-Digital') OVER ()) AS moved FROM
   (SELECT acquisition_channel, CAST(count(*) AS DOUBLE) AS n, avg(cost_of_acquisition) AS c, avg(default_flag) * 100 AS dr FROM active GROUP BY 1)))""")
def pol11(spark, d):
    stats = A.segment_stats(R.active(spark, d), "acquisition_channel", ("n_loans", "avg_cac", "default_rate_pct"))
    return P.mix_shift(stats, "Paid-Digital", "Referral", 10)


