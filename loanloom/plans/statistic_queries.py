"""Queries for credit statistics."""

from __future__ import annotations

from loanloom import schema as S
from loanloom.functions import exprs as E
from loanloom.operators import stats as T
from loanloom.operators.ranking import mid_ranks
from loanloom.plans.oracle import months, r
from loanloom.plans.registry import query
from loanloom.sources import roles as R

MOVES = {"moves": """
SELECT dpd_bucket AS from_bucket, to_bucket, count(*) AS n FROM
 (SELECT dpd_bucket, lead(dpd_bucket) OVER (PARTITION BY loan_id ORDER BY installment_no) AS to_bucket FROM repayments)
WHERE to_bucket IS NOT NULL GROUP BY 1, 2"""}


def _roll_cell(b):
    return r(f"coalesce(sum(n) FILTER (WHERE to_bucket = '{b}'), 0) * 100e0 / sum(n)")


@query("st1_roll_rates", "SELECT from_bucket, CAST(sum(n) AS BIGINT) AS n, " + ", ".join(f'{_roll_cell(b)} AS "{b}"' for b in S.DPD_BUCKETS)
       + f", {_roll_cell('Current')} AS cure_rate_pct FROM moves GROUP BY 1", views=MOVES)
def st1(spark, d):
    return T.roll_rates(R.repayments(spark, d))


@query("st1_transition_counts", "SELECT from_bucket, to_bucket, n FROM moves", views=MOVES)
def st1_counts(spark, d):
    return T.transitions(R.repayments(spark, d))


NUMERIC = ["monthly_income", "ticket_size", "bureau_score", "apr"]
CATEGORICAL = ["risk_tier", "origination_risk_grade", "employment_type", "geo_tier"]
WOE = {
    "tall_num": " UNION ALL ".join(
        f"SELECT '{c}' AS attribute, CAST({c} AS DOUBLE) AS value, default_flag AS y FROM active WHERE default_flag IS NOT NULL AND {c} IS NOT NULL"
        for c in NUMERIC),
    "edges": "SELECT attribute, quantile_cont(value, [" + ", ".join(f"{i / 10}" for i in range(1, 10)) + "]) AS e FROM tall_num GROUP BY 1",
    "tall": "SELECT attribute, lpad(CAST(len([x FOR x IN e IF value > x]) AS VARCHAR), 2, '0') AS bin, y FROM tall_num JOIN edges USING (attribute) UNION ALL "
    + " UNION ALL ".join(f"SELECT '{c}', CAST({c} AS VARCHAR), default_flag FROM active WHERE default_flag IS NOT NULL AND {c} IS NOT NULL" for c in CATEGORICAL),
    "cells2": "SELECT attribute, bin, count(*) FILTER (WHERE y = 1) AS bad, count(*) FILTER (WHERE y = 0) AS good FROM tall GROUP BY 1, 2",
    "shares": """SELECT attribute, bin, bad, good, greatest(bad, 0.5e0) / sum(bad) OVER (PARTITION BY attribute) AS b,
  greatest(good, 0.5e0) / sum(good) OVER (PARTITION BY attribute) AS g FROM cells2""",
}


@query("st2_woe_bins", f"SELECT attribute, bin, good, bad, {r('ln(g / b)', 6)} AS woe, {r('(g - b) * ln(g / b)', 6)} AS iv_part FROM shares",
       views=WOE, digits=6)
def st2_bins(spark, d):
    return T.woe_table(R.active(spark, d), "default_flag", NUMERIC, CATEGORICAL)


@query("st2_information_value", f"""
SELECT attribute, {r('iv', 6)} AS iv, CASE WHEN iv >= 0.3 THEN 'Strong' WHEN iv >= 0.1 THEN 'Medium' WHEN iv >= 0.02 THEN 'Weak' ELSE 'Useless' END AS strength
FROM (SELECT attribute, sum((g - b) * ln(g / b)) AS iv FROM shares GROUP BY 1)""", views=WOE, digits=6)
def st2(spark, d):
    return T.information_value(R.active(spark, d), "default_flag", NUMERIC, CATEGORICAL)


def _cramer_sql(a, b):
    return f"""
SELECT n, {r('chi2')} AS chi2, CAST((r - 1) * (c - 1) AS BIGINT) AS dof, {r('sqrt(chi2 / n / (least(r, c) - 1))')} AS cramers_v FROM (
 SELECT CAST(sum(n) AS BIGINT) AS n, sum(n) * (sum(n * n / (CAST(rn AS DOUBLE) * cn)) - 1) AS chi2, count(DISTINCT {a}) AS r, count(DISTINCT {b}) AS c FROM
  (SELECT {a}, {b}, CAST(n AS DOUBLE) AS n, sum(n) OVER (PARTITION BY {a}) AS rn, sum(n) OVER (PARTITION BY {b}) AS cn FROM
   (SELECT {a}, {b}, count(*) AS n FROM active WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2)))"""


@query("st3_cramers_v", _cramer_sql("employment_type", "risk_tier"))
def st3(spark, d):
    return T.cramers_v(R.active(spark, d), "employment_type", "risk_tier")


@query("st3_chi_square_pvalue", f"""
SELECT *, {r('exp(-chi2 / 2)')} AS p_value FROM ({_cramer_sql("kyc_type", "default_flag")})""")
def st3_p(spark, d):
    table = T.cramers_v(R.active(spark, d), "kyc_type", "default_flag")
    return table.withColumn("p_value", T.chi2_pvalue("chi2", "dof"))


MID = "rank() OVER (ORDER BY {0}) + (count(*) OVER (PARTITION BY {0}) - 1) / 2e0"


@query("st4_spearman", f"""
SELECT {r('corr(rx, ry)', 6)} AS rho FROM (SELECT {MID.format('apr')} AS rx, {MID.format('bureau_score')} AS ry FROM active)""", digits=6)
def st4(spark, d):
    return T.spearman(R.active(spark, d), "apr", "bureau_score")


@query("st4_mid_ranks", f"""
SELECT DISTINCT monthly_income, count(*) OVER (PARTITION BY monthly_income) AS n, {MID.format('monthly_income')} AS mid_rank FROM customers""")
def st4_ranks(spark, d):
    return mid_ranks(R.customers(spark, d), "monthly_income").drop("all_n")


RANKED = "(SELECT {1} AS g, {2} AS rk FROM active WHERE {0} IS NOT NULL AND {1} IS NOT NULL)"


KRUSKAL = f"""
SELECT {r('(12e0 / (n * (n + 1)) * q - 3 * (n + 1)) / (1 - ties / (n * n * n - n))')} AS h, k - 1 AS dof FROM
 (SELECT CAST(sum(m) AS DOUBLE) AS n, sum(s * s / m) AS q, count(*) AS k FROM
   (SELECT g, count(*) AS m, sum(rk) AS s FROM {{0}} GROUP BY 1)),
 (SELECT sum(CAST(t AS DOUBLE) * t * t - t) AS ties FROM (SELECT count(*) AS t FROM active GROUP BY ticket_size))"""


@query("st5_kruskal", KRUSKAL.format(RANKED.format('ticket_size', 'product_type', MID.format('ticket_size'))))
def st5(spark, d):
    return T.kruskal(R.active(spark, d), "ticket_size", "product_type")


@query("st5_kruskal_pvalue", f"""
SELECT h, dof, {r('exp(-h / 2) * (1 + h / 2)')} AS p_value FROM ({KRUSKAL.format(RANKED.format('ticket_size', 'risk_tier', MID.format('ticket_size')))})""")
def st5_p(spark, d):
    return T.kruskal(R.active(spark, d), "ticket_size", "risk_tier").withColumn("p_value", T.chi2_pvalue("h", "dof"))


def _mann_whitney_sql(value, group):
    ranked = RANKED.format(value, group, MID.format(value)).replace("FROM active", f"FROM (SELECT * FROM active WHERE {group} IS NOT NULL)")
    return f"""
SELECT n1, n0, {r('r1 - n1 * (n1 + 1) / 2', 1)} AS u,
  (r1 - n1 * (n1 + 1) / 2 - n1 * n0 / 2) / sqrt(n1 * n0 / 12 * (n1 + n0 + 1 - ties / ((n1 + n0) * (n1 + n0 - 1)))) AS z FROM
 (SELECT CAST(count(*) FILTER (WHERE g = 1) AS DOUBLE) AS n1, CAST(count(*) FILTER (WHERE g = 0) AS DOUBLE) AS n0, sum(rk) FILTER (WHERE g = 1) AS r1
  FROM {ranked}),
 (SELECT sum(CAST(t AS DOUBLE) * t * t - t) AS ties FROM (SELECT count(*) AS t FROM active WHERE {group} IS NOT NULL GROUP BY {value}))"""


@query("st6_mann_whitney", f"""
SELECT n1, n0, u, {r('z')} AS z FROM ({_mann_whitney_sql('cost_of_acquisition', 'default_flag')})""")
def st6(spark, d):
    return T.mann_whitney(R.active(spark, d), "cost_of_acquisition", "default_flag")


@query("st6_mann_whitney_pvalue", f"""
SELECT n1, n0, u, {r('z')} AS z, {r("""1 - 2 * least(8e0, abs(z)) / 3000 / sqrt(2 * pi()) * list_sum([
  (CASE WHEN i IN (0, 1000) THEN 1e0 WHEN i % 2 = 1 THEN 4e0 ELSE 2e0 END) * exp(-pow(least(8e0, abs(z)) * i / 1000, 2) / 2) FOR i IN range(0, 1001)])""")} AS p_value
FROM ({_mann_whitney_sql('ticket_size', 'default_flag')})""")
def st6_p(spark, d):
    return T.mann_whitney(R.active(spark, d), "ticket_size", "default_flag").withColumn("p_value", T.normal_pvalue("z"))


@query("st7_anova_f", f"""
SELECT {r('(sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*)))')} AS f, count(*) - 1 AS df_between,
  CAST(sum(n) - count(*) AS BIGINT) AS df_within FROM
 (SELECT CAST(count(*) AS DOUBLE) AS n, avg(monthly_income) AS m, var_pop(monthly_income) AS v FROM active GROUP BY risk_tier),
 (SELECT avg(monthly_income) AS g FROM active)""")
def st7(spark, d):
    return T.anova_f(R.active(spark, d), "monthly_income", "risk_tier")


def _ci_sql(source):
    half = "1.96 * sqrt(p * (1 - p) / n)"
    return (f"SELECT n, {r('p * 100')} AS rate_pct, {r(f'(p - {half}) * 100')} AS low_pct, {r(f'(p + {half}) * 100')} AS high_pct "
            f"FROM (SELECT count(*) AS n, avg(default_flag) AS p FROM {source} WHERE default_flag IS NOT NULL)")


@query("st8_rate_ci_active", _ci_sql("active"))
def st8(spark, d):
    return T.rate_ci(R.active(spark, d), "default_flag")


@query("st8_rate_ci_all_loans", _ci_sql("master"))
def st8_all(spark, d):
    return T.rate_ci(R.master(spark, d), "default_flag")


@query("st9_distribution", f"""
SELECT product_type, count(*) AS n, {r('avg(x)')} AS mean,
  {r('(avg(x * x * x) - 3 * avg(x) * avg(x * x) + 2 * avg(x) * avg(x) * avg(x)) / pow(avg(x * x) - avg(x) * avg(x), 1.5)')} AS skew,
  {r('median(x)')} AS median, {r('quantile_cont(x, 0.9)')} AS p90 FROM (SELECT product_type, ticket_size AS x FROM active) GROUP BY 1""")
def st9(spark, d):
    return T.distribution(R.active(spark, d), "ticket_size", "product_type")


@query("st10_predefault_windows", f"""
SELECT time_window, count(*) AS n, {r('avg(cash_flow_consistency)')} AS cash_flow_consistency, {r('avg(balance_volatility)')} AS balance_volatility,
  {r('avg(emi_obligation_ratio)')} AS emi_obligation_ratio FROM
 (SELECT s.*, CASE WHEN dm IS NULL THEN 'normal' WHEN dm - month BETWEEN 4 AND 6 THEN '6-4M' WHEN dm - month BETWEEN 1 AND 3 THEN '3-1M' END AS time_window
  FROM signals s LEFT JOIN (SELECT loan_id, min(installment_no) AS dm FROM repayments WHERE is_defaulted = 1 GROUP BY 1) USING (loan_id))
WHERE time_window IS NOT NULL GROUP BY 1""")
def st10(spark, d):
    return T.predefault_windows(R.signals(spark, d), R.repayments(spark, d))


CONTRAST = ["cost_of_acquisition", "ticket_size", "tenure_months"]


@query("st11_default_contrast", " UNION ALL ".join(
    f"SELECT '{c}' AS attribute, {r('a')} AS defaulted_mean, {r('b')} AS other_mean, {r('(a - b) * 100 / b')} AS gap_pct FROM "
    f"(SELECT avg({c}) FILTER (WHERE default_flag = 1) AS a, avg({c}) FILTER (WHERE default_flag = 0) AS b FROM active)" for c in CONTRAST))
def st11(spark, d):
    return T.default_contrast(R.active(spark, d), CONTRAST)


def _active_out(spark, d):
    return R.active(spark, d).join(R.outcomes(spark, d).select("loan_id", "recovery_amount"), "loan_id", "left")


LGD = (f"count(*) AS n, {r('avg(loss_given_default)')} AS mean_lgd, {r('stddev_samp(loss_given_default)')} AS std_lgd, "
       f"{r('avg(recovery_amount * 100e0 / nullif(loss_given_default + recovery_amount, 0))')} AS mean_recovery_pct, "
       f"{r('median(loss_given_default)')} AS median_lgd FROM active_out WHERE default_flag = 1")


@query("st12_lgd_stats", f"SELECT {LGD}")
def st12(spark, d):
    return T.lgd_stats(_active_out(spark, d))


@query("st12_lgd_by_grade", f"SELECT origination_risk_grade, {LGD} GROUP BY 1")
def st12_grade(spark, d):
    return T.lgd_stats(_active_out(spark, d), "origination_risk_grade")


@query("st13_festival_uplift", f"""
SELECT {r('a')} AS festival_pct, {r('b')} AS other_pct, {r('a - b')} AS uplift_pp FROM
 (SELECT avg(ot) FILTER (WHERE f) * 100 AS a, avg(ot) FILTER (WHERE NOT f) * 100 AS b FROM
  (SELECT CASE WHEN payment_status = 'Paid-On-Time' THEN 1 ELSE 0 END AS ot, month(due_date) IN (4,10,11) AS f FROM repayments))""")
def st13(spark, d):
    return T.festival_uplift(R.repayments(spark, d))


@query("st14_co_shock_rate", f"""
SELECT count(*) AS loan_months, {r('avg(CASE WHEN income_shock_flag = 1 AND spending_shock_flag = 1 THEN 1 ELSE 0 END) * 100')} AS co_shock_pct FROM signals""")
def st14(spark, d):
    return T.co_shock_rate(R.signals(spark, d))


@query("st15_grade_pricing", f"""
SELECT origination_risk_grade, {r('avg(apr) * 100')} AS mean_apr_pct, {r('avg(default_flag) * 100')} AS default_rate_pct,
  {r('median(apr) * 100')} AS median_apr_pct FROM active GROUP BY 1""")
def st15(spark, d):
    return T.grade_pricing(R.active(spark, d))


@query("st16_net_ltv", f"""
SELECT acquisition_channel, {r('l')} AS avg_ltv, {r('c')} AS avg_cac, {r('l - c')} AS net_ltv, {r('c / min(c) OVER ()')} AS cac_spread FROM
 (SELECT acquisition_channel, avg(customer_ltv) AS l, avg(cost_of_acquisition) AS c FROM active GROUP BY 1)""")
def st16(spark, d):
    return T.net_ltv(R.active(spark, d))


@query("st17_segment_channel_matrix", f"""
SELECT tier_group, channel_group, count(*) AS n, {r('avg(default_flag) * 100')} AS default_rate_pct, {r('avg(risk_adjusted_return)')} AS avg_rar FROM
 (SELECT *, CASE WHEN risk_tier IN ('Prime','Near-Prime') THEN 'low' WHEN risk_tier IN ('Subprime','Thin-File') THEN 'high' END AS tier_group,
  CASE WHEN acquisition_channel IN ('Referral','Organic-App') THEN 'low' WHEN acquisition_channel IN ('DSA-Agent','Paid-Digital') THEN 'high' END AS channel_group FROM active)
WHERE tier_group IS NOT NULL AND channel_group IS NOT NULL GROUP BY 1, 2""")
def st17(spark, d):
    return T.segment_channel_matrix(R.active(spark, d))


@query("st18_repeat_share", f"""
SELECT count(*) AS n_customers, count(*) FILTER (WHERE n > 1) AS n_repeat, {r('avg(CASE WHEN n > 1 THEN 1 ELSE 0 END) * 100')} AS repeat_pct
FROM (SELECT customer_id, count(*) AS n FROM loans GROUP BY 1)""")
def st18(spark, d):
    return T.repeat_share(R.loans(spark, d))


@query("st19_mom_change", f"""
SELECT due_month, {r('m')} AS mean_value, {r('m - lag(m) OVER (ORDER BY due_month)')} AS mom_change,
  CASE WHEN m - lag(m) OVER (ORDER BY due_month) < -0.05 THEN 1 ELSE 0 END AS alert FROM
 (SELECT {months('due_date')} AS due_month, avg(dpd) AS m FROM repayments GROUP BY 1)""")
def st19(spark, d):
    return T.mom_change(R.repayments(spark, d).withColumn("due_month", E.to_month("due_date")), "due_month", "dpd")
