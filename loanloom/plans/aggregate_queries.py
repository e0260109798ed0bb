"""Queries for portfolio aggregates, ordering, sampling and splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanloom import schema as S
from loanloom.functions import exprs as E
from loanloom.operators import aggregates as A
from loanloom.operators import evaluation as V
from loanloom.operators import joins as J
from loanloom.operators import modeling as M
from loanloom.plans.oracle import months, r
from loanloom.plans.registry import query
from loanloom.sources import roles as R

RATE = r("avg(default_flag) * 100")
PROFIT = r("avg(is_profitable) * 100")
RAR = r("avg(risk_adjusted_return) * 100")


def _seg(by, *columns, where=""):
    return f"SELECT {by}, {', '.join(columns)} FROM active {where} GROUP BY 1"


SEG = (
    "count(*) AS n_loans", f"{RATE} AS default_rate_pct", f"{r('avg(monthly_income)')} AS avg_income",
    f"{r('avg(bureau_score)')} AS avg_bureau", f"{PROFIT} AS profitable_pct",
    f"{r('avg(customer_ltv)')} AS avg_ltv", f"{RAR} AS avg_rar_pct",
)


def _in_domain(body: str, key: str, domain: list[str]) -> str:
    rows = ", ".join(f"('{v}')" for v in domain)
    return f"SELECT * FROM (VALUES {rows}) AS dom({key}) LEFT JOIN ({body}) USING ({key})"


@query("agg1_portfolio_kpis", f"""
SELECT count(*) AS n_loans, {RATE} AS default_rate_pct, {r('avg(customer_ltv)')} AS avg_ltv,
  {r('sum(CASE WHEN default_flag = 1 THEN ticket_size END) / 1e7')} AS npa_crore, {PROFIT} AS profitable_pct FROM active""")
def agg1(spark, d):
    return A.portfolio_kpis(R.active(spark, d))


@query("agg2_collection_efficiency", f"""
SELECT {r('avg(e)')} AS collection_efficiency_pct FROM
  (SELECT sum(amount_paid) * 100 / sum(emi_due) AS e FROM repayments GROUP BY {months('due_date')})""")
def agg2(spark, d):
    return A.collection_efficiency(R.repayments(spark, d))


@query("agg3_segment_stats", _in_domain(_seg("risk_tier", *SEG), "risk_tier", S.TIERS))
def agg3(spark, d):
    return J.reindex_to(A.segment_stats(R.active(spark, d)), "risk_tier", S.TIERS)


CHANNEL = f"""
SELECT acquisition_channel, count(*) AS n_loans, {RATE} AS default_rate_pct, {r('avg(cost_of_acquisition)')} AS avg_cac,
  {r('avg(customer_ltv)')} AS avg_ltv, {PROFIT} AS profitable_pct, {RAR} AS avg_rar_pct,
  {r('avg(customer_ltv) / nullif(avg(cost_of_acquisition), 0)')} AS ltv_cac,
  {r('count(*) * 100e0 / (SELECT count(*) FROM active)')} AS volume_pct
FROM active GROUP BY 1"""


@query("agg4_channel_stats", CHANNEL)
def agg4(spark, d):
    return A.channel_stats(R.active(spark, d))


@query("agg5_exit_rate", f"""
SELECT acquisition_channel, count(*) AS n_all, CAST(sum(cooling_off_exit) AS BIGINT) AS exits, {r('avg(cooling_off_exit) * 100')} AS exit_rate_pct
FROM master GROUP BY 1""")
def agg5(spark, d):
    return A.exit_rate(R.master(spark, d))


@query("agg6_product_stats", f"""
SELECT product_type, count(*) AS n_loans, {RATE} AS default_rate_pct, {r('avg(ticket_size)')} AS avg_ticket,
  {r('avg(apr) * 100')} AS avg_apr_pct, {r('avg(tenure_months)')} AS avg_tenure, {PROFIT} AS profitable_pct,
  {r('avg(customer_ltv)')} AS avg_ltv, {RAR} AS avg_rar_pct, {r('median(ticket_size)')} AS median_ticket,
  {r('count(*) * 100e0 / (SELECT count(*) FROM active)')} AS volume_pct FROM active GROUP BY 1""")
def agg6(spark, d):
    return A.product_stats(R.active(spark, d))


def _banded_sql(col, edges, labels):
    whens = " ".join(f"WHEN {col} <= {e} THEN '{x}'" for e, x in zip(edges[1:], labels))
    return f"CASE WHEN {col} <= {edges[0]} THEN NULL {whens} END"


TICKET_SQL = _banded_sql("ticket_size", S.TICKET_EDGES, S.TICKET_LABELS)
TENURE_SQL = _banded_sql("tenure_months", S.TENURE_EDGES, S.TENURE_LABELS)


@query("agg7_ticket_band", f"SELECT {TICKET_SQL} AS band, {RATE} AS default_rate_pct, count(*) AS n_loans FROM active GROUP BY 1")
def agg7_ticket(spark, d):
    return A.banded_rate(R.active(spark, d), E.ticket_band())


@query("agg7_tenure_band", f"SELECT {TENURE_SQL} AS band, {RATE} AS default_rate_pct, count(*) AS n_loans FROM active GROUP BY 1")
def agg7_tenure(spark, d):
    return A.banded_rate(R.active(spark, d), E.tenure_band())


@query("agg8_pricing_gap", f"""
SELECT origination_risk_grade, {RATE} AS default_rate_pct, {r('avg(apr) * 100')} AS avg_apr_pct, count(*) AS n_loans,
  {r('avg(customer_ltv)')} AS avg_ltv, {RAR} AS avg_rar_pct, {r('avg(default_flag) * 200 + 8')} AS fair_apr_pct,
  {r('avg(apr) * 100 - (avg(default_flag) * 200 + 8)')} AS pricing_gap_pct
FROM active WHERE origination_risk_grade IN ('A+','A','A-','B','B-','C+','C','D') GROUP BY 1""")
def agg8(spark, d):
    return J.reindex_to(A.pricing_gap(R.active(spark, d)), "origination_risk_grade", S.GRADES, drop=True)


@query("agg9_cross_rate", f"SELECT {TENURE_SQL} AS tenure_band, risk_tier, {RATE} AS default_rate_pct FROM active GROUP BY 1, 2")
def agg9(spark, d):
    return A.cross_rate(R.active(spark, d), E.tenure_band(), "risk_tier", "tenure_band")


@query("agg10_approval_turnaround", f"SELECT approval_turnaround_days, count(*) AS n_loans, {RATE} AS default_rate_pct FROM active GROUP BY 1")
def agg10(spark, d):
    return A.segment_stats(R.active(spark, d), "approval_turnaround_days", ("n_loans", "default_rate_pct"))


@query("agg11_monthly_kpis", f"""
SELECT * FROM (SELECT {months('due_date')} AS due_month, {r('sum(emi_due)', 2)} AS total_due, {r('sum(amount_paid)', 2)} AS total_paid,
  count(*) FILTER (WHERE payment_status = 'Paid-On-Time') AS on_time_cnt, count(*) FILTER (WHERE payment_status = 'Missed') AS missed_cnt,
  count(*) AS total_cnt, {r('sum(amount_paid) * 100 / sum(emi_due)', 2)} AS collection_eff_pct,
  {r("count(*) FILTER (WHERE payment_status = 'Paid-On-Time') * 100e0 / count(*)", 2)} AS on_time_pct,
  {r("count(*) FILTER (WHERE payment_status = 'Missed') * 100e0 / count(*)", 2)} AS missed_pct FROM repayments GROUP BY 1)
WHERE due_month > (SELECT min({months('due_date')}) FROM repayments) AND due_month < (SELECT max({months('due_date')}) FROM repayments)""", digits=2)
def agg11(spark, d):
    return A.monthly_kpis(R.repayments(spark, d))


@query("agg12_loan_rollup", f"""
SELECT loan_id, {r('total_paid', 2)} AS total_paid, installments, max_dpd, is_defaulted, final_status FROM rollup""", digits=2)
def agg12(spark, d):
    return A.loan_rollup(R.repayments(spark, d))


@query("agg13_seasonal_rate", f"""
SELECT CAST(month(due_date) AS INTEGER) AS cal_month, {r("avg(CASE WHEN payment_status = 'Paid-On-Time' THEN 1 ELSE 0 END) * 100")} AS on_time_pct,
  max(strftime(due_date, '%b')) AS month_name FROM repayments GROUP BY 1""")
def agg13(spark, d):
    return A.seasonal_rate(R.repayments(spark, d))


@query("agg14_value_counts", "SELECT payment_status, count(*) AS n FROM repayments GROUP BY 1")
def agg14(spark, d):
    return A.value_counts(R.repayments(spark, d), "payment_status")


@query("agg14_normalised_counts", f"""
SELECT risk_tier, count(*) AS n, {r('count(*) * 100e0 / (SELECT count(*) FROM customers)', 1)} AS share_pct FROM customers GROUP BY 1""")
def agg14_share(spark, d):
    return A.value_counts(R.customers(spark, d), "risk_tier", normalize=True)


def _pivot_sql(row, col, domain, value="default_flag", source="active", fill=None):
    cells = []
    for x in domain:
        cell = r(f"avg({value}) FILTER (WHERE {col} = '{x}') * 100", 2)
        cells.append(f"{cell if fill is None else f'coalesce({cell}, {fill})'} AS \"{x}\"")
    return f"SELECT {row}, {', '.join(cells)} FROM {source} GROUP BY 1"


@query("agg16_product_tier_pivot", _pivot_sql("product_type", "risk_tier", S.TIERS, fill="0e0"))
def agg16_product(spark, d):
    return A.rate_pivot(R.active(spark, d), "product_type", "risk_tier", S.TIERS, fill=0.0)


@query("agg16_employment_tier_pivot", _in_domain(
    _pivot_sql("employment_type", "risk_tier", S.TIERS, fill="0e0"), "employment_type", S.EMPLOYMENT_TYPES))
def agg16_employment(spark, d):
    table = A.rate_pivot(R.active(spark, d), "employment_type", "risk_tier", S.TIERS, fill=0.0)
    return J.reindex_to(table, "employment_type", S.EMPLOYMENT_TYPES)


@query("agg17_crosstab", _pivot_sql("state", "geo_tier", ["Metro", "Tier-2", "Tier-3"]))
def agg17(spark, d):
    return A.rate_pivot(R.active(spark, d), "state", "geo_tier", ["Metro", "Tier-2", "Tier-3"])


@query("agg18_default_by_grade", f"SELECT origination_risk_grade, {RATE} AS default_rate_pct FROM master GROUP BY 1")
def agg18(spark, d):
    stats = A.segment_stats(R.master(spark, d), "origination_risk_grade", ("default_rate_pct",))
    return stats.orderBy(F.desc("default_rate_pct"), "origination_risk_grade")


@query("agg19_volume_share", f"""
SELECT product_type, count(*) AS n_loans, {r('count(*) * 100e0 / (SELECT count(*) FROM active)')} AS volume_pct FROM active GROUP BY 1""")
def agg19(spark, d):
    return A.share_of_total(A.segment_stats(R.active(spark, d), "product_type", ("n_loans",)), "n_loans", "volume_pct")


@query("agg20_cutlines", f"""
SELECT {r('avg(d)')} AS mean_default_pct, {r('avg(p)')} AS mean_profitable_pct FROM
 (SELECT avg(default_flag) * 100 AS d, avg(is_profitable) * 100 AS p FROM active GROUP BY product_type)""")
def agg20(spark, d):
    stats = A.segment_stats(R.active(spark, d), "product_type", ("default_rate_pct", "profitable_pct"))
    return A.group_means(stats, {"mean_default_pct": "default_rate_pct", "mean_profitable_pct": "profitable_pct"})


@query("agg22_ecl", f"""
SELECT risk_tier, {r('p')} AS pd, {r('e')} AS ead, {r('l')} AS lgd_rate, {r('p * e * l')} AS ecl FROM
 (SELECT risk_tier, avg(default_flag) AS p, avg(ticket_size) FILTER (WHERE default_flag = 1) AS e,
  sum(loss_given_default) FILTER (WHERE default_flag = 1) / sum(ticket_size) FILTER (WHERE default_flag = 1) AS l FROM active GROUP BY 1)""")
def agg22(spark, d):
    return A.ecl(R.active(spark, d))


@query("agg23_table_profile", """
SELECT 'customers' AS table_name, count(*) AS n_rows, 14 AS n_columns FROM customers
UNION ALL SELECT 'loans', count(*), 14 FROM loans UNION ALL SELECT 'repayments', count(*), 11 FROM repayments
UNION ALL SELECT 'signals', count(*), 10 FROM signals UNION ALL SELECT 'outcomes', count(*), 11 FROM outcomes
UNION ALL SELECT 'master', count(*), 34 FROM master""")
def agg23(spark, d):
    return A.table_profile({
        name: getattr(R, name)(spark, d)
        for name in ("customers", "loans", "repayments", "signals", "outcomes", "master")
    })


@query("agg24_class_balance", f"""
SELECT target, count(*) AS n, {r('count(*) * 100e0 / (SELECT count(*) FROM scored)')} AS share_pct FROM scored GROUP BY 1""")
def agg24(spark, d):
    return A.class_balance(R.scored(spark, d))


# --- order, limits, splits --------------------------------------------------

@query("srt1_ordered_keys", """
SELECT loan_id, installment_no, lag(due_date) OVER (PARTITION BY loan_id ORDER BY installment_no) AS previous_due FROM repayments""")
def srt1(spark, d):
    from loanloom.operators.ordered import ordered_groups

    g = ordered_groups(R.repayments(spark, d).select("loan_id", "installment_no", "due_date"), "loan_id", ["installment_no"], 1)
    return g.finish(g.frame.withColumn("previous_due", F.lag("due_date", 1).over(g.window()))).drop("due_date")


@query("srt2_by_value", "SELECT product_type, count(*) AS n_loans FROM active GROUP BY 1")
def srt2(spark, d):
    return A.segment_stats(R.active(spark, d), "product_type", ("n_loans",)).orderBy(F.desc("n_loans"), "product_type")


@query("top1_largest_loans", "SELECT loan_id, ticket_size FROM active ORDER BY ticket_size DESC, loan_id LIMIT 15")
def top1(spark, d):
    return A.top_n(R.active(spark, d).select("loan_id", "ticket_size"), "ticket_size", 15, ["loan_id"])


@query("rnk1_ranked_list", f"""
SELECT * FROM (SELECT city AS feature, count(*) AS importance, CAST(row_number() OVER (ORDER BY count(*) DESC, city) AS INTEGER) AS rank FROM master GROUP BY 1)
WHERE rank <= 20""")
def rnk1(spark, d):
    counts = R.master(spark, d).groupBy(F.col("city").alias("feature")).agg(F.count("*").alias("importance"))
    return M.add_rank(counts, "importance", 20)


@query("smp1_exact_key_overlap", f"""
SELECT count(*) AS n_keys, count(month) AS n_matched, {r('count(month) * 100e0 / count(*)')} AS match_rate_pct
FROM (SELECT DISTINCT customer_id FROM loans) LEFT JOIN (SELECT DISTINCT customer_id, 1 AS month FROM user_days) USING (customer_id)""")
def smp1(spark, d):
    seen = R.read(spark, d, "events").select(F.col("user_id").alias("customer_id"))
    return J.match_rate(R.loans(spark, d), seen, ["customer_id"])


@query("smp2_thin_curve", """
SELECT fpr, tpr, threshold FROM (SELECT *, row_number() OVER (ORDER BY threshold DESC) AS i, count(*) OVER () AS n FROM rates)
WHERE (i - 1) % CAST(greatest(1, ceil(n / 200e0)) AS BIGINT) = 0""", digits=None)
def smp2(spark, d):
    points = V.curve(R.scored(spark, d)).select("fpr", "tpr", "threshold")
    return V.thin_curve(points, 200).select("fpr", "tpr", "threshold")


@query("spl1_stratified_split", """
SELECT part, target, count(*) AS n FROM (SELECT target,
  CASE WHEN ('0x' || substr(md5(loan_id || '|' || installment_no), 1, 8))::BIGINT % 100 < 20 THEN 'test'
       WHEN ('0x' || substr(md5(loan_id || '|' || installment_no), 1, 8))::BIGINT % 100 < 30 THEN 'valid' ELSE 'train' END AS part FROM scored)
GROUP BY 1, 2""")
def spl1(spark, d):
    parts = M.split(R.scored(spark, d), test_pct=20, valid_pct=10)
    return parts.groupBy("part", "target").agg(F.count("*").alias("n"))


@query("spl1_split_by_loan", """
SELECT part, count(*) AS n, count(DISTINCT loan_id) AS loans FROM (SELECT loan_id,
  CASE WHEN ('0x' || substr(md5(CAST(loan_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 20 THEN 'test' ELSE 'train' END AS part FROM scored)
GROUP BY 1""")
def spl1_loan(spark, d):
    parts = M.split(R.scored(spark, d), keys=["loan_id"])
    per_loan = parts.groupBy("part", "loan_id").agg(F.count("*").alias("n"))
    return per_loan.groupBy("part").agg(F.sum("n").alias("n"), F.count("*").alias("loans"))


_H = "('0x' || substr(md5(loan_id || '|' || installment_no), 1, 13))::BIGINT"


@query("spl1_exact_strata", f"""
SELECT part, target, count(*) AS n, CAST(sum(h % 1000003) AS BIGINT) AS keys FROM (SELECT target, h,
  CASE WHEN i <= round(0.2 * n) THEN 'test' WHEN i <= round(0.3 * n) THEN 'valid' ELSE 'train' END AS part FROM (
  SELECT target, {_H} AS h, row_number() OVER (PARTITION BY target ORDER BY {_H}) AS i, count(*) OVER (PARTITION BY target) AS n FROM scored))
GROUP BY 1, 2""")
def spl1_exact(spark, d):
    """Shares exact to one row in every stratum."""
    parts = M.split_exact(R.scored(spark, d), test_share=0.2, valid_share=0.1)
    return parts.groupBy("part", "target").agg(
        F.count("*").alias("n"), F.sum(M.hash_order("loan_id", "installment_no") % 1000003).cast("bigint").alias("keys"))


@query("spl1_by_date", """
SELECT part, count(*) AS n, min(due_date) AS first_day, max(due_date) AS last_day FROM (SELECT due_date,
  CASE WHEN later <= round(0.2 * n) THEN 'test' WHEN later <= round(0.3 * n) THEN 'valid' ELSE 'train' END AS part FROM (
  SELECT due_date, count(*) OVER (ORDER BY due_date DESC) AS later, count(*) OVER () AS n FROM repayments WHERE due_date IS NOT NULL))
GROUP BY 1""")
def spl1_date(spark, d):
    """Out of time: no test row is earlier than a training row."""
    rows = R.repayments(spark, d).where("due_date IS NOT NULL").select("due_date")
    return M.split_by_date(rows, "due_date", 0.2, 0.1).groupBy("part").agg(
        F.count("*").alias("n"), F.min("due_date").alias("first_day"), F.max("due_date").alias("last_day"))


@query("set1_one_grouping", "SELECT risk_bucket, count(*) AS n FROM bucketed GROUP BY 1")
def set1(spark, d):
    from loanloom.operators import scorecard as C

    return C.with_bucket(C.latest_scores(R.scored_with_tier(spark, d))).groupBy("risk_bucket").agg(F.count("*").alias("n"))
