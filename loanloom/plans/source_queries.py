"""Queries for reading, writing, projecting and filtering."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom import schema as S
from loanloom.functions import exprs as E
from loanloom.operators import aggregates as A
from loanloom.operators import features as X
from loanloom.operators import joins as J
from loanloom.operators import scorecard as C
from loanloom.operators.evaluation import confusion, metrics_summary, roc_points
from loanloom.operators.ordered import ordered_groups
from loanloom.plans.oracle import clip, months, r
from loanloom.plans.registry import query
from loanloom.session import ensure_checkpoint_dir
from loanloom.sources import roles as R
from loanloom.sources import tables as IO


def scratch(spark, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


CUSTOMER_FILE = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])


@query("src1_typed_scan", """
SELECT c_mktsegment, count(*) AS n, """ + r("sum(c_acctbal)", 2) + """ AS total FROM customer GROUP BY 1""", digits=2)
def src1(spark, d):
    df = IO.read_table(spark, f"{d}/customer.parquet", CUSTOMER_FILE)
    return df.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.sum("c_acctbal").alias("total"))


@query("src1_csv_scan", "SELECT customer_id, risk_tier, monthly_income, bureau_score FROM customers")
def src1_csv(spark, d):
    path = scratch(spark, "customers-csv")
    df = R.customers(spark, d).select("customer_id", "risk_tier", "monthly_income", "bureau_score")
    IO.write_table(df, path, "csv")
    return IO.read_table(spark, path, df.schema, "csv")


@query("src2_dates", """
SELECT loan_id, origination_date, year(origination_date) || 'Q' || quarter(origination_date) AS cohort_quarter, """
       + months("origination_date") + """ AS cohort_month FROM loans""")
def src2(spark, d):
    return R.loans(spark, d).select(
        "loan_id", "origination_date", E.to_quarter("origination_date").alias("cohort_quarter"),
        E.to_month("origination_date").alias("cohort_month"),
    )


@query("src3_limited_scan", """
SELECT loan_id, installment_no, pred_prob, target, risk_bucket FROM bucketed ORDER BY loan_id LIMIT 15000""")
def src3(spark, d):
    latest = C.with_bucket(C.latest_scores(R.scored_with_tier(spark, d)))
    rows = latest.select("loan_id", "installment_no", "pred_prob", "target", "risk_bucket")
    return IO.limit_rows(rows, 15000, ["loan_id"])


SCALARS = ["tn", "fp", "fn", "tp", "auc", "gini_pct", "ks", "ks_pct", "average_precision", "precision", "recall", "f1", "best_threshold",
           "n_rows", "n_pos", "n_neg", "positive_rate", "pos_weight"]


def _metrics(spark, d):
    scored = R.scored_with_tier(spark, d)
    summary = C.scorecard_summary(C.with_bucket(C.latest_scores(scored))).select(
        "bucket", "n", F.round("share_pct", 4).alias("share_pct")
    )
    scalars = metrics_summary(scored, 0.45).select(*SCALARS).withColumn("auc", F.round("auc", 6))
    return IO.metrics_frame(scalars, summary)  # category shares need a model: snk3_model_document


@query("src4_metrics_read", f"""
SELECT tn, fp, fn, tp, auc, bucket, n, share_pct FROM cells
CROSS JOIN (SELECT {r('sum(neg * (tp - pos / 2e0)) / (max(n_pos) * max(n_neg))', 6)} AS auc FROM curve)
CROSS JOIN (SELECT risk_bucket AS bucket, count(*) AS n, {r('count(*) * 100e0 / (SELECT count(*) FROM bucketed)')} AS share_pct
            FROM bucketed GROUP BY 1)""", digits=6)
def src4(spark, d):
    path = scratch(spark, "metrics-json")
    IO.write_metrics(_metrics(spark, d), path)
    back = IO.read_metrics(spark, path)
    return back.select("tn", "fp", "fn", "tp", "auc", F.explode("scorecard").alias("s")).select(
        "tn", "fp", "fn", "tp", "auc", "s.bucket", "s.n", "s.share_pct"
    )


@query("snk1_write_table", f"""
SELECT {months('due_date')} AS due_month, count(*) AS n, {r('sum(emi_due)', 2)} AS total FROM repayments
GROUP BY 1""", digits=2)
def snk1(spark, d):
    path = scratch(spark, "repayments")
    IO.write_repayments(R.repayments(spark, d), path)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("due_month").cast("string").alias("due_month")).agg(
        F.count("*").alias("n"), F.sum("emi_due").alias("total")
    )


@query("snk2_write_artifacts", """
SELECT 'scorecard ' || risk_bucket AS artifact, count(*) AS n FROM bucketed GROUP BY 1
UNION ALL SELECT 'confusion ' || name, n FROM (UNPIVOT (SELECT tn, fp, fn, tp FROM cells) ON tn, fp, fn, tp INTO NAME name VALUE n)
UNION ALL SELECT 'roc_points', count(*) + 1 FROM rates""")
def snk2(spark, d):
    folder = scratch(spark, "artifacts")
    scored = R.scored_with_tier(spark, d)
    bucketed = C.with_bucket(C.latest_scores(scored))
    IO.write_artifacts({
        "scorecard": C.scorecard_table(bucketed), "confusion": confusion(scored, 0.45),
        "roc_points": roc_points(scored, drop_intermediate=False),
    }, folder)
    back = {name: spark.read.parquet(f"{folder}/{name}") for name in ("scorecard", "confusion", "roc_points")}
    cells = back["confusion"].select(F.explode(F.array(*[
        F.struct(F.lit(f"confusion {c}").alias("artifact"), F.col(c).alias("n")) for c in ("tn", "fp", "fn", "tp")])).alias("c")).select("c.*")
    card = back["scorecard"].groupBy(F.concat(F.lit("scorecard "), "risk_bucket").alias("artifact")).agg(F.count("*").alias("n"))
    return card.unionByName(cells).unionByName(back["roc_points"].agg(F.lit("roc_points").alias("artifact"), F.count("*").alias("n")))


@query("snk3_metrics_document", f"""
SELECT tn, fp, fn, tp, {r('auc', 6)} AS auc, {r('(2 * auc - 1) * 100', 6)} AS gini_pct, {r('ks', 6)} AS ks, {r('ks * 100', 6)} AS ks_pct,
  {r('ap', 6)} AS average_precision, {r('tp / (tp + fp)', 6)} AS precision, {r('tp / (tp + fn)', 6)} AS recall,
  {r('2e0 * tp / (2 * tp + fp + fn)', 6)} AS f1, {r('best', 6)} AS best_threshold, tp + fp + tn + fn AS n_rows, tp + fn AS n_pos, tn + fp AS n_neg,
  {r('(tp + fn) / (tp + fp + tn + fn)', 6)} AS positive_rate, {r('(tn + fp) / (tp + fn)', 6)} AS pos_weight,
  (SELECT count(DISTINCT risk_bucket) FROM bucketed) AS n_buckets, CAST(0.45 AS DOUBLE) AS red_min
FROM cells, (SELECT sum(neg * (tp - pos / 2e0)) / (max(n_pos) * max(n_neg)) AS auc, max(abs(tpr - fpr)) AS ks,
  sum(pos / n_pos * (tp / (tp + fp))) AS ap FROM rates),
 (SELECT threshold AS best FROM rates ORDER BY tpr - fpr DESC, threshold DESC LIMIT 1)""", digits=6)
def snk3(spark, d):
    return _metrics(spark, d).select(
        *SCALARS, F.size("scorecard").cast("bigint").alias("n_buckets"),
        F.col("bucket_thresholds.RED_min").alias("red_min"),
    )


@query("snk5_shared_portfolio", f"""
SELECT risk_tier, count(*) AS n, {r('avg(default_flag) * 100')} AS default_rate_pct FROM active GROUP BY 1""")
def snk5(spark, d):
    """Through the shared, persisted portfolio of the role tables, which are written once per input."""
    stamp = IO.files_stamp(spark, d, "*.parquet")
    if stamp not in _folders:
        folder = scratch(spark, "lending")
        views = {"customers": R.customers, "loans": R.loans, "repayments": R.repayments, "signals": R.signals, "outcomes": R.outcomes}
        IO.write_artifacts({name: IO.conform(view(spark, d), S.TABLES[name]) for name, view in views.items()}, folder)
        _folders[stamp] = folder
    shared = IO.shared_portfolio(spark, _folders[stamp])
    return A.segment_stats(shared.active, "risk_tier", ("n_loans", "default_rate_pct")).withColumnRenamed("n_loans", "n")


_folders: dict[tuple, str] = {}


def _layout(spark, d):
    """The role tables bucketed by loan; one set of catalog tables per call."""
    return IO.lending_layout(R.repayments(spark, d), R.signals(spark, d), R.loans(spark, d), scratch(spark, "layout"),
                             f"lending_{uuid.uuid4().hex[:8]}", buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))


@query("snk1_bucketed_lags", """
SELECT loan_id, installment_no, coalesce(lag(dpd, 1) OVER w, 0) AS dpd_1m, coalesce(lag(dpd, 2) OVER w, 0) AS dpd_2m FROM repayments
WINDOW w AS (PARTITION BY loan_id ORDER BY installment_no)""")
def snk1_bucketed(spark, d):
    """Per-loan lags over repayments stored by loan: no shuffle after the write."""
    rows = _layout(spark, d)["repayments"].select("loan_id", "installment_no", "dpd")
    g = ordered_groups(rows, "loan_id", ["installment_no"], 2)
    w = g.window()
    return g.finish(g.frame.withColumns({"dpd_1m": X.lag0("dpd", 1, w), "dpd_2m": X.lag0("dpd", 2, w)})).drop("dpd")


@query("snk1_bucketed_panel_join", """
SELECT p.loan_id, p.installment_no, dpd, cash_flow_consistency, product_type
FROM repayments p LEFT JOIN signals s ON p.loan_id = s.loan_id AND p.installment_no = s.month LEFT JOIN loans l ON l.loan_id = p.loan_id""")
def snk1_bucketed_join(spark, d):
    """Signals of the month and loan columns joined to repayments, all stored by loan."""
    kept = _layout(spark, d)
    obs = kept["repayments"].select("loan_id", "installment_no", "dpd")
    joined = J.attach_signals(obs, kept["signals"].select("loan_id", "month", "cash_flow_consistency"), mode="month")
    return J.attach_origination(joined, kept["loans"].select("loan_id", "product_type"))


@query("src1_csv_rejects", """
SELECT 'good' AS kind, count(*) AS n FROM customers WHERE customer_id % 10 <> 3 AND customer_id % 10 <> 6 AND customer_id % 10 <> 9
UNION ALL SELECT 'income', count(*) FROM customers WHERE customer_id % 10 = 3
UNION ALL SELECT 'columns', count(*) FROM customers WHERE customer_id % 10 = 6
UNION ALL SELECT 'quote', count(*) FROM customers WHERE customer_id % 10 = 9""")
def src1_rejects(spark, d):
    """Customers as CSV lines, three in ten of them broken in three ways: each line is good or rejected with its reason."""
    key = F.col("customer_id")
    line = F.when(key % 10 == 3, F.concat_ws(",", key, "risk_tier", F.lit("n/a"))).when(
        key % 10 == 6, F.concat_ws(",", key, "risk_tier", F.lit("1.5"), F.lit("extra"))).when(
        key % 10 == 9, F.concat(key.cast("string"), F.lit(',"'), F.col("risk_tier"), F.lit(",1.5"))).otherwise(
        F.concat_ws(",", key, "risk_tier", "monthly_income"))
    path = scratch(spark, "broken-csv")
    R.customers(spark, d).select(line.alias("customer_id,risk_tier,income")).write.option("header", True).option("quote", "").option("sep", "\u0001").csv(path)
    schema = T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("risk_tier", T.StringType()), T.StructField("income", T.DoubleType())])
    good, rejects = IO.read_csv_checked(spark, path, schema)
    return good.agg(F.lit("good").alias("kind"), F.count(F.lit(1)).alias("n")).unionByName(
        rejects.groupBy(F.col("reason").alias("kind")).agg(F.count(F.lit(1)).alias("n")))



@query("prj1_column_subset", "SELECT loan_id, apr, tenure_months, ticket_size FROM loans")
def prj1(spark, d):
    return R.loans(spark, d).select("loan_id", "apr", "tenure_months", "ticket_size")


@query("prj2_rename_key", "SELECT loan_id, month AS installment_no, cash_flow_consistency FROM signals")
def prj2(spark, d):
    return R.signals(spark, d).select("loan_id", "month", "cash_flow_consistency").withColumnRenamed("month", "installment_no")


@query("flt1_active_loans", "SELECT loan_id, customer_id, default_flag FROM active")
def flt1(spark, d):
    return R.active(spark, d).select("loan_id", "customer_id", "default_flag")


@query("flt3_drop_null", "SELECT loan_id, default_flag FROM master WHERE default_flag IS NOT NULL")
def flt3(spark, d):
    return R.master(spark, d).select("loan_id", "default_flag").na.drop(subset=["default_flag"])


@query("flt4_membership", """
SELECT loan_id, installment_no FROM repayments WHERE payment_status IN ('Late-1-30','Late-31-60')
  AND month(due_date) IN (4,10,11)""")
def flt4(spark, d):
    return R.repayments(spark, d).where(
        F.col("payment_status").isin("Late-1-30", "Late-31-60") & (E.festival_flag("due_date") == 1)
    ).select("loan_id", "installment_no")


@query("flt5_trim_edges", f"""
SELECT * FROM (SELECT {months('due_date')} AS due_month, count(*) AS n FROM repayments GROUP BY 1)
WHERE due_month > (SELECT min({months('due_date')}) FROM repayments) AND due_month < (SELECT max({months('due_date')}) FROM repayments)""")
def flt5(spark, d):
    by_month = R.repayments(spark, d).groupBy(E.to_month("due_date").alias("due_month")).agg(F.count("*").alias("n"))
    return A.trim_edges(by_month, "due_month")


@query("flt6_defaults_only", "SELECT loan_id, ticket_size FROM active WHERE default_flag = 1")
def flt6(spark, d):
    return R.active(spark, d).where("default_flag = 1").select("loan_id", "ticket_size")


# --- row-level expressions --------------------------------------------------

def _expr(name, sql_expr, build, source="loans", keys=("loan_id",), digits=4, frame=None):
    """Register ``<name>`` as key columns plus one computed column ``v`` over a whole role view."""
    cols = ", ".join(keys)

    @query(name, f"SELECT {cols}, {sql_expr} AS v FROM {source}", digits=digits)
    def run(spark, d):
        df = (frame or getattr(R, source))(spark, d)
        return df.select(*keys, build().alias("v"))


BAND_SQL = (
    "CASE WHEN bureau_score = 0 THEN 'NTC' WHEN bureau_score >= 750 THEN '750+' WHEN bureau_score >= 700 THEN '700-749' "
    "WHEN bureau_score >= 650 THEN '650-699' WHEN bureau_score >= 600 THEN '600+' ELSE '<600' END"
)
GRADE_SQL = (
    "CASE WHEN risk_tier = 'Prime' THEN CASE WHEN bureau_score >= 750 THEN 'A+' WHEN bureau_score >= 700 THEN 'A' ELSE 'A-' END "
    "WHEN risk_tier = 'Near-Prime' THEN CASE WHEN bureau_score >= 650 AND bureau_score < 700 THEN 'B' ELSE 'B-' END "
    "WHEN risk_tier = 'Subprime' THEN CASE WHEN bureau_score >= 600 AND bureau_score < 650 THEN 'C+' ELSE 'C' END ELSE 'D' END"
)
CUST = ("customer_id",)
REP = ("loan_id", "installment_no")


def _band_sql(col, edges, labels):
    whens = " ".join(f"WHEN {col} <= {e} THEN '{x}'" for e, x in zip(edges[1:], labels))
    return f"CASE WHEN {col} <= {edges[0]} THEN NULL {whens} END"


_expr("exp1_bureau_band", BAND_SQL, lambda: E.bureau_band(), "customers", CUST)
_expr("exp2_risk_grade", GRADE_SQL, lambda: E.risk_grade("risk_tier", "bureau_score"), "customers", CUST)
_expr("exp3_emi", "emi_amount", lambda: F.col("emi_amount"), digits=2)
_expr("exp4_dpd_bucket", "dpd_bucket", lambda: E.dpd_bucket("dpd"), "repayments", REP)
_expr("exp5_loan_status", "loan_status", lambda: E.sma_status("dpd", F.col("is_defaulted") == 1), "repayments", REP)
_expr("exp6_payment_date", "due_date + dpd", lambda: E.payment_date("due_date", "dpd"), "repayments", REP)
_expr("exp6_due_date", "origination_date + tenure_months * 30", lambda: E.due_date("origination_date", "tenure_months"))
_expr("exp7_ntc_flag", "CASE WHEN bureau_score = 0 THEN 1 ELSE 0 END", lambda: E.is_ntc("bureau_score"), "customers", CUST)
_expr("exp8_foir", r(clip(r("emi_amount / nullif(monthly_income, 0)", 3), "0.01e0", "0.9e0"), 3),
      lambda: E.foir(), "master", digits=3)
_expr("exp13_ticket_band", _band_sql("ticket_size", [0, 25000, 50000, 100000, 200000, 500000, 2000000],
                                     ["<25K", "25-50K", "50-100K", "100-200K", "200-500K", "500K+"]), lambda: E.ticket_band())
_expr("exp14_tenure_band", _band_sql("tenure_months", [0, 3, 6, 12, 24, 36, 48, 60],
                                     ["1-3M", "4-6M", "7-12M", "13-24M", "25-36M", "37-48M", "49-60M"]), lambda: E.tenure_band())
_expr("exp15_quarter", "year(due_date) || 'Q' || quarter(due_date)", lambda: E.to_quarter("due_date"), "repayments", REP)
_expr("exp16_month_name", "strftime(due_date, '%b')", lambda: E.month_name("due_date"), "repayments", REP)

LOSS_COLUMNS = "loan_id, recovery_amount, loss_given_default"


@query("exp9_recovery_lgd", f"SELECT {LOSS_COLUMNS} FROM outcomes", digits=2)
def exp9(spark, d):
    return R.outcomes(spark, d).select("loan_id", "recovery_amount", "loss_given_default")


@query("exp10_customer_ltv", "SELECT loan_id, customer_ltv FROM outcomes", digits=2)
def exp10(spark, d):
    return R.outcomes(spark, d).select("loan_id", "customer_ltv")


@query("exp11_risk_adjusted_return", "SELECT loan_id, risk_adjusted_return FROM outcomes")
def exp11(spark, d):
    return R.outcomes(spark, d).select("loan_id", "risk_adjusted_return")


@query("exp12_is_profitable", "SELECT loan_id, is_profitable FROM outcomes")
def exp12(spark, d):
    return R.outcomes(spark, d).select("loan_id", "is_profitable")


@query("exp17_feature_category", """
SELECT CASE WHEN regexp_matches(p_name, 'missed_|late_|partial_|payment_ratio|max_dpd|dpd_trend|consecutive_|months_no_|dpd_bucket|is_festival|sma_')
  THEN 'Repayment Behavioral'
  WHEN regexp_matches(p_name, 'rolling_30d|volatility_acc|cash_flow|income_shock|spending_shock|both_shocks|emi_obligation|min_cash_flow|inflow_trend|active_loan')
  THEN 'Bank Behavioral' ELSE 'Origination' END AS category, count(*) AS n
FROM (SELECT CASE p_partkey % 3 WHEN 0 THEN 'late_' || p_name WHEN 1 THEN 'min_cash_flow ' || p_name ELSE p_name END AS p_name FROM part)
GROUP BY 1""")
def exp17(spark, d):
    key = F.col("p_partkey") % 3
    name = F.when(key == 0, F.concat(F.lit("late_"), "p_name")).when(
        key == 1, F.concat(F.lit("min_cash_flow "), "p_name")).otherwise(F.col("p_name"))
    return R.read(spark, d, "part").groupBy(E.feature_category(name).alias("category")).agg(F.count("*").alias("n"))


@query("exp18_build_outcomes", "SELECT * FROM outcomes", digits=4)
def exp18(spark, d):
    return R.outcomes(spark, d)
