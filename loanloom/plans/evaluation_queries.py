"""Queries for evaluation of scored rows and for scorecards."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanloom import schema as S
from loanloom.functions import exprs as E
from loanloom.operators import evaluation as V
from loanloom.operators.modeling import split
from loanloom.operators import scorecard as C
from loanloom.plans.oracle import r
from loanloom.plans.registry import query
from loanloom.sources import roles as R

AUC = "sum(neg * (tp - pos / 2e0)) / (CAST(max(n_pos) AS DOUBLE) * max(n_neg))"
CUT = 0.45


@query("ev1_roc_points", """
SELECT fpr, tpr, threshold FROM (SELECT *, lead(pos) OVER w AS np, lead(neg) OVER w AS nn FROM rates WINDOW w AS (ORDER BY threshold DESC))
WHERE np IS NULL OR np <> pos OR nn <> neg UNION ALL SELECT 0e0, 0e0, CAST('Infinity' AS DOUBLE)""", digits=None)
def ev1(spark, d):
    return V.roc_points(R.scored(spark, d))


@query("ev1_roc_points_all", """
SELECT fpr, tpr, threshold FROM rates UNION ALL SELECT 0e0, 0e0, CAST('Infinity' AS DOUBLE)""", digits=None)
def ev1_all(spark, d):
    return V.roc_points(R.scored(spark, d), drop_intermediate=False)


@query("ev2_auc", f"SELECT {r(AUC, 6)} AS auc FROM curve", digits=6)
def ev2(spark, d):
    return V.auc(R.scored(spark, d)).select("auc")


@query("ev3_gini", f"SELECT {r('(' + AUC + ' * 2 - 1) * 100')} AS gini_pct FROM curve")
def ev3(spark, d):
    return V.auc(R.scored(spark, d)).select("gini_pct")


@query("ev4_ks", f"""
SELECT {r('max(abs(tpr - fpr))', 6)} AS ks, max(n_pos) AS n_pos, max(n_neg) AS n_neg, {r('max(abs(tpr - fpr)) * 100', 6)} AS ks_pct FROM rates""", digits=6)
def ev4(spark, d):
    return V.ks(R.scored(spark, d))


@query("ev5_ks_pvalue", f"""
SELECT {r('''CASE WHEN lam = 0 THEN 1e0 ELSE greatest(0e0, least(1e0, 1 - sqrt(2 * pi()) / sqrt(lam)
  * list_sum([exp(-(2e0 * k - 1) * (2e0 * k - 1) * pi() * pi() / (8 * lam)) FOR k IN range(1, 2000)]))) END''', 6)} AS p_value
FROM (SELECT CAST(n_pos AS DOUBLE) * n_neg / (n_pos + n_neg) * ks * ks AS lam FROM
  (SELECT max(abs(tpr - fpr)) AS ks, max(n_pos) AS n_pos, max(n_neg) AS n_neg FROM rates))""", digits=6)
def ev5(spark, d):
    return V.ks(R.scored(spark, d)).select(V.ks_pvalue().alias("p_value"))


@query("ev5_ks_test", f"""
SELECT {r('ks', 6)} AS ks, n_pos, n_neg, CASE WHEN greatest(n_pos, n_neg) <= 10000 THEN 'exact' ELSE 'asymptotic' END AS method
FROM (SELECT max(abs(tpr - fpr)) AS ks, CAST(max(n_pos) AS BIGINT) AS n_pos, CAST(max(n_neg) AS BIGINT) AS n_neg FROM rates)""", digits=6)
def ev5_test(spark, d):
    return V.ks_test(R.scored(spark, d)).drop("p_value")


@query("ev6_youden", f"""
SELECT {r('tpr - fpr', 6)} AS youden_j, round_even(greatest(0.1e0, least(0.6e0, threshold)), 3) AS threshold FROM
 (SELECT tpr, fpr, threshold FROM rates ORDER BY tpr - fpr DESC, threshold DESC LIMIT 1)""", digits=6)
def ev6(spark, d):
    return V.youden(R.scored(spark, d))


_PART = """(SELECT *, CASE WHEN h < 20 THEN 'test' WHEN h < 30 THEN 'valid' ELSE 'train' END AS part FROM
  (SELECT *, ('0x' || substr(md5(loan_id || '|' || installment_no), 1, 8))::BIGINT % 100 AS h FROM scored))"""


@query("ev6_threshold_elsewhere", f"""
SELECT 'valid' AS chosen_on, 'test' AS applied_to, threshold, youden_j, tn, fp, fn, tp, {r('tp / (tp + fp)', 6)} AS precision,
  {r('tp / (tp + fn)', 6)} AS recall, {r('2e0 * tp / (2 * tp + fp + fn)', 6)} AS f1 FROM (
  SELECT threshold, youden_j, count(*) FILTER (pred_prob < threshold AND target = 0) AS tn, count(*) FILTER (pred_prob >= threshold AND target = 0) AS fp,
    count(*) FILTER (pred_prob < threshold AND target = 1) AS fn, count(*) FILTER (pred_prob >= threshold AND target = 1) AS tp
  FROM {_PART} p, (
    SELECT round_even(greatest(0.1e0, least(0.6e0, t)), 3) AS threshold, {r('j', 6)} AS youden_j FROM (
      SELECT t, sum(pos) OVER w / sum(pos) OVER () - sum(neg) OVER w / sum(neg) OVER () AS j
      FROM (SELECT pred_prob AS t, sum(target) AS pos, sum(1 - target) AS neg FROM {_PART} q WHERE part = 'valid' GROUP BY 1)
      WINDOW w AS (ORDER BY t DESC)) ORDER BY j DESC, t DESC LIMIT 1)
  WHERE part = 'test' GROUP BY 1, 2)""", digits=6)
def ev6_elsewhere(spark, d):
    """The threshold is chosen on the validation rows and judged on the test rows."""
    return V.threshold_elsewhere(split(R.scored(spark, d), valid_pct=10))


@query("ev7_confusion", "SELECT tn, fp, fn, tp FROM cells")
def ev7(spark, d):
    return V.confusion(R.scored(spark, d), CUT)


PRECISION = "coalesce(tp / nullif(tp + fp, 0), 0e0)"
RECALL = "coalesce(tp / nullif(tp + fn, 0), 0e0)"
F1 = "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0e0)"
NEG = {"p": "coalesce(tn / nullif(tn + fn, 0), 0e0)", "r": "coalesce(tn / nullif(tn + fp, 0), 0e0)",
       "f": "coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0e0)"}


@query("ev8_precision_recall_f1", f"""
SELECT tn, fp, fn, tp, {r(PRECISION, 6)} AS precision, {r(RECALL, 6)} AS recall, {r(F1, 6)} AS f1 FROM cells""", digits=6)
def ev8(spark, d):
    return V.precision_recall_f1(V.confusion(R.scored(spark, d), CUT))


def _weighted(a, b):
    return r(f"({a} * (tn + fp) + {b} * (tp + fn)) / (tn + fp + fn + tp)", 6)


ACC = r("(tp + tn) / (tn + fp + fn + tp)", 6)


@query("ev8_classification_report", f"""
SELECT 'Non-Delinquent' AS label, {r(NEG['p'], 6)} AS precision, {r(NEG['r'], 6)} AS recall, {r(NEG['f'], 6)} AS f1, tn + fp AS support FROM cells
UNION ALL SELECT 'Will-Delinquent', {r(PRECISION, 6)}, {r(RECALL, 6)}, {r(F1, 6)}, tp + fn FROM cells
UNION ALL SELECT 'accuracy', {ACC}, {ACC}, {ACC}, tn + fp + fn + tp FROM cells
UNION ALL SELECT 'macro avg', {r(f"({NEG['p']} + {PRECISION}) / 2", 6)}, {r(f"({NEG['r']} + {RECALL}) / 2", 6)}, {r(f"({NEG['f']} + {F1}) / 2", 6)}, tn + fp + fn + tp FROM cells
UNION ALL SELECT 'weighted avg', {_weighted(NEG['p'], PRECISION)}, {_weighted(NEG['r'], RECALL)}, {_weighted(NEG['f'], F1)}, tn + fp + fn + tp FROM cells""", digits=6)
def ev8_report(spark, d):
    return V.classification_report(V.confusion(R.scored(spark, d), CUT))


@query("ev9_average_precision", f"""
SELECT {r('sum(pos / n_pos * (tp / (tp + fp)))', 6)} AS average_precision FROM curve""", digits=6)
def ev9(spark, d):
    return V.average_precision(R.scored(spark, d))


@query("ev10_rates", f"""
SELECT {r('tp * 100e0 / (tp + fn)')} AS tpr_pct, {r('tn * 100e0 / (tn + fp)')} AS tnr_pct, {r('fp * 100e0 / (fp + tn)')} AS fpr_pct,
  {r('fn * 100e0 / (fn + tp)')} AS fnr_pct FROM cells""")
def ev10(spark, d):
    return V.rates(V.confusion(R.scored(spark, d), CUT))


@query("ev11_verdicts", f"""
SELECT CASE WHEN a > 0.85 THEN 'Excellent' WHEN a > 0.75 THEN 'Good' WHEN a > 0.65 THEN 'Moderate' ELSE 'Needs improvement' END AS auc_verdict,
  CASE WHEN (a * 2 - 1) * 100 > 60 THEN 'Strong (production-ready)' WHEN (a * 2 - 1) * 100 > 40 THEN 'Good (suitable for EWS)'
    WHEN (a * 2 - 1) * 100 > 25 THEN 'Moderate (further tuning recommended)' ELSE 'Weak' END AS gini_verdict,
  CASE WHEN k > 50 THEN 'Excellent' WHEN k > 35 THEN 'Good' WHEN k > 20 THEN 'Moderate' ELSE 'Weak' END AS ks_verdict,
  CASE WHEN abs(a - 0.5) < 0.05 THEN 'Acceptable' ELSE 'POSSIBLE OVERFIT' END AS gap_verdict
FROM (SELECT {AUC} AS a FROM curve), (SELECT max(abs(tpr - fpr)) * 100 AS k FROM rates)""")
def ev11(spark, d):
    scored = R.scored(spark, d)
    row = V.auc(scored).withColumn("ks_pct", V.ks(scored).select("ks_pct").scalar())
    return row.select(
        E.verdict("auc", "auc").alias("auc_verdict"), E.verdict("gini", "gini_pct").alias("gini_verdict"),
        E.verdict("ks", "ks_pct").alias("ks_verdict"), E.gap_verdict(F.col("auc") - 0.5).alias("gap_verdict"),
    )


# --- scorecard --------------------------------------------------------------

def _bucketed(spark, d):
    return C.with_bucket(C.latest_scores(R.scored_with_tier(spark, d)))


@query("sc1_risk_bucket", """
SELECT loan_id, installment_no, CASE WHEN pred_prob >= 0.45e0 THEN 'RED' WHEN pred_prob >= 0.2e0 THEN 'AMBER' ELSE 'GREEN' END AS risk_bucket FROM scored""")
def sc1(spark, d):
    return C.with_bucket(R.scored(spark, d)).select("loan_id", "installment_no", "risk_bucket")


@query("sc1_published_thresholds", """
SELECT loan_id, installment_no, CASE WHEN pred_prob >= 0.4e0 THEN 'RED' WHEN pred_prob >= 0.15e0 THEN 'AMBER' ELSE 'GREEN' END AS risk_bucket FROM scored""")
def sc1_published(spark, d):
    return C.with_bucket(R.scored(spark, d), 0.15, 0.40).select("loan_id", "installment_no", "risk_bucket")


@query("sc2_latest_scores", "SELECT loan_id, installment_no, target, pred_prob FROM latest")
def sc2(spark, d):
    return C.latest_scores(R.scored(spark, d))


SUMMARY = f"""
SELECT risk_bucket AS bucket, count(*) AS n, {r('count(*) * 100e0 / (SELECT count(*) FROM bucketed)')} AS share_pct,
  {r('avg(pred_prob)')} AS mean_prob, {r('avg(target) * 100')} AS actual_delinquency_rate,
  {r('coalesce(sum(target) * 100e0 / nullif((SELECT sum(target) FROM bucketed), 0), 0)')} AS catch_rate FROM bucketed GROUP BY 1"""


@query("sc3_scorecard_summary", SUMMARY)
def sc3(spark, d):
    return C.scorecard_summary(_bucketed(spark, d))


@query("sc4_tier_decode", """
SELECT loan_id, CASE risk_tier_encoded WHEN 0 THEN 'Prime' WHEN 1 THEN 'Near-Prime' WHEN 2 THEN 'Subprime' WHEN 3 THEN 'Thin-File' ELSE 'Unknown' END AS risk_tier_label
FROM latest""")
def sc4(spark, d):
    return _bucketed(spark, d).select("loan_id", E.decode("risk_tier_encoded", S.TIER_ORDINAL).alias("risk_tier_label"))


@query("sc5_tier_bucket_rates", "SELECT CASE risk_tier_encoded WHEN 0 THEN 'Prime' WHEN 1 THEN 'Near-Prime' WHEN 2 THEN 'Subprime' "
       "WHEN 3 THEN 'Thin-File' ELSE 'Unknown' END AS risk_tier_label, "
       + ", ".join(f"{r(f'''avg(target) FILTER (WHERE risk_bucket = '{b}') * 100''', 2)} AS \"{b}\"" for b in S.RISK_BUCKETS)
       + " FROM bucketed GROUP BY 1")
def sc5(spark, d):
    return C.tier_bucket_rates(_bucketed(spark, d))


def _values(rows):
    def lit(v):
        return "'" + v.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)


@query("sc6_interventions", f"""
SELECT loan_id, risk_bucket, action1, contact, urgency, escalate FROM bucketed
JOIN (VALUES {_values(S.INTERVENTIONS)}) AS t(risk_bucket, label, action1, action2, action3, contact, urgency, escalate) USING (risk_bucket)""")
def sc6(spark, d):
    return C.attach_interventions(_bucketed(spark, d)).select(
        "loan_id", "risk_bucket", "action1", "contact", "urgency", "escalate"
    )


@query("sc7_scorecard_table", "SELECT loan_id, installment_no, risk_bucket, pred_prob, target, risk_tier_encoded FROM bucketed")
def sc7(spark, d):
    return C.scorecard_table(_bucketed(spark, d))


@query("sc8_bucket_metric", f"SELECT actual_delinquency_rate FROM ({SUMMARY}) WHERE bucket = 'RED'")
def sc8(spark, d):
    return C.bucket_metric(C.scorecard_summary(_bucketed(spark, d)), "RED", "actual_delinquency_rate")
