import numpy as np
import pytest
from pyspark.sql import functions as F

from loanloom.operators import evaluation as V
from loanloom.operators import scorecard as C
from loanloom.operators import stats as T


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    y = rng.random(600) < 0.3
    p = np.round(np.clip(rng.normal(0.35 + 0.15 * y, 0.2), 0, 1), 2)
    rows = [(f"L{i % 150}", i // 150 + 1, int(a), float(b), int(i % 5)) for i, (a, b) in enumerate(zip(y, p))]
    return spark.createDataFrame(
        rows, "loan_id string, installment_no int, target int, pred_prob double, risk_tier_encoded int").cache()


def arrays(df):
    pdf = df.toPandas()
    return pdf["target"].to_numpy(), pdf["pred_prob"].to_numpy()


def brute_curve(y, p):
    cuts = np.unique(p)[::-1]
    tp = np.array([(y[p >= c] == 1).sum() for c in cuts])
    fp = np.array([(y[p >= c] == 0).sum() for c in cuts])
    return cuts, tp, fp


def check_all(scored):
    y, p = arrays(scored)
    cuts, tp, fp = brute_curve(y, p)
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    wins = sum((p[y == 0] < s).sum() + 0.5 * (p[y == 0] == s).sum() for s in p[y == 1])
    row = V.auc(scored).first()
    assert row["auc"] == pytest.approx(wins / (n1 * n0)) and row["gini_pct"] == pytest.approx((2 * wins / (n1 * n0) - 1) * 100)
    gaps = tp / n1 - fp / n0
    assert V.ks(scored).first()["ks"] == pytest.approx(np.abs(gaps).max())
    best = V.youden(scored).first()
    assert best["youden_j"] == pytest.approx(gaps.max())
    assert best["threshold"] == pytest.approx(round(min(max(cuts[gaps.argmax()], 0.1), 0.6), 3))
    precision = tp / (tp + fp)
    recall = tp / n1
    ap = (np.diff(np.r_[0, recall]) * precision).sum()
    assert V.average_precision(scored).first()["average_precision"] == pytest.approx(ap)
    full = V.roc_points(scored, drop_intermediate=False).toPandas().sort_values("threshold", ascending=False)
    np.testing.assert_allclose(full["tpr"], np.r_[0, tp / n1])
    keep = np.r_[np.logical_or(np.diff(np.r_[0, fp], 2), np.diff(np.r_[0, tp], 2)), True]
    thin = V.roc_points(scored).toPandas().sort_values("threshold", ascending=False)
    np.testing.assert_allclose(thin["threshold"].to_numpy()[1:], cuts[keep])
    assert np.isinf(thin["threshold"].iloc[0])


def test_curve_metrics_direct(scored):
    check_all(scored)


def test_curve_metrics_bucketed(scored, no_small_path):
    check_all(scored)


def test_auc_equals_mann_whitney(scored):
    u = T.mann_whitney(scored, "pred_prob", "target").first()
    assert u["u"] / (u["n1"] * u["n0"]) == pytest.approx(V.auc(scored).first()["auc"])


def test_confusion_and_report(scored):
    y, p = arrays(scored)
    cells = V.confusion(scored, 0.45)
    c = cells.first()
    assert c["tp"] == ((p >= 0.45) & (y == 1)).sum() and sum(c) == len(y)
    r = V.precision_recall_f1(cells).first()
    assert r["f1"] == pytest.approx(2 * r["precision"] * r["recall"] / (r["precision"] + r["recall"]))
    report = {x["label"]: x for x in V.classification_report(cells).collect()}
    assert report["macro avg"]["support"] == len(y) and report["Will-Delinquent"]["support"] == (y == 1).sum()
    assert report["accuracy"]["f1"] == pytest.approx((c["tp"] + c["tn"]) / len(y))
    rates = V.rates(cells).first()
    assert rates["tpr_pct"] + rates["fnr_pct"] == pytest.approx(100)


def test_single_class(spark):
    one = spark.createDataFrame([(0, 0.2), (0, 0.7)], "target int, pred_prob double")
    assert V.auc(one).first()["auc"] is None
    r = V.precision_recall_f1(V.confusion(one, 0.5)).first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)
    assert V.average_precision(one).first()["average_precision"] == 0.0


def test_ks_pvalue(spark):
    # Kolmogorov's distribution at lambda: published table values
    table = {0.0: 1.0, 0.4: 0.9972, 0.8: 0.5441, 1.0: 0.2700, 1.17: 0.1294, 1.19: 0.1177, 1.36: 0.0495, 1.63: 0.0098}
    rows = [(float(lam / np.sqrt(5000)), 10_000, 10_000) for lam in table] + [(0.001, 100, 100), (0.05, 100, 100), (1.0, 50, 50)]
    frame = spark.createDataFrame(rows, "ks double, n_pos int, n_neg int").coalesce(1)
    got = [r[0] for r in frame.select(V.ks_pvalue()).collect()]
    assert got[:len(table)] == pytest.approx(list(table.values()), abs=6e-4)
    assert got[-3] == 1.0 and got[-2] == pytest.approx(0.9996, abs=2e-3) and got[-1] < 1e-15


def test_thin_curve_is_stable(scored):
    points = V.curve(scored).select("fpr", "tpr", "threshold")
    a, b = (V.thin_curve(points, 10).toPandas().sort_values("threshold")["threshold"].tolist() for _ in range(2))
    assert a == b and 5 <= len(a) <= 11


def test_scorecard(scored):
    latest = C.latest_scores(scored)
    assert latest.count() == 150 and latest.agg(F.min("installment_no")).first()[0] == 4
    bucketed = C.with_bucket(latest)
    s = C.scorecard_summary(bucketed).toPandas()
    assert s["share_pct"].sum() == pytest.approx(100) and s["catch_rate"].sum() == pytest.approx(100)
    none = C.scorecard_summary(bucketed.withColumn("target", F.lit(0))).toPandas()
    assert (none["catch_rate"] == 0).all()
    table = C.tier_bucket_rates(bucketed).toPandas()
    assert "Unknown" in set(table["risk_tier_label"])
    assert C.attach_interventions(bucketed).where("action1 is null").count() == 0


def test_exact_ks_pvalue_by_hand_and_by_sql():
    """All orders of small samples one by one, and the lattice recursion written in SQL."""
    from itertools import combinations

    import duckdb

    from loanloom.operators.evaluation import ks_exact

    for n, m in ((1, 1), (2, 3), (4, 4), (5, 2), (3, 6)):
        gaps = []
        for mine in combinations(range(n + m), n):
            i = j = top = 0
            for k in range(n + m):
                i, j = i + (k in mine), j + (k not in mine)
                top = max(top, abs(i * m - j * n))
            gaps.append(top)
        for reach in range(n * m + 1):
            assert ks_exact(reach / (n * m), n, m) == pytest.approx(sum(g >= reach for g in gaps) / len(gaps), abs=1e-12)
    for d, n, m in ((0.5, 8, 10), (0.3, 20, 15), (0.9, 12, 12)):
        reach = round(d * n * m)
        told = duckdb.sql(f"""
WITH RECURSIVE w AS (
  SELECT 0 AS s, 0 AS i, 0e0 AS hit
  UNION ALL
  SELECT s + 1, k, CASE WHEN abs(k * {m} - (s + 1 - k) * {n}) >= {reach} THEN 1e0 ELSE hit END FROM (
    SELECT s, i + step AS k, sum(hit * CASE WHEN step = 1 THEN i + 1 ELSE s + 1 - i END) / (s + 1) AS hit
    FROM w, (VALUES (0), (1)) t(step) WHERE s < {n + m} AND i + step <= {n} AND s + 1 - i - step <= {m} GROUP BY 1, 2))
SELECT hit FROM w WHERE s = {n + m}""").fetchall()
        assert ks_exact(d, n, m) == pytest.approx(told[0][0], rel=1e-9)
    assert ks_exact(0.0, 5, 7) == 1.0 and 0 < ks_exact(1.0, 500, 500) < 1e-250


def test_ks_test_names_its_method(spark):
    from loanloom.operators.evaluation import ks_exact, ks_test

    rows = spark.createDataFrame([(i % 2, (i * 7 % 20) / 20) for i in range(20)], "target int, pred_prob double")
    got = ks_test(rows).first()
    assert got.method == "exact" and got.p_value == pytest.approx(ks_exact(got.ks, 10, 10))
    assert ks_test(rows, exact_rows=5).first().method == "asymptotic"
    one = ks_test(rows.where("target = 1")).first()
    assert one.ks is None and one.method is None


def test_threshold_is_chosen_on_another_part(spark):
    from loanloom.operators.evaluation import threshold_elsewhere

    rows = [("valid", 1, 0.5), ("valid", 1, 0.4), ("valid", 0, 0.3), ("test", 1, 0.45), ("test", 0, 0.41), ("test", 1, 0.2), ("test", 0, 0.1), ("train", 1, 0.11)]
    got = threshold_elsewhere(spark.createDataFrame(rows, "part string, target int, pred_prob double")).first()
    assert (got.chosen_on, got.applied_to, got.threshold) == ("valid", "test", 0.4)
    assert (got.tn, got.fp, got.fn, got.tp) == (1, 1, 1, 1) and got.f1 == pytest.approx(0.5)
