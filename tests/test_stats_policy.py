import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanloom import schema as S
from loanloom.operators import aggregates as A
from loanloom.operators import joins as J
from loanloom.operators import policy as P
from loanloom.operators import stats as T

import fixtures as D


@pytest.fixture(scope="module")
def active(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(400):
        tier = S.TIERS[int(rng.integers(0, 3))]
        channel = ["Referral", "Paid-Digital", "DSA-Agent", None][int(rng.integers(0, 4))]
        bad = int(rng.random() < 0.1 + 0.1 * S.TIER_ORDINAL[tier])
        rows.append((f"L{i}", tier, channel, float(rng.integers(1, 40)), bad, float(rng.normal(10, 3)), int(rng.integers(1, 5)) * 100,
                     0.5, 1, 700, 30.0, i % 2))
    return spark.createDataFrame(
        rows, "loan_id string, risk_tier string, acquisition_channel string, ticket_size double, default_flag int, "
              "customer_ltv double, cost_of_acquisition int, risk_adjusted_return double, is_profitable int, "
              "bureau_score int, monthly_income double, cooling_off_exit int").cache()


def test_shares_and_domain(active):
    stats = A.channel_stats(active).toPandas()
    assert stats["volume_pct"].sum() == pytest.approx(100) and None not in set(stats["acquisition_channel"])
    tiers = [r["risk_tier"] for r in J.reindex_to(A.segment_stats(active), "risk_tier", S.TIERS).collect()]
    assert tiers == S.TIERS
    kept = J.reindex_to(A.segment_stats(active), "risk_tier", S.TIERS, drop=True).collect()
    assert [r["risk_tier"] for r in kept] == S.TIERS[:3]
    pivot = A.rate_pivot(active, "acquisition_channel", "risk_tier", S.TIERS, fill=0.0).toPandas()
    assert (pivot["Thin-File"] == 0.0).all()
    assert A.rate_pivot(active, "acquisition_channel", "risk_tier", S.TIERS).toPandas()["Thin-File"].isna().all()


def test_roll_rates_sum_to_100(spark):
    for max_rows in (None, 2):
        rolls = T.roll_rates(D.repayments(spark).where("dpd_bucket <> 'Odd-Bucket'"), max_rows).toPandas()
        np.testing.assert_allclose(rolls[S.DPD_BUCKETS].sum(axis=1), 100)
        assert rolls["n"].sum() == 14


def brute_ranks(pdf, value):
    return pdf[value].rank().to_numpy()


def rank_checks(active):
    pdf = active.toPandas()
    rank = brute_ranks(pdf, "ticket_size")
    n = len(pdf)
    h = 12 / (n * (n + 1)) * sum(rank[pdf["risk_tier"] == t].sum() ** 2 / (pdf["risk_tier"] == t).sum() for t in S.TIERS[:3]) - 3 * (n + 1)
    t = pdf["ticket_size"].value_counts().to_numpy().astype(float)
    h /= 1 - (t ** 3 - t).sum() / (n ** 3 - n)
    row = T.kruskal(active, "ticket_size", "risk_tier").first()
    assert row["h"] == pytest.approx(h) and row["dof"] == 2
    rho = np.corrcoef(rank, brute_ranks(pdf, "customer_ltv"))[0, 1]
    assert T.spearman(active, "ticket_size", "customer_ltv").first()["rho"] == pytest.approx(rho)


def test_rank_tests_direct(active):
    rank_checks(active)


def test_rank_tests_bucketed(active, no_small_path):
    rank_checks(active)


def test_contingency(active):
    pdf = active.toPandas()
    table = pdf.groupby(["risk_tier", "default_flag"]).size().unstack(fill_value=0).to_numpy().astype(float)
    want = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    chi2 = ((table - want) ** 2 / want).sum()
    row = T.cramers_v(active, "risk_tier", "default_flag").withColumn("p", T.chi2_pvalue("chi2", "dof")).first()
    assert row["chi2"] == pytest.approx(chi2) and row["cramers_v"] == pytest.approx(math.sqrt(chi2 / table.sum()))
    assert row["dof"] == 2 and row["p"] == pytest.approx(math.exp(-chi2 / 2))


def test_pvalues(spark):
    df = spark.createDataFrame([(3.841458820694124, 1), (100.0, 100), (0.0, 3)], "s double, k int")
    got = [r[0] for r in df.select(T.chi2_pvalue("s", "k")).collect()]
    assert got[0] == pytest.approx(0.05, abs=1e-9) and got[1] == pytest.approx(0.4811917, abs=1e-6) and got[2] == 1.0
    z = spark.createDataFrame([(1.959963984540054,)], "z double").select(T.normal_pvalue("z")).first()[0]
    assert z == pytest.approx(0.05)


def iv_checks(active):
    pdf = active.toPandas()
    got = {r["attribute"]: r for r in T.information_value(active, "default_flag", ["ticket_size"], ["risk_tier"]).collect()}

    def iv(groups):
        bad = np.maximum(pdf.groupby(groups)["default_flag"].sum(), 0.5) / pdf["default_flag"].sum()
        good = np.maximum((1 - pdf["default_flag"]).groupby(groups).sum(), 0.5) / (1 - pdf["default_flag"]).sum()
        return ((good - bad) * np.log(good / bad)).sum()

    edges = pdf["ticket_size"].quantile([i / 10 for i in range(1, 10)]).to_numpy()
    assert got["ticket_size"]["iv"] == pytest.approx(iv(np.searchsorted(edges, pdf["ticket_size"], side="left")))
    assert got["risk_tier"]["iv"] == pytest.approx(iv(pdf["risk_tier"]))


def test_information_value_direct(active):
    iv_checks(active)


def test_information_value_bucketed(active, no_small_path):
    iv_checks(active)


def test_anova_and_ci(active):
    pdf = active.toPandas()
    groups = [g["customer_ltv"].to_numpy() for _, g in pdf.groupby("risk_tier")]
    n, k, grand = len(pdf), len(groups), pdf["customer_ltv"].mean()
    f = (sum(len(g) * (g.mean() - grand) ** 2 for g in groups) / (k - 1)) / (sum(((g - g.mean()) ** 2).sum() for g in groups) / (n - k))
    assert T.anova_f(active, "customer_ltv", "risk_tier").first()["f"] == pytest.approx(f)
    row = T.rate_ci(active, "default_flag").first()
    p = pdf["default_flag"].mean()
    assert row["high_pct"] - row["rate_pct"] == pytest.approx(196 * math.sqrt(p * (1 - p) / n))


def test_distribution_skew_variants(active):
    pdf = active.toPandas()
    got = T.distribution(active, "ticket_size", "risk_tier", bias_corrected=True).toPandas().set_index("risk_tier")
    want = pdf.groupby("risk_tier")["ticket_size"]
    np.testing.assert_allclose(got["skew"].sort_index(), want.skew().sort_index())
    np.testing.assert_allclose(got["p90"].sort_index(), want.quantile(0.9).sort_index())


def test_predefault_windows_skip_later_months(spark):
    got = {r["time_window"]: r["n"] for r in T.predefault_windows(D.signals(spark), D.repayments(spark)).collect()}
    assert got == {"normal": 5, "6-4M": 2, "3-1M": 3}  # L1 defaults at 6: months 1-2, 3-5; month 6 in no window


def test_escalations(spark):
    rows = [("a", m, c, b, e) for m, (c, b, e) in enumerate(
        [(0.9, 0.1, 0.3), (0.8, 0.2, 0.45), (0.7, 0.3, 0.55), (0.6, 0.4, 0.6), (0.7, 0.5, 0.7)], start=1)]
    df = spark.createDataFrame(rows, "loan_id string, month int, cash_flow_consistency double, balance_volatility double, emi_obligation_ratio double")
    for max_rows in (None, 3):
        assert [r["month"] for r in P.escalations(df, max_rows=max_rows).orderBy("month").collect()] == [3, 4]


def test_status_and_limits(spark):
    kpis = spark.createDataFrame([("default_rate_pct", 8.0), ("avg_ltv", 24000.0), ("profitable_pct", 70.0)], "kpi string, value double")
    assert {r["kpi"]: r["status"] for r in P.kpi_status(kpis).collect()} == {
        "default_rate_pct": "GREEN", "avg_ltv": "RED", "profitable_pct": "AMBER"}
    flags = P.limit_flags(spark.createDataFrame([("subprime_share_pct", 25.0), ("avg_turnaround_days", 2.0)], "kpi string, value double"),
                          S.ORIGINATION_LIMITS)
    assert {r["kpi"]: r["flagged"] for r in flags.collect()} == {"subprime_share_pct": 0, "avg_turnaround_days": 1}


def test_stance_caps_and_mix(spark):
    cols = ("risk_tier string, foir double, employment_stability_score int, bureau_score int, employment_type string, "
            "income_shock_flag_3m int, both_shocks_flag int, cash_flow_consistency double, product_type string, tenure_months int, ticket_size int")
    rows = [("Prime", None, 1, 1, "Gig-Worker", 0, 0, None, "BNPL", 60, 300000),
            ("Near-Prime", 0.39, 6, 650, "x", 0, 0, None, "Personal-Loan", 37, 150001),
            ("Subprime", 0.3, 5, 541, "x", 1, 0, None, "Personal-Loan", 24, 75000),
            ("Thin-File", 0.3, 5, 0, "x", 0, 0, 0.61, "SME-Working-Capital", 19, 30001),
            (None, 0.3, 5, 0, "x", 0, 0, 0.61, "BNPL", 19, 1)]
    df = spark.createDataFrame(rows, cols)
    out = P.ticket_breach(P.tenure_breach(P.approval_stance(df))).collect()
    assert [r["stance"] for r in out] == ["approve", "approve", "decline", "approve on account data", "refer"]
    assert [r["tenure_breach"] for r in out] == [0, 1, 0, 1, 0] and [r["ticket_breach"] for r in out] == [0, 1, 0, 1, 0]
    assert out[0]["extra_scrutiny"] == 1
    stats = spark.createDataFrame([("A", 10, 100.0, 10.0), ("B", 90, 50.0, 5.0)],
                                  "acquisition_channel string, n_loans long, avg_cac double, default_rate_pct double")
    row = P.mix_shift(stats, "A", "B", 50).first()  # only ten loans can move
    assert row["cac_after"] == pytest.approx(50.0) and row["cac_before"] == pytest.approx(55.0)
    penalty = {r["acquisition_channel"]: r["double_penalty"] for r in P.double_penalty(stats).collect()}
    assert penalty == {"A": 1, "B": 0}


def test_trim_and_seasonality(spark):
    rep = D.repayments(spark)
    months = A.monthly_kpis(rep, trim=False)
    assert A.monthly_kpis(rep).count() == months.count() - 2
    assert months.agg(F.sum("total_cnt")).first()[0] == 19
