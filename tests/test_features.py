import pytest
from pyspark.sql import functions as F

from loanloom import schema as S
from loanloom.operators import aggregates as A
from loanloom.operators import features as X
from loanloom.operators import joins as J
from loanloom.operators.ordered import latest_per
from loanloom.plans.panel import build_panel

import fixtures as D

ON_TIME, MISSED = "Paid-On-Time", "Missed"
REPAYMENTS = "loan_id string, installment_no int, dpd_bucket string, loan_status string, dpd int, payment_status string, amount_paid double, emi_due double"


def check(got, want):
    """``want`` maps a row's key to the features worked out for it by hand."""
    for key, features in want.items():
        for name, value in features.items():
            assert got[key][name] == pytest.approx(value), (key, name)


@pytest.mark.parametrize("max_rows", [None, 3])
def test_repayment_features_by_hand(spark, max_rows):
    rows = [
        ("A", 1, "Current", "Standard", 0, ON_TIME, 100.0, 100.0),
        ("A", 2, "DPD_1-30", "SMA-1", 12, MISSED, 0.0, 100.0),
        ("A", 3, "DPD_31-60", "SMA-2", 40, "Late-31-60", 50.0, 100.0),
        ("A", 4, "Current", "Standard", 0, ON_TIME, 150.0, 100.0),
        ("A", 5, "DPD_61-90", "NPA", 70, MISSED, 10.0, 0.0),
        ("B", 1, "DPD_90+", "Defaulted", 120, MISSED, 5.0, None),
    ]
    rep = spark.createDataFrame(rows, REPAYMENTS)
    for name, kind in D.repayments(spark).dtypes:
        if name not in rep.columns:
            rep = rep.withColumn(name, F.lit(None).cast(kind))
    got = {(r["loan_id"], r["installment_no"]): r for r in X.repayment_features(rep, max_rows).collect()}
    ordinal = S.STATUS_ORDINAL
    sma1, sma2, npa = ordinal["SMA-1"], ordinal["SMA-2"], ordinal["NPA"]
    check(got, {
        # the next bucket is 1-30: not late enough for the label; nothing lies before
        ("A", 1): {"target": 0, "max_dpd_last_3m": 0, "dpd_trend_slope": 0, "sma_trend": 0, "missed_payment_last_3m": 0,
                   "months_no_on_time": 2, "payment_ratio_last_month": 1},
        # the next bucket is 31-60; a month before the first counts as not on time
        ("A", 2): {"target": 1, "max_dpd_last_3m": 12, "dpd_trend_slope": 6, "sma_trend": sma1 / 2, "missed_payment_last_3m": 1,
                   "months_no_on_time": 2, "payment_ratio_last_month": 0},
        ("A", 3): {"target": 0, "max_dpd_last_3m": 40, "dpd_trend_slope": 20, "sma_trend": sma2 / 2, "missed_payment_last_3m": 1,
                   "months_no_on_time": 2, "payment_ratio_last_month": 0.5},
        # 0 against 12 two months ago; an overpayment counts as 1
        ("A", 4): {"target": 1, "max_dpd_last_3m": 40, "dpd_trend_slope": -6, "sma_trend": -sma1 / 2, "missed_payment_last_3m": 1,
                   "months_no_on_time": 2, "payment_ratio_last_month": 1},
        # the last row has no next bucket; nothing due gives ratio 0
        ("A", 5): {"target": 0, "max_dpd_last_3m": 70, "dpd_trend_slope": 15, "sma_trend": (npa - sma2) / 2, "missed_payment_last_3m": 1,
                   "months_no_on_time": 2, "payment_ratio_last_month": 0},
        ("B", 1): {"target": 0, "max_dpd_last_3m": 120, "dpd_trend_slope": 60, "missed_payment_last_3m": 1, "months_no_on_time": 3,
                   "payment_ratio_last_month": 0},
    })


def test_last_instalment_label(spark):
    rep = D.repayments(spark)
    last = {r["loan_id"]: r["target"] for r in X.repayment_features(rep).where("loan_id = 'L2'").collect()}
    assert last == {"L2": 0}
    dropped = X.repayment_features(rep, censored="drop")
    assert dropped.where("loan_id = 'L2'").first()["target"] is None
    kept = {(r["loan_id"], r["installment_no"]) for r in X.eligible(dropped).collect()}
    assert ("L3", 4) in kept and ("L3", 6) not in kept


def test_signal_features_by_hand(spark):
    names = "loan_id string, month int, balance_volatility double, avg_monthly_inflow int, spending_shock_flag int, income_shock_flag int"
    rows = [("A", 1, 0.2, 1000, 0, 1), ("A", 2, 0.4, 1200, 1, 0), ("A", 3, 0.9, 1500, 0, 1), ("A", 4, 0.1, 3600, 0, 0), ("B", 1, 0.4, 0, 0, 0)]
    sig = spark.createDataFrame(rows, names)
    for name, kind in D.signals(spark).dtypes:
        if name not in sig.columns:
            sig = sig.withColumn(name, F.lit(0).cast(kind))
    got = {(r["loan_id"], r["month"]): r for r in X.signal_features(sig).collect()}
    # medians of all rows stand in for missing months: volatility 0.4, inflow 1200, flags 0
    check(got, {
        ("A", 1): {"rolling_30d_balance_volatility": (0.2 + 0.4 + 0.4) / 3, "inflow_trend": -200 / 1200, "spending_shock_flag_3m": 0,
                   "income_shock_count": 1},
        ("A", 2): {"rolling_30d_balance_volatility": (0.4 + 0.2 + 0.4) / 3, "inflow_trend": 0.0, "spending_shock_flag_3m": 1,
                   "income_shock_count": 1},
        ("A", 3): {"rolling_30d_balance_volatility": 0.5, "inflow_trend": 0.5, "spending_shock_flag_3m": 1, "income_shock_count": 2},
        # tripled: cut at 1
        ("A", 4): {"inflow_trend": 1.0, "spending_shock_flag_3m": 0, "income_shock_count": 1},
        ("B", 1): {"rolling_30d_balance_volatility": 0.4, "inflow_trend": -1.0},
    })


def test_origination_defaults(spark):
    got = {r["loan_id"]: r for r in X.origination_features(D.loans(spark), D.customers(spark)).collect()}
    zero_income, unknown, orphan = got["L2"], got["L3"], got["L6"]
    assert (zero_income["emi_to_income_ratio"], zero_income["ticket_to_income_ratio"]) == (0.5, 1.0)
    assert (unknown["risk_tier_encoded"], unknown["grade_encoded"], unknown["employment_risk"]) == (2, 4, 3)
    assert (unknown["product_risk"], unknown["channel_risk_score"], unknown["processing_fee_pct"]) == (1.0, 1.0, 0.05)
    assert orphan["risk_tier_encoded"] == 2 and orphan["bureau_score"] is None


@pytest.mark.parametrize("mode", ["month", "latest", "auto"])
def test_panel_has_no_nulls(spark, mode):
    panel = build_panel(D.repayments(spark), D.signals(spark), D.loans(spark), D.customers(spark), mode=mode)
    assert panel.columns == ["loan_id", "installment_no", "target", *S.FEATURES]
    assert A.null_audit(panel).first()["total_nulls"] == 0
    rows = {(r["loan_id"], r["installment_no"]): r["target"] for r in panel.collect()}
    assert rows == {("L1", 7): 0, ("L3", 4): 1, ("L3", 6): 0, ("L4", 4): 0, ("L4", 5): 0, ("L4", 6): 0}


def test_match_rate_modes(spark):
    obs = D.repayments(spark).select("loan_id", "installment_no")
    sig = D.signals(spark).withColumnRenamed("month", "installment_no")
    keys = ["loan_id", "installment_no"]
    rate = J.match_rate(obs, sig, keys).first()
    missing = J.unmatched_keys(obs, sig, keys).count()
    assert rate["n_matched"] + missing == rate["n_keys"] == 19
    chosen = J.attach_signals(obs, D.signals(spark).select("loan_id", "month", "active_loan_accounts"), min_match=0.99)
    latest = {r["loan_id"]: r["active_loan_accounts"] for r in chosen.collect()}
    assert latest == {"L1": 6, "L2": 1, "L3": 4, "L4": None}


def test_outcomes_and_master(spark):
    loans = D.loans(spark).withColumn("recovery_rate", F.lit(0.5))
    out = J.build_outcomes(loans, A.loan_rollup(D.repayments(spark)))
    rows = {r["loan_id"]: r for r in out.collect()}
    assert set(rows) == {"L1", "L2", "L3", "L4", "L5"}
    cooled = rows["L5"]
    assert (cooled["final_loan_status"], cooled["default_flag"], cooled["customer_ltv"]) == ("Cooling-Off-Exit", 0, 0.0)
    bad = rows["L1"]
    assert bad["default_flag"] == 1 and bad["final_loan_status"] == "Standard"
    assert bad["recovery_amount"] == int((25000 - bad["total_amount_paid"]) * 0.5)
    master = J.build_master(D.loans(spark), D.customers(spark), out)
    assert master.count() == 6 and len(master.columns) == 34
    assert J.build_master(D.loans(spark), D.customers(spark), out, wide=True).count() == 6


@pytest.mark.parametrize("max_rows", [None, 3])
def test_latest_shocks_equal_the_full_features(spark, max_rows):
    signals = D.signals(spark)
    got = X.latest_shocks(signals, ["cash_flow_consistency"], max_rows)
    flags = ["income_shock_flag_3m", "spending_shock_flag_3m", "both_shocks_flag"]
    want = latest_per(X.signal_features(signals).select("loan_id", "month", *flags), "loan_id", ["month"]).join(
        latest_per(signals.select("loan_id", "month", "cash_flow_consistency"), "loan_id", ["month"]).drop("month"), "loan_id")
    columns = ["loan_id", *flags, "cash_flow_consistency"]
    assert sorted(got.select(columns).collect()) == sorted(want.select(columns).collect())
    if max_rows is None:
        assert "lag(balance_volatility" not in got._jdf.queryExecution().executedPlan().toString()
