import datetime as dt

from pyspark.sql import functions as F

from loanloom import schema as S
from loanloom.functions import exprs as E


def column(spark, build, values, ddl):
    df = spark.createDataFrame([(i, *v) if isinstance(v, tuple) else (i, v) for i, v in enumerate(values)], f"i int, {ddl}")
    return [r[0] for r in df.orderBy("i").select(build).collect()]


def test_ratio_and_clip_keep_null(spark):
    pairs = [(1.0, 2.0), (1.0, 0.0), (None, 2.0), (9.0, 2.0), (-4.0, 2.0)]
    assert column(spark, E.ratio("a", "b"), pairs, "a double, b double") == [0.5, None, None, 4.5, -2.0]
    assert column(spark, E.clip(E.ratio("a", "b"), 0.0, 1.0), pairs, "a double, b double") == [0.5, None, None, 1.0, 0.0]
    assert column(spark, E.ratio_clip("a", "b", 0.0, 1.0, 0.5), pairs, "a double, b double") == [0.5, 0.5, 0.5, 1.0, 0.0]


def test_encode_unknown_and_null(spark):
    assert column(spark, E.encode("x", S.TIER_ORDINAL, 2), ["Prime", "Odd", None, "Thin-File"], "x string") == [0, 2, 2, 3]
    assert column(spark, E.decode("x", S.TIER_ORDINAL), [0, 3, 9, None], "x int") == ["Prime", "Thin-File", "Unknown", "Unknown"]


def test_bands_are_right_closed(spark):
    assert column(spark, E.ticket_band("x"), [0, 1, 25000, 25001, 2000000, 2000001, None], "x int") == [
        None, "<25K", "<25K", "25-50K", "500K+", None, None]
    assert column(spark, E.tenure_band("x"), [3, 4, 60, 61], "x int") == ["1-3M", "4-6M", "49-60M", None]


def test_dpd_edges(spark):
    assert column(spark, E.dpd_bucket("x"), [0, 1, 30, 31, 60, 61, 90, 91, None], "x int") == [
        "Current", "DPD_1-30", "DPD_1-30", "DPD_31-60", "DPD_31-60", "DPD_61-90", "DPD_61-90", "DPD_90+", None]
    assert column(spark, E.sma_status("x", F.col("d") == 1), [(0, 0), (30, 0), (31, 0), (91, 0), (91, 1), (5, None)],
                  "x int, d int") == ["Standard", "SMA-1", "SMA-2", "NPA", "Defaulted", "SMA-1"]


def test_grade_and_fallback(spark):
    rows = [("Prime", 750), ("Prime", 700), ("Prime", 600), ("Near-Prime", 720), ("Near-Prime", 650), ("Near-Prime", 640),
            ("Subprime", 600), ("Subprime", 650), ("Subprime", 500), ("Thin-File", 0), (None, 700)]
    assert column(spark, E.risk_grade("t", "s"), rows, "t string, s int") == [
        "A+", "A", "A-", "B-", "B", "B-", "C+", "C", "C", "D", "D"]
    assert column(spark, E.risk_grade("t", "s", True), rows[3:4], "t string, s int") == ["B+"]
    assert column(spark, E.bureau_band("s"), [0, 750, 749, 650, 600, 599, None], "s int") == [
        "NTC", "750+", "700-749", "650-699", "600+", "<600", None]


def test_emi_and_value(spark):
    rows = [(100000.0, 0.12, 12, "Personal-Loan"), (1200.0, 0.12, 12, "BNPL"), (1200.0, 0.0, 12, "Personal-Loan")]
    assert column(spark, E.emi("p", "a", "n", "k"), rows, "p double, a double, n int, k string") == [8884.88, 100.0, 100.0]
    got = column(spark, F.struct(E.recovery("t", "p", "r", "d"), E.lgd("t", "p", "r", "d")),
                 [(1000.0, 300.0, 0.333, 1), (1000.0, 1200.0, 0.5, 1), (1000.0, 300.0, 0.5, 0)],
                 "t double, p double, r double, d int")
    assert [tuple(g) for g in got] == [(233, 467.0), (-100, 0.0), (0, 0.0)]


def test_dates(spark):
    d = dt.date(2021, 11, 30)
    assert column(spark, F.struct(E.to_quarter("x"), E.to_month("x"), E.month_name("x"), E.festival_flag("x"),
                                  E.payment_date("x", F.lit(3)), E.due_date("x", F.lit(2))), [(d,)], "x date") == [
        ("2021Q4", "2021-11", "Nov", 1, dt.date(2021, 12, 3), dt.date(2022, 1, 29))]


def test_categories_and_verdicts(spark):
    rows = ["missed_payment_last_3m", "sma_trend", "min_cash_flow_3m", "apr"]
    assert column(spark, E.feature_category("x"), rows, "x string") == [
        "Repayment Behavioral", "Repayment Behavioral", "Bank Behavioral", "Origination"]
    counts = {}
    for c in column(spark, E.feature_category("x"), S.FEATURES, "x string"):
        counts[c] = counts.get(c, 0) + 1
    assert len(S.FEATURES) == 42 and counts == {"Repayment Behavioral": 13, "Bank Behavioral": 11, "Origination": 18}
    assert column(spark, E.verdict("auc", "x"), [0.9, 0.85, 0.7, 0.5], "x double") == [
        "Excellent", "Good", "Moderate", "Needs improvement"]
    assert column(spark, E.risk_bucket("x"), [0.45, 0.2, 0.199], "x double") == ["RED", "AMBER", "GREEN"]
