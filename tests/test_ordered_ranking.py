import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanloom.operators import ordered as O
from loanloom.operators import ranking as R


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds more than a third of the rows; another key is null."""
    rng = np.random.default_rng(7)
    n = 900
    key = np.where(rng.random(n) < 0.4, 1, rng.integers(2, 60, n))
    pdf = pd.DataFrame({"k": key, "o": rng.permutation(n), "v": rng.integers(0, 40, n) / 4.0})
    rows = [(None if i % 97 == 0 else int(r.k), int(r.o), float(r.v)) for i, r in enumerate(pdf.itertuples())]
    return spark.createDataFrame(rows, "k int, o int, v double").repartition(5).cache()


def expected(df):
    pdf = df.toPandas().sort_values("o")
    g = pdf.groupby("k", dropna=False)
    pdf["no"] = g.cumcount() + 1
    pdf["l1"], pdf["l2"], pdf["n1"] = g["v"].shift(1), g["v"].shift(2), g["v"].shift(-1)
    return pdf.sort_values("o").reset_index(drop=True)


@pytest.mark.parametrize("max_rows,max_keys", [(None, 1000), (20, 1000), (7, 2)])
def test_split_groups_equal_plain_windows(skewed, monkeypatch, max_rows, max_keys):
    monkeypatch.setattr(O, "MAX_HOT_KEYS", max_keys)
    O._known_hot.clear()
    numbered = O.number_within(skewed, "k", ["o"], "no", max_rows)
    g = O.ordered_groups(numbered, "k", ["o"], 2, 1, max_rows)
    w = g.window()
    out = g.finish(g.frame.withColumns({
        "l1": F.lag("v", 1).over(w), "l2": F.lag("v", 2).over(w), "n1": F.lead("v", 1).over(w)}))
    got = out.toPandas().sort_values("o").reset_index(drop=True)
    want = expected(skewed)
    assert set(got.columns) == {"k", "o", "v", "no", "l1", "l2", "n1"}
    for c in want.columns:
        pd.testing.assert_series_equal(got[c].astype(float), want[c].astype(float), check_names=False)


def test_run_must_exceed_reach(skewed):
    with pytest.raises(ValueError):
        O.ordered_groups(skewed, "k", ["o"], 2, 1, max_rows=2)


def test_latest_is_last_non_null_per_column(spark):
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 2, None, "y"), ("a", 3, None, None), ("b", 1, 7, None)],
                               "k string, o int, v int, s string")
    got = {r["k"]: (r["o"], r["v"], r["s"]) for r in O.latest_per(df, "k", ["o"]).collect()}
    assert got == {"a": (3, 5, "y"), "b": (1, 7, None)}
    first = {r["k"]: (r["o"], r["v"], r["s"]) for r in O.latest_per(df, "k", ["o"], first=True).collect()}
    assert first == {"a": (1, 5, "x"), "b": (1, 7, None)}


def _ranking_checks(df):
    pdf = df.toPandas().dropna()
    got = R.exact_quantiles(df, "v", {"m": 0.5, "p9": 0.9}, ["k"]).toPandas().set_index("k").sort_index()
    want = pdf.groupby("k")["v"].quantile([0.5, 0.9]).unstack()
    np.testing.assert_allclose(got[["m", "p9"]].to_numpy(), want.to_numpy())
    ranks = R.mid_ranks(df, "v").toPandas().set_index("v").sort_index()
    all_v = df.toPandas()["v"]
    want_rank = all_v.rank().groupby(all_v).first()
    np.testing.assert_allclose(ranks["mid_rank"].to_numpy(), want_rank.sort_index().to_numpy())
    medians = R.exact_medians(df, ["v", "o"]).first()
    assert (medians["v"], medians["o"]) == (all_v.median(), df.toPandas()["o"].median())
    down = R.running_totals(df, "v", {"n": F.lit(1)}, descending=True).toPandas().sort_values("v", ascending=False)
    assert (down["n"].cumsum() == down["cum_n"]).all() and (down["all_n"] == len(all_v)).all()


def test_ranking_direct(skewed):
    _ranking_checks(skewed)


def test_ranking_bucketed(skewed, no_small_path):
    _ranking_checks(skewed)


def test_ranking_single_value_and_empty(spark, no_small_path):
    one = spark.createDataFrame([(2.5,)] * 4 + [(None,)], "v double")
    assert R.exact_medians(one, ["v"]).first()["v"] == 2.5
    assert R.running_totals(one.where("v < 0"), "v", {"n": F.lit(1)}).count() == 0
    zero = spark.createDataFrame([(0.0,), (-0.0,)], "v double")
    assert R.mid_ranks(zero, "v").count() == 1


@pytest.mark.parametrize("small", [True, False])
def test_quantiles_do_not_show_the_way_taken(spark, monkeypatch, small):
    """Null groups, NaN and -0.0 give the same rows on both ways."""
    if not small:
        monkeypatch.setattr(R, "SMALL_DISTINCT", -1)
    R._measured.clear()
    nan = float("nan")
    rows = [("a", 1.0), ("a", 2.0), ("a", nan), ("b", None), ("b", nan), ("c", -0.0), ("c", 0.0), ("c", 3.0), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.m for r in R.exact_quantiles(df, "v", {"m": 0.5}, ["g"]).collect()}
    assert got == {"a": 1.5, "b": None, "c": 0.0, "d": None}
    more = R.exact_quantiles(df, "v", {"m": 0.5}, ["g"], {"n": F.count(F.lit(1))}).collect()
    assert {(r.g, r.n, r.m) for r in more} == {("a", 3, 1.5), ("b", 2, None), ("c", 3, 0.0), ("d", 1, None)}
    assert R.exact_medians(df, ["v"]).first().v == 1.0
    ranks = {(r.g, r.v): (r.n, r.mid_rank) for r in R.mid_ranks(df, "v", ["g"]).collect()}
    assert ranks == {("a", 1.0): (1, 1.0), ("a", 2.0): (1, 2.0), ("c", 0.0): (2, 1.5), ("c", 3.0): (1, 3.0)}
    R._measured.clear()


def test_flag_over_many_partitions_is_measured_as_few_values(spark):
    df = spark.range(0, 20_000, 1, 200).select((F.col("id") % 2).alias("flag"))
    assert R.value_stats(df, ["flag"])["flag"].distinct <= 3


def test_many_hot_keys_leave_other_rows_alone(spark, monkeypatch):
    monkeypatch.setattr(O, "MAX_HOT_KEYS", 20)
    O._known_hot.clear()
    rows = [(k, i) for k in range(50) for i in range(6)] + [(k, i) for k in range(100, 130) for i in range(2)] + [(None, i) for i in range(7)]
    df = spark.createDataFrame(rows, "k int, i int").repartition(4)
    marked = O._with_hot(df, "k", O.hot_keys(df, "k", 4), 4)
    assert {r.k for r in marked.where("__hot").collect()} == {*range(50), None}
    got = O.number_within(df, "k", ["i"], "n", 4).collect()
    assert len(got) == len(rows) and all(r.n == r.i + 1 for r in got)
    groups = O.ordered_groups(df, "k", ["i"], back=1, max_rows=4)
    lagged = groups.finish(groups.frame.withColumn("p", F.lag("i").over(groups.window())))
    assert all(r.p == (r.i - 1 if r.i else None) for r in lagged.collect())
    O._known_hot.clear()


@pytest.mark.parametrize("gather", [3, 50, 10_000])
def test_narrowing_brackets_equal_percentile(spark, gather):
    """Sorted over partitions, with ties, infinities, nulls and NaN; a few passes however little may be gathered."""
    rng = np.random.default_rng(gather)
    a = np.sort(rng.normal(size=5_001))
    rows = [(float(x), float(rng.integers(0, 9)), None if i % 3 else float(i), float("nan") if i % 2 else 1.0, None,
             float("inf") if i % 4 == 0 else float(x)) for i, x in enumerate(a)]
    df = spark.createDataFrame(rows, "a double, ties double, gaps double, one double, none double, high double").repartitionByRange(7, "a")
    probs = {c: [0.0, 0.1, 0.5, 0.99, 1.0] for c in df.columns}
    got = R.select_quantiles(df, probs, points=20, gather=gather)
    want = df.select(*[R.plain(c).alias(c) for c in df.columns]).agg(*[F.percentile(c, probs[c]).alias(c) for c in df.columns]).first()
    for c in df.columns:
        if c == "none":
            assert got[c] == [None] * 5
        else:
            assert got[c] == pytest.approx(want[c], abs=1e-12)


def test_selection_takes_three_passes(spark, no_small_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    df = spark.range(20_000).select(F.rand(3).alias("x"), F.rand(4).alias("y")).repartition(5).cache()
    want = df.agg(F.percentile("x", 0.5), F.percentile("y", 0.5)).first()
    passes, first = [], DataFrame.first
    monkeypatch.setattr(DataFrame, "first", lambda self: passes.append(1) or first(self))
    monkeypatch.setattr(R, "GATHER_VALUES", 2_000)
    got = R.exact_medians(df, ["x", "y"])
    assert len(passes) == 3 and tuple(first(got)) == pytest.approx(tuple(want))


def test_shares_of_many_groups_use_no_global_window(spark):
    from loanloom.operators.aggregates import share_by

    df = spark.range(1_000).select((F.col("id") % 250).alias("k"))
    shared = share_by(df, "k", normalize=True)
    assert "Window" not in shared._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.n, r.share_pct) for r in shared.collect()} == {(4, 0.4)}
