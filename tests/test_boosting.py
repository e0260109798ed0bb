"""Trees grown in one stage: MLlib's trees where nothing is drawn, whatever the number of tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanloom.operators import boosting as B
from loanloom.operators import modeling as M

NAMES = ["a", "b", "c", "d", "e", "same"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    n = 1500
    x = np.stack([rng.integers(0, k, n) for k in (30, 9, 2, 25)] + [rng.normal(size=n).round(1).clip(-1.5, 1.5), np.ones(n)], 1).astype(float)
    p = 1 / (1 + np.exp(1.5 - x[:, 0] / 10 - x[:, 1] * x[:, 2] / 4 + x[:, 4]))
    y = (rng.random(n) < p).astype(int)
    told = [(f"L{i}", i % 5, int(y[i]), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(told, f"loan_id string, installment_no int, target int, {', '.join(f'{c} double' for c in NAMES)}")
    return M.split(df, valid_pct=20).cache()


@pytest.fixture
def fits(monkeypatch):
    from pyspark.ml.regression import RandomForestRegressor

    seen, fit = [], RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, df, *a: seen.append(1) or fit(self, df, *a))
    return seen


def same(a, b):
    if len(a) != len(b) or a[0] != pytest.approx(b[0]):
        return False
    if len(a) == 2:
        return a[1] == pytest.approx(b[1], abs=1e-9)
    return a[1:3] == b[1:3] and same(a[3], b[3]) and same(a[4], b[4])


@pytest.mark.parametrize("task_rows", [10_000, 300])
def test_trees_are_mllibs(spark, rows, fits, monkeypatch, task_rows):
    """One task, and several that exchange sums: the same splits, covers, values, gains and number of trees, without a
    pass of MLlib's over the rows for each tree."""
    options = dict(trees=8, depth=4, min_rows=7, step=0.1, row_share=1.0, column_share=1.0, patience=3)
    want = M.train(rows, NAMES, **options)
    met = len(fits)
    assert met == 8
    monkeypatch.setattr(M, "FITTED_ROWS", 100, raising=False)
    monkeypatch.setattr(M, "TASK_ROWS", task_rows)
    got = M.train(rows, NAMES, **options)
    assert len(fits) == met
    a, b = M.ensemble_trees(want), M.ensemble_trees(got)
    assert len(a) == len(b) and all(u[0] == v[0] and same(u[1], v[1]) for u, v in zip(a, b))
    assert got.stages[-1].featureImportances.toArray() == pytest.approx(want.stages[-1].featureImportances.toArray())
    del M._grown[got.stages[-1]]  # as MLlib reads them back
    assert M.ensemble_trees(got) == b
    told = [{r[0]: r[1] for r in M.score(m, rows).select("loan_id", "pred_prob").collect()} for m in (want, got)]
    assert told[0] == pytest.approx(told[1])


def test_growth_stops_and_draws_are_repeatable(spark, rows, monkeypatch, tmp_path):
    monkeypatch.setattr(M, "FITTED_ROWS", 100, raising=False)
    monkeypatch.setattr(M, "TASK_ROWS", 400)
    grown, boost = [], B.boost
    monkeypatch.setattr(B, "boost", lambda *a: grown.append(boost(*a)) or grown[-1])
    models = [M.train(rows, NAMES, trees=40, depth=3, min_rows=5, step=0.8, patience=4) for _ in range(2)]
    best = models[0].stages[-1].getNumTrees
    trees, losses, _ = grown[0]
    assert 1 < best and len(trees) == len(losses) == min(40, best + 4) and losses[best - 1] == min(losses)
    assert M.ensemble_leaves(models[0]) == M.ensemble_leaves(models[1])
    M.save_model(models[0], str(tmp_path / "m"))
    a, b = (M.score(m, rows).agg(F.sum("pred_prob")).first()[0] for m in (models[0], M.load_model(str(tmp_path / "m"))))
    assert a == pytest.approx(b)


def test_without_watched_rows_all_trees_are_grown(spark, rows, monkeypatch):
    monkeypatch.setattr(M, "FITTED_ROWS", 100, raising=False)
    model = M.train(rows.withColumn("part", F.lit("train")), NAMES, trees=3, depth=2, patience=1)
    assert model.stages[-1].getNumTrees == 3


def test_missing_values_are_refused(spark, rows, monkeypatch):
    monkeypatch.setattr(M, "FITTED_ROWS", 100, raising=False)
    for gap in (F.lit(None).cast("double"), F.lit(float("nan"))):
        with pytest.raises(Exception, match="null or NaN"):
            M.train(rows.withColumn("b", F.when(F.col("loan_id") == "L7", gap).otherwise(F.col("b"))), NAMES, trees=1)


def test_limits_of_many_values(monkeypatch):
    """A summary of summaries keeps ranks within its share of the weight, and heavy values by themselves."""
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=60_000), np.full(30_000, 0.25)])
    rng.shuffle(x)
    kept = np.zeros(0), np.zeros(0)
    for part in np.array_split(x, 9):
        kept = B.summed(*(np.concatenate(z) for z in zip(kept, (part, np.ones(len(part))))))
    assert len(kept[0]) <= 2 * B.SUMMARY_VALUES + 1 and kept[1].sum() == pytest.approx(len(x))
    limits = np.array(B.cuts(*kept))
    assert len(limits) <= B.BINS - 1 and (np.diff(limits) > 0).all()
    sizes = np.bincount(np.searchsorted(limits, x), minlength=len(limits) + 1)
    assert sizes.max() < 30_000 + len(x) / B.BINS and np.sort(sizes)[-2] < 1.1 * len(x) / B.BINS + len(x) / 1000
    assert B.cuts(np.array([1.0, 2.0, 4.0]), np.ones(3)) == [1.5, 3.0]
    assert B.cuts(np.array([1.0]), np.ones(1)) == []
