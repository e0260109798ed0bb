import numpy as np
import pytest
from pyspark.sql import functions as F

from loanloom import schema as S
from loanloom.operators import modeling as M
from loanloom.sources import tables as IO

import fixtures as D


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_tables_round_trip(spark, tmp_path, fmt):
    frames = {"customers": D.customers(spark), "loans": D.loans(spark), "repayments": D.repayments(spark), "signals": D.signals(spark)}
    IO.write_artifacts(frames, str(tmp_path), fmt)
    for name, df in frames.items():
        back = IO.read_table(spark, f"{tmp_path}/{name}", S.TABLES[name], fmt)
        assert back.schema == S.TABLES[name] and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_nan_becomes_null(spark):
    df = IO.nan_to_null(spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, y int"))
    assert [r["x"] for r in df.orderBy("y").collect()] == [None, 2.0]


def test_repayments_are_laid_out_by_month(spark, tmp_path):
    IO.write_repayments(D.repayments(spark), str(tmp_path / "rep"))
    back = spark.read.parquet(str(tmp_path / "rep"))
    assert back.count() == 19
    plan = back.where("due_month = '2021-03'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(due_month" in plan


def test_metrics_document(spark, tmp_path):
    scalars = spark.createDataFrame([(1, 0.5)], "tp long, auc double")
    summary = spark.createDataFrame([("RED", 3), ("AMBER", 2)], "bucket string, n long")
    groups = spark.createDataFrame([("Origination", 0.4)], "category string, importance double")
    path = str(tmp_path / "m")
    IO.write_metrics(IO.metrics_frame(scalars, summary, groups), path)
    row = IO.read_metrics(spark, path).first()
    assert [(s["bucket"], s["n"]) for s in row["scorecard"]] == [("AMBER", 2), ("RED", 3)]
    assert row["category_importance"]["Origination"] == 0.4 and row["bucket_thresholds"]["RED_min"] == 0.45


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] * x[:, 2] + rng.normal(0, 0.5, 500) > 0.6).astype(int)
    rows = [(f"L{i // 5}", i % 5 + 1, int(y[i]), *map(float, x[i])) for i in range(500)]
    df = spark.createDataFrame(rows, "loan_id string, installment_no int, target int, a double, b double, c double, d double")
    parts = M.split(df, valid_pct=10).cache()
    names = ["a", "b", "c", "d"]
    return M.train(parts, names, trees=6, depth=3, min_rows=5), parts, names


def test_split_is_stable_and_by_loan(fitted, spark):
    _, parts, _ = fitted
    again = M.split(parts.drop("part"), valid_pct=10)
    assert parts.select("loan_id", "installment_no", "part").exceptAll(again.select("loan_id", "installment_no", "part")).count() == 0
    by_loan = M.split(parts.drop("part"), keys=["loan_id"])
    assert by_loan.groupBy("loan_id").agg(F.count_distinct("part").alias("n")).where("n > 1").count() == 0


def raw_margin(model, df):
    from pyspark.ml.functions import vector_to_array

    rows = model.transform(df).select("loan_id", "installment_no", vector_to_array("rawPrediction")[1].alias("m")).collect()
    return {(r[0], r[1]): r[2] for r in rows}


def test_attributions_add_up_to_margin(fitted):
    model, parts, names = fitted
    leaves = M.ensemble_leaves(model)
    base, margin = M.base_margin(leaves), raw_margin(model, parts)
    rows = M.attributions(model, parts, names).collect()
    assert len(rows) == 500
    for r in rows:
        # the raw prediction of class 1 is the weighted sum of the trees
        assert base + sum(r["attributions"]) == pytest.approx(margin[r["loan_id"], r["installment_no"]], abs=1e-9)


def test_attributions_match_subset_definition(fitted):
    """Shapley values from the definition: conditional expectations over all feature subsets."""
    from itertools import combinations
    from math import factorial

    model, parts, names = fitted
    leaves = M.ensemble_leaves(model)
    row = parts.orderBy("loan_id", "installment_no").first()
    x = [row[n] for n in names]

    def value(known):
        total = 0.0
        for v, path, lows, highs, shares in leaves:
            for f, lo, hi, share in zip(path, lows, highs, shares):
                v *= float(lo < x[f] <= hi) if f in known else share
            total += v
        return total

    want = []
    for i in range(4):
        others = [j for j in range(4) if j != i]
        want.append(sum(
            factorial(len(s)) * factorial(3 - len(s)) / factorial(4) * (value({*s, i}) - value(set(s)))
            for k in range(4) for s in combinations(others, k)))
    got = M.attributions(model, parts.where((F.col("loan_id") == row["loan_id"]) & (F.col("installment_no") == row["installment_no"])), names).first()
    np.testing.assert_allclose(got["attributions"], want, atol=1e-12)


def test_summary_and_persistence(fitted, spark, tmp_path):
    model, parts, names = fitted
    summary = M.attribution_summary(M.attributions(model, parts, names), names)
    top = M.add_rank(summary, "mean_abs", 2).orderBy("rank").collect()
    assert top[0]["feature"] == "a" and len(top) == 2
    assert M.category_importance(summary).agg(F.sum("share_pct")).first()[0] == pytest.approx(100)
    assert M.feature_importance(spark, model, names).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    M.save_model(model, str(tmp_path / "gbt"))
    a = M.score(model, parts).agg(F.sum("pred_prob")).first()[0]
    b = M.score(M.load_model(str(tmp_path / "gbt")), parts).agg(F.sum("pred_prob")).first()[0]
    assert a == pytest.approx(b)
    assert M.pos_weight(parts).first()["pos_weight"] == pytest.approx(
        parts.where("target = 0").count() / parts.where("target = 1").count())


def test_patience_chooses_the_number_of_trees():
    assert M.best_iteration([5.0, 4.0, 3.0, 3.5, 3.4, 2.0], 2) == 3
    assert M.best_iteration([5.0, 4.0, 3.0, 3.5, 3.4, 2.0], 3) == 6
    assert M.best_iteration([1.0], 50) == 1


@pytest.fixture
def fits(monkeypatch):
    """Counts fitted trees."""
    from pyspark.ml.regression import RandomForestRegressor

    seen, fit = [], RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, df, *a: seen.append(1) or fit(self, df, *a))
    return seen


def test_growth_stops_and_the_model_is_a_prefix(spark, fitted, fits, monkeypatch):
    """Every tree is fitted once; growth ends ``patience`` trees after the lowest loss of the valid part."""
    from pyspark.ml.functions import vector_to_array

    monkeypatch.setattr(M, "MARGIN_STEPS", 3)
    _, parts, names = fitted
    rows = M.split(parts.drop("part"), test_pct=20, valid_pct=20)
    options = dict(depth=3, min_rows=5, step=0.8, row_share=1.0, column_share=1.0)
    model = M.train(rows, names, trees=40, patience=4, **options)
    best = model.stages[-1].getNumTrees
    assert 1 < best and len(fits) == min(40, best + 4)

    def loss(trees):
        cut = M.PipelineModel([model.stages[0], M.ensemble(trees, 0.8)])
        told = cut.transform(rows.where("part = 'valid'").select(*names, "target")).select("target", vector_to_array("rawPrediction")[1].alias("m")).collect()
        ratio = rows.where("part = 'train' and target = 0").count() / rows.where("part = 'train' and target = 1").count()
        pairs = [(ratio if r.target else 1.0, 2 * np.log1p(np.exp(-2 * (2 * r.target - 1) * r.m))) for r in told]
        return sum(w * x for w, x in pairs) / sum(w for w, _ in pairs)

    longer = M.train(rows.withColumn("part", F.when(F.col("part") == "valid", "test").otherwise(F.col("part"))), names, trees=len(fits), **options)
    losses = [loss(longer.stages[-1].trees[:i]) for i in range(1, longer.stages[-1].getNumTrees + 1)]
    assert M.best_iteration(losses, 4) == best  # trees do not depend on being watched


def test_first_tree_is_the_gradient_at_zero(spark, fitted):
    _, parts, names = fitted
    model = M.train(parts.withColumn("part", F.lit("train")), names, trees=2, depth=2, min_rows=5, step=0.5, row_share=1.0, column_share=1.0)
    leaves = M.ensemble_leaves(model)
    assert len(leaves) == 8 and all(abs(v) <= 0.5 * 2.0 + 1e-12 for v, *_ in leaves[:4])
    assert M.score(model, parts).where("pred_prob between 0 and 1").count() == 500


def coalitions(shares, met, order):
    """Shapley values or pair interactions of a product game, coalition by coalition."""
    from itertools import combinations
    from math import factorial, prod

    d = len(shares)
    value = lambda known: prod(met[i] if i in known else shares[i] for i in range(d))
    out = np.zeros((d,) * order)
    for who in np.ndindex(*out.shape):
        if len(set(who)) < order:
            continue
        others = [k for k in range(d) if k not in who]
        for size in range(len(others) + 1):
            weight = factorial(size) * factorial(d - size - order) / factorial(d - order + 1) / order
            for known in combinations(others, size):
                known = set(known)
                if order == 1:
                    gain = value(known | {who[0]}) - value(known)
                else:
                    gain = value(known | set(who)) - value(known | {who[0]}) - value(known | {who[1]}) + value(known)
                out[who] += weight * gain
    return out


@pytest.mark.parametrize("d", [1, 2, 5, 8])
def test_path_values_match_all_coalitions(d):
    rng = np.random.default_rng(d)
    shares, met = rng.random(d), rng.integers(0, 2, (6, d)).astype(float)
    shares[0] = 0.0  # a branch without training rows
    for m, phi, pairs in zip(met, M.path_attributions(shares, met), M.path_interactions(shares, met)):
        np.testing.assert_allclose(phi, coalitions(shares, m, 1), atol=1e-12)
        if d > 1:
            off = pairs - np.diag(np.diag(pairs))
            np.testing.assert_allclose(off, coalitions(shares, m, 2), atol=1e-12)
        np.testing.assert_allclose(pairs.sum(1), phi, atol=1e-12)


def test_long_paths_stay_exact_and_cheap():
    """Depth 14 and more: values add up to the game's range, patterns are those of the rows."""
    rng = np.random.default_rng(1)
    for d in (14, 30):
        shares, met = rng.random(d), np.ones((1, d))
        phi = M.path_attributions(shares, met)
        assert phi.sum() == pytest.approx(1 - np.prod(shares), abs=1e-12)
        leaf = (2.0, list(range(d)), [-0.5] * d, [0.5] * d, shares.tolist())
        x = rng.normal(size=(7, d))
        path, values = M._by_pattern(leaf, x, M.path_attributions)
        for row, got in zip(x, values):
            z = (np.abs(row) < 0.5) | (row == 0.5)
            assert got.sum() == pytest.approx(2.0 * (float(z.all()) - np.prod(shares)), abs=1e-10)
    np.testing.assert_allclose(M.path_attributions(shares[:14], met[:, :14])[0][:2], coalitions_of(shares[:14]), atol=1e-12)


def coalitions_of(shares):
    """First two values of a game whose conditions are all met, by the sizes of coalitions."""
    from math import factorial

    out = []
    for i in range(2):
        sums = np.zeros(len(shares))
        sums[0] = 1.0
        for s in np.delete(shares, i):  # number of known features -> sum of products of the unknown ones' shares
            sums = sums * s + np.concatenate([[0.0], sums[:-1]])
        d = len(shares)
        out.append((1 - shares[i]) * sum(factorial(k) * factorial(d - k - 1) / factorial(d) * sums[k] for k in range(d)))
    return out


def test_interactions_add_up_to_attributions(fitted, monkeypatch):
    monkeypatch.setattr(M, "INTERACTION_ROWS", 64)
    model, parts, names = fitted
    both = M.interactions(model, parts, names).join(M.attributions(model, parts, names), ["loan_id", "installment_no"]).collect()
    assert len(both) == 500
    matrices = np.array([r["interactions"] for r in both])
    np.testing.assert_allclose(matrices, matrices.transpose(0, 2, 1), atol=1e-12)
    np.testing.assert_allclose(matrices.sum(2), np.array([r["attributions"] for r in both]), atol=1e-9)
    summary = {(r.feature_a, r.feature_b): r for r in M.interaction_summary(model, parts, names).collect()}
    assert len(summary) == 6
    for pair, (i, j) in {("a", "b"): (0, 1), ("a", "d"): (0, 3), ("b", "c"): (1, 2)}.items():
        assert summary[pair].mean_abs == pytest.approx(2 * np.abs(matrices[:, i, j]).mean())
        assert summary[pair].mean_signed == pytest.approx(2 * matrices[:, i, j].mean())


@pytest.mark.parametrize("small", [True, False])
def test_exact_split_holds_in_every_stratum(spark, small, request):
    if not small:
        request.getfixturevalue("no_small_path")
    rows = spark.createDataFrame([(f"L{i}", 1, None if i % 11 == 0 else i % 3) for i in range(1003)], "loan_id string, installment_no int, target int")
    got = {(r.target, r.part): r["count"] for r in M.split_exact(rows, test_share=0.2, valid_share=0.1).groupBy("target", "part").count().collect()}
    for t in (None, 0, 1, 2):
        n = sum(v for (target, _), v in got.items() if target == t)
        assert got[t, "test"] == round(n * 0.2) and got[t, "valid"] == round(n * 0.3) - round(n * 0.2)
    assert sum(got.values()) == 1003


def test_split_by_date_keeps_time_order(spark):
    rows = spark.createDataFrame([(i, f"2021-01-{1 + i * i % 28:02d}" if i % 9 else None) for i in range(300)], "i int, day string")
    parts = M.split_by_date(rows.withColumn("day", F.to_date("day")), "day", 0.2, 0.2)
    got = {r.part: r for r in parts.where("day IS NOT NULL").groupBy("part").agg(F.min("day").alias("lo"), F.max("day").alias("hi"), F.count("*").alias("n")).collect()}
    assert got["train"].hi < got["valid"].lo and got["valid"].hi < got["test"].lo
    total = sum(r.n for r in got.values())
    assert got["test"].n <= round(0.2 * total) and got["test"].n + got["valid"].n <= round(0.4 * total)
    assert parts.where("day IS NULL AND part <> 'train'").count() == 0 and parts.count() == 300


@pytest.mark.parametrize("bits", [10, 3])
def test_blocks_tell_what_the_leaves_tell(fitted, monkeypatch, bits):
    """A lookup per block gives the sums of its leaves one by one; rows with NaN or -inf meet neither side of a cut."""
    monkeypatch.setattr(M, "BLOCK_BITS", bits)
    model, _, names = fitted
    leaves, (blocks, alone) = M.ensemble_leaves(model), M.ensemble_blocks(model)
    assert bool(alone) == (bits < 10)
    if not alone:
        assert sum(len(b[1]) for b in blocks) == len([leaf for leaf in leaves if leaf[1]]) > 2 * len(blocks)
    x = np.random.default_rng(3).normal(size=(200, len(names)))
    x[0, 0], x[1, 1], x[2, 2], x[3, 0] = np.nan, -np.inf, np.inf, leaves[0][3][0]
    phi, pairs = np.zeros_like(x), np.zeros((len(x), len(names), len(names)))
    for leaf in leaves:
        path, values = M._by_pattern(leaf, x, M.path_attributions)
        phi[:, path] += values
        path, values = M._by_pattern(leaf, x, M.path_interactions)
        pairs[:, np.array(path)[:, None], path] += values
    values, where = M._pairs((blocks, alone, leaves), x)
    np.testing.assert_allclose(values.T[:, where], pairs, atol=1e-12)
    np.testing.assert_allclose(M._shapley(list(M._tables(blocks, M.path_attributions, M._feature_cells)), alone, leaves, x), phi, atol=1e-12)


def test_rows_are_not_dealt_by_stratum(spark, monkeypatch):
    """The limits go to the rows: a join dealt by stratum would put all rows of one into a task."""
    rows = spark.createDataFrame([(f"L{i}", 1, i % 2) for i in range(50)], "loan_id string, installment_no int, target int")
    kind, sides = type(rows), []
    join = kind.join
    monkeypatch.setattr(kind, "join", lambda self, other, *a: sides.append(other) or join(self, other, *a))
    M.split_exact(rows)
    assert "broadcast" in sides[-1]._jdf.queryExecution().logical().toString().lower()


def test_losses_of_several_trees_take_one_pass(spark, fitted, fits, monkeypatch):
    """Validation rows are read once per written margin and where growth may stop, not once per tree."""
    monkeypatch.setattr(M, "MARGIN_STEPS", 5)
    _, parts, names = fitted
    kind, passes = type(parts), []
    first = kind.first
    monkeypatch.setattr(kind, "first", lambda self: passes.append(1) or first(self))
    M.train(parts, names, trees=12, depth=2, min_rows=5)
    assert len(fits) == 12 and len(passes) <= 3


def test_training_rows_are_dealt_evenly(spark, fitted, monkeypatch):
    """Partitions of unequal sizes would leave cores idle in every pass of every tree."""
    from pyspark.ml.regression import RandomForestRegressor

    monkeypatch.setattr(M, "SLICE_ROWS", 50, raising=False)
    _, parts, names = fitted
    rows = parts.where("part = 'train'")
    uneven = rows.where("a > 1").coalesce(1).union(rows.where("a <= 1").coalesce(1))
    sizes, fit = [], RandomForestRegressor.fit

    def seen(self, df, *a):
        sizes.append([r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()])
        return fit(self, df, *a)

    monkeypatch.setattr(RandomForestRegressor, "fit", seen)
    M.train(uneven, names, trees=1, depth=2, min_rows=5)
    assert sum(sizes[0]) == rows.count() and max(sizes[0]) <= 50 and max(sizes[0]) - min(sizes[0]) <= 4
