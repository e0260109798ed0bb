"""Queries that fit or read a boosted-tree model (no SQL counterpart)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from loanloom import schema as S
from loanloom.operators import modeling as M
from loanloom.operators import scorecard as C
from loanloom.operators.evaluation import auc, metrics_summary, threshold_elsewhere
from loanloom.operators.ranking import running_totals
from loanloom.plans.feature_queries import FEATURE_VIEWS, _panel_sql
from loanloom.plans.oracle import r
from loanloom.plans.panel import build_panel
from loanloom.plans.registry import query
from loanloom.plans.source_queries import scratch
from loanloom.sources import roles as R
from loanloom.sources import tables as IO

TRAIN_PART = """('0x' || substr(md5(loan_id || '|' || installment_no), 1, 8))::BIGINT % 100 >= 30"""
OBS_PART = """CASE WHEN ('0x' || substr(md5(loan_id || '|' || installment_no), 1, 8))::BIGINT % 100 < 20 THEN 'test' ELSE 'other' END"""


def _panel(spark, d):
    panel = build_panel(R.repayments(spark, d), R.signals(spark, d), R.loans(spark, d), R.customers(spark, d), mode="latest")
    return M.split(panel, valid_pct=10)


_fitted: dict[tuple, tuple] = {}


def _fit(spark, d):
    """The model, of ``train``'s own size, and its feature table, kept for as long as the input files are the
    same. The panel is written once to the shared folder, so that training, scoring and attribution read it
    back instead of rebuilding it."""
    memo = IO.files_stamp(spark, d, "*.parquet")
    if memo not in _fitted:
        _fitted.clear()
        path = scratch(spark, "panel")
        _panel(spark, d).write.parquet(path)
        _fitted[memo] = (M.train(spark.read.parquet(path)), path)
    model, path = _fitted[memo]
    return model, spark.read.parquet(path)


@query("ml1_training_checks", """
SELECT true AS more_than_one_tree, true AS train_beats_chance, true AS test_is_a_rate, count(*) AS n_rows FROM obs""", views=FEATURE_VIEWS)
def ml1_checks(spark, d):
    """The model has several trees and ranks; one row of facts about the fit."""
    model, panel = _fit(spark, d)
    scored = M.score(model, panel)
    train = auc(scored.where("part = 'train'")).select(F.col("auc").alias("train"))
    test = auc(scored.where("part = 'test'")).select(F.col("auc").alias("test"))
    return train.join(test).join(panel.agg(F.count("*").alias("n_rows"))).select(
        F.lit(model.stages[-1].getNumTrees > 1).alias("more_than_one_tree"), (F.col("train") > 0.5).alias("train_beats_chance"),
        F.col("test").between(0.0, 1.0).alias("test_is_a_rate"), "n_rows")


_TALL = ", ".join(f"{r(f'panel.{c}', 6)} AS {c}" for c in S.FEATURES)


@query("ml1_beats_single_features", f"""
SELECT true AS model_ranks_better, {r('max(greatest(a, 1 - a))', 6)} AS best_single, count(*) AS n_features FROM (
  SELECT feature, sum(neg * (tp - pos / 2e0)) / (max(n_pos) * CAST(max(n_neg) AS DOUBLE)) AS a FROM (
    SELECT *, sum(pos) OVER (PARTITION BY feature ORDER BY v DESC) AS tp, sum(pos) OVER (PARTITION BY feature) AS n_pos,
      sum(neg) OVER (PARTITION BY feature) AS n_neg FROM (
      SELECT feature, v, sum(target) AS pos, sum(1 - target) AS neg FROM (
        UNPIVOT (SELECT target, {_TALL} FROM ({_panel_sql()}) panel WHERE {TRAIN_PART}) ON COLUMNS(* EXCLUDE (target)) INTO NAME feature VALUE v)
      GROUP BY 1, 2)) GROUP BY 1)""", views=FEATURE_VIEWS, digits=6)
def ml1_single(spark, d):
    """On the rows it learnt from, the model ranks at least as well as the best feature by itself, either way round."""
    model, panel = _fit(spark, d)
    train = panel.where("part = 'train'")
    tall = train.select("target", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.round(F.col(c).cast("double"), 6).alias("v")) for c in S.FEATURES])).alias("cell")).select("target", "cell.*")
    totals = running_totals(tall, "v", {"pos": F.col("target"), "neg": 1 - F.col("target")}, ["feature"], descending=True)
    area = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2.0)) / (F.max("all_pos").cast("double") * F.max("all_neg"))
    single = totals.groupBy("feature").agg(area.alias("a")).agg(
        F.max(F.greatest("a", 1 - F.col("a"))).alias("best_single"), F.count(F.lit(1)).alias("n_features"))
    whole = auc(M.score(model, train)).select("auc")
    return single.join(whole).select((F.col("auc") >= F.col("best_single")).alias("model_ranks_better"), "best_single", "n_features")


@query("ml3_score_checks", """
SELECT count(DISTINCT loan_id) AS n_loans, 0 AS outside, 0 AS wrong_bucket FROM obs""", views=FEATURE_VIEWS)
def ml3_checks(spark, d):
    """Every loan of the panel has one latest score, a probability, in the bucket of its limits."""
    model, panel = _fit(spark, d)
    table = C.with_bucket(C.latest_scores(M.score(model, panel)))
    p = F.col("pred_prob")
    right = F.when(p < 0.20, "GREEN").when(p < 0.45, "AMBER").otherwise("RED")
    return table.agg(F.count("*").alias("n_loans"), F.count_if(~p.between(0.0, 1.0)).alias("outside"),
                     F.count_if(F.upper("risk_bucket") != right).alias("wrong_bucket"))


@query("snk4_round_trip_checks", "SELECT count(*) AS n_rows, 0 AS changed FROM obs", views=FEATURE_VIEWS)
def snk4_checks(spark, d):
    """A saved and loaded model scores every row of the panel as before."""
    model, panel = _fit(spark, d)
    path = scratch(spark, "model")
    M.save_model(model, path)
    both = M.score(M.load_model(path), M.score(model, panel).withColumnRenamed("pred_prob", "before"))
    return both.agg(F.count("*").alias("n_rows"), F.count_if(F.abs(F.col("before") - F.col("pred_prob")) > 1e-12).alias("changed"))


@query("expl1_additivity_checks", f"SELECT count(*) AS n_rows, 0 AS not_additive FROM obs WHERE {OBS_PART} = 'test'", views=FEATURE_VIEWS)
def expl1_checks(spark, d):
    """Attributions of a row and the base margin add up to the model's margin."""
    model, panel = _fit(spark, d)
    test = panel.where("part = 'test'")
    base = M.base_margin(M.ensemble_leaves(model))
    told = M.attributions(model, test)
    total = told.select("loan_id", "installment_no", F.aggregate("attributions", F.lit(float(base)), lambda s, x: s + x).alias("told"))
    raw = model.transform(test).select("loan_id", "installment_no", vector_to_array("rawPrediction")[1].alias("margin"))
    both = raw.join(total, ["loan_id", "installment_no"])
    return both.agg(F.count("*").alias("n_rows"), F.count_if(F.abs(F.col("margin") - F.col("told")) > 1e-6).alias("not_additive"))


@query("snk2_model_artifacts", """
SELECT name, true AS complete FROM (VALUES ('attributions'), ('attribution_summary'), ('importance')) AS t(name)""")
def snk2_model(spark, d):
    """The attribution frames, written and read back: a row per test row, and per feature."""
    model, panel = _fit(spark, d)
    test = panel.where("part = 'test'")
    told = M.attributions(model, test)
    folder = scratch(spark, "model-artifacts")
    IO.write_artifacts({"attributions": told, "attribution_summary": M.attribution_summary(told),
                        "importance": M.feature_importance(spark, model)}, folder)
    rows = test.agg(F.count("*").alias("want"))
    out = spark.read.parquet(f"{folder}/attributions").agg(F.count("*").alias("n")).join(rows).select(
        F.lit("attributions").alias("name"), (F.col("n") == F.col("want")).alias("complete"))
    for name in ("attribution_summary", "importance"):
        back = spark.read.parquet(f"{folder}/{name}").agg(F.count_distinct("feature").alias("n"))
        out = out.unionByName(back.select(F.lit(name).alias("name"), (F.col("n") == len(S.FEATURES)).alias("complete")))
    return out


@query("expl2_summary_checks", f"SELECT {len(S.FEATURES)} AS n_features, 0 AS differing")
def expl2_checks(spark, d):
    """The summary equals the written attributions aggregated anew in SQL."""
    model, panel = _fit(spark, d)
    told = M.attributions(model, panel.where("part = 'test'"))
    path = scratch(spark, "attributions")
    told.write.parquet(path)
    written = spark.read.parquet(path)
    again = spark.sql("""
SELECT i, avg(abs(v)) AS mean_abs, avg(v) AS mean_signed, CASE WHEN avg(v) > 0 THEN 'up' ELSE 'down' END AS direction
FROM (SELECT posexplode(attributions) AS (i, v) FROM {written}) GROUP BY i""", written=written)
    names = F.array(*[F.lit(f) for f in S.FEATURES])
    again = again.select(F.element_at(names, F.col("i") + 1).alias("feature"), *[F.col(c).alias(f"{c}_again") for c in ("mean_abs", "mean_signed", "direction")])
    both = M.attribution_summary(written).join(again, "feature", "full")
    same = ((F.abs(F.col("mean_abs") - F.col("mean_abs_again")) < 1e-9) & (F.abs(F.col("mean_signed") - F.col("mean_signed_again")) < 1e-9)
            & ((F.col("direction") == F.col("direction_again")) | (F.abs("mean_signed") < 1e-9)))
    return both.agg(F.count(F.lit(1)).cast("int").alias("n_features"), F.count_if(~F.coalesce(same, F.lit(False))).cast("int").alias("differing"))


@query("expl2_interaction_checks", f"""
SELECT count(*) AS n_rows, 0 AS not_symmetric, 0 AS not_additive, 0 AS not_the_margin FROM obs WHERE {OBS_PART} = 'test'""", views=FEATURE_VIEWS)
def expl2_interaction_checks(spark, d):
    """Interaction matrices are symmetric, their rows add up to the attributions, all of it to the margin."""
    model, panel = _fit(spark, d)
    test, keys = panel.where("part = 'test'"), ["loan_id", "installment_no"]
    base = M.base_margin(M.ensemble_leaves(model))
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)
    sums = F.transform("interactions", total)
    columns = F.transform(F.sequence(F.lit(0), F.size("interactions") - 1), lambda i: total(F.transform("interactions", lambda m: m[i])))
    gap = lambda a, b: F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))
    pairs = M.interactions(model, test).select(*keys, sums.alias("sums"), gap(sums, columns).alias("skew"))
    raw = model.transform(test).select(*keys, vector_to_array("rawPrediction")[1].alias("margin"))
    both = pairs.join(M.attributions(model, test), keys).join(raw, keys)
    return both.agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("skew") > 1e-9).alias("not_symmetric"),
        F.count_if(gap(F.col("sums"), F.col("attributions")) > 1e-6).alias("not_additive"),
        F.count_if(F.abs(total(F.col("sums")) + base - F.col("margin")) > 1e-6).alias("not_the_margin"))


@query("expl2_interactions", digits=6)
def expl2_interactions(spark, d):
    """The 20 strongest pairs of features over the test rows."""
    model, panel = _fit(spark, d)
    return M.interaction_summary(model, panel.where("part = 'test'")).orderBy(F.desc("mean_abs"), "feature_a", "feature_b").limit(20)


@query("expl4_importance_checks", f"SELECT {len(S.FEATURES)} AS n_features, true AS adds_up, 0 AS unused_with_gain, 0 AS used_without_gain")
def expl4_checks(spark, d):
    """Importances are a share of 1, above 0 exactly for the features that stand on a path to a leaf."""
    model, _ = _fit(spark, d)
    used = sorted({S.FEATURES[f] for leaf in M.ensemble_leaves(model) for f in leaf[1]})
    marked = M.feature_importance(spark, model).withColumn("used", F.col("feature").isin(used))
    gain = F.col("importance") > 0
    return marked.agg(F.count(F.lit(1)).cast("int").alias("n_features"), (F.abs(F.sum("importance") - 1) < 1e-9).alias("adds_up"),
                      F.count_if(gain & ~F.col("used")).cast("int").alias("unused_with_gain"),
                      F.count_if(~gain & F.col("used")).cast("int").alias("used_without_gain"))


@query("snk3_model_document", f"""
SELECT {len(set(S.FEATURES))} AS n_features, true AS shares_are_those, true AS adds_up, true AS train_auc_is_that, count(*) AS n_rows FROM obs
WHERE {OBS_PART} = 'test'""", views=FEATURE_VIEWS)
def snk3_model(spark, d):
    """The metrics document of the fitted model, written and read back: test metrics, train AUC and the share of
    each feature category, which are the model's own."""
    model, panel = _fit(spark, d)
    scored = M.score(model, panel)
    summary = M.attribution_summary(M.attributions(model, panel.where("part = 'test'")))
    groups = M.category_importance(summary)
    train = auc(scored.where("part = 'train'")).select(F.col("auc").alias("auc_train"))
    cut = threshold_elsewhere(scored).first()["threshold"]
    scalars = metrics_summary(scored.where("part = 'test'"), cut).join(train)
    bucketed = C.scorecard_summary(C.with_bucket(C.latest_scores(scored)))
    path = scratch(spark, "model-metrics")
    IO.write_metrics(IO.metrics_frame(scalars, bucketed, groups.select("category", F.col("share_pct").alias("importance"))), path)
    back = IO.read_metrics(spark, path)
    # a map is a document of its own in the file; its fields are the categories met
    kinds = back.schema["category_importance"].dataType.names
    told = back.select("n_rows", "auc_train", F.explode(F.array(*[
        F.struct(F.lit(k).alias("category"), F.col(f"category_importance.`{k}`").alias("told")) for k in kinds])).alias("c")).select("n_rows", "auc_train", "c.*")
    both = told.join(groups, "category", "full").agg(
        F.max("n_rows").alias("n_rows"), F.max("auc_train").alias("auc_train"),
        F.bool_and(F.coalesce(F.abs(F.col("told") - F.col("share_pct")) < 1e-9, F.lit(False))).alias("shares_are_those"),
        (F.abs(F.sum("told") - 100) < 1e-6).alias("adds_up"))
    again = train.select(F.col("auc_train").alias("again"))
    return both.join(again).select(
        F.lit(len(S.FEATURES)).alias("n_features"), "shares_are_those", "adds_up",
        (F.abs(F.col("auc_train") - F.col("again")) < 1e-9).alias("train_auc_is_that"), F.col("n_rows").cast("long").alias("n_rows"))


@query("expl3_share_checks", "SELECT true AS has_categories, true AS shares_add_up")
def expl3_checks(spark, d):
    return M.category_importance(_summary(spark, d)).agg(
        (F.count("*") > 1).alias("has_categories"), (F.abs(F.sum("share_pct") - 100) < 1e-6).alias("shares_add_up"))


@query("ml1_train_and_score", digits=6)
def ml1(spark, d):
    model, panel = _fit(spark, d)
    scored = M.score(model, panel)
    test = auc(scored.where("part = 'test'")).select(F.lit("test").alias("part"), "auc", "gini_pct")
    train = auc(scored.where("part = 'train'")).select(F.lit("train").alias("part"), "auc", "gini_pct")
    return train.unionAll(test)


@query("ml2_pos_weight", f"""
SELECT {r('count(*) FILTER (WHERE target = 0) / nullif(count(*) FILTER (WHERE target = 1), 0)', 6)} AS pos_weight FROM obs""",
       views=FEATURE_VIEWS, digits=6)
def ml2(spark, d):
    return M.pos_weight(_panel(spark, d))


@query("ml3_batch_scores", digits=6)
def ml3(spark, d):
    model, panel = _fit(spark, d)
    latest = C.latest_scores(M.score(model, panel))
    return C.scorecard_table(C.with_bucket(latest))


@query("ml3_scored_threshold", digits=6)
def ml3_threshold(spark, d):
    """The threshold of the validation rows, and what it does on the test rows."""
    model, panel = _fit(spark, d)
    return threshold_elsewhere(M.score(model, panel))


@query("snk4_model_round_trip", digits=6)
def snk4(spark, d):
    model, panel = _fit(spark, d)
    path = scratch(spark, "model")
    M.save_model(model, path)
    return M.score(M.load_model(path), panel.where("part = 'test'")).select("loan_id", "installment_no", "pred_prob")


@query("expl1_attributions", digits=6)
def expl1(spark, d):
    model, panel = _fit(spark, d)
    return M.attributions(model, panel.where("part = 'test'"))


def _summary(spark, d):
    model, panel = _fit(spark, d)
    return M.attribution_summary(M.attributions(model, panel.where("part = 'test'")))


@query("expl2_attribution_summary", digits=6)
def expl2(spark, d):
    return M.add_rank(_summary(spark, d), "mean_abs", 20)


@query("expl3_category_importance", digits=6)
def expl3(spark, d):
    return M.category_importance(_summary(spark, d))


@query("expl4_feature_importance", digits=6)
def expl4(spark, d):
    model, _ = _fit(spark, d)
    return M.add_rank(M.feature_importance(spark, model), "importance", 15)
