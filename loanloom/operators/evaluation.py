"""Evaluation of a scored frame (``target`` 0/1, ``pred_prob``) at any size.

Curves are built on distinct scores: rows are first reduced to positives and
negatives per score, then running totals come from the bucketed kernel.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import pi, sqrt

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions import exprs as E
from loanloom.operators.ranking import BUCKET, ValueStats, running_totals, value_stats

CLASS_NAMES = ("Non-Delinquent", "Will-Delinquent")


def _counts(
    scored: DataFrame, label: str, score: str, buckets: int | None = None, stats: ValueStats | None = None
) -> DataFrame:
    positive = F.when(F.col(label) == 1, 1).otherwise(0)
    measures = {"pos": positive, "neg": F.lit(1) - positive}
    return running_totals(
        scored.where(F.col(label).isNotNull()), score, measures, descending=True, buckets=buckets, stats=stats
    )


def curve(
    scored: DataFrame, label: str = "target", score: str = "pred_prob", buckets: int | None = None,
    stats: ValueStats | None = None,
) -> DataFrame:
    """One row per distinct score: counts, tpr and fpr when that score is the threshold."""
    return _counts(scored, label, score, buckets, stats).select(
        F.col(score).alias("threshold"), "pos", "neg",
        F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
        F.col("all_pos").alias("n_pos"), F.col("all_neg").alias("n_neg"),
        E.ratio("cum_pos", "all_pos").alias("tpr"), E.ratio("cum_neg", "all_neg").alias("fpr"),
        BUCKET,
    )


def roc_points(
    scored: DataFrame, label: str = "target", score: str = "pred_prob",
    drop_intermediate: bool = True, buckets: int | None = None,
) -> DataFrame:
    """ROC points with the (0, 0, inf) origin.

    A point is collinear when the step that leads to it equals the step that
    leaves it; such points can be dropped without changing the curve.
    """
    scores = scored.where(F.col(label).isNotNull()).na.drop(subset=[score])
    stats = value_stats(scores.select(F.col(score).cast("double").alias(score)), [score], buckets)[score]
    points = curve(scored, label, score, buckets, stats)
    step = F.struct("pos", "neg")
    if drop_intermediate and stats.small:
        following = F.lead(step, 1).over(Window.orderBy(F.desc("threshold")))  # few distinct scores
        points = points.withColumn("__next", following)
    elif drop_intermediate:
        later = Window.orderBy(F.desc(BUCKET))  # one row per bucket
        heads = points.groupBy(BUCKET).agg(F.max_by(step, "threshold").alias("head")).select(
            F.col(BUCKET).alias("__b"), F.lead("head", 1).over(later).alias("__next")
        )
        within = Window.partitionBy(BUCKET).orderBy(F.desc("threshold"))
        points = (
            points.join(F.broadcast(heads), F.col(BUCKET) == F.col("__b"))
            .withColumn("__next", F.coalesce(F.lead(step, 1).over(within), F.col("__next")))
        )
    if drop_intermediate:
        points = points.where(F.col("__next").isNull() | (F.col("__next") != step))
    origin = scored.sparkSession.createDataFrame(
        [(0.0, 0.0, float("inf"))], "fpr double, tpr double, threshold double"
    )
    return origin.unionByName(points.select("fpr", "tpr", "threshold"))


def auc(scored: DataFrame, label: str = "target", score: str = "pred_prob") -> DataFrame:
    """Area under the curve with ties averaged, and Gini in percent."""
    points = curve(scored, label, score)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    pairs = F.max("n_pos").cast("double") * F.max("n_neg").cast("double")
    return points.agg(E.ratio(area, pairs).alias("auc")).withColumn(
        "gini_pct", (F.col("auc") * 2 - 1) * 100
    )


def gini(auc_value: Column | str) -> Column:
    return (E.as_col(auc_value) * 2 - 1) * 100


def ks(scored: DataFrame, label: str = "target", score: str = "pred_prob") -> DataFrame:
    """Two-sample KS statistic, which is the largest gap between tpr and fpr."""
    return curve(scored, label, score).agg(
        F.max(F.abs(F.col("tpr") - F.col("fpr"))).alias("ks"),
        F.max("n_pos").alias("n_pos"), F.max("n_neg").alias("n_neg"),
    ).withColumn("ks_pct", F.col("ks") * 100)


def ks_pvalue(d: Column | str = "ks", n: Column | str = "n_pos", m: Column | str = "n_neg", terms: int = 20) -> Column:
    """Asymptotic p-value: the Kolmogorov distribution at sqrt(nm / (n + m)) * D.

    Of its two series each is taken where it converges within a few terms, so D = 0 gives 1.
    """
    n, m = E.as_col(n).cast("double"), E.as_col(m).cast("double")
    lam2 = n * m / (n + m) * E.as_col(d) * E.as_col(d)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam2),
    )
    theta = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.exp(-(2.0 * k - 1.0) * (2.0 * k - 1.0) * (pi * pi / 8.0) / lam2),
    )
    near_zero = 1.0 - F.lit(sqrt(2.0 * pi)) / F.sqrt(lam2) * theta
    return F.when(lam2 <= 0, 1.0).when(lam2 < 1.18 * 1.18, E.clip(near_zero, 0.0, 1.0)).otherwise(E.clip(2.0 * series, 0.0, 1.0))


EXACT_ROWS = 10_000  # the larger sample's size up to which the p-value is counted exactly


def ks_exact(d: float, n: int, m: int) -> float:
    """P(D >= d) of two samples without ties: the share of lattice paths from (0, 0) to (n, m), all equally
    likely, that reach a point (i, j) with abs(i / n - j / m) >= d.

    Walked by anti-diagonals: of the paths to (i, j), i / (i + j) come from (i - 1, j). Points that were reached
    count 1, so small p-values lose no digits.
    """
    reach = round(d * n * m)  # the gap in units of 1 / (n m) is a whole number
    if reach <= 0:
        return 1.0
    hit = np.zeros(n + 1)  # by i, on the diagonal i + j = s
    i = np.arange(n + 1)
    for s in range(1, n + m + 1):
        j = s - i
        left = np.concatenate([[0.0], hit[:-1]])
        hit = (left * i + hit * j) / s
        hit[np.abs(i * m - j * n) >= reach] = 1.0
        hit[(j < 0) | (j > m)] = 0.0
    return float(hit[n])


def ks_test(scored: DataFrame, label: str = "target", score: str = "pred_prob", exact_rows: int = EXACT_ROWS) -> DataFrame:
    """KS statistic with its p-value in one row: exact up to ``exact_rows`` rows in the larger sample, the
    asymptotic series above; ``method`` says which. Without rows of both classes both are null."""
    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            small = (batch["n_pos"] > 0) & (batch["n_neg"] > 0) & (batch[["n_pos", "n_neg"]].max(axis=1) <= exact_rows)
            for row in batch.index[small & batch["ks"].notna()]:
                batch.loc[row, "p_value"] = ks_exact(batch.at[row, "ks"], int(batch.at[row, "n_pos"]), int(batch.at[row, "n_neg"]))
                batch.loc[row, "method"] = "exact"
            yield batch

    row = ks(scored, label, score).select(
        "ks", F.col("n_pos").cast("long").alias("n_pos"), F.col("n_neg").cast("long").alias("n_neg"), ks_pvalue().alias("p_value"),
        F.when(F.col("ks").isNotNull(), "asymptotic").alias("method"))
    return row.mapInPandas(fill, row.schema)


def youden(
    scored: DataFrame, label: str = "target", score: str = "pred_prob", lo: float = 0.10, hi: float = 0.60
) -> DataFrame:
    """Threshold with the largest tpr - fpr, clamped and rounded; a tie takes the higher threshold."""
    gain = F.col("tpr") - F.col("fpr")
    best = curve(scored, label, score).agg(
        F.max(F.struct(gain.alias("j"), F.col("threshold").alias("t"))).alias("best")
    )
    # an all-negative gain would lose to the origin point (gain 0, infinite threshold)
    beats_origin = F.col("best.j") > 0
    raw = F.when(beats_origin, F.col("best.t")).otherwise(float("inf"))
    return best.select(
        F.greatest(F.col("best.j"), F.lit(0.0)).alias("youden_j"),
        F.bround(E.clip(raw, lo, hi), 3).alias("threshold"),
    )


def confusion(scored: DataFrame, threshold: Column | float, label: str = "target", score: str = "pred_prob") -> DataFrame:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    hit, bad = F.col(score) >= t, F.col(label) == 1
    return scored.where(F.col(label).isNotNull() & F.col(score).isNotNull()).agg(
        F.count_if(~hit & ~bad).alias("tn"), F.count_if(hit & ~bad).alias("fp"),
        F.count_if(~hit & bad).alias("fn"), F.count_if(hit & bad).alias("tp"),
    )


def _or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(E.ratio(num, den), F.lit(0.0))


def precision_recall_f1(cells: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return cells.select(
        "*",
        _or_zero(tp, tp + fp).alias("precision"),
        _or_zero(tp, tp + fn).alias("recall"),
        _or_zero(tp * 2, tp * 2 + fp + fn).alias("f1"),
    )


def classification_report(cells: DataFrame) -> DataFrame:
    """Rows per class plus accuracy, macro and weighted averages, from one confusion row."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn

    def line(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("label"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), support.cast("bigint").alias("support"),
        )

    def scores(hit, false_hit, missed):
        return (_or_zero(hit, hit + false_hit), _or_zero(hit, hit + missed),
                _or_zero(hit * 2, hit * 2 + false_hit + missed))

    neg, pos = scores(tn, fn, fp), scores(tp, fp, fn)
    accuracy = _or_zero(tp + tn, n)
    macro = [(a + b) / 2.0 for a, b in zip(neg, pos)]
    weighted = [_or_zero(a * (tn + fp) + b * (tp + fn), n) for a, b in zip(neg, pos)]
    rows = F.array(
        line(CLASS_NAMES[0], *neg, tn + fp), line(CLASS_NAMES[1], *pos, tp + fn),
        line("accuracy", accuracy, accuracy, accuracy, n),
        line("macro avg", *macro, n), line("weighted avg", *weighted, n),
    )
    return cells.select(F.explode(rows).alias("r")).select("r.*")


def rates(cells: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.select(
        E.pct(tp, tp + fn).alias("tpr_pct"), E.pct(tn, tn + fp).alias("tnr_pct"),
        E.pct(fp, fp + tn).alias("fpr_pct"), E.pct(fn, fn + tp).alias("fnr_pct"),
    )


def average_precision(scored: DataFrame, label: str = "target", score: str = "pred_prob") -> DataFrame:
    gain = F.col("pos") / F.col("n_pos")
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return curve(scored, label, score).agg(
        F.coalesce(F.sum(F.when(F.col("n_pos") > 0, gain * precision)), F.lit(0.0)).alias("average_precision")
    )


def metrics_summary(scored: DataFrame, cut: Column | float, label: str = "target", score: str = "pred_prob") -> DataFrame:
    """All scalar metrics of a scored set in one row and one pass over its curve: ranking metrics,
    the cells and rates at ``cut``, the best threshold, row counts and class weight."""
    cut = cut if isinstance(cut, Column) else F.lit(float(cut))
    hit, gap = F.col("threshold") >= cut, F.col("tpr") - F.col("fpr")
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    row = curve(scored, label, score).agg(
        F.max("n_pos").alias("n_pos"), F.max("n_neg").alias("n_neg"),
        F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(hit, F.col("neg"))), F.lit(0)).alias("fp"),
        F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)).alias("__area"),
        F.max(F.abs(gap)).alias("ks"),
        F.sum(F.when(F.col("n_pos") > 0, F.col("pos") / F.col("n_pos") * precision)).alias("average_precision"),
        F.max(F.struct(gap.alias("j"), F.col("threshold").alias("t"))).getField("t").alias("best_threshold"),
    )
    row = row.withColumn("auc", E.ratio("__area", F.col("n_pos").cast("double") * F.col("n_neg"))).drop("__area")
    row = row.withColumns({
        "fn": F.col("n_pos") - F.col("tp"), "tn": F.col("n_neg") - F.col("fp"), "n_rows": F.col("n_pos") + F.col("n_neg"),
        "gini_pct": gini("auc"), "ks_pct": F.col("ks") * 100, "ks_pvalue": ks_pvalue(),
        "precision": E.ratio("tp", F.col("tp") + F.col("fp")), "recall": E.ratio("tp", "n_pos"),
        "positive_rate": E.ratio("n_pos", F.col("n_pos") + F.col("n_neg")), "pos_weight": E.ratio("n_neg", "n_pos"),
    })
    both = F.col("precision") + F.col("recall")
    return row.withColumn("f1", E.ratio(2 * F.col("precision") * F.col("recall"), both))


def thin_curve(points: DataFrame, n: int, order: str = "threshold") -> DataFrame:
    """About ``n`` evenly spaced points of a curve for display, the same ones every time.

    Points are numbered by the ranking kernel, so long curves are not sorted in one task.
    """
    numbered = running_totals(points.where(F.col(order) < float("inf")), order, {"n": F.lit(1)}, descending=True)
    every = F.greatest(F.lit(1), F.ceil(F.col("all_n") / F.lit(float(n)))).cast("bigint")
    kept = numbered.where((F.col("cum_n") - 1) % every == 0).select(order)
    return points.join(kept, order)


def threshold_elsewhere(
    scored: DataFrame, fit_part: str = "valid", apply_part: str = "test", label: str = "target", score: str = "pred_prob"
) -> DataFrame:
    """The Youden threshold of one part's rows (``part``), and the confusion cells and rates it gives on another's.

    One row: the parts, the threshold and its gain where it was chosen; cells, precision, recall and F1 where it is applied.
    """
    chosen = youden(scored.where(F.col("part") == fit_part), label, score)
    # a column of its own: scores of a model may not stand beside a subquery in an aggregate
    judged = scored.where(F.col("part") == apply_part).withColumn("__cut", chosen.select("threshold").scalar())
    cells = confusion(judged, F.col("__cut"), label, score)
    return precision_recall_f1(cells).join(chosen.select(F.lit(fit_part).alias("chosen_on"), F.lit(apply_part).alias("applied_to"), "threshold", "youden_j"))
