"""Split, boosted-tree training, scoring and exact tree attributions."""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from uuid import uuid4
from weakref import WeakKeyDictionary

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom import schema as S
from loanloom.functions import exprs as E
from loanloom.operators import boosting
from loanloom.operators.aggregates import over_groups
from loanloom.operators.ranking import running_totals
from loanloom.session import ensure_checkpoint_dir


# --- split ------------------------------------------------------------------

def hash_percent(*keys: str) -> Column:
    """A stable number 0..99 per key, the same on every run and cluster."""
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100


def split(
    panel: DataFrame, keys: Sequence[str] = ("loan_id", "installment_no"), test_pct: int = 20, valid_pct: int = 0
) -> DataFrame:
    """Adds ``part``: train, valid or test. Splitting on ``loan_id`` alone keeps a loan's rows together.

    The hash is independent of the label, so every class is cut in the same
    proportion without gathering a class in one place.
    """
    h = hash_percent(*keys)
    part = F.when(h < test_pct, "test").when(h < test_pct + valid_pct, "valid").otherwise("train")
    return panel.withColumn("part", part)


def hash_order(*keys: str) -> Column:
    """A stable 52-bit number per key, exact as a double."""
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


def split_exact(
    rows: DataFrame, strata: str = "target", keys: Sequence[str] = ("loan_id", "installment_no"),
    test_share: float = 0.2, valid_share: float = 0.0,
) -> DataFrame:
    """Adds ``part`` with exact shares in every stratum: of n rows the round(n * test_share) of smallest key
    hash are test, the next ones up to round(n * (test_share + valid_share)) valid, all others train.

    The limits are order statistics of the hashes within the stratum, found by the ranking kernel, so no
    stratum is sorted in one task. Rows with equal keys share a hash and stay together, before the limit
    only if all of them fit. Null is a stratum of its own.
    """
    marked = rows.withColumns({"__h": hash_order(*keys).cast("double"), "__stratum": F.coalesce(F.col(strata).cast("string"), F.lit("\x00null"))})
    totals = running_totals(marked, "__h", {"n": F.lit(1)}, ["__stratum"])

    def upto(share: float) -> Column:
        return F.coalesce(F.max(F.when(F.col("cum_n") <= F.round(F.col("all_n") * F.lit(share)), F.col("__h"))), F.lit(-1.0))

    limits = totals.groupBy("__stratum").agg(upto(test_share).alias("__test"), upto(test_share + valid_share).alias("__valid"))
    part = F.when(F.col("__h") <= F.col("__test"), "test").when(F.col("__h") <= F.col("__valid"), "valid").otherwise("train")
    # a row per stratum; dealt by stratum, all rows of one would meet in a task
    return marked.join(F.broadcast(limits), "__stratum").withColumn("part", part).drop("__h", "__stratum", "__test", "__valid")


def split_by_date(rows: DataFrame, date: str, test_share: float = 0.2, valid_share: float = 0.0) -> DataFrame:
    """Adds ``part`` by time: train rows are older than valid rows, these older than test rows.

    Test takes the latest dates, as many whole dates as fit into its share of the rows, valid the dates
    before them up to both shares. Rows without a date are train.
    """
    marked = rows.withColumn("__day", F.unix_date(F.col(date).cast("date")).cast("double"))
    totals = running_totals(marked, "__day", {"n": F.lit(1)}, descending=True)

    def since(share: float) -> Column:
        return F.min(F.when(F.col("cum_n") <= F.round(F.col("all_n") * F.lit(share)), F.col("__day")))

    limits = totals.agg(F.struct(since(test_share).alias("test"), since(test_share + valid_share).alias("valid")).alias("l")).scalar()
    marked = marked.withColumn("__limits", limits)
    part = F.when(F.col("__day") >= F.col("__limits.test"), "test").when(F.col("__day") >= F.col("__limits.valid"), "valid").otherwise("train")
    return marked.withColumn("part", part).drop("__day", "__limits")


def pos_weight(rows: DataFrame, label: str = "target") -> DataFrame:
    return rows.agg(
        E.ratio(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).alias("pos_weight")
    )


# --- training and scoring ---------------------------------------------------

MARGIN_STEPS = 10  # trees between two written margins
SLICE_ROWS = 250_000  # training rows of a partition, where they are dealt anew
FITTED_ROWS = 100_000  # training rows up to which MLlib fits the trees
TASK_ROWS = 50_000  # training rows of a task beyond, where there are slots


def train(
    rows: DataFrame,
    features: Sequence[str] = tuple(S.FEATURES),
    label: str = "target",
    trees: int = 500,
    depth: int = 6,
    step: float = 0.05,
    row_share: float = 0.8,
    column_share: float = 0.8,
    min_rows: int = 50,
    seed: int = 42,
    patience: int = 50,
) -> PipelineModel:
    """Gradient-boosted trees with class weights, grown once.

    Trees are added one by one, each fitted to the gradient of the log loss at the margins so far; the loss
    of the rows with ``part = 'valid'`` is known for each. Growth stops after ``patience`` trees without a new
    lowest one, or at ``trees``, and the model is the trees up to the lowest. Without such rows all trees are
    grown. Margins are written to the checkpoint folder every ``MARGIN_STEPS`` trees, so a plan holds that
    many trees at most and a lost executor costs no tree. The losses of these trees are taken together then,
    or as soon as growth might stop.

    Beyond ``FITTED_ROWS`` the same kind of trees is grown by ``boosting.boost`` in one stage, where a barrier stage can
    run: MLlib reads all rows eight times a tree and bins them anew.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    if "part" not in rows.columns:
        rows = rows.withColumn("part", F.lit("train"))
    rows = rows.where(F.col("part") != "test")
    weight = pos_weight(rows.where(F.col("part") == "train"), label).scalar()
    ready = rows.select(
        *[F.col(c).cast("double").alias(c) for c in features],
        F.when(F.col(label) == 1, 1.0).otherwise(-1.0).alias("__y"),
        F.when(F.col(label) == 1, F.coalesce(weight, F.lit(1.0))).otherwise(1.0).alias("__weight"),
        (F.col("part") == "valid").alias("__valid"),
    )
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    n = ready.where(~F.col("__valid")).count()
    tasks = min(boosting.slots(rows.sparkSession), math.ceil(n / TASK_ROWS))
    if n > FITTED_ROWS and (tasks == 1 or tasks and boosting.shared_folder(rows.sparkSession)):
        heavier = ready.where("__y > 0").agg(F.max("__weight")).first()[0]
        grown, losses, limits = boosting.boost(
            ready, features, tasks, 1.0 if heavier is None else heavier,
            lambda losses: bool(losses) and len(losses) - best_iteration(losses, len(losses)) >= patience,
            trees, depth, step, row_share, column_share, min_rows, seed)
        kept = grown[:best_iteration(losses, patience)] if losses else grown
        return PipelineModel([assembler, boosted(rows.sparkSession, kept, limits, step)])
    base, valid = (
        assembler.transform(some).select("features", "__y", "__weight", F.lit(0.0).alias("__margin")).checkpoint()
        for some in (dealt_evenly(ready.where(~F.col("__valid")), n), ready.where("__valid"))
    )
    watched = not valid.isEmpty()
    learner = RandomForestRegressor(
        numTrees=1, labelCol="__gradient", featuresCol="features", weightCol="__weight", maxDepth=depth, bootstrap=False,
        subsamplingRate=row_share, featureSubsetStrategy=str(column_share), minInstancesPerNode=min_rows,
    )
    grown, losses, fresh = [], [], 0

    def may_stop() -> bool:
        return watched and len(grown) - best_iteration(losses, len(losses)) >= patience

    def take_losses() -> None:
        if watched and len(losses) < len(grown):
            losses.extend(prefix_losses(valid, grown[len(grown) - fresh:], step, fresh - (len(grown) - len(losses))))

    y = F.col("__y")
    while len(grown) < trees:
        if may_stop():  # a lower loss among the trees since the last one taken lets it go on
            take_losses()
            if may_stop():
                break
        now = with_margin(base, grown[len(grown) - fresh:], step)
        gradient = now.withColumn("__gradient", y * 4.0 / (1.0 + F.exp(y * 2.0 * F.col("__margin"))))
        grown.append(learner.setSeed(seed + len(grown)).fit(gradient).trees[0])
        fresh += 1
        if fresh == MARGIN_STEPS:
            take_losses()
            base, valid = (with_margin(some, grown[-fresh:], step).checkpoint() if some is not None else None
                           for some in (base, valid if watched else None))
            fresh = 0
    take_losses()
    best = best_iteration(losses, patience) if watched else len(grown)
    return PipelineModel([assembler, ensemble(grown[:best], step)])


def dealt_evenly(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows in equal partitions of at most ``SLICE_ROWS``, as many as cores or a multiple; up to that many rows stay as they are.

    Files of a panel have unequal sizes and their partitions seldom fit the cores, so that each pass would
    wait for a few late tasks.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if n <= SLICE_ROWS else rows.repartition(cores * math.ceil(n / (cores * SLICE_ROWS)))


def prefix_losses(rows: DataFrame, trees: Sequence, step: float, known: int = 0) -> list[float]:
    """Mean losses of the rows after each tree beyond the first ``known``, in one pass."""
    y, told, names = F.col("__y"), rows, []
    for n in range(known + 1, len(trees) + 1):
        names.append(f"__after{n}")
        margin = (F.col("__margin") + vector_to_array("rawPrediction")[1]).alias(names[-1])
        told = ensemble(trees[:n], step).transform(told).select("features", "__y", "__weight", "__margin", *names[:-1], margin)
    loss = [F.sum(F.col("__weight") * log_loss(y * F.col(c))) / F.sum("__weight") for c in names]
    return list(told.agg(*[x.alias(c) for x, c in zip(loss, names)]).first())


def log_loss(agreement: Column) -> Column:
    """2 log(1 + exp(-2 yF)), without overflow."""
    z = agreement * -2.0
    return 2.0 * (F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))))


def with_margin(rows: DataFrame, trees: Sequence, step: float) -> DataFrame:
    """Rows with ``__margin`` raised by the given trees."""
    if not trees:
        return rows
    told = ensemble(trees, step).transform(rows)
    return told.select("features", "__y", "__weight", (F.col("__margin") + vector_to_array("rawPrediction")[1]).alias("__margin"))


def ensemble(trees: Sequence, step: float) -> GBTClassificationModel:
    """Fitted regression trees of one weight as a boosted classifier."""
    context = SparkContext._active_spark_context
    gateway, ml = context._gateway, context._jvm.org.apache.spark.ml
    members = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(gateway.jvm.double, len(trees))
    for i, tree in enumerate(trees):
        members[i], weights[i] = tree._java_obj, float(step)
    uid = f"GBTClassifier_{uuid4().hex[:12]}"
    model = GBTClassificationModel(ml.classification.GBTClassificationModel(uid, members, weights))
    model._resetUid(uid)
    model._transfer_params_from_java()
    return model


def boosted(spark: SparkSession, trees: Sequence[boosting.Tree], limits: Sequence[np.ndarray], step: float) -> GBTClassificationModel:
    """Grown trees of one weight as MLlib's boosted classifier, by way of its file format: made node by node across the
    gateway, a tree takes longer than to grow it. Sibling leaves of one prediction are one leaf, as in MLlib's own trees."""
    context, jvm = spark.sparkContext, spark.sparkContext._jvm
    path = f"{context.getCheckpointDir()}/boosted-{uuid4().hex}"
    nothing = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(jvm.org.apache.spark.mllib.linalg.Vectors.parse("[0.0,0.0,0.0]").toArray(), 0)
    leaf = jvm.org.apache.spark.ml.tree.LeafNode(0.0, 0.0, nothing)
    stump = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel(f"dtr_{uuid4().hex[:12]}", leaf, len(limits))
    pattern = ensemble([DecisionTreeRegressionModel(stump)], step)
    pattern.write().save(f"{path}/pattern")

    def put(tree: boosting.Tree, i: int, at: int) -> tuple[list[tuple], tuple]:
        """The nodes from one down in the order of files, the first numbered ``at``, and the node for ``ensemble_trees``."""
        n, weight, pull, square, *rest = tree[i]
        value = pull / weight if weight else 0.0
        told = (value, boosting.impurity(tree[i]), [float(weight), float(pull), float(square)], int(n))
        if rest:
            gain, f, cut = rest
            left, a = put(tree, 2 * i, at + 1)
            right, b = put(tree, 2 * i + 1, at + 1 + len(left))
            if not (len(a) == len(b) == 2 and a[1] == b[1]):
                limit = float(limits[f][cut])
                first = (at, *told, gain, at + 1, at + 1 + len(left), (f, [limit], -1))
                return [first, *left, *right], (float(weight), f, limit, a, b)
            value = a[1]
            told = (value, *told[1:])
        return [(at, *told, -1.0, -1, -1, (-1, [], -1))], (float(weight), value)

    stored = [put(tree, 1, 0) for tree in trees]
    _, one, _ = spark.read.parquet(f"{path}/pattern/treesMetadata").first()
    told = json.loads(spark.read.text(f"{path}/pattern/metadata").first()[0])
    names = [json.dumps({**json.loads(one), "uid": f"dtr_{uuid4().hex[:12]}"}) for _ in trees]
    frames = {"data": [(k, node) for k, (nodes, _) in enumerate(stored) for node in nodes],
              "treesMetadata": [(k, name, float(step)) for k, name in enumerate(names)]}
    for name, rows in frames.items():
        kind = spark.read.parquet(f"{path}/pattern/{name}").schema
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{path}/model/{name}")
    spark.createDataFrame([(json.dumps({**told, "numTrees": len(trees)}),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    model = GBTClassificationModel.load(f"{path}/model")
    _grown[model] = [(float(step), root) for _, root in stored]
    return model


def best_iteration(losses: Sequence[float], patience: int) -> int:
    """Number of iterations up to the lowest loss met before ``patience`` iterations without a lower one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1 if losses else 0


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds ``pred_prob``, the probability of class 1."""
    scored = model.transform(rows)
    return scored.withColumn("pred_prob", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- attributions -----------------------------------------------------------

Leaf = tuple[float, list[int], list[float], list[float], list[float]]

_grown: WeakKeyDictionary = WeakKeyDictionary()


def ensemble_trees(model: PipelineModel) -> list[tuple]:
    """The trees as (weight, root); a node is (cover, value) or (cover, feature, cut, left, right). Read once a model."""
    booster = model.stages[-1]

    def read(node) -> tuple:
        cover = node.impurityStats().count()
        if node.subtreeDepth() == 0:
            return cover, node.prediction()
        split = node.split()
        return cover, split.featureIndex(), split.threshold(), read(node.leftChild()), read(node.rightChild())

    if booster not in _grown:
        _grown[booster] = [(float(scale), read(tree._java_obj.rootNode())) for tree, scale in zip(booster.trees, booster.treeWeights)]
    return _grown[booster]


def _branches(node: tuple, path: dict[int, tuple[float, float, float]]) -> Iterator[tuple[tuple, dict]]:
    """A node's children, each with its path: per feature low, high and cover share."""
    cover, f, cut, left, right = node
    low, high, kept = path.get(f, (-np.inf, np.inf, 1.0))
    for child, span in ((left, (low, min(high, cut))), (right, (max(low, cut), high))):
        yield child, {**path, f: (*span, kept * (child[0] / cover if cover else 0.0))}


def ensemble_leaves(model: PipelineModel) -> list[Leaf]:
    """Every leaf as (value, features, lows, highs, cover shares).

    A row reaches the leaf when ``low < x <= high`` holds for each feature on
    the path; the cover share is the part of training weight that takes the
    feature's branches.
    """
    leaves: list[Leaf] = []

    def walk(node: tuple, scale: float, path: dict[int, tuple[float, float, float]]) -> None:
        if len(node) == 2:
            order = list(path)
            leaves.append((
                node[1] * scale, order,
                [path[f][0] for f in order], [path[f][1] for f in order], [path[f][2] for f in order],
            ))
            return
        for child, longer in _branches(node, path):
            walk(child, scale, longer)

    for scale, root in ensemble_trees(model):
        walk(root, scale, {})
    return leaves


def base_margin(leaves: Sequence[Leaf]) -> float:
    """Expected raw margin: what the attributions of a row start from."""
    return float(sum(value * np.prod(shares) for value, _, _, _, shares in leaves))


_gauss = lru_cache(np.polynomial.legendre.leggauss)


def _at_nodes(shares: np.ndarray, met: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quadrature weights, and a path's factors at the nodes: (node, pattern, feature).

    The game of a leaf is a product over its path: a known feature gives 1 or 0 (``met``), an unknown one its
    cover share. Averaging a coalition's product over all orders is the integral over t in [0, 1] of factors
    share (1 - t) + met t, a polynomial of at most the path's length, for which Gauss-Legendre nodes of half
    that number are exact.
    """
    nodes, weights = _gauss((len(shares) + 1) // 2)
    t = ((nodes + 1) / 2)[:, None, None]
    return weights / 2, shares * (1 - t) + met * t


def _product_of_others(factors: np.ndarray) -> np.ndarray:
    """Per feature the product of all other factors, without division."""
    ones = np.ones_like(factors[..., :1])
    before = np.cumprod(np.concatenate([ones, factors[..., :-1]], -1), -1)
    after = np.cumprod(np.concatenate([ones, factors[..., :0:-1]], -1), -1)[..., ::-1]
    return before * after


def path_attributions(shares: np.ndarray, met: np.ndarray) -> np.ndarray:
    """Shapley values of a leaf of value 1, one row per pattern of met conditions."""
    weights, factors = _at_nodes(shares, met)
    return (met - shares) * np.tensordot(weights, _product_of_others(factors), 1)


def path_interactions(shares: np.ndarray, met: np.ndarray) -> np.ndarray:
    """Shapley interaction values of a leaf of value 1: (pattern, feature, feature). Each pair is split evenly
    between its two cells; the diagonal is what is left of a feature's Shapley value."""
    d = len(shares)
    weights, factors = _at_nodes(shares, met)
    gap = met - shares
    out = np.zeros((len(met), d, d))
    for i in range(d):
        rest = factors.copy()
        rest[..., i] = 1.0
        out[:, i, :] = 0.5 * gap[:, i:i + 1] * gap * np.tensordot(weights, _product_of_others(rest), 1)
        out[:, i, i] = 0.0
    diagonal = np.arange(d)
    out[:, diagonal, diagonal] = path_attributions(shares, met) - out.sum(2)
    return out


def _by_pattern(leaf: Leaf, x: np.ndarray, of_path) -> tuple[list[int], np.ndarray]:
    """A leaf's path and ``of_path`` of each row of ``x``: worked out once per pattern of met conditions, of
    which there are at most as many as rows."""
    value, path, lows, highs, shares = leaf
    d = len(path)
    pattern = np.zeros(len(x), dtype=np.int64)
    for bit, (f, low, high) in enumerate(zip(path, lows, highs)):
        pattern |= ((x[:, f] > low) & (x[:, f] <= high)).astype(np.int64) << bit
    if 2 ** d <= len(x):
        patterns, place = np.arange(2 ** d), pattern
    else:
        patterns, place = np.unique(pattern, return_inverse=True)
    met = ((patterns[:, None] >> np.arange(d)) & 1).astype(float)
    return path, value * of_path(np.array(shares), met)[place]


BLOCK_DEPTH = 2  # levels of a block of leaves
BLOCK_BITS = 10  # conditions of a block at most; leaves with more stay alone

Block = tuple[list[tuple[int, float, float]], list[tuple[float, list[int], list[float], list[list[tuple[int, bool]]]]]]


def ensemble_blocks(model: PipelineModel) -> tuple[list[Block], list[Leaf]]:
    """The leaves in blocks, and those that are in none.

    A block is the leaves below one node near the bottom, with the conditions that decide all of them: the
    intervals on the way to the node, and ``x <= cut`` of each split below. A leaf's feature is met when each of its
    (condition, outcome) holds.
    """
    blocks: list[Block] = []
    alone: list[Leaf] = []

    def depth(node: tuple) -> int:
        return 0 if len(node) == 2 else 1 + max(depth(node[3]), depth(node[4]))

    def walk(node: tuple, scale: float, path: dict[int, tuple[float, float, float]]) -> None:
        if depth(node) > BLOCK_DEPTH:
            for child, longer in _branches(node, path):
                walk(child, scale, longer)
            return
        conditions = [(f, low, high) for f, (low, high, _) in path.items()]
        leaves: list = []
        plain: list[Leaf] = []

        def below(node: tuple, path: dict, tests: dict[int, list[tuple[int, bool]]]) -> None:
            if len(node) == 2:
                order = list(path)
                leaves.append((node[1] * scale, order, [path[f][2] for f in order], [tests[f] for f in order]))
                plain.append((node[1] * scale, order, *[[path[f][k] for f in order] for k in range(3)]))
                return
            _, f, cut, _, _ = node
            bit = len(conditions)
            conditions.append((f, -np.inf, cut))
            for (child, longer), outcome in zip(_branches(node, path), (True, False)):
                below(child, longer, {**tests, f: [*tests.get(f, []), (bit, outcome)]})

        below(node, path, {f: [(bit, True)] for bit, f in enumerate(path)})
        if not conditions:
            return
        if len(conditions) <= BLOCK_BITS:
            blocks.append((conditions, leaves))
        else:
            alone.extend(plain)

    for scale, root in ensemble_trees(model):
        walk(root, scale, {})
    return blocks, alone


Table = tuple[list[tuple[int, float, float]], list, np.ndarray]


def _tables(blocks: Sequence[Block], of_path, cells_of) -> Iterator[Table]:
    """Per block its conditions, and per cell of the result the sum of its leaves' values for each pattern of
    conditions met. ``cells_of`` names the cells of a list of features, and picks them from ``of_path``'s values."""
    for conditions, leaves in blocks:
        patterns = np.arange(2 ** len(conditions))
        met_bit = (patterns >> np.arange(len(conditions))[:, None]) & 1 == 1
        cells: dict = {}
        rows: list[np.ndarray] = []
        for value, path, shares, tests in leaves:
            code = np.zeros(len(patterns), dtype=np.int64)
            for j, wanted in enumerate(tests):
                code |= np.logical_and.reduce([met_bit[bit] == outcome for bit, outcome in wanted]).astype(np.int64) << j
            d = len(path)
            met = ((np.arange(2 ** d)[:, None] >> np.arange(d)) & 1).astype(float)
            names, values = cells_of(path, value * of_path(np.array(shares), met))
            for name, told in zip(names, values):
                if name not in cells:
                    cells[name] = len(rows)
                    rows.append(np.zeros(len(patterns)))
                rows[cells[name]] += told[code]
        yield conditions, list(cells), np.array(rows)


def _add_blocks(tables: Iterable[Table], x: np.ndarray, out: np.ndarray) -> None:
    """Add to ``out``, (cell, row), what the blocks tell of the rows ``x``: a lookup per block and cell."""
    columns = np.ascontiguousarray(x.T)
    for conditions, cells, table in tables:
        place = np.zeros(len(x), dtype=np.intp)
        for bit, (f, low, high) in enumerate(conditions):
            met = columns[f] <= high if low == -np.inf else columns[f] > low
            if low != -np.inf and high != np.inf:
                met &= columns[f] <= high
            place += np.multiply(met, 1 << bit, dtype=np.intp)
        for cell, told in zip(cells, table):
            out[cell] += told[place]


def _ordinary(x: np.ndarray) -> np.ndarray:
    """Rows for which one of ``x <= cut`` and ``x > cut`` opens each interval: those without NaN and -inf."""
    return (x > -np.inf).all(1)


def _feature_cells(path: list[int], values: np.ndarray) -> tuple[list, np.ndarray]:
    return path, values.T


def _pair_cells(path: list[int], values: np.ndarray) -> tuple[list, list]:
    pairs = [(a, b) for a in range(len(path)) for b in range(len(path)) if path[a] <= path[b]]
    return [(path[a], path[b]) for a, b in pairs], [values[:, a, b] for a, b in pairs]


def attributions(
    model: PipelineModel, rows: DataFrame, features: Sequence[str] = tuple(S.FEATURES),
    keys: Sequence[str] = ("loan_id", "installment_no"),
) -> DataFrame:
    """Path-dependent Shapley values of the raw margin, one array per row.

    Spark partitions the rows; each task makes the tables of the broadcast blocks of leaves, whose number
    is fixed by trees and depth, and looks Arrow batches up in them: per row and block, one lookup per feature.
    """
    features, keys = list(features), list(keys)
    kept = rows.sparkSession.sparkContext.broadcast((*ensemble_blocks(model), [leaf for leaf in ensemble_leaves(model) if leaf[1]]))

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (blocks, alone, leaves), tables = kept.value, None
        for batch in batches:
            if tables is None:
                tables = list(_tables(blocks, path_attributions, _feature_cells))
            phi = _shapley(tables, alone, leaves, batch[features].to_numpy(dtype=float))
            out = batch[keys].copy()
            out["attributions"] = list(phi)
            yield out

    fields = [rows.schema[k] for k in keys] + [T.StructField("attributions", T.ArrayType(T.DoubleType()))]
    return _explained(rows, keys, features).mapInPandas(explain, T.StructType(fields))


def _shapley(tables: Sequence[Table], alone: Sequence[Leaf], leaves: Sequence[Leaf], x: np.ndarray) -> np.ndarray:
    """Shapley values (row, feature): ordinary rows by tables and the leaves outside of them, others leaf by leaf."""
    phi = np.zeros_like(x)
    plain = _ordinary(x)
    sums = np.zeros((x.shape[1], int(plain.sum())))
    _add_blocks(tables, x[plain], sums)
    phi[plain] = sums.T
    for some, by_leaf in ((plain, alone), (~plain, leaves)):
        at = np.flatnonzero(some)
        for leaf in by_leaf if len(at) else ():
            path, values = _by_pattern(leaf, x[at], path_attributions)
            phi[at[:, None], path] += values
    return phi


def _explained(rows: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    return rows.select(*keys, *[F.col(c).cast("double").alias(c) for c in features])


INTERACTION_ROWS = 500  # rows whose matrices a task holds at once
PAIR_ROWS = 10_000  # rows whose pair values a task holds at once


def interactions(
    model: PipelineModel, rows: DataFrame, features: Sequence[str] = tuple(S.FEATURES),
    keys: Sequence[str] = ("loan_id", "installment_no"),
) -> DataFrame:
    """Pairwise Shapley interaction values of the raw margin: per row a symmetric matrix (array of rows) whose
    rows add up to ``attributions``."""
    features, keys = list(features), list(keys)
    kept = rows.sparkSession.sparkContext.broadcast((*ensemble_blocks(model), [leaf for leaf in ensemble_leaves(model) if leaf[1]]))

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), PAIR_ROWS):
                part = batch.iloc[start:start + PAIR_ROWS]
                values, where = _pairs(kept.value, part[features].to_numpy(dtype=float))
                for at in range(0, len(part), INTERACTION_ROWS):
                    out = part.iloc[at:at + INTERACTION_ROWS][keys].copy()
                    out["interactions"] = [list(m) for m in values[:, at:at + INTERACTION_ROWS].T[:, where]]
                    yield out

    matrix = T.ArrayType(T.ArrayType(T.DoubleType()))
    fields = [rows.schema[k] for k in keys] + [T.StructField("interactions", matrix)]
    return _explained(rows, keys, features).mapInPandas(explain, T.StructType(fields))


def _pairs(kept: tuple[list[Block], list[Leaf], list[Leaf]], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interaction values (pair, row) of each pair of features, and a matrix of the pairs' places in it."""
    blocks, alone, leaves = kept
    m = x.shape[1]
    where = np.zeros((m, m), dtype=np.intp)
    i, j = np.triu_indices(m)
    where[i, j] = where[j, i] = np.arange(len(i))
    total = np.zeros((len(i), len(x)))
    plain = _ordinary(x)
    told = ((conditions, [where[pair] for pair in cells], table) for conditions, cells, table in _tables(blocks, path_interactions, _pair_cells))
    if plain.all():
        _add_blocks(told, x, total)
    else:
        some = np.zeros((len(i), int(plain.sum())))
        _add_blocks(told, x[plain], some)
        total[:, plain] = some
    for some, by_leaf in ((plain, alone), (~plain, leaves)):
        at = np.flatnonzero(some)
        for leaf in by_leaf if len(at) else ():
            path, values = _by_pattern(leaf, x[at], path_interactions)
            for cell, v in zip(*_pair_cells(path, values)):
                total[where[cell], at] += v
    return total, where


def interaction_summary(model: PipelineModel, rows: DataFrame, features: Sequence[str] = tuple(S.FEATURES)) -> DataFrame:
    """Mean absolute and mean signed interaction of each pair of features (both cells together) over the rows.

    Tasks send sums per pair, not matrices."""
    features = list(features)
    names = features
    kept = rows.sparkSession.sparkContext.broadcast((*ensemble_blocks(model), [leaf for leaf in ensemble_leaves(model) if leaf[1]]))
    i, j = np.triu_indices(len(features), 1)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, size, signed = 0, np.zeros(len(i)), np.zeros(len(i))
        for batch in batches:
            for at in range(0, len(batch), PAIR_ROWS):
                values, where = _pairs(kept.value, batch.iloc[at:at + PAIR_ROWS].to_numpy(dtype=float))
                pairs = where[i, j]
                n, size, signed = n + values.shape[1], size + 2 * np.abs(values).sum(1)[pairs], signed + 2 * values.sum(1)[pairs]
        yield pd.DataFrame({"feature_a": [names[k] for k in i], "feature_b": [names[k] for k in j], "n": n, "size": size, "signed": signed})

    sums = _explained(rows, [], features).mapInPandas(add, "feature_a string, feature_b string, n bigint, size double, signed double")
    return sums.groupBy("feature_a", "feature_b").agg(
        E.ratio(F.sum("size"), F.sum("n")).alias("mean_abs"), E.ratio(F.sum("signed"), F.sum("n")).alias("mean_signed"))


def attribution_summary(values: DataFrame, features: Sequence[str] = tuple(S.FEATURES)) -> DataFrame:
    """Mean absolute and mean signed attribution per feature, with direction and category."""
    names = F.array(*[F.lit(f) for f in features])
    tall = values.select(F.posexplode("attributions").alias("i", "v")).select(
        F.element_at(names, F.col("i") + 1).alias("feature"), "v"
    )
    return (
        tall.groupBy("feature").agg(F.avg(F.abs("v")).alias("mean_abs"), F.avg("v").alias("mean_signed"))
        .withColumn("direction", F.when(F.col("mean_signed") > 0, "up").otherwise("down"))
        .withColumn("category", E.feature_category("feature"))
    )


def category_importance(summary: DataFrame, value: str = "mean_abs") -> DataFrame:
    by_group = summary.groupBy(E.feature_category("feature").alias("category")).agg(
        F.sum(value).alias("importance")
    )
    return by_group.withColumn("share_pct", E.pct("importance", over_groups(F.sum("importance"))))


def feature_importance(spark: SparkSession, model: PipelineModel, features: Sequence[str] = tuple(S.FEATURES)) -> DataFrame:
    """Gain-based importance per feature (one row per feature)."""
    gains = model.stages[-1].featureImportances.toArray()
    frame = spark.createDataFrame(
        [(f, float(g)) for f, g in zip(features, gains)], "feature string, importance double"
    )
    return frame.withColumn("category", E.feature_category("feature"))


def add_rank(df: DataFrame, by: str, n: int) -> DataFrame:
    """Rank the ``n`` largest rows by a column, ties by feature name.

    The list is cut before it is numbered, so the numbering window sees ``n`` rows.
    """
    order = [F.desc(by), F.asc("feature")]
    return df.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)))
