"""Boosted regression trees for many rows, grown in one stage whose tasks keep their rows as bin codes.

The trees are those of MLlib's learner: level-wise, weighted variance, at most ``BINS`` bins a feature, features drawn
per node, rows per tree. The rows are binned once for all trees, on all rows instead of a sample of them, and dealt
evenly to the tasks of a barrier stage. A tree then costs each task a pass over the smaller child of each split, and
an exchange of histograms a level, through small files; nothing is planned or shuffled between trees.
"""

from __future__ import annotations

import itertools
import math
import os
import pickle
import time
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import unquote, urlsplit
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession

BINS = 32
CELLS = 1024  # of a joint table of several features' bins
SUMMARY_VALUES = 4096  # distinct values of a feature that a task tells one by one
BLOCK_ROWS = 2048
CHUNK_ROWS = 1 << 14  # rows whose codes a task widens at once
FOLDER_SECONDS = 60.0
EPSILON = 2.0 ** -52
POSITIVE = 2.0 ** 26  # what a row of class 1 adds to a packed count beside 1


def slots(spark: SparkSession) -> int:
    """Tasks that run at the same time; 0 where a barrier stage cannot run."""
    context = spark.sparkContext
    if str(context.getConf().get("spark.dynamicAllocation.enabled", "false")).lower() == "true":
        return 0
    scala = context._jsc.sc()
    return scala.maxNumConcurrentTasks(scala.resourceProfileManager().defaultResourceProfile())


def shared_folder(spark: SparkSession) -> str | None:
    """The checkpoint folder, where tasks can open it as a path."""
    place = urlsplit(spark.sparkContext.getCheckpointDir() or "none:")
    return unquote(place.path) if place.scheme in ("", "file") else None


# --- bins -------------------------------------------------------------------

def summed(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order with their weights. Of more than ``SUMMARY_VALUES``, runs of less than that share of
    the weight are told by their last value; a value of more weight stays by itself."""
    order = np.argsort(values)
    values, total = values[order], np.cumsum(weights[order])
    last = np.flatnonzero(np.append(values[1:] != values[:-1], True)[:len(values)])
    values, total = values[last], total[last]
    if len(values) > SUMMARY_VALUES:
        run = np.floor(total * (SUMMARY_VALUES / total[-1]))
        heavy = np.diff(total, prepend=0.0) * SUMMARY_VALUES >= total[-1]
        kept = np.flatnonzero(np.append(run[1:] != run[:-1], True) | heavy)
        values, total = values[kept], total[kept]
    return values, np.diff(total, prepend=0.0)


def cuts(values: np.ndarray, weights: np.ndarray) -> list[float]:
    """At most ``BINS`` - 1 limits between distinct values: all of them, or those next to equal steps of weight."""
    if len(values) <= BINS:
        return list((values[1:] + values[:-1]) / 2)
    stride, total = weights.sum() / BINS, np.cumsum(weights)
    found: list[float] = []
    target = stride
    for i in range(1, len(values)):
        if len(found) < BINS - 1 and abs(total[i - 1] - target) < abs(total[i] - target):
            found.append((values[i - 1] + values[i]) / 2)
            target += stride
    return found


def bin_limits(rows: DataFrame, features: Sequence[str], heavier: float) -> list[np.ndarray]:
    """Each feature's limits; a row is in the bin of the first limit that is not below its value."""
    features = list(features)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [(np.zeros(0), np.zeros(0)) for _ in features]
        waiting: list[list] = [[] for _ in features]
        n = 0

        def merge() -> None:
            for f, some in enumerate(waiting):
                kept[f] = summed(*(np.concatenate(x) for x in zip(kept[f], *some)))
                some.clear()

        for batch in batches:
            weights = np.where(batch.column("__y").to_numpy(zero_copy_only=False) > 0, heavier, 1.0)
            for f, name in enumerate(features):
                waiting[f].append((_numbers(batch, name), weights))
            n += batch.num_rows
            if n > 5 * SUMMARY_VALUES:
                merge()
                n = 0
        merge()
        yield pa.RecordBatch.from_pydict({
            "feature": pa.array(range(len(features)), pa.int32()),
            "found": pa.array([v for v, _ in kept], pa.list_(pa.float64())),
            "weights": pa.array([w for _, w in kept], pa.list_(pa.float64()))})

    def limits(told: pd.DataFrame) -> pd.DataFrame:
        found = cuts(*summed(np.concatenate([*told["found"]]), np.concatenate([*told["weights"]])))
        return pd.DataFrame({"feature": told["feature"].iloc[:1], "limits": [found]})

    summaries = rows.select(*features, "__y").mapInArrow(summarise, "feature int, found array<double>, weights array<double>")
    told = summaries.groupBy("feature").applyInPandas(limits, "feature int, limits array<double>").collect()
    by_feature = {r["feature"]: r["limits"] for r in told}
    return [np.array(by_feature.get(f, []), dtype=float) for f in range(len(features))]


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(name)
    values = column.to_numpy(zero_copy_only=False)
    if column.null_count or np.isnan(values).any():
        raise ValueError(f"{name} has null or NaN values")
    return values


class Layout:
    """Features whose bins share a table of at most ``CELLS`` cells are one code of a row."""

    def __init__(self, limits: Sequence[np.ndarray]):
        self.limits = list(limits)
        sizes = {f: len(x) + 1 for f, x in enumerate(limits) if len(x)}
        self.groups: list[list[int]] = []
        self.cells: list[int] = []
        for f in sorted(sizes, key=lambda f: (-sizes[f], f)):
            g = next((g for g, n in enumerate(self.cells) if n * sizes[f] <= CELLS), len(self.cells))
            if g == len(self.cells):
                self.groups.append([])
                self.cells.append(1)
            self.groups[g].append(f)
            self.cells[g] *= sizes[f]
        self.features = sorted(sizes)
        self.of_group: dict[int, int] = {}
        self.bin_of: dict[int, np.ndarray] = {}  # a feature's bin for each code of its group
        self.step_of: dict[int, int] = {}
        first, at = {}, 0
        for g, members in enumerate(self.groups):
            step = 1
            for f in members:
                self.of_group[f], self.step_of[f], first[f] = g, step, at
                self.bin_of[f] = np.arange(self.cells[g]) // step % sizes[f]
                step, at = step * sizes[f], at + sizes[f]
        self.width = at  # bins of all features
        # a feature a row; what lies beyond its bins is the column past the last
        self.place = np.full((len(self.features), max(sizes.values(), default=1)), at)
        for k, f in enumerate(self.features):
            self.place[k, :sizes[f]] = first[f] + np.arange(sizes[f])
        self.cuttable = np.array([[b < sizes[f] - 1 for b in range(self.place.shape[1])] for f in self.features], dtype=bool).reshape(self.place.shape)

    def codes(self, batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
        """A row's codes stand together: most nodes of a tree hold few of the rows that lie side by side."""
        out = np.zeros((len(self.groups), batch.num_rows), dtype=np.uint16)
        for f, name in enumerate(names):
            values = _numbers(batch, name)
            if f in self.of_group:
                out[self.of_group[f]] += (np.searchsorted(self.limits[f], values) * self.step_of[f]).astype(np.uint16)
        return np.ascontiguousarray(out.T)

    def spread(self, g: int) -> np.ndarray:
        """Cells of a group's table to its features' bins."""
        return np.concatenate([np.eye(self.bin_of[f].max() + 1)[self.bin_of[f]] for f in self.groups[g]], 1)


# --- trees ------------------------------------------------------------------

# a node by its place (1, then 2n and 2n + 1): rows, weight, sum and sum of squares of the gradient; with a split also gain, feature, bin
Tree = dict[int, tuple]


class Task:
    """The rows of a task."""

    def __init__(self, layout: Layout, blocks: Iterator[pa.RecordBatch], heavier: float):
        codes, positive, valid = [], [], []
        for batch in blocks:
            for block, label, watched in zip(batch.column("codes"), batch.column("positive"), batch.column("valid")):
                label = np.frombuffer(label.as_py(), dtype=np.uint8)
                positive.append(label)
                codes.append(np.frombuffer(block.as_py(), dtype=np.uint16))
                valid.append(np.full(len(label), watched.as_py()))
        self.positive, watched = np.concatenate([np.zeros(0, np.uint8), *positive]), np.concatenate([np.zeros(0, bool), *valid])
        self.codes = np.concatenate([np.zeros(0, np.uint16), *codes]).reshape(len(watched), len(layout.groups))
        self.learnt, self.valid = (np.flatnonzero(x) for x in (~watched, watched))
        self.layout, self.heavier = layout, heavier
        self.spreads = [layout.spread(g) for g in range(len(layout.groups))]
        self.margin = np.zeros(len(self.positive))
        self.pull = self.square = self.margin  # of a row: weight times gradient, and times its square

    def take_gradients(self) -> None:
        y = self.positive * 2.0 - 1.0
        with np.errstate(over="ignore"):
            gradient = y * 4.0 / (1.0 + np.exp(y * 2.0 * self.margin))
        self.pull = np.where(self.positive == 1, self.heavier, 1.0) * gradient
        self.square = self.pull * gradient

    def histogram(self, rows: np.ndarray) -> np.ndarray:
        """Rows, rows of class 1 and pull of each bin: (3, width)."""
        if len(rows) > POSITIVE / 2:
            return self.histogram(rows[:len(rows) // 2]) + self.histogram(rows[len(rows) // 2:])
        tables = [np.zeros((2, n)) for n in self.layout.cells]
        unit = np.array([1.0, 1.0 + POSITIVE])
        for at in range(0, len(rows), CHUNK_ROWS):
            some = rows[at:at + CHUNK_ROWS]
            count, pull = unit.take(self.positive.take(some)), self.pull.take(some)
            codes = self.codes.take(some, 0)
            for g, table in enumerate(tables):
                code = codes[:, g].astype(np.intp)
                table[0] += np.bincount(code, count, table.shape[1])
                table[1] += np.bincount(code, pull, table.shape[1])
        packed, pull = np.concatenate([t @ s for t, s in zip(tables, self.spreads)], 1) if tables else np.zeros((2, 0))
        positive = np.floor(packed / POSITIVE)
        return np.array([packed - positive * POSITIVE, positive, pull])

    def totals(self, rows: np.ndarray) -> list[float]:
        return [len(rows), self.positive.take(rows).sum(dtype=float), self.pull.take(rows).sum(), self.square.take(rows).sum()]

    def parted(self, rows: np.ndarray, f: int, cut: int) -> tuple[np.ndarray, np.ndarray]:
        below, codes = self.layout.bin_of[f] <= cut, self.codes.ravel()
        sides: tuple[list, list] = [rows[:0]], [rows[:0]]
        for at in range(0, len(rows), CHUNK_ROWS):
            some = rows[at:at + CHUNK_ROWS]
            left = below.take(codes.take(some * self.codes.shape[1] + self.layout.of_group[f]))
            sides[0].append(some[left])
            sides[1].append(some[~left])
        return np.concatenate(sides[0]), np.concatenate(sides[1])

    def loss(self) -> np.ndarray:
        """Weighted log loss of the watched rows, and their weight."""
        positive = self.positive[self.valid]
        weight = np.where(positive == 1, self.heavier, 1.0)
        z = (positive * 2.0 - 1.0) * self.margin[self.valid] * -2.0
        return np.array([(weight * 2.0 * (np.maximum(z, 0.0) + np.log1p(np.exp(-np.abs(z))))).sum(), weight.sum()])


def best_splits(layout: Layout, histograms: np.ndarray, stats: np.ndarray, allowed: np.ndarray, heavier: float, min_rows: int) -> list[tuple]:
    """Per node the split of most gain, as gain, feature, bin and the left side's rows, rows of class 1 and pull.

    Only sums in a fixed order and single operations decide, so every task finds the same.
    """
    padded = np.concatenate([histograms, np.zeros((*histograms.shape[:2], 1))], 2)[:, :, layout.place]
    n, positive, pull = np.moveaxis(np.cumsum(padded, -1), 1, 0)
    rows, ones, drawn = (stats[:, k][:, None, None] for k in range(3))
    weight, whole = n + (heavier - 1.0) * positive, rows + (heavier - 1.0) * ones
    open_ = layout.cuttable & (n >= min_rows) & (rows - n >= min_rows) & allowed[:, :, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (pull ** 2 / weight + (drawn - pull) ** 2 / (whole - weight) - drawn ** 2 / whole) / whole
    flat = np.where(open_ & (gain > 0), gain, -np.inf).reshape(len(gain), -1)
    out = []
    for k, at in enumerate(flat.argmax(1) if flat.shape[1] else []):
        place = np.unravel_index(at, gain.shape[1:])
        out.append((float(flat[k, at]), layout.features[place[0]], int(place[1]), *(float(x[k][place]) for x in (n, positive, pull))))
    return out or [(-np.inf, 0, 0, 0.0, 0.0, 0.0)] * len(histograms)


def grow_tree(task: Task, gather: Callable, depth: int, step: float, row_share: float, column_share: float, min_rows: int, drawn: tuple) -> tuple[Tree, np.ndarray]:
    """A tree fitted to the gradient at the task's margins, which it raises, and the loss after it."""
    layout, (of_rows, of_columns) = task.layout, drawn
    task.take_gradients()
    chosen = of_rows.random(len(task.learnt)) < row_share if row_share < 1.0 else np.ones(len(task.learnt), bool)
    rows = {1: task.learnt[chosen]}
    others = {1: np.concatenate([task.learnt[~chosen], task.valid])}
    columns = math.ceil(column_share * len(layout.limits))
    tree: Tree = {}
    splits: dict[int, tuple] = {}
    known: dict[int, list[float]] = {}  # rows, rows of class 1 and pull, of all tasks
    kept: dict[int, np.ndarray] = {}
    level = [1]

    def node(i: int, square: float) -> tuple:
        n, positive, pull = known[i]
        return n, n + (task.heavier - 1.0) * positive, pull, square

    for deep in range(depth):
        # of two children the smaller one is counted, the other one is what its parent has besides
        growing = [i for i in level if deep == 0 or known[i][0] >= 2 * min_rows]
        counted = sorted({i if deep == 0 or known[i][0] < known[i ^ 1][0] or (known[i][0] == known[i ^ 1][0] and i % 2 == 0) else i ^ 1 for i in growing})
        local = [task.totals(rows[i]) for i in level] if deep == 0 else [[0.0, 0.0, 0.0, task.square.take(rows[i]).sum()] for i in level]
        told = gather(np.concatenate([np.array(local).ravel(), *[task.histogram(rows[i]).ravel() for i in counted]]))
        totals, tables = told[:4 * len(level)].reshape(-1, 4), told[4 * len(level):].reshape(len(counted), 3, layout.width)
        if deep == 0:
            known[1] = list(totals[0, :3])
        here = dict(zip(counted, tables))
        for i in growing:
            if i not in here:
                rest = kept[i // 2] - here[i ^ 1]
                rest[2][rest[0] == 0] = 0.0
                here[i] = rest
        for i, (_, _, _, square) in zip(level, totals):
            tree[i] = node(i, float(square))
        pure = {i for i in level if deep and abs(impurity(tree[i])) < EPSILON}
        open_ = [i for i in growing if i not in pure]
        kept, level = {i: here[i] for i in open_}, []
        allowed = np.array([np.isin(layout.features, of_columns.choice(len(layout.limits), columns, replace=False)) for _ in open_]).reshape(len(open_), len(layout.features))
        found = best_splits(layout, np.array([here[i] for i in open_]), np.array([known[i] for i in open_]), allowed, task.heavier, min_rows) if open_ else []
        for i, (gain, f, cut, *left) in zip(open_, found):
            if gain <= 0:
                continue
            splits[i] = gain, f, cut
            known[2 * i], known[2 * i + 1] = left, [a - b for a, b in zip(known[i], left)]
            for some in (rows, others):
                some[2 * i], some[2 * i + 1] = task.parted(some.pop(i), f, cut)
            level += [2 * i, 2 * i + 1]
        if not level:
            break
    for i, some in rows.items():
        n, weight, pull, _ = node(i, 0.0)
        value = step * (pull / weight if weight else 0.0)
        task.margin[some] += value
        task.margin[others[i]] += value
    told = gather(np.concatenate([task.loss(), [task.square.take(rows[i]).sum() for i in level]]))
    for i, square in zip(level, told[2:]):
        tree[i] = node(i, float(square))
    return {i: (*map(float, x), *splits.get(i, ())) for i, x in tree.items()}, told[:2]


def impurity(node: tuple) -> float:
    _, weight, pull, square = node[:4]
    return (square - pull * pull / weight) / weight if weight else 0.0


def exchange(folder: str, me: int, n: int) -> Callable[[np.ndarray], np.ndarray]:
    """The sum of ``n`` tasks' numbers, added in the order of the tasks, by files of a folder that all of them open.

    Spark's own ``allGather`` looks for an answer once a second, which would take longer than a tree. Each task writes two
    files in turn: whoever writes a step has read all of the step before, so nobody still needs the one before that.
    """
    steps = itertools.count(1)

    def read(task: int, step: int) -> np.ndarray:
        wait, since = 0.0005, time.monotonic()
        while True:
            try:
                with open(f"{folder}/{task}-{step % 2}", "rb") as f:
                    told = f.read()
                if int.from_bytes(told[:8], "little") == step:
                    return np.frombuffer(told, offset=8)
            except FileNotFoundError:
                if step == 1 and time.monotonic() - since > FOLDER_SECONDS:
                    raise RuntimeError(f"{folder} is not shared by all executors") from None
            time.sleep(wait)
            wait = min(2 * wait, 0.002)

    def gather(numbers: np.ndarray) -> np.ndarray:
        step, numbers = next(steps), numbers.astype(float)
        if n == 1:
            return numbers
        with open(f"{folder}/{me}-new", "wb") as f:
            f.write(step.to_bytes(8, "little") + numbers.tobytes())
        os.replace(f"{folder}/{me}-new", f"{folder}/{me}-{step % 2}")
        total = np.zeros(len(numbers))
        for task in range(n):
            total += numbers if task == me else read(task, step)
        return total

    return gather


def boost(
    rows: DataFrame, features: Sequence[str], tasks: int, heavier: float, stop: Callable[[list[float]], bool],
    trees: int, depth: int, step: float, row_share: float, column_share: float, min_rows: int, seed: int,
) -> tuple[list[Tree], list[float], list[np.ndarray]]:
    """Trees, the loss of the watched rows after each, and each feature's limits.

    ``rows`` has the features as doubles, ``__y`` (1 or -1) and ``__valid``; rows of class 1 weigh ``heavier``. Growth
    ends at ``trees`` or when ``stop`` says so of the losses, without watched rows never.
    """
    features, folder = list(features), f"{shared_folder(rows.sparkSession)}/boost-{uuid4().hex}"
    layout = Layout(bin_limits(rows.where(~rows["__valid"]), features, heavier))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = layout.codes(batch, features)
            positive = (batch.column("__y").to_numpy(zero_copy_only=False) > 0).astype(np.uint8)
            watched = batch.column("__valid").to_numpy(zero_copy_only=False)
            out = {"valid": [], "positive": [], "codes": []}
            for kind in (False, True):
                some = np.flatnonzero(watched == kind)
                for at in range(0, len(some), BLOCK_ROWS):
                    block = some[at:at + BLOCK_ROWS]
                    out["valid"].append(kind)
                    out["positive"].append(positive[block].tobytes())
                    out["codes"].append(codes[block].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out["valid"], pa.bool_()), pa.array(out["positive"], pa.binary()), pa.array(out["codes"], pa.binary())], ["valid", "positive", "codes"])

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        task = Task(layout, batches, heavier)
        attempt = context.allGather(uuid4().hex)[0] if tasks > 1 else ""
        if tasks > 1:
            os.makedirs(f"{folder}/{attempt}", exist_ok=True)
        gather = exchange(f"{folder}/{attempt}", context.partitionId(), tasks)
        grown: list[Tree] = []
        losses: list[float] = []
        while len(grown) < trees and not stop(losses):
            drawn = tuple(np.random.default_rng([seed + len(grown), k]) for k in (1 + context.partitionId(), 0))
            tree, (loss, weight) = grow_tree(task, gather, depth, step, row_share, column_share, min_rows, drawn)
            grown.append(tree)
            if weight:
                losses.append(float(loss / weight))
        if context.partitionId() == 0:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((grown, losses))], pa.binary())], ["told"])

    blocks = rows.select(*features, "__y", "__valid").mapInArrow(pack, "valid boolean, positive binary, codes binary")
    told = blocks.repartition(tasks).mapInArrow(grow, "told binary", barrier=True).collect()
    grown, losses = pickle.loads(told[0]["told"])
    return grown, losses, layout.limits
