"""Global order statistics without a single-task sort.

Everything here starts from the distinct values of a column with their counts.
A column measured to have few distinct values takes the direct way: Spark's own
``percentile``, or one window over the distinct values. Otherwise values are put into buckets with bounds taken from approximate percentiles (a
few for each shuffle partition on the driver); running totals are formed inside
a bucket and shifted by the totals of the buckets before it. Ties are already
merged, so no bucket can be flooded by one popular value.

Null and NaN values are left out before anything is measured, -0.0 equals 0.0, and a group
without any value keeps its row with a null quantile; which way is taken never shows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "__bucket"
GATHER_VALUES = 500_000  # values between two limits that one task may sort to finish a selection
SMALL_DISTINCT = 200_000  # this many distinct values may share one task
MAX_SLICES = 256  # sketches that are merged in one task
REMEMBERED = 256


_measured: dict[tuple, dict] = {}


def plain(value: str | Column) -> Column:
    """The value as a double; NaN is null and -0.0 is 0.0."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double") + F.lit(0.0)
    return F.when(~F.isnan(v), v)


@dataclass(frozen=True)
class ValueStats:
    """Bucket limits of a column and an upper estimate of its distinct values."""

    bounds: list[float]
    distinct: int

    @property
    def small(self) -> bool:
        return self.distinct <= SMALL_DISTINCT


def value_stats(df: DataFrame, columns: Sequence[str], buckets: int | None = None) -> dict[str, ValueStats]:
    """Measure numeric columns in one pass over ``df``.

    Input partitions are summarised in slices first, so that no single task
    has to merge the percentile sketch of every partition. The numbers only
    choose the execution path and the bucket limits, never a result, so the latest
    are remembered for the same plan over input of the same size.
    """
    size = str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    memo = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), size, tuple(columns), buckets)
    if memo not in _measured:
        while len(_measured) >= REMEMBERED:
            del _measured[next(iter(_measured))]
        _measured[memo] = _measure(df, columns, buckets)
    return _measured[memo]


def _measure(df: DataFrame, columns: Sequence[str], buckets: int | None) -> dict[str, ValueStats]:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = min(parts, MAX_SLICES)
    buckets = max(2, 4 * parts if buckets is None else buckets)
    probs = [i / buckets for i in range(1, buckets)]

    def sketch(c: Column) -> Column:
        return F.percentile_approx(c.cast("double"), probs, max(1_000, 4 * buckets))

    per_slice = df.groupBy((F.spark_partition_id() % slices).alias("slice")).agg(*[
        F.struct(sketch(F.col(c)).alias("q"), F.hll_sketch_agg(F.xxhash64(plain(c))).alias("d")).alias(c) for c in columns
    ])
    tall = per_slice.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(f"{c}.q").alias("q"), F.col(f"{c}.d").alias("d")) for c in columns
    ])).alias("s")).select("s.name", "s.d", F.posexplode_outer("s.q").alias("pos", "v"))
    rows = tall.groupBy("name").agg(
        sketch(F.col("v")).alias("q"), F.hll_sketch_estimate(F.hll_union_agg("d")).alias("d")
    ).collect()  # one row per column
    found = {r["name"]: r for r in rows}
    out = {}
    for c in columns:
        q, d = (found[c]["q"], found[c]["d"]) if c in found else (None, 0)
        inner = sorted({float(v) for v in (q or [])}) or [0.0]
        # approximate counts may be a few percent low
        out[c] = ValueStats([float("-inf"), *inner, float("inf")], int((d or 0) * 1.25))
    return out


def _bucketed(df: DataFrame, value: str, bounds: list[float]) -> DataFrame:
    marked = Bucketizer(splits=bounds, inputCol=value, outputCol=BUCKET).transform(df)
    # never null, so no null filter is pushed below the aggregate and both readers share one shuffle
    return marked.withColumn(BUCKET, F.coalesce(F.col(BUCKET).cast("int"), F.lit(0)))


def running_totals(
    df: DataFrame,
    value: str,
    measures: dict[str, Column],
    by: Sequence[str] = (),
    descending: bool = False,
    buckets: int | None = None,
    stats: ValueStats | None = None,
) -> DataFrame:
    """One row per distinct ``(by, value)`` with each measure ``m``, its running total
    ``cum_m`` and the total ``all_m`` of the whole group.

    ``measures`` are row expressions that get summed. ``cum_m`` includes the
    row's own value; ``descending`` starts from the largest value. Rows with a
    null key or value are left out. The input is read twice: once to measure it
    (unless ``stats`` is given), once for the distinct values.
    """
    by = list(by)
    names = list(measures)
    # adding 0.0 makes -0.0 and 0.0 one value
    rows = df.na.drop(subset=[*by, value]).withColumn(value, plain(value))
    stats = stats or value_stats(rows, [value], buckets)[value]
    distinct = rows.groupBy(*by, value).agg(*[F.sum(m).alias(n) for n, m in measures.items()])
    if stats.small:
        distinct = distinct.withColumn(BUCKET, F.lit(0))
    else:
        distinct = _bucketed(distinct, value, stats.bounds)
    arrange = F.desc if descending else F.asc
    earlier = Window.partitionBy(*by).orderBy(arrange(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*by)
    if stats.small:
        upto = everything.orderBy(arrange(value)).rowsBetween(Window.unboundedPreceding, 0)
        return distinct.select(
            *by, value, BUCKET, *names, *[F.sum(n).over(upto).alias(f"cum_{n}") for n in names],
            *[F.sum(n).over(everything).alias(f"all_{n}") for n in names],
        )
    # one row per bucket and group
    offsets = (
        distinct.groupBy(*by, BUCKET).agg(*[F.sum(n).alias(n) for n in names])
        .select(
            *[F.col(c).alias(f"__{c}") for c in [*by, BUCKET]],
            *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"__{n}") for n in names],
            *[F.sum(n).over(everything).alias(f"all_{n}") for n in names],
        )
    )
    if not by:
        offsets = F.broadcast(offsets)  # one row per bucket
    same = [F.col(c) == F.col(f"__{c}") for c in [*by, BUCKET]]
    within = Window.partitionBy(*by, BUCKET).orderBy(arrange(value)).rowsBetween(Window.unboundedPreceding, 0)
    on = same[0]
    for cond in same[1:]:
        on = on & cond
    return distinct.join(offsets, on).select(
        *by, value, BUCKET, *names,
        *[(F.col(f"__{n}") + F.sum(n).over(within)).alias(f"cum_{n}") for n in names],
        *[f"all_{n}" for n in names],
    )


def mid_ranks(
    df: DataFrame, value: str, by: Sequence[str] = (), buckets: int | None = None, stats: ValueStats | None = None
) -> DataFrame:
    """Distinct values with their count ``n``, tie-averaged rank ``mid_rank`` and group size ``all_n``."""
    totals = running_totals(df, value, {"n": F.lit(1)}, by, buckets=buckets, stats=stats)
    return totals.select(
        *by, value, "n", (F.col("cum_n") - (F.col("n") - 1) / 2.0).alias("mid_rank"), "all_n"
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    by: Sequence[str] = (),
    extra: dict[str, Column] | None = None,
    buckets: int | None = None,
    stats: ValueStats | None = None,
) -> DataFrame:
    """Exact interpolated quantiles per group, one column per entry of ``probs``,
    together with the ordinary aggregates in ``extra``.

    Equals ``percentile``, which is used, in the same pass as ``extra``, for
    columns measured to be small; a larger group's distinct values are never
    gathered in one task.
    """
    by, extra = list(by), extra or {}
    others = [e.alias(name) for name, e in extra.items()]
    rows = df.na.drop(subset=by) if by else df
    stats = stats or value_stats(rows.withColumn(value, plain(value)), [value], buckets)[value]
    if stats.small:
        cuts = F.percentile(plain(value), [float(p) for p in probs.values()]).alias("__q")
        return rows.groupBy(*by).agg(*others, cuts).select(
            *by, *extra, *[F.col("__q")[i].alias(name) for i, name in enumerate(probs)]
        )
    totals = running_totals(rows, value, {"n": F.lit(1)}, by, stats=stats)
    last = F.col("all_n") - 1
    first, picks, out = F.col("cum_n") - F.col("n"), [], []
    for name, p in probs.items():
        at = last * F.lit(float(p))
        for side, place in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            inside = (first <= place) & (place < F.col("cum_n"))
            picks.append(F.max(F.when(inside, F.col(value))).alias(f"__{side}_{name}"))
        picks.append(F.max(at - F.floor(at)).alias(f"__part_{name}"))
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        out.append((lo + (hi - lo) * F.col(f"__part_{name}")).alias(name))
    cuts = totals.groupBy(*by).agg(*picks).select(*by, *out)
    if by:  # the list of groups is that of the rows: a group may have no values
        return rows.groupBy(*by).agg(*(others or [F.count(F.lit(1)).alias("__n")])).join(cuts, by, "left").select(*by, *extra, *probs)
    if not extra:
        return cuts
    found = cuts.select(F.struct(*probs)).scalar()
    return rows.agg(*others).withColumns({name: found.getField(name) for name in probs})


def exact_medians(df: DataFrame, columns: Sequence[str], buckets: int | None = None) -> DataFrame:
    """One row holding the exact median of each column, under the column's own name."""
    columns = list(columns)
    df = df.select(*[plain(c).alias(c) for c in columns])
    stats = value_stats(df, columns, buckets)
    if all(v.small for v in stats.values()):
        return df.agg(*[F.median(F.col(c).cast("double")).alias(c) for c in columns])
    found = select_quantiles(df, {c: [0.5] for c in columns})
    row = [found[c][0] for c in columns]
    return df.sparkSession.createDataFrame([row], ", ".join(f"`{c}` double" for c in columns))


@dataclass
class _Bracket:
    """Where the value at position ``at`` (0 first) of a column's order is: above ``lo`` and below ``hi``, with
    ``below`` values up to ``lo`` and ``inside`` between the two."""

    column: str
    at: int
    lo: float = float("-inf")
    hi: float = float("inf")
    below: int = 0
    inside: int = 0
    value: float | None = None

    def holds(self) -> Column:
        c = F.col(self.column)
        # an infinite value is inside an unlimited bracket
        above = (c > self.lo) if self.lo != float("-inf") else F.lit(True)
        return above & ((c < self.hi) if self.hi != float("inf") else F.lit(True)) & c.isNotNull()


def select_quantiles(
    df: DataFrame, probs: dict[str, Sequence[float]], points: int = 2_000, gather: int | None = None
) -> dict[str, list[float | None]]:
    """Exact interpolated quantiles of numeric columns by narrowing brackets; nulls (and NaN) are left out.

    A pass counts and sketches, the next counts exactly below, at and between two limits around each
    wanted position, the last sorts what is left between them. While more than ``gather`` values are left,
    the bracket is sketched and counted again; limits that miss their position move the bracket to the side
    it is on, so the sketch never decides a result. The driver holds a few numbers a quantile, and no task
    more than ``gather`` values, whatever the number of distinct values. A bracket keeps about a
    ``points / 4``-th of the values, so three passes serve up to ``gather * points / 4`` rows.
    """
    gather = GATHER_VALUES if gather is None else gather
    rows = df.select(*[plain(c).alias(c) for c in probs])
    slices = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MAX_SLICES)
    step, grid = 2.0 / points, [i / points for i in range(points + 1)]

    def sketched(wanted: list[tuple[Column, float]]) -> list[tuple[int, float, float]]:
        """Per column and share: number of values, and two limits around that share of them. Each slice of the
        input gives its own percentiles; they are weighted by its values."""
        per_slice = rows.groupBy((F.spark_partition_id() % slices).alias("__slice")).agg(*[
            F.struct(F.lit(i).alias("i"), F.percentile_approx(v, grid, 4 * points).alias("q"), F.count(v).alias("n")).alias(f"w{i}")
            for i, (v, _) in enumerate(wanted)])
        tall = per_slice.select(F.explode(F.array(*[f"w{i}" for i in range(len(wanted))])).alias("w")).select("w.i", "w.n", F.explode("w.q").alias("v"))
        row = tall.agg(*[f for i, (_, p) in enumerate(wanted) for f in (
            F.sum(F.when(F.col("i") == i, F.col("n"))).alias(f"n{i}"),
            F.percentile(F.when(F.col("i") == i, F.col("v")), [max(0.0, p - step), min(1.0, p + step)], F.when(F.col("i") == i, F.col("n")).otherwise(0)).alias(f"q{i}"))
        ]).first()
        return [((row[f"n{i}"] or 0) // (points + 1), *(row[f"q{i}"] or (0.0, 0.0))) for i in range(len(wanted))]

    columns = list(probs)
    first = sketched([(F.col(c), p) for c in columns for p in probs[c]])
    asked = [(c, p) for c in columns for p in probs[c]]
    total = {c: n for (c, _), (n, _, _) in zip(asked, first)}
    open_: list[_Bracket] = []
    limits: list[tuple[float, float]] = []
    brackets: dict[tuple[str, int], _Bracket] = {}
    for (c, p), (_, *found) in zip(asked, first):
        last = (total[c] - 1) * p
        for at in {int(last // 1), int(-(-last // 1))} if total[c] else ():
            if (c, at) not in brackets:
                brackets[c, at] = _Bracket(c, at, inside=total[c])
                open_.append(brackets[c, at])
                limits.append(tuple(found))
    while open_:
        small = [b for b in open_ if b.inside <= gather]
        if small:
            got = rows.agg(*[F.sort_array(F.collect_list(F.when(b.holds(), F.col(b.column))))[b.at - b.below].alias(f"v{i}") for i, b in enumerate(small)]).first()
            for i, b in enumerate(small):
                b.value = got[f"v{i}"]
        pairs = [(b, q) for b, q in zip(open_, limits) if b.value is None]  # with the percentiles as limits: values of the bracket, or between two
        if not pairs:
            break
        counts = rows.agg(*[
            F.count_if(b.holds() & test).alias(f"{name}{i}")
            for i, (b, (lo, hi)) in enumerate(pairs)
            for name, test in (("a", F.col(b.column) < lo), ("b", F.col(b.column) == lo), ("c", (F.col(b.column) > lo) & (F.col(b.column) < hi)),
                               ("d", (F.col(b.column) == hi) & (F.lit(lo) != hi)))]).first()
        for i, (b, (lo, hi)) in enumerate(pairs):
            below, at_lo, between, at_hi = (counts[f"{k}{i}"] for k in "abcd")
            place = b.at - b.below
            if place < below:
                b.hi, b.inside = lo, below
            elif place < below + at_lo:
                b.value = lo
            elif place < below + at_lo + between:
                b.lo, b.hi, b.below, b.inside = lo, hi, b.below + below + at_lo, between
            elif place < below + at_lo + between + at_hi:
                b.value = hi
            else:
                up_to = below + at_lo + between + at_hi
                b.lo, b.below, b.inside = hi, b.below + up_to, b.inside - up_to
        open_ = [b for b, _ in pairs if b.value is None]
        large = [b for b in open_ if b.inside > gather]
        again = sketched([(F.when(b.holds(), F.col(b.column)), (b.at - b.below) / max(1, b.inside - 1)) for b in large]) if large else []
        fresh = {id(b): (lo, hi) for b, (_, lo, hi) in zip(large, again)}
        limits = [fresh.get(id(b), (0.0, 0.0)) for b in open_]
    out = {}
    for c in columns:
        out[c] = []
        for p in probs[c]:
            last = (total[c] - 1) * p
            if not total[c]:
                out[c].append(None)
                continue
            lo, hi = brackets[c, int(last // 1)].value, brackets[c, int(-(-last // 1))].value
            out[c].append(lo if lo == hi else lo + (hi - lo) * (last - last // 1))
    return out


def pearson_of(df: DataFrame, x: Column, y: Column, weight: Column) -> DataFrame:
    """Weighted Pearson correlation in one aggregate row named ``rho``."""
    sums = df.agg(
        F.sum(weight * x * y).alias("xy"), F.sum(weight * x * x).alias("xx"),
        F.sum(weight * y * y).alias("yy"),
    )
    spread = F.sqrt(F.col("xx") * F.col("yy"))
    return sums.select((F.col("xy") / F.nullif(spread, F.lit(0.0))).alias("rho"))
