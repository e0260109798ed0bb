"""Ordered windows over groups of any size.

A plain ``Window.partitionBy(key)`` puts a whole group into one task. That is
right for ordinary loans (tens of rows) but not for a key that holds a large
part of the table. ``ordered_groups`` counts rows per key first (a partial
aggregate), leaves ordinary groups alone, and cuts oversized ones into runs of
at most ``span`` rows. Each run also receives copies of its neighbours' edge
rows, so lags and leads up to the declared reach stay exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.session import ensure_checkpoint_dir

MAX_GROUP_ROWS = 1_000_000
MAX_HOT_KEYS = 1_000  # up to so many are named in the plan; more are joined as a table
REMEMBERED = 256

_RUN, _COPY, _POS, _MID, _PART, _HOT = "__run", "__copy", "__pos", "__mid", "__part", "__hot"
_ROW_BITS = 33  # layout of monotonically_increasing_id: partition above, row below

_known_hot: dict[tuple, list] = {}


def hot_keys(df: DataFrame, key: str, max_rows: int = MAX_GROUP_ROWS) -> list:
    """Keys with more than ``max_rows`` rows; at most ``MAX_HOT_KEYS + 1`` of them.

    The answer only selects an execution path, never a result, so the latest are
    remembered for the same plan over input of the same size.
    """
    size = str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    memo = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), size, key, max_rows)
    if memo not in _known_hot:
        while len(_known_hot) >= REMEMBERED:
            del _known_hot[next(iter(_known_hot))]
        rows = (
            df.groupBy(key).count().where(F.col("count") > max_rows)
            .select(key).limit(MAX_HOT_KEYS + 1).collect()
        )
        _known_hot[memo] = [r[0] for r in rows]
    return _known_hot[memo]


def _with_hot(df: DataFrame, key: str, keys: list, max_rows: int) -> DataFrame:
    """Adds whether the row's key is hot. A table of hot keys has at most rows / ``max_rows`` rows, so it
    is broadcast whatever the input."""
    if len(keys) > MAX_HOT_KEYS:
        many = df.groupBy(key).count().where(F.col("count") > max_rows).select(F.col(key).alias("__key"), F.lit(True).alias(_HOT))
        marked = df.join(F.broadcast(many), F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")
        return marked.withColumn(_HOT, F.coalesce(_HOT, F.lit(False)))
    named = [k for k in keys if k is not None]
    hot = F.coalesce(F.col(key).isin(named), F.lit(False)) if named else F.lit(False)
    return df.withColumn(_HOT, hot | F.col(key).isNull() if None in keys else hot)


def with_positions(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Dense position 0..N-1 of every row in the given total order.

    Range partitions split even one key's rows. The sorted rows are written
    to the checkpoint folder once, so positions cannot change when a task is
    recomputed; only one start offset per partition is broadcast.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = (
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn(_MID, F.monotonically_increasing_id())
        .checkpoint()
        .withColumn(_PART, F.shiftright(_MID, _ROW_BITS))
    )
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy(_PART).count()
        .select(_PART, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    )
    row = F.col(_MID).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        stored.join(F.broadcast(starts), _PART)  # one row per range partition
        .withColumn(_POS, F.col("__start") + row)
        .drop(_PART, _MID, "__start")
    )


@dataclass(frozen=True)
class OrderedGroups:
    """A frame plus the window that walks each of its groups in order."""

    frame: DataFrame
    partition_by: tuple[str, ...]
    order_by: tuple

    def window(self):
        return Window.partitionBy(*self.partition_by).orderBy(*self.order_by)

    def finish(self, df: DataFrame) -> DataFrame:
        """Remove neighbour copies and helper columns after window columns are computed."""
        if _COPY not in df.columns:
            return df
        return df.where(~F.col(_COPY)).drop(_RUN, _COPY)


def ordered_groups(
    df: DataFrame,
    key: str,
    order: Sequence[str | Column],
    back: int = 0,
    ahead: int = 0,
    max_rows: int | None = None,
) -> OrderedGroups:
    """Prepare ``df`` for row lags up to ``back`` and leads up to ``ahead`` per ``key``."""
    span = MAX_GROUP_ROWS if max_rows is None else max_rows
    keys = hot_keys(df, key, span)
    if not keys:
        return OrderedGroups(df, (key,), tuple(order))
    if span < back + ahead:
        raise ValueError("a run must be longer than the rows it shares with its neighbours")
    marked = _with_hot(df, key, keys, span)
    run, place = F.floor(F.col(_POS) / span), F.col(_POS) % span
    homes = F.array(
        run,
        F.when(place < ahead, run - 1),
        F.when(place >= span - back, run + 1),
    )
    split = (
        with_positions(marked.where(_HOT).drop(_HOT), [key, *order])
        .withColumn("__home", run)
        .withColumn(_RUN, F.explode(F.array_compact(homes)))
        .withColumn(_COPY, F.col(_RUN) != F.col("__home"))
        .drop("__home", _POS)
    )
    whole = marked.where(~F.col(_HOT)).drop(_HOT).withColumn(_RUN, F.lit(-1).cast("bigint")).withColumn(_COPY, F.lit(False))
    return OrderedGroups(whole.unionByName(split), (key, _RUN), tuple(order))


def number_within(
    df: DataFrame, key: str, order: Sequence[str | Column], out: str, max_rows: int | None = None
) -> DataFrame:
    """Row number 1..n of each row within its key, for keys of any size."""
    span = MAX_GROUP_ROWS if max_rows is None else max_rows
    window = Window.partitionBy(key).orderBy(*order)
    keys = hot_keys(df, key, span)
    if not keys:
        return df.withColumn(out, F.row_number().over(window))
    marked = _with_hot(df, key, keys, span)
    placed = with_positions(marked.where(_HOT).drop(_HOT), [key, *order])
    # one row per hot key
    firsts = F.broadcast(placed.groupBy(F.col(key).alias("__key")).agg(F.min(_POS).alias("__first")))
    split = (
        placed.join(firsts, F.col(key).eqNullSafe(F.col("__key")))
        .withColumn(out, (F.col(_POS) - F.col("__first") + 1).cast("int"))
        .drop("__key", "__first", _POS)
    )
    rest = marked.where(~F.col(_HOT)).drop(_HOT)
    return rest.withColumn(out, F.row_number().over(window)).unionByName(split)


def latest_per(df: DataFrame, key: str | Sequence[str], order: Sequence[str], first: bool = False) -> DataFrame:
    """Last non-null value of every column per key, in the given order.

    An aggregate with partial combine rather than a window, so a large group
    is reduced before it is shuffled.
    """
    keys = [key] if isinstance(key, str) else list(key)
    pick = F.min_by if first else F.max_by
    # a plain column keeps the hash aggregate; a struct would need a sort
    rank = F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])
    values = [
        pick(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c)
        for c in df.columns if c not in keys
    ]
    return df.groupBy(*keys).agg(*values).select(*df.columns)
