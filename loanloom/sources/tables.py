"""Typed reading and writing of the lending tables and result frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom import schema as S
from loanloom.functions.exprs import tenure_band, ticket_band, to_month, to_quarter


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read with a fixed schema (never inferred); NaN becomes null."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        df = reader.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    else:
        df = reader.format(fmt).load(path)
    return nan_to_null(df)


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` with its types; columns that ``df`` lacks are null."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: str | None = None
) -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(path)


def write_repayments(rep: DataFrame, path: str) -> None:
    """Repayments laid out by due month, so monthly reads prune to their folders."""
    monthly = rep.withColumn("due_month", to_month("due_date"))
    # adaptive rebalancing: few files per month, and a month with most of the rows is split
    write_table(monthly.hint("rebalance", "due_month"), path, partition_by="due_month")


#: Co-partitioned reads: a join on the bucket column and more keys may use the buckets as they are.
BUCKETED_READS = {"spark.sql.sources.bucketing.enabled": "true", "spark.sql.requireAllClusterKeysForCoPartition": "false",
                  "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}


def write_bucketed(df: DataFrame, table: str, path: str, key: str, order: Sequence[str] = (), buckets: int = 200) -> DataFrame:
    """Store ``df`` in ``path`` as catalog table ``table``, bucketed by ``key`` and sorted within buckets, and read it back.

    Rows are dealt to their buckets first, so a bucket is one file. Tables with as many buckets of the same key
    join on it, and per-key windows run over them, without a shuffle (``BUCKETED_READS`` is set for the session).
    """
    spark = df.sparkSession
    for name, value in BUCKETED_READS.items():
        spark.conf.set(name, value)
    dealt = df.repartition(buckets, key).sortWithinPartitions(key, *order)
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, key)
    writer.sortBy(key, *order).saveAsTable(table)
    return spark.table(table)


def lending_layout(
    repayments: DataFrame, signals: DataFrame, loans: DataFrame, folder: str, prefix: str = "lending", buckets: int = 200
) -> dict[str, DataFrame]:
    """Repayments, signals and loans bucketed alike by ``loan_id``, in order of instalment and month: beside the
    layout by month, the one for per-loan windows and panel joins."""
    plan = {"repayments": (repayments, ["installment_no"]), "signals": (signals, ["month"]), "loans": (loans, [])}
    return {name: write_bucketed(df, f"{prefix}_{name}", f"{folder}/{name}", "loan_id", order, buckets) for name, (df, order) in plan.items()}


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of CSV files with a header line and a fixed schema.

    A line is rejected if it has too few or too many fields, a value that its type cannot hold, or a quote
    that is never closed. Rejects keep the whole line (``record``) with the ``reason``: ``quote``, ``columns`` for a
    wrong number of fields, or the names of the columns that did not parse. Good and rejected rows are all
    lines but headers and empty lines. Values within quotes hold no line breaks. The lines are scanned as
    text, so each of the two results is one pass without a shuffle.
    """
    names = [f.name for f in schema]
    lines = spark.read.text(path).where((F.length(F.trim("value")) > 0) & (F.col("value") != ",".join(names)))
    raw = "__record"
    typed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    texts = ", ".join(f"`{n}` string" for n in names)
    options = {"mode": "PERMISSIVE", "dateFormat": "yyyy-MM-dd", "columnNameOfCorruptRecord": raw}
    parsed = lines.select(
        "value", F.from_csv("value", f"{typed}, `{raw}` string", options).alias("t"),
        (F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1).alias("open"))
    broken = F.col("open") | F.col(f"t.{raw}").isNotNull()
    good = parsed.where(~broken).select(*[F.col(f"t.`{n}`").alias(n) for n in names])
    # a rejected line, field by field, tells what is wrong with it
    fields = F.from_csv("value", texts, {"mode": "PERMISSIVE"})
    commas = F.length(F.regexp_replace(F.regexp_replace("value", '"[^"]*"', ""), "[^,]", ""))
    bad = F.concat_ws(",", *[F.when(_unparsed(F.col(f"f.`{f.name}`"), f.dataType), F.lit(f.name)) for f in schema])
    reason = F.when(F.col("open"), "quote").when(commas != len(names) - 1, "columns").otherwise(bad)
    rejects = parsed.where(broken).withColumn("f", fields).select(F.col("value").alias("record"), reason.alias("reason"))
    return nan_to_null(good), rejects


def _unparsed(text: Column, kind: T.DataType) -> Column:
    """Whether a field holds something that its type cannot."""
    value = F.try_to_date(text, "yyyy-MM-dd") if isinstance(kind, T.DateType) else text.try_cast(kind)
    return text.isNotNull() & value.isNull()


def write_artifacts(frames: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    for name, df in frames.items():
        write_table(df, f"{folder}/{name}", fmt)


def limit_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows in a stated order (file order means nothing in Spark)."""
    return df.orderBy(*order).limit(n)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").json(path)


def metrics_frame(
    scalars: DataFrame, summary: DataFrame, categories: DataFrame | None = None, amber: float = 0.20, red: float = 0.45
) -> DataFrame:
    """One nested row: scalar metrics, the scorecard list, the bucket limits that made it and, for a model
    with attributions, a category-to-share map.

    ``summary`` has one row per risk bucket and ``categories`` one per feature
    group, so the collected lists are a few entries long.
    """
    scorecard = summary.agg(F.sort_array(F.collect_list(F.struct(
        *[F.col(c) for c in summary.columns]
    ))).alias("v"))
    limits = F.struct(
        F.lit(amber).alias("GREEN_max"), F.lit(red).alias("AMBER_max"), F.lit(red).alias("RED_min")
    )
    out = scalars.select("*", scorecard.scalar().alias("scorecard"), limits.alias("bucket_thresholds"))
    if categories is None:
        return out
    shares = categories.agg(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct("category", "importance")
    ))).alias("v"))
    return out.withColumn("category_importance", shares.scalar())


@dataclass(frozen=True)
class Portfolio:
    """The tables one analysis session shares, with ``master`` and ``active`` kept in memory or on disk."""

    customers: DataFrame
    loans: DataFrame
    repayments: DataFrame
    signals: DataFrame
    outcomes: DataFrame
    master: DataFrame
    active: DataFrame

    def release(self) -> None:
        self.active.unpersist()


def assemble(customers, loans, repayments, signals, outcomes, keep: bool = True) -> Portfolio:
    from loanloom.operators.joins import active_loans, build_master

    loans = loans.withColumns({
        "cohort_quarter": to_quarter("origination_date"), "cohort_month": to_month("origination_date"),
    })
    repayments = repayments.withColumns({
        "due_month": to_month("due_date"), "cal_month": F.month("due_date"),
    })
    master = build_master(loans, customers, outcomes, wide=True)
    active = active_loans(master).withColumns({
        "ticket_band": ticket_band(), "tenure_band": tenure_band(),
    })
    if keep:
        active = active.persist(StorageLevel.MEMORY_AND_DISK)
    return Portfolio(customers, loans, repayments, signals, outcomes, master, active)


def files_stamp(spark: SparkSession, folder: str, pattern: str = "*") -> tuple:
    """Names the current files of a folder: their paths, sizes and times, as one aggregated row."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    row = files.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("path", "modificationTime", "length")).alias("h")).first()
    return spark.sparkContext.applicationId, folder, row.n, row.h


_shared: dict[tuple, tuple[tuple, Portfolio]] = {}


def shared_portfolio(spark: SparkSession, folder: str, fmt: str = "parquet") -> Portfolio:
    """The portfolio of a folder, built and persisted once for all callers of a session.

    When the folder's files change, the kept frames are released and built anew.
    """
    stamp = files_stamp(spark, folder, f"*.{fmt}")
    place = (spark.sparkContext.applicationId, folder, fmt)
    if place in _shared and _shared[place][0] != stamp:
        _shared.pop(place)[1].release()
    if place not in _shared:
        _shared[place] = (stamp, portfolio(spark, folder, fmt))
    return _shared[place][1]


def release_portfolio(spark: SparkSession, folder: str, fmt: str = "parquet") -> bool:
    """Give up the shared portfolio of a folder; false if there is none."""
    kept = _shared.pop((spark.sparkContext.applicationId, folder, fmt), None)
    if kept:
        kept[1].release()
    return kept is not None


def portfolio(spark: SparkSession, folder: str, fmt: str = "parquet", keep: bool = True) -> Portfolio:
    """Load the five tables from ``folder/<table>`` and build the shared frames."""
    t = {name: read_table(spark, f"{folder}/{name}", schema, fmt) for name, schema in S.TABLES.items()}
    return assemble(t["customers"], t["loans"], t["repayments"], t["signals"], t["outcomes"], keep)
