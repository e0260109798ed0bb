"""Portfolio aggregates. Every share and rate is in percent unless named otherwise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions import exprs as E
from loanloom.operators.ranking import exact_quantiles


def _on_time() -> Column:
    return (F.col("payment_status") == "Paid-On-Time").cast("int")


def _missed() -> Column:
    return (F.col("payment_status") == "Missed").cast("int")


def _rate(column: str) -> Column:
    return F.avg(column) * 100.0


def count_rows() -> Column:
    return F.count(F.lit(1))


def over_groups(aggregate: Column) -> Column:
    """An aggregate over all rows of an already aggregated frame: a window over one row per group,
    so that what lies below is planned and run once."""
    return aggregate.over(Window.partitionBy())


def share_of_total(df: DataFrame, column: str, out: str, few: bool = False) -> DataFrame:
    """Adds ``column`` as percent of its total over the (already aggregated) frame.

    ``few`` says that the groups are known to be few: one window then. Else the total is an aggregate of its
    own, which partial sums feed, and no task sees more than its share of the groups.
    """
    total = over_groups(F.sum(column)) if few else df.agg(F.sum(column)).scalar()
    return df.withColumn(out, E.pct(column, total))


def known(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose group keys are all present."""
    return df.na.drop(subset=list(keys))


# --- headline ---------------------------------------------------------------

def portfolio_kpis(active: DataFrame) -> DataFrame:
    defaulted = F.col("default_flag") == 1
    return active.agg(
        count_rows().alias("n_loans"),
        _rate("default_flag").alias("default_rate_pct"),
        F.avg("customer_ltv").alias("avg_ltv"),
        (F.coalesce(F.sum(F.when(defaulted, F.col("ticket_size"))), F.lit(0.0)) / 1e7).alias("npa_crore"),
        _rate("is_profitable").alias("profitable_pct"),
    )


def collection_efficiency(rep: DataFrame) -> DataFrame:
    """Plain mean of the monthly paid/due ratios, months not weighted by size."""
    monthly = known(rep, "due_date").groupBy(E.to_month("due_date").alias("due_month")).agg(
        F.sum("amount_paid").alias("paid"), F.sum("emi_due").alias("due")
    )
    return monthly.agg(F.avg(E.pct("paid", "due")).alias("collection_efficiency_pct"))


# --- group statistics -------------------------------------------------------

SEGMENT_MEASURES = {
    "n_loans": lambda: count_rows(),
    "default_rate_pct": lambda: _rate("default_flag"),
    "avg_income": lambda: F.avg("monthly_income"),
    "avg_bureau": lambda: F.avg("bureau_score"),
    "profitable_pct": lambda: _rate("is_profitable"),
    "avg_ltv": lambda: F.avg("customer_ltv"),
    "avg_rar_pct": lambda: _rate("risk_adjusted_return"),
    "avg_cac": lambda: F.avg("cost_of_acquisition"),
    "avg_ticket": lambda: F.avg("ticket_size"),
    "avg_apr_pct": lambda: _rate("apr"),
    "avg_tenure": lambda: F.avg("tenure_months"),
}


def measure_columns(measures: Sequence[str]) -> dict[str, Column]:
    return {m: SEGMENT_MEASURES[m]() for m in measures}


def segment_stats(
    active: DataFrame,
    by: str = "risk_tier",
    measures: Sequence[str] = (
        "n_loans", "default_rate_pct", "avg_income", "avg_bureau", "profitable_pct",
        "avg_ltv", "avg_rar_pct",
    ),
) -> DataFrame:
    return known(active, by).groupBy(by).agg(*[c.alias(m) for m, c in measure_columns(measures).items()])


def channel_stats(active: DataFrame) -> DataFrame:
    stats = segment_stats(active, "acquisition_channel", (
        "n_loans", "default_rate_pct", "avg_cac", "avg_ltv", "profitable_pct", "avg_rar_pct",
    ))
    stats = stats.withColumn("ltv_cac", E.ratio("avg_ltv", "avg_cac"))
    return share_of_total(stats, "n_loans", "volume_pct", few=True)


def exit_rate(master: DataFrame, by: str = "acquisition_channel") -> DataFrame:
    """Cooling-off exits over all loans, not only active ones."""
    return known(master, by).groupBy(by).agg(
        count_rows().alias("n_all"), F.sum("cooling_off_exit").alias("exits"),
        _rate("cooling_off_exit").alias("exit_rate_pct"),
    )


def channel_stats_with_exits(active: DataFrame, master: DataFrame) -> DataFrame:
    exits = exit_rate(master).select("acquisition_channel", "exit_rate_pct")
    return channel_stats(active).join(exits, "acquisition_channel", "left")


def product_stats(active: DataFrame) -> DataFrame:
    measures = measure_columns((
        "n_loans", "default_rate_pct", "avg_ticket", "avg_apr_pct", "avg_tenure",
        "profitable_pct", "avg_ltv", "avg_rar_pct",
    ))
    stats = exact_quantiles(active, "ticket_size", {"median_ticket": 0.5}, ["product_type"], measures)
    return share_of_total(stats, "n_loans", "volume_pct", few=True)


def banded_rate(active: DataFrame, band: Column, out: str = "band") -> DataFrame:
    """Default rate and volume per band; bands without loans do not appear."""
    return known(active.withColumn(out, band), out).groupBy(out).agg(
        _rate("default_flag").alias("default_rate_pct"), count_rows().alias("n_loans")
    )


def pricing_gap(active: DataFrame, base: float = 8.0, multiple: float = 2.0) -> DataFrame:
    stats = segment_stats(active, "origination_risk_grade", (
        "default_rate_pct", "avg_apr_pct", "n_loans", "avg_ltv", "avg_rar_pct",
    ))
    fair = F.col("default_rate_pct") * multiple + base
    return stats.withColumns({"fair_apr_pct": fair, "pricing_gap_pct": F.col("avg_apr_pct") - fair})


def cross_rate(active: DataFrame, a: Column | str, b: str, a_name: str | None = None) -> DataFrame:
    name = a_name or a
    return known(active.withColumn(name, E.as_col(a)), name, b).groupBy(name, b).agg(
        _rate("default_flag").alias("default_rate_pct")
    )


def rate_pivot(
    df: DataFrame, row: str, column: str, domain: Sequence[str],
    value: str = "default_flag", fill: float | None = None, digits: int = 2,
) -> DataFrame:
    """Mean of ``value`` in percent, one column per domain member; half-even rounding."""
    table = known(df, row, column).groupBy(row).pivot(column, list(domain)).agg(F.avg(value) * 100.0)
    table = table.select(row, *[F.bround(F.col(f"`{c}`"), digits).alias(c) for c in domain])
    return table if fill is None else table.na.fill(fill, list(domain))


def share_by(df: DataFrame, column: str, normalize: bool = False) -> DataFrame:
    """Row count per value; with ``normalize`` also the share in percent, one decimal."""
    counts = known(df, column).groupBy(column).agg(count_rows().alias("n"))
    if not normalize:
        return counts
    shared = share_of_total(counts, "n", "share_pct")
    return shared.withColumn("share_pct", F.bround("share_pct", 1))


value_counts = share_by


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def top_n(df: DataFrame, by: str, n: int, tie: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.desc(by), *tie).limit(n)


def group_means(stats: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Unweighted means over groups, used as reference lines; ``columns`` maps new name to column."""
    return stats.agg(*[F.avg(source).alias(name) for name, source in columns.items()])


def ecl(active: DataFrame, by: str = "risk_tier") -> DataFrame:
    """Expected loss per loan: PD x mean defaulted ticket x loss share of the defaulted ticket."""
    defaulted = F.col("default_flag") == 1
    ticket = F.when(defaulted, F.col("ticket_size"))
    stats = known(active, by).groupBy(by).agg(
        F.avg("default_flag").alias("pd"),
        F.avg(ticket).alias("ead"),
        E.ratio(F.sum(F.when(defaulted, F.col("loss_given_default"))), F.sum(ticket)).alias("lgd_rate"),
    )
    return stats.withColumn("ecl", F.col("pd") * F.col("ead") * F.col("lgd_rate"))


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        row = df.agg(count_rows().alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        out = row if out is None else out.unionAll(row)
    return out


def class_balance(panel: DataFrame, label: str = "target") -> DataFrame:
    return share_of_total(known(panel, label).groupBy(label).agg(count_rows().alias("n")), "n", "share_pct", few=True)


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    per_column = [F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    counts = df.agg(*per_column)
    total = F.lit(0)
    for c in columns:
        total = total + F.col(c)
    return counts.withColumn("total_nulls", total)


# --- repayments -------------------------------------------------------------

def monthly_kpis(rep: DataFrame, trim: bool = True) -> DataFrame:
    months = known(rep, "due_date").groupBy(E.to_month("due_date").alias("due_month")).agg(
        F.sum("emi_due").alias("total_due"),
        F.sum("amount_paid").alias("total_paid"),
        F.sum(_on_time()).alias("on_time_cnt"),
        F.sum(_missed()).alias("missed_cnt"),
        count_rows().alias("total_cnt"),
    ).withColumns({
        "collection_eff_pct": E.pct("total_paid", "total_due"),
        "on_time_pct": E.pct("on_time_cnt", "total_cnt"),
        "missed_pct": E.pct("missed_cnt", "total_cnt"),
    })
    return trim_edges(months, "due_month") if trim else months


def trim_edges(df: DataFrame, order_col: str) -> DataFrame:
    """Without the first and the last period."""
    at = F.col(order_col)
    inside = (at > over_groups(F.min(order_col))) & (at < over_groups(F.max(order_col)))
    return df.withColumn("__inside", inside).where("__inside").drop("__inside")


def loan_rollup(rep: DataFrame) -> DataFrame:
    status = F.when(F.col("loan_status").isNotNull(), F.col("installment_no"))
    return known(rep, "loan_id").groupBy("loan_id").agg(
        F.sum("amount_paid").alias("total_paid"),
        F.count("installment_no").alias("installments"),
        F.max("dpd").alias("max_dpd"),
        F.max("is_defaulted").alias("is_defaulted"),
        F.max_by("loan_status", status).alias("final_status"),
    )


def seasonal_rate(rep: DataFrame) -> DataFrame:
    return known(rep, "due_date").groupBy(F.month("due_date").alias("cal_month")).agg(
        (F.avg(_on_time()) * 100.0).alias("on_time_pct"),
        F.max(E.month_name("due_date")).alias("month_name"),
    )
