"""Joins between the lending tables, coverage checks and fixed-domain alignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.functions import exprs as E
from loanloom.operators.ordered import latest_per

MASTER_OUTCOMES = [
    "final_loan_status", "default_flag", "max_dpd", "customer_ltv",
    "risk_adjusted_return", "is_profitable", "loss_given_default",
]


def fixed_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A lookup table of constants from ``schema``, always small enough to broadcast."""
    if len(rows) > 1_000:
        raise ValueError("fixed tables are broadcast and must stay small")
    return F.broadcast(spark.createDataFrame(list(rows), ddl))


def active_loans(master: DataFrame) -> DataFrame:
    return master.where(F.col("cooling_off_exit") == 0)


def originations(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """Loans with their customer's attributes; size-based broadcast is left to the optimizer."""
    return loans.join(customers, "customer_id", "left")


def build_outcomes(loans: DataFrame, rollup: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    """Loan outcomes from the repayment rollup.

    Cooling-off loans get a zero row; other loans without repayments are left
    out. ``rates`` gives ``recovery_rate`` per loan and may be omitted when
    ``loans`` already has the column.
    """
    base = loans.join(rollup, "loan_id", "left")
    if rates is not None:
        base = base.join(rates, "loan_id", "left")
    cooled = F.col("cooling_off_exit") == 1
    loss = E.lgd("ticket_size", "total_paid", "recovery_rate", "is_defaulted")
    terms = ("ticket_size", "apr", "tenure_months", "processing_fee", "cost_of_acquisition")
    ltv = E.customer_ltv(*terms, loss)

    def unless_cooled(value, zero):
        return F.when(cooled, zero).otherwise(value)

    return base.where(cooled | F.col("installments").isNotNull()).select(
        "loan_id", "customer_id",
        unless_cooled(F.col("final_status"), F.lit("Cooling-Off-Exit")).alias("final_loan_status"),
        unless_cooled(F.col("is_defaulted"), F.lit(0)).alias("default_flag"),
        unless_cooled(F.col("max_dpd"), F.lit(0)).alias("max_dpd"),
        unless_cooled(F.round("total_paid", 2), F.lit(0.0)).alias("total_amount_paid"),
        unless_cooled(E.recovery("ticket_size", "total_paid", "recovery_rate", "is_defaulted"), F.lit(0))
        .alias("recovery_amount"),
        unless_cooled(F.round(loss, 2), F.lit(0.0)).alias("loss_given_default"),
        unless_cooled(ltv, F.lit(0.0)).alias("customer_ltv"),
        unless_cooled(E.risk_adjusted_return(*terms, "is_defaulted"), F.lit(0.0)).alias("risk_adjusted_return"),
        unless_cooled(E.is_profitable(ltv), F.lit(0)).alias("is_profitable"),
    )


def build_master(loans: DataFrame, customers: DataFrame, outcomes: DataFrame, wide: bool = False) -> DataFrame:
    """Loans with customer and outcome columns.

    ``wide`` joins on loan and customer and keeps every outcome column;
    otherwise seven outcome columns are joined on the loan alone.
    """
    enriched = originations(loans, customers)
    if wide:
        return enriched.join(outcomes, ["loan_id", "customer_id"], "left")
    return enriched.join(outcomes.select("loan_id", *MASTER_OUTCOMES), "loan_id", "left")


# --- coverage of one table by another ---------------------------------------

def matched_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct left keys with ``matched`` = 1 where the right side has them."""
    keys = list(keys)
    known = right.select(*keys).distinct().withColumn("__hit", F.lit(1))
    return (
        left.select(*keys).distinct().join(known, keys, "left")
        .select(*keys, F.coalesce("__hit", F.lit(0)).alias("matched"))
    )


def match_rate(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Exact share of distinct left keys found on the right (no key sample)."""
    return matched_keys(left, right, keys).agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum("matched"), F.lit(0)).alias("n_matched"),
        (F.avg("matched") * 100.0).alias("match_rate_pct"),
    )


def unmatched_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    keys = list(keys)
    return left.select(*keys).distinct().join(right.select(*keys), keys, "left_anti")


def attach_signals(
    obs: DataFrame, signals: DataFrame, mode: str = "auto", min_match: float = 0.5,
    bare: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Join signal features to observations.

    ``month`` matches the instalment number, ``latest`` gives every row the
    loan's last known signal, ``auto`` measures the key overlap first and uses
    ``latest`` below ``min_match``. ``bare`` gives the two key lists (loan_id,
    installment_no) where they can be had without computing the features.
    """
    monthly = signals.withColumnRenamed("month", "installment_no")
    keys = ["loan_id", "installment_no"]
    if mode == "auto":
        rate = match_rate(*(bare or (obs, monthly)), keys).first()["match_rate_pct"]
        mode = "month" if rate is None or rate >= 100.0 * min_match else "latest"
    if mode == "month":
        return obs.join(monthly, keys, "left")
    if mode != "latest":
        raise ValueError(f"unknown mode {mode!r}")
    last = latest_per(signals, "loan_id", ["month"]).drop("month")
    return obs.join(last, "loan_id", "left")


def attach_origination(obs: DataFrame, orig: DataFrame) -> DataFrame:
    return obs.join(orig, "loan_id", "left")


# --- fixed domains ----------------------------------------------------------

def reindex_to(df: DataFrame, key: str, domain: Sequence[str], drop: bool = False) -> DataFrame:
    """Rows of a small aggregate in domain order.

    Missing members appear with nulls, or are left out with ``drop``; values
    outside the domain disappear either way.
    """
    order = df.sparkSession.createDataFrame(list(enumerate(domain)), f"__ord int, {key} string")
    kept = df.na.drop().join(order, key) if drop else order.join(df, key, "left")
    return kept.orderBy("__ord").select(*df.columns)
