"""Lending tables as views over a generic star schema.

``customer``, ``orders``, ``lineitem`` and ``events`` play the roles of
customers, loans, repayments and account signals. Only structure is borrowed:
the attributes the star schema lacks are arithmetic on its keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loanloom.functions import exprs as E
from loanloom.operators.aggregates import loan_rollup
from loanloom.operators.joins import build_master, build_outcomes
from loanloom.operators.ordered import number_within


_schemas: dict[tuple[str, str], StructType] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A star-schema table; its file footer is consulted for the schema once per session."""
    path = f"{sf_dir}/{name}.parquet"
    memo = (spark.sparkContext.applicationId, path)
    if memo not in _schemas:
        _schemas[memo] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[memo]).parquet(path)


def _pick(key: Column, labels: list[str], other: str) -> Column:
    """labels[key], or ``other`` past the end of the list."""
    out = F.when(key == 0, labels[0])
    for i, label in enumerate(labels[1:], start=1):
        out = out.when(key == i, label)
    return out.otherwise(other)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    raw_score = (key * 37) % 901
    score = F.when(raw_score < 300, 0).otherwise(raw_score).cast("int")
    places = read(spark, sf_dir, "nation").join(
        read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    segment = F.col("c_mktsegment")
    region = F.col("r_name")
    return (
        read(spark, sf_dir, "customer")
        .join(places, nation == F.col("n_nationkey"), "left")
        .select(
            key.alias("customer_id"),
            F.when(segment == "AUTOMOBILE", "Prime").when(segment == "BUILDING", "Near-Prime")
            .when(segment == "FURNITURE", "Subprime").when(segment == "HOUSEHOLD", "Thin-File")
            .otherwise("Unrated").alias("risk_tier"),
            F.col("n_name").alias("city"),
            F.when(region.isin("AMERICA", "EUROPE"), "Metro").when(region == "ASIA", "Tier-2")
            .otherwise("Tier-3").alias("geo_tier"),
            region.alias("state"),
            (key % 40 + 21).cast("int").alias("age"),
            _pick(key % 3, ["Male", "Female"], "Other").alias("gender"),
            _pick(nation % 9, [
                "Salaried-Govt", "Salaried-Private", "Self-Employed-Prof",
                "Self-Employed-Business", "Gig-Worker", "Daily-Wage", "Unemployed", "Student",
            ], "Freelance").alias("employment_type"),
            (nation % 10 + 1).cast("int").alias("employment_stability_score"),
            F.col("c_acctbal").alias("monthly_income"),
            score.alias("bureau_score"),
            E.is_ntc(score).alias("new_to_credit_flag"),
            (key % 2).cast("int").alias("existing_customer"),
            _pick(key % 5, ["Aadhaar-OTP", "Aadhaar-OTP", "Aadhaar-OTP", "Video-KYC"], "Physical")
            .alias("kyc_type"),
        )
    )


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, buyer, ticket = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    priority = F.col("o_orderpriority")
    base = read(spark, sf_dir, "orders").select(
        key.alias("loan_id"),
        buyer.alias("customer_id"),
        _pick(key % 7, [
            "Personal-Loan", "SME-Working-Capital", "BNPL", "Two-Wheeler-Loan",
            "Consumer-Durable", "Education-Loan",
        ], "Gold-Loan").alias("product_type"),
        ticket.alias("ticket_size"),
        ((key * 7) % 60 + 1).cast("int").alias("tenure_months"),
        F.when(key % 50 == 0, 0.0).otherwise((buyer % 25 + 8) / F.lit(100.0)).alias("apr"),
        F.floor(ticket * (key % 6 + 1) / F.lit(200.0)).cast("int").alias("processing_fee"),
        F.to_date("o_orderdate").alias("origination_date"),
        F.when(priority == "1-URGENT", "A+").when(priority == "2-HIGH", "B")
        .when(priority == "3-MEDIUM", "B-").when(priority == "4-NOT SPECIFIED", "C")
        .otherwise("D").alias("origination_risk_grade"),
        _pick(buyer % 8, [
            "Organic-App", "Referral", "Paid-Digital", "DSA-Agent", "Bank-Partnership",
            "Corporate-Tie-Up", "NBFC-Embedded",
        ], "Walk-In").alias("acquisition_channel"),
        (key % 19 * 100 + 400).cast("int").alias("cost_of_acquisition"),
        (key % 5 + F.when(key % 5 == 4, 1).otherwise(0)).cast("int").alias("approval_turnaround_days"),
        (F.col("o_orderstatus") == "P").cast("int").alias("cooling_off_exit"),
    )
    return base.withColumn("emi_amount", E.emi("ticket_size", "apr", "tenure_months", "product_type"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return number_within(
        read(spark, sf_dir, "lineitem"), "l_orderkey",
        ["l_shipdate", "l_linenumber", "l_partkey"], "installment_no",
    )


def repayments(spark: SparkSession, sf_dir: str) -> DataFrame:
    line_flag, state = F.col("l_returnflag"), F.col("l_linestatus")
    dpd = F.round(F.col("l_discount") * 1000).cast("int")
    cents_kept = F.lit(100) - F.round(F.col("l_discount") * 100)
    due = F.to_date("l_shipdate")
    return _lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("loan_id"),
        "installment_no",
        due.alias("due_date"),
        E.payment_date(due, dpd).alias("payment_date"),
        F.col("l_extendedprice").alias("emi_due"),
        (F.floor(F.col("l_extendedprice") * cents_kept) / F.lit(100.0)).alias("amount_paid"),
        F.when(line_flag == "A", "Paid-On-Time")
        .when((line_flag == "N") & (state == "O"), "Late-1-30")
        .when(line_flag == "N", "Late-31-60")
        .when(state == "O", "Partial").otherwise("Missed").alias("payment_status"),
        dpd.alias("dpd"),
        E.dpd_bucket(dpd).alias("dpd_bucket"),
        E.sma_status(dpd, (dpd > 90) & (state == "F")).alias("loan_status"),
        E.flag((dpd > 90) & (state == "F")).alias("is_defaulted"),
    )


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per loan and day index: daily account activity of the loan's customer."""
    value, kind = F.col("value"), F.col("event_type")
    total = F.sum(value)
    days = (
        read(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("customer_id"), F.dayofmonth("ts").alias("month"))
        .agg(
            (F.count_distinct(kind) / F.lit(5.0)).alias("cash_flow_consistency"),
            F.round(E.ratio(F.stddev_pop(value), F.avg(value)), 4).alias("balance_volatility"),
            F.max((kind == "error").cast("int")).alias("income_shock_flag"),
            F.max((kind == "purchase").cast("int")).alias("spending_shock_flag"),
            F.round(total * 100).cast("bigint").alias("avg_monthly_inflow"),
            F.round(E.clip(E.ratio(F.max(value), total), 0.01, 0.90), 3).alias("emi_obligation_ratio"),
            F.count(F.lit(1)).cast("int").alias("active_loan_accounts"),
        )
    )
    open_loans = loans(spark, sf_dir).where("cooling_off_exit = 0").select("loan_id", "customer_id")
    return open_loans.join(days, "customer_id")


def outcomes(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    base = loans(spark, sf_dir) if base is None else base
    rate = F.col("loan_id") % 41 / F.lit(100.0) + 0.25
    return build_outcomes(base.withColumn("recovery_rate", rate), loan_rollup(repayments(spark, sf_dir)))


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = loans(spark, sf_dir)
    return build_master(base, customers(spark, sf_dir), outcomes(spark, sf_dir, base))


def active(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loanloom.operators.joins import active_loans

    return active_loans(master(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a label and a model-free score that has many ties."""
    p = F.col("l_quantity") / F.lit(50.0) * 0.6 + F.col("l_discount") * 4
    lines = _lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("loan_id"),
        "installment_no",
        E.flag(F.col("l_returnflag") == "R").alias("target"),
        F.round(p, 4).alias("pred_prob"),
    )
    return lines


def scored_with_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loanloom import schema as S

    tiers = loans(spark, sf_dir).join(customers(spark, sf_dir), "customer_id", "left").select(
        "loan_id", E.encode("risk_tier", S.TIER_ORDINAL, 4).alias("risk_tier_encoded")
    )
    return scored(spark, sf_dir).join(tiers, "loan_id", "left")
