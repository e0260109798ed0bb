"""Green / Amber / Red scorecards over scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom import schema as S
from loanloom.functions import exprs as E
from loanloom.operators.aggregates import over_groups, rate_pivot
from loanloom.operators.joins import fixed_table
from loanloom.operators.ordered import latest_per


def latest_scores(scored: DataFrame) -> DataFrame:
    """Latest scored row of each loan."""
    return latest_per(scored, "loan_id", ["installment_no"])


def with_bucket(scored: DataFrame, amber: float = 0.20, red: float = 0.45) -> DataFrame:
    return scored.withColumn("risk_bucket", E.risk_bucket("pred_prob", amber, red))


def scorecard_summary(bucketed: DataFrame) -> DataFrame:
    """Per bucket: loans, share, mean score, actual rate and share of all delinquencies caught."""
    stats = bucketed.groupBy("risk_bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("pred_prob").alias("mean_prob"),
        (F.avg("target") * 100.0).alias("actual_delinquency_rate"),
        F.sum("target").alias("__caught"),
    )
    return stats.select(
        F.col("risk_bucket").alias("bucket"), "n",
        E.pct("n", over_groups(F.sum("n"))).alias("share_pct"), "mean_prob",
        "actual_delinquency_rate",
        F.coalesce(E.pct("__caught", over_groups(F.sum("__caught"))), F.lit(0.0)).alias("catch_rate"),
    )


def tier_bucket_rates(bucketed: DataFrame) -> DataFrame:
    """Delinquency rate by decoded tier and bucket; empty cells stay null."""
    labelled = bucketed.withColumn("risk_tier_label", E.decode("risk_tier_encoded", S.TIER_ORDINAL))
    return rate_pivot(labelled, "risk_tier_label", "risk_bucket", S.RISK_BUCKETS, value="target")


def interventions(spark) -> DataFrame:
    return fixed_table(
        spark, S.INTERVENTIONS,
        "risk_bucket string, label string, action1 string, action2 string, action3 string, "
        "contact string, urgency string, escalate string",
    )


def attach_interventions(bucketed: DataFrame) -> DataFrame:
    return bucketed.join(interventions(bucketed.sparkSession), "risk_bucket", "left")


def scorecard_table(bucketed: DataFrame) -> DataFrame:
    """The published scorecard columns, as far as the frame has them."""
    return bucketed.select(*[c for c in S.SCORECARD_COLUMNS if c in bucketed.columns])


def bucket_metric(summary: DataFrame, bucket: str, metric: str) -> DataFrame:
    return summary.where(F.col("bucket") == bucket).select(metric)
