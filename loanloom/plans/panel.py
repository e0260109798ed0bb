"""The observation panel: label, 42 features, eligibility and fills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom import schema as S
from loanloom.operators import features as X
from loanloom.operators.joins import attach_origination, attach_signals


def build_panel(
    repayments: DataFrame,
    signals: DataFrame,
    loans: DataFrame,
    customers: DataFrame,
    mode: str = "auto",
    min_history: int = 4,
    max_bucket: int = 1,
    censored: str = "negative",
    max_rows: int | None = None,
) -> DataFrame:
    """One row per eligible instalment with ``target`` and all of ``schema.FEATURES``."""
    obs = X.eligible(
        X.repayment_features(repayments, max_rows, censored), min_history, max_bucket
    )
    orig = X.origination_features(loans, customers)
    medians = X.signal_medians(signals)
    # without the rows that a missing label drops, the keys of eligible rows need no window
    keys = None
    if censored == "negative":
        bucket = X.E.encode("dpd_bucket", S.BUCKET_ORDINAL, 0)
        rows = repayments.where((F.col("installment_no") >= min_history) & (bucket <= max_bucket))
        keys = (rows.select("loan_id", "installment_no"), signals.select("loan_id", F.col("month").alias("installment_no")))
    panel = attach_signals(obs, X.signal_features(signals, max_rows, medians), mode, bare=keys)
    panel = attach_origination(panel, orig)
    panel = panel.withColumn("months_since_origination", F.col("installment_no"))
    panel = X.fill_constants(panel, X.SIGNAL_CONSTANTS)
    panel = X.fill_medians(panel, signals, X.SIGNAL_MEDIAN_FILLS, medians)
    # Signal rows never multiply observations, so these medians need only the two narrow inputs.
    narrow = attach_origination(
        obs.select("loan_id"), orig.select("loan_id", *X.PANEL_MEDIAN_FILLS)
    )
    panel = X.fill_medians(panel, narrow, X.PANEL_MEDIAN_FILLS)
    panel = X.fill_constants(panel, X.ORIGINATION_CONSTANTS)
    return X.fill_constants(panel, dict.fromkeys(S.FEATURES, 0)).select(
        "loan_id", "installment_no", "target", *S.FEATURES
    )
