"""Per-loan lag features, the forward label and missing-value rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from loanloom import schema as S
from loanloom.functions import exprs as E
from loanloom.operators.joins import originations
from loanloom.operators.ordered import latest_per, ordered_groups
from loanloom.operators.ranking import exact_medians

REACH_BACK, REACH_AHEAD = 2, 1


# --- window building blocks -------------------------------------------------

def lag0(c: Column | str, n: int, w: WindowSpec) -> Column:
    """Value ``n`` rows back; no such row, or a null there, gives 0."""
    return F.coalesce(F.lag(E.as_col(c), n).over(w), F.lit(0))


def lag_or(c: Column | str, n: int, w: WindowSpec, default: Column) -> Column:
    return F.coalesce(F.lag(E.as_col(c), n).over(w), default)


def forward_label(bucket: Column | str, w: WindowSpec, threshold: int = 2, censored: str = "negative") -> Column:
    """1 when the next row's bucket reaches the threshold.

    The last row has no successor: ``negative`` labels it 0, ``drop`` leaves null.
    """
    following = F.lead(E.as_col(bucket), 1).over(w)
    label = (following >= threshold).cast("int")
    if censored == "negative":
        return F.coalesce(label, F.lit(0))
    if censored != "drop":
        raise ValueError("censored must be 'negative' or 'drop'")
    return label


def mean_of(*values: Column) -> Column:
    """Mean of the non-null values."""
    total, seen = F.lit(0.0), F.lit(0)
    for v in values:
        total = total + F.coalesce(v, F.lit(0.0))
        seen = seen + v.isNotNull().cast("int")
    return E.ratio(total, seen)


def slope2(now: Column, two_back: Column) -> Column:
    return (now - two_back) / 2.0


# --- repayments -------------------------------------------------------------

def status_flags(status: Column | str = "payment_status") -> dict[str, Column]:
    s = E.as_col(status)
    return {
        "is_missed": E.flag(s == "Missed"),
        "is_late": E.flag(s.isin("Late-1-30", "Late-31-60")),
        "is_partial": E.flag(s == "Partial"),
        "is_on_time": E.flag(s == "Paid-On-Time"),
    }


def repayment_features(rep: DataFrame, max_rows: int | None = None, censored: str = "negative") -> DataFrame:
    """Label and payment-behaviour features, one row per instalment.

    All lags share one window, so the whole set costs one shuffle and one sort.
    """
    groups = ordered_groups(rep, "loan_id", ["installment_no"], REACH_BACK, REACH_AHEAD, max_rows)
    w = groups.window()
    base = groups.frame.withColumns({
        "dpd_bucket_encoded": E.encode("dpd_bucket", S.BUCKET_ORDINAL, 0),
        "sma_encoded": E.encode("loan_status", S.STATUS_ORDINAL, 0),
        **status_flags(),
    })
    lagged = ["dpd", "sma_encoded", "is_missed", "is_late", "is_partial", "is_on_time"]
    base = base.withColumns({
        "target": forward_label("dpd_bucket_encoded", w, censored=censored),
        **{f"{c}_{n}m": lag0(c, n, w) for c in lagged for n in (1, 2)},
    })
    out = groups.finish(base)

    def three(c: str) -> list[Column]:
        return [F.col(c), F.col(f"{c}_1m"), F.col(f"{c}_2m")]

    def total(c: str) -> Column:
        a, b, d = three(c)
        return a + b + d

    return out.select(
        "loan_id", "installment_no", F.month("due_date").alias("cal_month"), "target",
        "dpd_bucket_encoded", "sma_encoded",
        slope2(F.col("sma_encoded"), F.col("sma_encoded_2m")).alias("sma_trend"),
        F.greatest(*three("sma_encoded")).alias("max_sma_last_3m"),
        total("is_missed").alias("missed_payment_last_3m"),
        total("is_late").alias("late_payment_last_3m"),
        E.flag(total("is_partial") > 0).alias("partial_payment_flag"),
        E.ratio_clip("amount_paid", "emi_due", 0.0, 1.0, 0.0).alias("payment_ratio_last_month"),
        F.greatest(*three("dpd")).alias("max_dpd_last_3m"),
        slope2(F.col("dpd"), F.col("dpd_2m")).alias("dpd_trend_slope"),
        (F.col("is_missed") + F.col("is_missed_1m")).alias("consecutive_missed"),
        (F.lit(3) - total("is_on_time")).alias("months_no_on_time"),
        E.festival_flag("due_date").alias("is_festival_month"),
    )


def eligible(obs: DataFrame, min_history: int = 4, max_bucket: int = 1) -> DataFrame:
    return obs.where(
        (F.col("installment_no") >= min_history)
        & F.col("target").isNotNull()
        & (F.col("dpd_bucket_encoded") <= max_bucket)
    )


# --- account signals --------------------------------------------------------

LAGGED_SIGNALS = [
    "balance_volatility", "cash_flow_consistency", "income_shock_flag",
    "spending_shock_flag", "emi_obligation_ratio", "avg_monthly_inflow",
]


def signal_medians(signals: DataFrame, columns: Sequence[str] = LAGGED_SIGNALS) -> DataFrame:
    """One row: exact medians of the unlagged columns over all loans."""
    return exact_medians(signals, columns)


def lag_median(
    signals: DataFrame, max_rows: int | None = None, medians: DataFrame | None = None, columns: Sequence[str] = LAGGED_SIGNALS
) -> DataFrame:
    """Adds ``<column>_1m`` and ``<column>_2m``; missing lags take the column's global median."""
    medians = signal_medians(signals, columns) if medians is None else medians
    fill = medians.select(F.struct(*columns)).scalar()
    groups = ordered_groups(signals, "loan_id", ["month"], REACH_BACK, 0, max_rows)
    w = groups.window()
    return groups.finish(groups.frame.withColumns({
        f"{c}_{n}m": lag_or(c, n, w, fill.getField(c)) for c in columns for n in (1, 2)
    }))


def shock_flags() -> dict[str, Column]:
    """Whether income fell short in three rows, spending in two, and both, over columns lagged by ``lag_median``."""
    income = F.greatest("income_shock_flag", "income_shock_flag_1m", "income_shock_flag_2m")
    spending = F.greatest("spending_shock_flag", "spending_shock_flag_1m")
    return {"income_shock_flag_3m": income, "spending_shock_flag_3m": spending,
            "both_shocks_flag": E.flag((income >= 1) & (spending >= 1))}


def latest_shocks(signals: DataFrame, carried: Sequence[str] = (), max_rows: int | None = None) -> DataFrame:
    """Each loan's last known shock flags and last known values of ``carried``.

    Lags the two shock columns alone: one window over them and one aggregate, whatever else signals hold.
    """
    narrow = signals.select("loan_id", "month", "income_shock_flag", "spending_shock_flag", *carried)
    lagged = lag_median(narrow, max_rows, columns=("income_shock_flag", "spending_shock_flag"))
    flags = shock_flags()
    rows = lagged.select("loan_id", "month", *[flags[c].alias(c) for c in flags], *carried)
    return latest_per(rows, "loan_id", ["month"]).drop("month")


def signal_features(
    signals: DataFrame, max_rows: int | None = None, medians: DataFrame | None = None
) -> DataFrame:
    """Bank-behaviour features, one row per loan and month.

    Names follow the published feature list: the "30d" column averages three
    rows and the spending flag named 3m looks at two.
    """
    out = lag_median(signals, max_rows, medians)

    def at(c: str, *lags: int) -> list[Column]:
        return [F.col(c)] + [F.col(f"{c}_{n}m") for n in lags]

    income, shocks = at("income_shock_flag", 1, 2), shock_flags()
    inflow, earlier = F.col("avg_monthly_inflow"), F.col("avg_monthly_inflow_2m")
    return out.select(
        "loan_id", "month",
        mean_of(*at("balance_volatility", 1, 2)).alias("rolling_30d_balance_volatility"),
        slope2(*at("balance_volatility", 2)).alias("volatility_acceleration"),
        slope2(*at("cash_flow_consistency", 2)).alias("cash_flow_trend"),
        shocks["income_shock_flag_3m"].alias("income_shock_flag_3m"),
        (income[0] + income[1] + income[2]).alias("income_shock_count"),
        shocks["spending_shock_flag_3m"].alias("spending_shock_flag_3m"),
        shocks["both_shocks_flag"].alias("both_shocks_flag"),
        mean_of(*at("emi_obligation_ratio", 1)).alias("avg_emi_obligation_ratio"),
        F.least(*at("cash_flow_consistency", 1, 2)).alias("min_cash_flow_3m"),
        E.ratio_clip(inflow - earlier, earlier, -1.0, 1.0, 0.0).alias("inflow_trend"),
        "active_loan_accounts",
    )


# --- origination ------------------------------------------------------------

def origination_features(loans: DataFrame, customers: DataFrame) -> DataFrame:
    yearly_income = F.col("monthly_income") * 12
    return originations(loans, customers).select(
        "loan_id", "customer_id", "bureau_score", "monthly_income", "employment_stability_score",
        "new_to_credit_flag", "existing_customer",
        E.encode("risk_tier", S.TIER_ORDINAL, 2).alias("risk_tier_encoded"),
        E.encode("origination_risk_grade", S.GRADE_ORDINAL, 4).alias("grade_encoded"),
        E.encode("acquisition_channel", S.CHANNEL_RISK, 1.0).alias("channel_risk_score"),
        E.encode("employment_type", S.EMPLOYMENT_RISK, 3).alias("employment_risk"),
        E.encode("product_type", S.PRODUCT_RISK, 1.0).alias("product_risk"),
        E.encode("gender", S.GENDER_CODE, 0).alias("gender_encoded"),
        "apr", "tenure_months", "ticket_size", "emi_amount",
        E.ratio_clip("emi_amount", "monthly_income", 0.0, 1.0, 0.5).alias("emi_to_income_ratio"),
        E.ratio_clip("ticket_size", yearly_income, 0.0, 5.0, 1.0).alias("ticket_to_income_ratio"),
        E.ratio_clip("processing_fee", "ticket_size", 0.0, 0.05, 0.02).alias("processing_fee_pct"),
        "approval_turnaround_days", "origination_date",
    )


# --- missing values ---------------------------------------------------------

SIGNAL_CONSTANTS = {
    "volatility_acceleration": 0.0, "cash_flow_trend": 0.0, "income_shock_flag_3m": 0.0,
    "income_shock_count": 0.0, "spending_shock_flag_3m": 0.0, "both_shocks_flag": 0.0,
    "inflow_trend": 0.0, "active_loan_accounts": 1.0,
}
SIGNAL_MEDIAN_FILLS = {
    "rolling_30d_balance_volatility": "balance_volatility",
    "avg_emi_obligation_ratio": "emi_obligation_ratio",
    "min_cash_flow_3m": "cash_flow_consistency",
}
ORIGINATION_CONSTANTS = {
    "emi_to_income_ratio": 0.4, "ticket_to_income_ratio": 1.0, "months_since_origination": 6,
}
PANEL_MEDIAN_FILLS = ["bureau_score", "employment_stability_score", "approval_turnaround_days"]


def fill_constants(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if c in df.columns
    })


def fill_medians(
    df: DataFrame, source: DataFrame, columns: Mapping[str, str] | Sequence[str], medians: DataFrame | None = None
) -> DataFrame:
    """Fill nulls with exact medians of ``source``; ``columns`` maps target to source column.

    ``medians`` may bring a one-row frame that has them already.
    """
    pairs = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    names = sorted(set(pairs.values()))
    medians = exact_medians(source, names) if medians is None else medians
    fill = medians.select(F.struct(*medians.columns)).scalar()
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), fill.getField(src)) for c, src in pairs.items()
    })
