"""Credit statistics: transitions, information value, association and rank tests."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom import schema as S
from loanloom.functions import exprs as E
from loanloom.operators.aggregates import known, over_groups, share_of_total
from loanloom.operators.ordered import ordered_groups
from loanloom.operators.ranking import exact_quantiles, mid_ranks, pearson_of, value_stats


def _n() -> Column:
    return F.count(F.lit(1))


# --- roll rates -------------------------------------------------------------

def transitions(rep: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Counts of bucket-to-next-bucket moves between consecutive instalments."""
    groups = ordered_groups(rep, "loan_id", ["installment_no"], 0, 1, max_rows)
    moved = groups.finish(
        groups.frame.withColumn("to_bucket", F.lead("dpd_bucket", 1).over(groups.window()))
    )
    return (
        moved.where(F.col("to_bucket").isNotNull() & F.col("dpd_bucket").isNotNull())
        .groupBy(F.col("dpd_bucket").alias("from_bucket"), "to_bucket").agg(_n().alias("n"))
    )


def roll_rates(rep: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Row-normalised transition matrix in percent; ``cure_rate_pct`` is the move to Current."""
    counts = transitions(rep, max_rows)
    wide = counts.groupBy("from_bucket").pivot("to_bucket", S.DPD_BUCKETS).agg(F.sum("n")).na.fill(0)
    row_total = F.lit(0)
    for c in S.DPD_BUCKETS:
        row_total = row_total + F.col(f"`{c}`")
    return wide.select(
        "from_bucket", row_total.alias("n"),
        *[E.pct(F.col(f"`{c}`"), row_total).alias(c) for c in S.DPD_BUCKETS],
        E.pct(F.col(f"`{S.DPD_BUCKETS[0]}`"), row_total).alias("cure_rate_pct"),
    )


# --- information value ------------------------------------------------------

def woe_table(
    df: DataFrame, label: str, numeric: Sequence[str] = (), categorical: Sequence[str] = (), bins: int = 10,
    smoothing: float = 0.5,
) -> DataFrame:
    """Weight of evidence per attribute and bin.

    Numeric attributes are cut at exact quantiles, intervals closed on the
    right. An empty cell counts as ``smoothing`` rows. All attributes are
    counted in one pass over an unpivoted frame.
    """
    base = df.where(F.col(label).isNotNull())
    parts = []
    if numeric:
        tall = base.select(F.col(label).alias("__y"), F.explode(F.array(*[
            F.struct(F.lit(c).alias("attribute"), F.col(c).cast("double").alias("value")) for c in numeric
        ])).alias("cell")).select("__y", "cell.attribute", "cell.value").where(F.col("value").isNotNull())
        names = {f"q{i}": i / bins for i in range(1, bins)}
        edges = exact_quantiles(tall, "value", names, ["attribute"]).select(
            "attribute", F.array(*names).alias("edges")
        )
        place = F.size(F.filter("edges", lambda e: F.col("value") > e))
        parts.append(
            tall.join(F.broadcast(edges), "attribute")  # one row per attribute
            .select("attribute", F.format_string("%02d", place).alias("bin"), "__y")
        )
    if categorical:
        parts.append(base.select(F.col(label).alias("__y"), F.explode(F.array(*[
            F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("bin")) for c in categorical
        ])).alias("cell")).select("cell.attribute", "cell.bin", "__y").where(F.col("bin").isNotNull()))
    tall = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    cells = tall.groupBy("attribute", "bin").agg(
        F.count_if(F.col("__y") == 1).alias("bad"), F.count_if(F.col("__y") == 0).alias("good")
    )
    sizes = cells.groupBy("attribute").agg(F.sum("bad").alias("all_bad"), F.sum("good").alias("all_good"))
    bad = F.greatest(F.col("bad").cast("double"), F.lit(smoothing)) / F.col("all_bad")
    good = F.greatest(F.col("good").cast("double"), F.lit(smoothing)) / F.col("all_good")
    return (
        cells.join(sizes, "attribute")
        .where((F.col("all_bad") > 0) & (F.col("all_good") > 0))
        .select("attribute", "bin", "good", "bad", F.ln(good / bad).alias("woe"),
                ((good - bad) * F.ln(good / bad)).alias("iv_part"))
    )


def information_value(df: DataFrame, label: str, numeric=(), categorical=(), bins: int = 10) -> DataFrame:
    return (
        woe_table(df, label, numeric, categorical, bins)
        .groupBy("attribute").agg(F.sum("iv_part").alias("iv"))
        .withColumn("strength", E.iv_strength("iv"))
    )


# --- association of categoricals --------------------------------------------

def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chi-square of the contingency table and Cramer's V (no bias correction).

    Uses sum(n^2 / (row * column)), so absent cells need not be materialised.
    """
    cells = known(df, a, b).groupBy(a, b).agg(_n().alias("n"))
    n = F.col("n").cast("double")
    margins = cells.withColumns({"row_n": F.sum("n").over(Window.partitionBy(a)), "col_n": F.sum("n").over(Window.partitionBy(b))})
    stats = margins.agg(
        F.sum(n * n / (F.col("row_n").cast("double") * F.col("col_n"))).alias("phi"), F.sum("n").alias("n"),
        F.count_distinct(a).alias("r"), F.count_distinct(b).alias("c"),
    )
    r, c = F.col("r"), F.col("c")
    chi2 = F.col("n") * (F.col("phi") - 1.0)
    return stats.select(
        "n", chi2.alias("chi2"), ((r - 1) * (c - 1)).alias("dof"),
        F.sqrt(E.ratio(F.col("phi") - 1.0, F.least(r, c) - 1)).alias("cramers_v"),
    )


# --- rank statistics --------------------------------------------------------

def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Spearman's rho: Pearson correlation of tie-averaged ranks.

    Rows are reduced to distinct (x, y) pairs first; the rank tables have
    unique keys, so a popular value can only make one join side uneven, which
    adaptive skew handling splits.
    """
    rows = known(df, x, y).select(
        (F.col(x).cast("double") + 0.0).alias("x"), (F.col(y).cast("double") + 0.0).alias("y")
    )
    pairs = rows.groupBy("x", "y").agg(_n().alias("n"))
    middle = (F.col("all_n") + 1) / 2.0
    measured = value_stats(rows, ["x", "y"])
    rx = mid_ranks(rows, "x", stats=measured["x"]).select("x", (F.col("mid_rank") - middle).alias("rx"))
    ry = mid_ranks(rows, "y", stats=measured["y"]).select("y", (F.col("mid_rank") - middle).alias("ry"))
    ranked = pairs.join(rx, "x").join(ry, "y")
    return pearson_of(ranked, F.col("rx"), F.col("ry"), F.col("n"))


def rank_sums(df: DataFrame, value: str, group: str) -> tuple[DataFrame, Column]:
    """Size and rank sum of each group under joint tie-averaged ranking, and the
    tie term, the sum of t^3 - t over runs of t equal values."""
    rows = known(df, value, group).withColumn(value, F.col(value).cast("double") + 0.0)
    per_value = rows.groupBy(value, group).agg(_n().alias("m"))
    ranks = mid_ranks(rows, value).select(value, "n", "mid_rank")
    t = F.col("n").cast("double")
    ties = ranks.agg(F.sum(t * t * t - t)).scalar()
    sums = per_value.join(ranks.drop("n"), value).groupBy(group).agg(
        F.sum("m").alias("n"), F.sum(F.col("m") * F.col("mid_rank")).alias("rank_sum")
    )
    return sums, ties


def kruskal(df: DataFrame, value: str, group: str) -> DataFrame:
    """Kruskal-Wallis H with tie correction, and its degrees of freedom."""
    sums, ties = rank_sums(df, value, group)
    total = sums.agg(
        F.sum("n").cast("double").alias("n"), _n().alias("groups"),
        F.sum(F.col("rank_sum") * F.col("rank_sum") / F.col("n")).alias("q"),
    )
    n = F.col("n")
    raw = F.col("q") * 12.0 / (n * (n + 1)) - (n + 1) * 3.0
    return total.select(
        E.ratio(raw, F.lit(1.0) - ties / (n * n * n - n)).alias("h"),
        (F.col("groups") - 1).alias("dof"),
    )


def mann_whitney(df: DataFrame, value: str, flag: str) -> DataFrame:
    """Mann-Whitney U of the flagged rows, and the tie-corrected z score."""
    sums, ties = rank_sums(df, value, flag)
    one = F.col(flag) == 1
    stats = sums.agg(
        F.sum(F.when(one, F.col("n"))).cast("double").alias("n1"),
        F.sum(F.when(~one, F.col("n"))).cast("double").alias("n0"),
        F.sum(F.when(one, F.col("rank_sum"))).alias("r1"),
    )
    n1, n0 = F.col("n1"), F.col("n0")
    n = n1 + n0
    u = F.col("r1") - n1 * (n1 + 1) / 2.0
    sigma = F.sqrt(n1 * n0 / 12.0 * ((n + 1) - ties / (n * (n - 1))))
    return stats.select(n1.alias("n1"), n0.alias("n0"), u.alias("u"),
                        E.ratio(u - n1 * n0 / 2.0, sigma).alias("z"))


def anova_f(df: DataFrame, value: str, group: str) -> DataFrame:
    """One-way ANOVA from per-group size, mean and centred variance."""
    groups = known(df, value, group).groupBy(group).agg(
        _n().cast("double").alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v")
    )
    gap = F.col("m") - over_groups(F.sum(F.col("n") * F.col("m"))) / over_groups(F.sum("n"))
    sums = groups.withColumn("b", F.col("n") * gap * gap).agg(
        F.sum("b").alias("between"),
        F.sum(F.col("n") * F.col("v")).alias("within"),
        F.sum("n").alias("n"), _n().alias("k"),
    )
    df1, df2 = F.col("k") - 1, F.col("n") - F.col("k")
    return sums.select(
        E.ratio(E.ratio("between", df1), E.ratio("within", df2)).alias("f"),
        df1.alias("df_between"), df2.cast("bigint").alias("df_within"),
    )


# --- p-values of one-row test results ---------------------------------------

def _upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function by series or continued fraction."""
    if x <= 0:
        return 1.0
    lead = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-15:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - lead * total)
    b, c = x + 1 - a, 1e300
    d = 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1.0 / (an * d + b)
        c = b + an / c
        step = c * d
        h *= step
        if abs(step - 1) < 1e-15:
            break
    return lead * h


@F.pandas_udf(T.DoubleType())
def chi2_pvalue(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([
        None if pd.isna(s) or pd.isna(k) or k < 1 else _upper_gamma(k / 2.0, s / 2.0)
        for s, k in zip(stat, dof)
    ], dtype="float64")


@F.pandas_udf(T.DoubleType())
def normal_pvalue(z: pd.Series) -> pd.Series:
    """Two-sided."""
    return z.map(lambda v: None if pd.isna(v) else math.erfc(abs(v) / math.sqrt(2.0))).astype("float64")


# --- rates and distributions ------------------------------------------------

def rate_ci(df: DataFrame, flag: str, z: float = 1.96) -> DataFrame:
    """Proportion in percent with its normal interval; the denominator is every row given."""
    stats = df.where(F.col(flag).isNotNull()).agg(_n().alias("n"), F.avg(flag).alias("p"))
    half = F.sqrt(F.col("p") * (F.lit(1.0) - F.col("p")) / F.nullif(F.col("n"), F.lit(0))) * z
    return stats.select(
        "n", (F.col("p") * 100).alias("rate_pct"),
        ((F.col("p") - half) * 100).alias("low_pct"), ((F.col("p") + half) * 100).alias("high_pct"),
    )


def distribution(df: DataFrame, column: str, by: str, bias_corrected: bool = False) -> DataFrame:
    """Mean, median, P90 and skew per group; population skew unless corrected."""
    skew = F.skewness(column)
    n = _n().cast("double")
    if bias_corrected:
        skew = F.when(n > 2, skew * F.sqrt(n * (n - 1)) / (n - 2))
    shape = {"n": _n(), "mean": F.avg(column), "skew": skew}
    return exact_quantiles(known(df, by, column), column, {"median": 0.5, "p90": 0.9}, [by], shape)


def predefault_windows(
    signals: DataFrame, rep: DataFrame,
    columns: Sequence[str] = ("cash_flow_consistency", "balance_volatility", "emi_obligation_ratio"),
) -> DataFrame:
    """Mean signals of never-defaulting loans and of 6-4 and 3-1 months before default.

    Months after the default are in no window.
    """
    event = rep.where(F.col("is_defaulted") == 1).groupBy("loan_id").agg(
        F.min("installment_no").alias("default_month")
    )
    gap = F.col("default_month") - F.col("month")
    window = (
        F.when(F.col("default_month").isNull(), "normal")
        .when(gap.between(4, 6), "6-4M").when(gap.between(1, 3), "3-1M")
    )
    return (
        signals.join(event, "loan_id", "left").withColumn("time_window", window)
        .where(F.col("time_window").isNotNull()).groupBy("time_window")
        .agg(_n().alias("n"), *[F.avg(c).alias(c) for c in columns])
    )


def default_contrast(active: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean of each column for defaulted and other loans, and the gap in percent of the latter."""
    bad, good = F.col("default_flag") == 1, F.col("default_flag") == 0
    means = active.agg(*[
        F.struct(F.lit(c).alias("attribute"), F.avg(F.when(bad, F.col(c))).alias("defaulted_mean"),
                 F.avg(F.when(good, F.col(c))).alias("other_mean")).alias(c)
        for c in columns
    ])
    tall = means.select(F.explode(F.array(*columns)).alias("r")).select("r.*")
    return tall.withColumn("gap_pct", E.pct(F.col("defaulted_mean") - F.col("other_mean"), "other_mean"))


def lgd_stats(active: DataFrame, by: str | None = None) -> DataFrame:
    """Loss and recovery of defaulted loans: mean, exact median, sample deviation."""
    d = active.where(F.col("default_flag") == 1)
    shortfall = F.col("loss_given_default") + F.col("recovery_amount")
    d = d.withColumn("recovery_rate_pct", E.pct("recovery_amount", shortfall))
    keys = [by] if by else []
    return exact_quantiles(d, "loss_given_default", {"median_lgd": 0.5}, keys, {
        "n": _n(), "mean_lgd": F.avg("loss_given_default"),
        "std_lgd": F.stddev_samp("loss_given_default"), "mean_recovery_pct": F.avg("recovery_rate_pct"),
    })


def festival_uplift(rep: DataFrame) -> DataFrame:
    on_time = (F.col("payment_status") == "Paid-On-Time").cast("int")
    festive = E.festival_flag("due_date") == 1
    return rep.agg(
        (F.avg(F.when(festive, on_time)) * 100.0).alias("festival_pct"),
        (F.avg(F.when(~festive, on_time)) * 100.0).alias("other_pct"),
    ).withColumn("uplift_pp", F.col("festival_pct") - F.col("other_pct"))


def co_shock_rate(signals: DataFrame) -> DataFrame:
    """Share of loan-months with both shocks in the same month."""
    both = E.flag((F.col("income_shock_flag") == 1) & (F.col("spending_shock_flag") == 1))
    return signals.agg(_n().alias("loan_months"), (F.avg(both) * 100.0).alias("co_shock_pct"))


def grade_pricing(active: DataFrame) -> DataFrame:
    stats = exact_quantiles(active, "apr", {"median_apr": 0.5}, ["origination_risk_grade"], {
        "mean_apr_pct": F.avg("apr") * 100.0, "default_rate_pct": F.avg("default_flag") * 100.0,
    })
    return stats.withColumn("median_apr_pct", F.col("median_apr") * 100.0).drop("median_apr")


def net_ltv(active: DataFrame) -> DataFrame:
    """LTV less acquisition cost by channel, and each channel's cost as multiple of the cheapest."""
    stats = known(active, "acquisition_channel").groupBy("acquisition_channel").agg(
        F.avg("customer_ltv").alias("avg_ltv"), F.avg("cost_of_acquisition").alias("avg_cac")
    )
    cheapest = over_groups(F.min("avg_cac"))
    return stats.withColumns({
        "net_ltv": F.col("avg_ltv") - F.col("avg_cac"), "cac_spread": E.ratio("avg_cac", cheapest),
    })


def segment_channel_matrix(active: DataFrame) -> DataFrame:
    """Low/high risk tiers against low/high risk channels; other rows are in no cell."""
    tier, channel = F.col("risk_tier"), F.col("acquisition_channel")
    cells = active.withColumns({
        "tier_group": F.when(tier.isin(S.LOW_RISK_TIERS), "low").when(tier.isin(S.HIGH_RISK_TIERS), "high"),
        "channel_group": F.when(channel.isin(S.LOW_RISK_CHANNELS), "low")
        .when(channel.isin(S.HIGH_RISK_CHANNELS), "high"),
    })
    return known(cells, "tier_group", "channel_group").groupBy("tier_group", "channel_group").agg(
        _n().alias("n"), (F.avg("default_flag") * 100.0).alias("default_rate_pct"),
        F.avg("risk_adjusted_return").alias("avg_rar"),
    )


def repeat_share(loans: DataFrame) -> DataFrame:
    """Share of customers with more than one loan."""
    per_customer = known(loans, "customer_id").groupBy("customer_id").agg(_n().alias("n"))
    return per_customer.agg(
        _n().alias("n_customers"), F.count_if(F.col("n") > 1).alias("n_repeat"),
        (F.avg((F.col("n") > 1).cast("int")) * 100.0).alias("repeat_pct"),
    )


def mom_change(df: DataFrame, month: str, column: str, drop: float = 0.05) -> DataFrame:
    """Monthly mean of a signal, its change and a flag for a fall larger than ``drop``.

    The window runs over one row per month.
    """
    monthly = known(df, month).groupBy(month).agg(F.avg(column).alias("mean_value"))
    change = F.col("mean_value") - F.lag("mean_value").over(Window.orderBy(month))
    return monthly.withColumn("mom_change", change).withColumn("alert", E.flag(F.col("mom_change") < -drop))


def share_table(df: DataFrame, by: str) -> DataFrame:
    return share_of_total(known(df, by).groupBy(by).agg(_n().alias("n")), "n", "share_pct")
