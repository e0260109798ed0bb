"""Policy rules: thresholds held in small fixed tables, joined to data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom import schema as S
from loanloom.functions import exprs as E
from loanloom.operators import aggregates as A
from loanloom.operators.joins import fixed_table
from loanloom.operators.ordered import ordered_groups


def melt_row(row: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One-row frame to (kpi, value) rows."""
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("kpi"), F.col(c).cast("double").alias("value")) for c in columns
    ])).alias("r")).select("r.*")


def kpi_status(kpis: DataFrame, thresholds: Sequence[tuple] = tuple(S.KPI_THRESHOLDS)) -> DataFrame:
    """GREEN, AMBER or RED per KPI row."""
    limits = fixed_table(kpis.sparkSession, thresholds, "kpi string, better string, green double, red double")
    v, low = F.col("value"), F.col("better") == "low"
    good = F.when(low, v < F.col("green")).otherwise(v > F.col("green"))
    bad = F.when(low, v > F.col("red")).otherwise(v < F.col("red"))
    status = F.when(v.isNotNull(), F.when(good, "GREEN").when(bad, "RED").otherwise("AMBER"))
    return kpis.join(limits, "kpi").select("kpi", "value", status.alias("status"))


def limit_flags(kpis: DataFrame, limits: Sequence[tuple]) -> DataFrame:
    """Raise a flag where the value stands in the stated relation to its limit."""
    table = fixed_table(kpis.sparkSession, limits, "kpi string, relation string, threshold double")
    v, t, rel = F.col("value"), F.col("threshold"), F.col("relation")
    hit = (
        F.when(rel == ">", v > t).when(rel == ">=", v >= t).when(rel == "<", v < t).when(rel == "<=", v <= t)
    )
    return kpis.join(table, "kpi").select("kpi", "value", "threshold", E.flag(hit).alias("flagged"))


def portfolio_status(active: DataFrame, rep: DataFrame) -> DataFrame:
    row = A.portfolio_kpis(active).withColumn(
        "collection_efficiency_pct", A.collection_efficiency(rep).scalar()
    )
    return kpi_status(melt_row(row, [k[0] for k in S.KPI_THRESHOLDS]))


def origination_flags(master: DataFrame) -> DataFrame:
    """Channel mix, worst channel exit rate, subprime share and approval speed of new loans."""
    channel = F.col("acquisition_channel")

    def share(condition: Column) -> Column:
        return F.avg(E.flag(condition)) * 100.0

    row = master.agg(
        share(channel == "Paid-Digital").alias("paid_digital_share_pct"),
        share(channel.isin(S.LOW_RISK_CHANNELS)).alias("referral_organic_share_pct"),
        share(F.col("risk_tier") == "Subprime").alias("subprime_share_pct"),
        F.avg("approval_turnaround_days").alias("avg_turnaround_days"),
    ).withColumn("max_channel_exit_pct", A.exit_rate(master).agg(F.max("exit_rate_pct")).scalar())
    return limit_flags(melt_row(row, [k[0] for k in S.ORIGINATION_LIMITS]), S.ORIGINATION_LIMITS)


def ews_flags(summary: DataFrame, signals: DataFrame, rep: DataFrame) -> DataFrame:
    """Early-warning flags from the scorecard summary, co-shock rate, DPD 1-30 roll rate and the
    last month's fall of the portfolio's cash-flow consistency."""
    from loanloom.operators.stats import co_shock_rate, mom_change, transitions

    red = F.col("bucket") == "RED"
    row = summary.agg(
        F.max(F.when(red, F.col("share_pct"))).alias("red_share_pct"),
        F.max(F.when(red, F.col("actual_delinquency_rate"))).alias("red_delinquency_pct"),
    )
    worse = F.sum(F.when(F.col("to_bucket").isin(S.DPD_BUCKETS[2:]), F.col("n")).otherwise(0))
    rolled = transitions(rep).where(F.col("from_bucket") == S.DPD_BUCKETS[1]).agg(E.pct(worse, F.sum("n")))
    row = row.withColumns({
        "co_shock_pct": co_shock_rate(signals).select("co_shock_pct").scalar(),
        "dpd_1_30_roll_pct": rolled.scalar(),
        "cash_flow_fall": mom_change(signals, "month", "cash_flow_consistency").agg(
            -F.max_by("mom_change", "month")).scalar(),
    })
    return limit_flags(melt_row(row, [k[0] for k in S.WARNING_LIMITS]), S.WARNING_LIMITS)


def escalations(signals: DataFrame, foir_limit: float = 0.50, max_rows: int | None = None) -> DataFrame:
    """Loan-months with two falls of consistency and two rises of volatility in a row
    while the obligation ratio crosses the limit from at or below to above."""
    groups = ordered_groups(signals, "loan_id", ["month"], 2, 0, max_rows)
    w = groups.window()

    def back(c: str, n: int) -> Column:
        return F.lag(c, n).over(w)

    cfc, bv, foir = "cash_flow_consistency", "balance_volatility", "emi_obligation_ratio"
    marked = groups.finish(groups.frame.withColumns({
        f"__{c}_{n}": back(c, n) for c in (cfc, bv, foir) for n in (1, 2)
    }))
    falling = (F.col(cfc) < F.col(f"__{cfc}_1")) & (F.col(f"__{cfc}_1") < F.col(f"__{cfc}_2"))
    rising = (F.col(bv) > F.col(f"__{bv}_1")) & (F.col(f"__{bv}_1") > F.col(f"__{bv}_2"))
    earlier = F.least(f"__{foir}_1", f"__{foir}_2")
    crossed = (F.col(foir) > foir_limit) & (earlier <= foir_limit)
    return marked.where(falling & rising & crossed).select("loan_id", "month", cfc, bv, foir)


def approval_stance(loans: DataFrame) -> DataFrame:
    """Stance by tier. Conditions on absent columns are simply not met.

    Expects ``risk_tier``, ``foir``, ``employment_stability_score``,
    ``bureau_score``, ``employment_type`` and, where known, the latest
    ``income_shock_flag_3m``, ``both_shocks_flag`` and ``cash_flow_consistency``.
    """
    tier, foir = F.col("risk_tier"), F.col("foir")
    near = (foir < 0.40) & (F.col("employment_stability_score") > 5)
    sub = (F.col("bureau_score") > 540) & (foir < 0.35) & (F.coalesce("income_shock_flag_3m", F.lit(0)) == 0)
    thin = (F.col("cash_flow_consistency") > 0.6) & (F.coalesce("both_shocks_flag", F.lit(0)) == 0)

    def met(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    stance = (
        F.when(tier == "Prime", "approve")
        .when((tier == "Near-Prime") & met(near), "approve")
        .when((tier == "Subprime") & met(sub), "approve selectively")
        .when((tier == "Thin-File") & met(thin), "approve on account data")
        .when(tier.isin(S.TIERS), "decline").otherwise("refer")
    )
    scrutiny = E.flag(F.col("employment_type").isin("Gig-Worker", "Daily-Wage"))
    return loans.withColumns({"stance": stance, "extra_scrutiny": scrutiny})


def apr_adjustment(loans: DataFrame) -> DataFrame:
    """Channel mark-up in basis points and the adjusted rate range."""
    table = fixed_table(
        loans.sparkSession, S.APR_ADJUSTMENT_BPS, "acquisition_channel string, bps_low int, bps_high int"
    )
    joined = loans.join(table, "acquisition_channel", "left")
    low, high = F.coalesce("bps_low", F.lit(0)), F.coalesce("bps_high", F.lit(0))
    return joined.withColumns({
        "bps_low": low, "bps_high": high,
        "apr_low": F.col("apr") + low / F.lit(10000.0), "apr_high": F.col("apr") + high / F.lit(10000.0),
    })


def tenure_breach(loans: DataFrame) -> DataFrame:
    """Loans longer than the cap for their product and tier."""
    caps = fixed_table(
        loans.sparkSession, S.TENURE_CAPS, "__product string, __tier string, tenure_cap int"
    )
    # the tightest cap for any tier, and for the loan's own: a loan meets one row of each
    general = caps.where("__tier IS NULL").groupBy("__product").agg(F.min("tenure_cap").alias("__any"))
    own = caps.where("__tier IS NOT NULL").groupBy(F.col("__product").alias("__same"), "__tier").agg(F.min("tenure_cap").alias("__own"))
    capped = loans.join(F.broadcast(general), F.col("product_type") == F.col("__product"), "left").join(
        F.broadcast(own), (F.col("product_type") == F.col("__same")) & (F.col("risk_tier") == F.col("__tier")), "left")
    capped = capped.withColumn("tenure_cap", F.least("__any", "__own")).drop("__product", "__same", "__tier", "__any", "__own")
    return capped.withColumn("tenure_breach", E.flag(F.col("tenure_months") > F.col("tenure_cap")))


def ticket_breach(loans: DataFrame) -> DataFrame:
    cap = E.encode("risk_tier", dict(S.TICKET_CAPS), None)
    return loans.withColumn("ticket_cap", cap.cast("int")).withColumn(
        "ticket_breach", E.flag(F.col("ticket_size") > F.col("ticket_cap"))
    )


def growth_quadrant(stats: DataFrame) -> DataFrame:
    """Products against the unweighted mean default and profitable rates."""
    safe = F.col("default_rate_pct") <= A.over_groups(F.avg("default_rate_pct"))
    profitable = F.col("profitable_pct") >= A.over_groups(F.avg("profitable_pct"))
    quadrant = (
        F.when(F.col("__safe") & F.col("__profitable"), "grow aggressively").when(F.col("__profitable"), "grow selectively")
        .when(F.col("__safe"), "manage carefully").otherwise("restrict or reprice")
    )
    return stats.withColumns({"__safe": safe, "__profitable": profitable}).withColumn("quadrant", quadrant).drop("__safe", "__profitable")


def double_penalty(stats: DataFrame) -> DataFrame:
    """Channels dearer and riskier than the mean channel."""
    hit = (F.col("avg_cac") > A.over_groups(F.avg("avg_cac"))) & (F.col("default_rate_pct") > A.over_groups(F.avg("default_rate_pct")))
    return stats.withColumn("double_penalty", E.flag(hit))


def mix_shift(stats: DataFrame, source: str, target: str, pct: float) -> DataFrame:
    """Mean cost and default rate before and after moving ``pct`` percent of all loans
    from one channel to another (no more than the source has)."""
    n = F.col("n_loans").cast("double")
    name = F.col("acquisition_channel")
    total = A.over_groups(F.sum("n_loans")).cast("double")
    available = F.coalesce(A.over_groups(F.sum(F.when(name == source, F.col("n_loans")))), F.lit(0)).cast("double")
    stats = stats.withColumn("__moved", F.least(total * (pct / 100.0), available))
    moved = F.col("__moved")
    after = n + F.when(name == source, -moved).when(name == target, moved).otherwise(0.0)
    frame = stats.withColumns({"__before": n, "__after": after})

    def mean(c: str, weight: str) -> Column:
        return E.ratio(F.sum(F.col(c) * F.col(weight)), F.sum(weight))

    return frame.agg(
        mean("avg_cac", "__before").alias("cac_before"), mean("avg_cac", "__after").alias("cac_after"),
        mean("default_rate_pct", "__before").alias("default_before_pct"),
        mean("default_rate_pct", "__after").alias("default_after_pct"),
    )
