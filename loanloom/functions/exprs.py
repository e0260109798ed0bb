"""Row-level column expressions: null-safe arithmetic, encodings, lending formulas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanloom import schema as S


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- null-safe arithmetic ---------------------------------------------------

def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, null when the divisor is zero or null."""
    return as_col(num) / F.nullif(as_col(den), F.lit(0))


def pct(num: Column | str, den: Column | str) -> Column:
    return ratio(as_col(num) * 100.0, den)


def clip(c: Column | str, lo: float, hi: float) -> Column:
    """Clamp to [lo, hi]; null stays null (``least``/``greatest`` would drop it)."""
    c = as_col(c)
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(hi)), F.lit(lo)))


def ratio_clip(num, den, lo: float, hi: float, default: float) -> Column:
    return F.coalesce(clip(ratio(num, den), lo, hi), F.lit(default))


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or null."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def encode(c: Column | str, mapping: Mapping, default) -> Column:
    """Look a value up in a fixed table; unknown and null give the default."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), as_col(c)), F.lit(default))


def decode(c: Column | str, mapping: Mapping, default: str = "Unknown") -> Column:
    """Inverse lookup: code to label."""
    return encode(as_col(c).cast("int"), {code: label for label, code in mapping.items()}, default)


# --- bands, periods ---------------------------------------------------------

def band(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval (edge, next edge]; outside gives null."""
    c = as_col(c)
    out = F.when(c <= edges[0], F.lit(None))
    for top, label in zip(edges[1:], labels):
        out = out.when(c <= top, F.lit(label))
    return out


def ticket_band(c: Column | str = "ticket_size") -> Column:
    return band(c, S.TICKET_EDGES, S.TICKET_LABELS)


def tenure_band(c: Column | str = "tenure_months") -> Column:
    return band(c, S.TENURE_EDGES, S.TENURE_LABELS)


def to_quarter(c: Column | str) -> Column:
    c = as_col(c)
    return F.concat(F.year(c).cast("string"), F.lit("Q"), F.quarter(c).cast("string"))


def to_month(c: Column | str) -> Column:
    return F.date_format(as_col(c), "yyyy-MM")


def month_name(c: Column | str) -> Column:
    return F.date_format(as_col(c), "MMM")


def festival_flag(due_date: Column | str = "due_date") -> Column:
    return flag(F.month(as_col(due_date)).isin(S.FESTIVAL_MONTHS))


# --- origination ------------------------------------------------------------

def is_ntc(score: Column | str = "bureau_score") -> Column:
    return flag(as_col(score) == 0)


def bureau_band(score: Column | str = "bureau_score") -> Column:
    s = as_col(score)
    return (
        F.when(s == 0, "NTC").when(s >= 750, "750+").when(s >= 700, "700-749")
        .when(s >= 650, "650-699").when(s >= 600, "600+").when(s.isNotNull(), "<600")
    )


def risk_grade(tier: Column | str, score: Column | str, near_prime_top: bool = False) -> Column:
    """Grade from tier and bureau score.

    A Near-Prime score of 700 or more falls back to ``B-`` unless
    ``near_prime_top`` asks for the intended ``B+``.
    """
    t, b = as_col(tier), bureau_band(score)
    top = F.lit("B+" if near_prime_top else "B-")
    prime = F.when(b == "750+", "A+").when(b == "700-749", "A").otherwise("A-")
    near = F.when(b == "650-699", F.lit("B")).when(b.isin("700-749", "750+"), top).otherwise("B-")
    sub = F.when(b == "600+", "C+").otherwise("C")
    return (
        F.when(t == "Prime", prime).when(t == "Near-Prime", near).when(t == "Subprime", sub)
        .otherwise("D")
    )


def emi(principal, apr, months, product) -> Column:
    """Monthly instalment: reducing balance, or straight line for BNPL and zero rates."""
    principal, apr, months = as_col(principal), as_col(apr), as_col(months)
    rate = apr / 12.0
    growth = F.pow(rate + 1.0, months)
    reducing = ratio(principal * rate * growth, growth - 1.0)
    charged = (apr > 0) & (as_col(product) != "BNPL")
    return F.round(F.when(charged, reducing).otherwise(ratio(principal, months)), 2)


def foir(emi_amount="emi_amount", income="monthly_income") -> Column:
    """Fixed obligation to income ratio, kept within 1% and 90%."""
    return F.round(clip(F.round(ratio(emi_amount, income), 3), 0.01, 0.90), 3)


# --- delinquency ------------------------------------------------------------

def dpd_bucket(dpd: Column | str = "dpd") -> Column:
    d = as_col(dpd)
    return (
        F.when(d == 0, "Current").when(d <= 30, "DPD_1-30").when(d <= 60, "DPD_31-60")
        .when(d <= 90, "DPD_61-90").when(d.isNotNull(), "DPD_90+")
    )


def sma_status(dpd: Column | str, is_default: Column | None = None) -> Column:
    d = as_col(dpd)
    status = (
        F.when(d > 90, "NPA").when(d > 30, "SMA-2").when(d > 0, "SMA-1")
        .when(d.isNotNull(), "Standard")
    )
    if is_default is None:
        return status
    return F.when(F.coalesce(is_default, F.lit(False)), "Defaulted").otherwise(status)


def due_date(origination: Column | str, installment: Column | str) -> Column:
    return F.date_add(as_col(origination), (as_col(installment) * 30).cast("int"))


def payment_date(due: Column | str = "due_date", dpd: Column | str = "dpd") -> Column:
    return F.date_add(as_col(due), as_col(dpd))


# --- value of a loan --------------------------------------------------------

def recovery(ticket, paid, rate, is_default) -> Column:
    amount = ((as_col(ticket) - as_col(paid)) * as_col(rate)).cast("int")
    return F.when(as_col(is_default) == 1, amount).otherwise(0)


def lgd(ticket, paid, rate, is_default) -> Column:
    lost = as_col(ticket) - as_col(paid) - recovery(ticket, paid, rate, is_default)
    return F.when(as_col(is_default) == 1, F.greatest(F.lit(0.0), lost)).otherwise(0.0)


def _margin(ticket, apr, tenure, fee, cac) -> Column:
    ticket = as_col(ticket)
    revenue = ticket * as_col(apr) * (as_col(tenure) / 12.0) + as_col(fee)
    return revenue - (as_col(cac) + ticket * 0.02)


def customer_ltv(ticket, apr, tenure, fee, cac, loss) -> Column:
    return F.round(_margin(ticket, apr, tenure, fee, cac) - as_col(loss), 2)


def risk_adjusted_return(ticket, apr, tenure, fee, cac, is_default) -> Column:
    expected = as_col(ticket) * 0.5 * as_col(is_default)
    return F.round(ratio(_margin(ticket, apr, tenure, fee, cac) - expected, ticket), 4)


def is_profitable(ltv: Column | str = "customer_ltv") -> Column:
    return flag(as_col(ltv) > 0)


# --- labels -----------------------------------------------------------------

def feature_category(name: Column | str) -> Column:
    """Group of a feature, by the first set of name fragments that matches."""
    out = None
    for label, marks in S.FEATURE_CATEGORY_MARKS:
        hit = as_col(name).rlike("|".join(marks))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(S.DEFAULT_FEATURE_CATEGORY)


def risk_bucket(p: Column | str = "pred_prob", amber: float = 0.20, red: float = 0.45) -> Column:
    p = as_col(p)
    return F.when(p >= red, "RED").when(p >= amber, "AMBER").otherwise("GREEN")


def verdict(metric: str, value: Column | str) -> Column:
    cuts, labels = S.VERDICTS[metric]
    out = None
    for cut, label in zip(cuts, labels):
        hit = as_col(value) > cut
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(labels[-1])


def gap_verdict(gap: Column | str) -> Column:
    return F.when(F.abs(as_col(gap)) < S.MAX_AUC_GAP, "Acceptable").otherwise("POSSIBLE OVERFIT")


def iv_strength(iv: Column | str) -> Column:
    v = as_col(iv)
    return F.when(v >= 0.3, "Strong").when(v >= 0.1, "Medium").when(v >= 0.02, "Weak").otherwise("Useless")
