"""Table schemas, value domains and fixed lookup tables of the lending model."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


S, I, D, DT = T.StringType(), T.IntegerType(), T.DoubleType(), T.DateType()

CUSTOMERS = _struct(
    ("customer_id", S), ("risk_tier", S), ("city", S), ("geo_tier", S), ("state", S),
    ("age", I), ("gender", S), ("employment_type", S), ("employment_stability_score", I),
    ("monthly_income", I), ("bureau_score", I), ("new_to_credit_flag", I),
    ("existing_customer", I), ("kyc_type", S),
)
LOANS = _struct(
    ("loan_id", S), ("customer_id", S), ("product_type", S), ("ticket_size", I),
    ("tenure_months", I), ("apr", D), ("processing_fee", I), ("emi_amount", D),
    ("origination_date", DT), ("origination_risk_grade", S), ("acquisition_channel", S),
    ("cost_of_acquisition", I), ("approval_turnaround_days", I), ("cooling_off_exit", I),
)
REPAYMENTS = _struct(
    ("repayment_id", S), ("loan_id", S), ("customer_id", S), ("installment_no", I),
    ("due_date", DT), ("payment_date", DT), ("emi_due", D), ("amount_paid", D),
    ("payment_status", S), ("dpd", I), ("dpd_bucket", S), ("loan_status", S), ("is_defaulted", I),
)
SIGNALS = _struct(
    ("signal_id", S), ("loan_id", S), ("customer_id", S), ("month", I),
    ("cash_flow_consistency", D), ("balance_volatility", D), ("income_shock_flag", I),
    ("spending_shock_flag", I), ("avg_monthly_inflow", I), ("emi_obligation_ratio", D),
    ("active_loan_accounts", I),
)
OUTCOMES = _struct(
    ("loan_id", S), ("customer_id", S), ("final_loan_status", S), ("default_flag", I),
    ("max_dpd", I), ("total_amount_paid", D), ("recovery_amount", I), ("loss_given_default", D),
    ("customer_ltv", D), ("risk_adjusted_return", D), ("is_profitable", I),
)
TABLES = {
    "customers": CUSTOMERS, "loans": LOANS, "repayments": REPAYMENTS,
    "signals": SIGNALS, "outcomes": OUTCOMES,
}

# --- Fixed values -----------------------------------------------------------
# The lists, tables and thresholds from here on are facts of the lending model;
# results are only right when they hold exactly these values.

TIERS = ["Prime", "Near-Prime", "Subprime", "Thin-File"]
GRADES = ["A+", "A", "A-", "B", "B-", "C+", "C", "D"]
EMPLOYMENT_TYPES = [
    "Salaried-Govt", "Salaried-Private", "Self-Employed-Prof", "Self-Employed-Business",
    "Gig-Worker", "Daily-Wage", "Unemployed", "Student",
]
DPD_BUCKETS = ["Current", "DPD_1-30", "DPD_31-60", "DPD_61-90", "DPD_90+"]
RISK_BUCKETS = ["GREEN", "AMBER", "RED"]
FESTIVAL_MONTHS = [4, 10, 11]

BUCKET_ORDINAL = {"Current": 0, "DPD_1-30": 1, "DPD_31-60": 2, "DPD_61-90": 3, "DPD_90+": 4}
STATUS_ORDINAL = {"Standard": 0, "SMA-1": 1, "SMA-2": 2, "NPA": 3, "Defaulted": 4}
TIER_ORDINAL = {"Prime": 0, "Near-Prime": 1, "Subprime": 2, "Thin-File": 3}
GRADE_ORDINAL = {
    "A+": 0, "A": 1, "A-": 2, "B+": 3, "B": 4, "B-": 5, "C+": 6, "C": 7, "D": 8,
}
CHANNEL_RISK = {
    "Organic-App": 0.0, "Referral": 0.0, "Bank-Partnership": 1.0, "Corporate-Tie-Up": 1.0,
    "NBFC-Embedded": 1.5, "DSA-Agent": 2.0, "Paid-Digital": 2.0,
}
EMPLOYMENT_RISK = {
    "Salaried-Govt": 0, "Salaried-Private": 1, "Self-Employed-Prof": 2, "Corporate-Tie-Up": 2,
    "Self-Employed-Business": 3, "Gig-Worker": 4, "Daily-Wage": 5, "Student": 5, "Unemployed": 6,
}
PRODUCT_RISK = {
    "Personal-Loan": 1.0, "Education-Loan": 0.8, "Two-Wheeler-Loan": 1.0,
    "Consumer-Durable": 1.2, "SME-Working-Capital": 1.5, "BNPL": 2.0,
}
GENDER_CODE = {"Male": 0, "Female": 1, "Other": 2}

TICKET_EDGES = [0, 25000, 50000, 100000, 200000, 500000, 2000000]
TICKET_LABELS = ["<25K", "25-50K", "50-100K", "100-200K", "200-500K", "500K+"]
TENURE_EDGES = [0, 3, 6, 12, 24, 36, 48, 60]
TENURE_LABELS = ["1-3M", "4-6M", "7-12M", "13-24M", "25-36M", "37-48M", "49-60M"]

REPAYMENT_FEATURES = [
    "missed_payment_last_3m", "late_payment_last_3m", "partial_payment_flag",
    "payment_ratio_last_month", "max_dpd_last_3m", "dpd_trend_slope", "consecutive_missed",
    "months_no_on_time", "dpd_bucket_encoded", "is_festival_month", "sma_encoded",
    "sma_trend", "max_sma_last_3m",
]
SIGNAL_FEATURES = [
    "rolling_30d_balance_volatility", "volatility_acceleration", "cash_flow_trend",
    "income_shock_flag_3m", "income_shock_count", "spending_shock_flag_3m", "both_shocks_flag",
    "avg_emi_obligation_ratio", "min_cash_flow_3m", "inflow_trend", "active_loan_accounts",
]
ORIGINATION_FEATURES = [
    "bureau_score", "monthly_income", "employment_stability_score", "new_to_credit_flag",
    "existing_customer", "risk_tier_encoded", "grade_encoded", "channel_risk_score",
    "employment_risk", "product_risk", "apr", "tenure_months", "ticket_size",
    "emi_to_income_ratio", "ticket_to_income_ratio", "processing_fee_pct",
    "approval_turnaround_days", "months_since_origination",
]
FEATURES = REPAYMENT_FEATURES + SIGNAL_FEATURES + ORIGINATION_FEATURES

SCORECARD_COLUMNS = [
    "loan_id", "installment_no", "risk_bucket", "pred_prob", "target",
    "missed_payment_last_3m", "late_payment_last_3m", "dpd_trend_slope", "max_dpd_last_3m",
    "sma_encoded", "rolling_30d_balance_volatility", "both_shocks_flag",
    "income_shock_flag_3m", "cash_flow_trend", "bureau_score", "risk_tier_encoded",
    "grade_encoded", "emi_to_income_ratio", "payment_ratio_last_month",
]

FEATURE_CATEGORY_MARKS = [
    ("Repayment Behavioral", [
        "missed_", "late_", "partial_", "payment_ratio", "max_dpd", "dpd_trend",
        "consecutive_", "months_no_", "dpd_bucket", "is_festival", "sma_",
    ]),
    ("Bank Behavioral", [
        "rolling_30d", "volatility_acc", "cash_flow", "income_shock", "spending_shock",
        "both_shocks", "emi_obligation", "min_cash_flow", "inflow_trend", "active_loan",
    ]),
]
DEFAULT_FEATURE_CATEGORY = "Origination"

# bucket, label, first action, second action, third action, contact, urgency, escalation
INTERVENTIONS = [
    ("GREEN", "Low Risk — Standard Portfolio",
     "Monthly auto-debit confirmation + e-statement",
     "Cross-sell eligibility check (top-up loans)",
     "Loyalty reward nudge for long-term customers",
     "None (digital only)", "Routine", "1 missed payment → auto-move to AMBER"),
    ("AMBER", "Medium Risk — Proactive Intervention",
     "Proactive WhatsApp/SMS reminder 7 days before due date",
     "IVR call 3 days before due date",
     "Offer EMI date change or 1-month moratorium",
     "Digital + 1 phone call", "HIGH — act in 7 days",
     "Missed payment → immediate RED escalation"),
    ("RED", "High Risk — Collections Escalation",
     "Immediate collections call within 24 hours of flag",
     "Restructuring / settlement offer if DPD already > 0",
     "Legal notice prep + NPA provisioning (ticket > ₹50K)",
     "Direct call + field visit", "CRITICAL — act in 24 hrs",
     "DPD crosses 30 → NPA provisioning + recovery team"),
]

# metric, excellent from, good from, moderate from, labels best to worst (strict >)
VERDICTS = {
    "auc": ([0.85, 0.75, 0.65], ["Excellent", "Good", "Moderate", "Needs improvement"]),
    "gini": ([60, 40, 25], [
        "Strong (production-ready)", "Good (suitable for EWS)",
        "Moderate (further tuning recommended)", "Weak"]),
    "ks": ([50, 35, 20], ["Excellent", "Good", "Moderate", "Weak"]),
}
MAX_AUC_GAP = 0.05

# kpi, better direction, green limit, red limit
KPI_THRESHOLDS = [
    ("default_rate_pct", "low", 9.0, 12.0),
    ("collection_efficiency_pct", "high", 99.5, 98.0),
    ("profitable_pct", "high", 72.0, 68.0),
    ("avg_ltv", "high", 30000.0, 25000.0),
]
# kpi, operator that raises the flag, limit
ORIGINATION_LIMITS = [
    ("paid_digital_share_pct", ">=", 20.0),
    ("referral_organic_share_pct", "<=", 40.0),
    ("max_channel_exit_pct", ">", 7.0),
    ("subprime_share_pct", ">", 25.0),
    ("avg_turnaround_days", ">=", 2.0),
]
WARNING_LIMITS = [
    ("red_share_pct", ">", 70.0),
    ("red_delinquency_pct", ">", 10.0),
    ("co_shock_pct", ">", 1.5),
    ("dpd_1_30_roll_pct", ">", 8.7),
    ("cash_flow_fall", ">", 0.05),
]
# channel, basis points low, basis points high
APR_ADJUSTMENT_BPS = [
    ("Referral", 0, 0), ("Organic-App", 10, 20), ("Corporate-Tie-Up", 20, 30),
    ("Bank-Partnership", 20, 30), ("NBFC-Embedded", 25, 35), ("DSA-Agent", 50, 75),
    ("Paid-Digital", 75, 100),
]
# product, tier (None = any), longest tenure in months
TENURE_CAPS = [
    ("BNPL", "Subprime", 18), ("Consumer-Durable", "Subprime", 18),
    ("Personal-Loan", "Near-Prime", 36), ("Personal-Loan", "Subprime", 24),
    ("SME-Working-Capital", None, 18), ("Education-Loan", None, 60),
]
# tier, largest ticket
TICKET_CAPS = [
    ("Prime", 300000), ("Near-Prime", 150000), ("Subprime", 75000), ("Thin-File", 30000),
]
LOW_RISK_TIERS = ["Prime", "Near-Prime"]
HIGH_RISK_TIERS = ["Subprime", "Thin-File"]
LOW_RISK_CHANNELS = ["Referral", "Organic-App"]
HIGH_RISK_CHANNELS = ["DSA-Agent", "Paid-Digital"]
