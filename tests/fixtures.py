"""Small lending frames that contain the awkward rows."""

from __future__ import annotations

import datetime as dt

from loanloom import schema as S


def day(n: int) -> dt.date:
    return dt.date(2021, 1, 15) + dt.timedelta(days=30 * n)


def repayments(spark):
    rows = []
    plan = {
        "L1": [0, 10, 35, 65, 95, 120, 0],     # long loan that defaults and comes back
        "L2": [0],                             # one instalment
        "L3": [0, 0, 0, 0, 45, 0],             # label turns 1 at instalment 4
        "L4": [5, None, 5, 5, 5],              # a null inside a lagged column, and a gap in numbers
    }
    status = ["Paid-On-Time", "Late-1-30", "Late-31-60", "Partial", "Missed"]
    bucket = {0: "Current", 10: "DPD_1-30", 5: "DPD_1-30", 35: "DPD_31-60", 45: "DPD_31-60",
              65: "DPD_61-90", 95: "DPD_90+", 120: "DPD_90+", None: "Odd-Bucket"}
    for loan, dpds in plan.items():
        for i, dpd in enumerate(dpds, start=1):
            number = i + 1 if loan == "L4" and i > 2 else i
            due = {2: 0.0, 3: None}.get(number, 100.0)
            sma = "NPA" if (dpd or 0) > 90 else "SMA-1" if dpd else "Standard"
            rows.append((f"R{len(rows)}", loan, "C1", number, day(number), day(number), due, 80.0 if i % 2 else 120.0,
                         status[(i + len(loan)) % 5] if dpd else "Paid-On-Time", dpd, bucket[dpd], sma,
                         int((dpd or 0) == 120)))
    return spark.createDataFrame(rows, S.REPAYMENTS)


def signals(spark):
    rows = []
    for loan, n in {"L1": 6, "L2": 1, "L3": 4}.items():
        for m in range(1, n + 1):
            inflow = 0 if (loan, m) == ("L1", 2) else 1000 + 100 * m
            vol = None if (loan, m) == ("L1", 3) else 0.1 * m
            rows.append((f"S{len(rows)}", loan, "C1", m, 0.9 - 0.1 * m, vol, m % 2, int(m == 2), inflow, 0.1 * m, m))
    return spark.createDataFrame(rows, S.SIGNALS)


def customers(spark):
    rows = [
        ("C1", "Prime", "X", "Metro", "S", 30, "Male", "Salaried-Govt", 8, 50000, 760, 0, 1, "Video-KYC"),
        ("C2", "Near-Prime", "X", "Tier-2", "S", 40, "Female", "Gig-Worker", 4, 0, 720, 0, 0, "Physical"),
        ("C3", None, "Y", "Tier-3", "S", 25, "Other", "Circus", None, None, 0, 1, 0, "Aadhaar-OTP"),
    ]
    return spark.createDataFrame(rows, S.CUSTOMERS)


def loans(spark):
    rows = [
        ("L1", "C1", "Personal-Loan", 25000, 12, 0.12, 500, 2221.22, day(0), "A+", "Referral", 400, 1, 0),
        ("L2", "C2", "BNPL", 50000, 3, 0.24, 1000, 16666.67, day(0), "B-", "Paid-Digital", 2300, 0, 0),
        ("L3", "C3", "Gold-Loan", 100000, 36, 0.0, 9000, 2777.78, day(1), "Z", "Walk-In", 900, 2, 0),
        ("L4", "C1", "Education-Loan", 2000000, 60, 0.10, 0, 42494.09, day(2), "C", "DSA-Agent", 1500, 5, 0),
        ("L5", "C1", "BNPL", 25001, 6, 0.2, 100, 4166.83, day(2), "D", "Referral", 420, 0, 1),   # cooling-off
        ("L6", "C9", "BNPL", 1000, 6, 0.2, 100, 166.67, day(2), "D", "Referral", 420, 0, 0),     # no customer, no repayments
    ]
    return spark.createDataFrame(rows, S.LOANS)
