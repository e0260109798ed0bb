"""Named queries against DuckDB on the driver's tables.

A spread of queries runs by default; LOANLOOM_ALL_QUERIES=1 runs every one.
"""

from __future__ import annotations

import math
import os
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = os.environ.get("LOANLOOM_TEST_DATA", "/root/testdata/sf0.001")
QUERIES, ORACLE = driver.queries(), driver.oracle_sql()
DEFAULT = [
    "src1_typed_scan", "src4_metrics_read", "snk1_write_table", "exp3_emi", "exp8_foir", "exp18_build_outcomes", "jn2_master",
    "jn6_match_rate", "jn7_adaptive_key", "jn10_reindex", "win4_latest_per_loan", "fe5_payment_ratio", "fe17_inflow_trend",
    "fe18_origination_encodings", "imp3_panel_median_fill", "pan1_panel", "agg2_collection_efficiency", "agg3_segment_stats",
    "agg6_product_stats", "agg11_monthly_kpis", "agg16_employment_tier_pivot", "spl1_stratified_split", "ev1_roc_points",
    "ev2_auc", "ev6_youden", "ev8_classification_report", "sc3_scorecard_summary", "sc5_tier_bucket_rates", "st1_roll_rates",
    "st2_information_value", "st3_cramers_v", "st5_kruskal", "st12_lgd_by_grade", "pol3_ews_flags", "pol5_approval_stance",
]
OWN = [n for n in ORACLE if not re.match(r"op\d+_", n)]  # the optional package has its own tests
NAMES = sorted(OWN) if os.environ.get("LOANLOOM_ALL_QUERIES") else DEFAULT

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return None if value is None else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == table(columns, cursor.fetchall())


def test_every_inventory_entry_has_a_query():
    """Operators of the inventory by family; PRJ3 and the like do not exist."""
    families = {"src": 4, "snk": 5, "prj": 2, "flt": 6, "jn": 11, "win": 5, "lbl": 1, "fe": 22, "imp": 4, "pan": 1, "exp": 18,
                "agg": 24, "srt": 2, "top": 1, "rnk": 1, "smp": 2, "spl": 1, "set": 1, "ml": 3, "ev": 11, "expl": 4, "sc": 8,
                "st": 19, "pol": 11}
    have = {found.group() for n in QUERIES if (found := re.match(r"[a-z]+\d+", n))}
    missing = [f"{f}{i}" for f, n in families.items() for i in range(1, n + 1) if f"{f}{i}" not in have]
    assert missing == []
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[0] == "risk_tier" and df.count() == 4
