"""Bucketed storage, shared portfolio and checked CSV reading."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import fixtures as D
from loanloom.operators import features as X
from loanloom.operators import joins as J
from loanloom.operators.aggregates import loan_rollup
from loanloom.operators.ordered import ordered_groups
from loanloom.sources import tables as IO


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def layout(spark, tmp_path):
    names = [*IO.BUCKETED_READS, "spark.sql.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    kept = IO.lending_layout(D.repayments(spark), D.signals(spark), D.loans(spark), str(tmp_path), "test_layout", buckets=4)
    yield kept
    for name in ("repayments", "signals", "loans"):
        spark.sql(f"DROP TABLE test_layout_{name}")
    for name, value in before.items():
        spark.conf.set(name, value)


def test_lags_over_bucketed_rows_need_no_shuffle(spark, layout):
    def lags(rows):
        g = ordered_groups(rows.select("loan_id", "installment_no", "dpd"), "loan_id", ["installment_no"], 2)
        return g.finish(g.frame.withColumn("dpd_2m", X.lag0("dpd", 2, g.window())))

    stored, plain = lags(layout["repayments"]), lags(D.repayments(spark))
    assert "Exchange" not in plan(stored) and "Exchange" in plan(plain)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, plain.collect()))


def test_panel_joins_over_bucketed_rows_need_no_shuffle(spark, layout):
    def joined(rep, sig, loans):
        obs = rep.select("loan_id", "installment_no", "dpd")
        monthly = J.attach_signals(obs, sig.select("loan_id", "month", "cash_flow_consistency"), mode="month")
        return J.attach_origination(monthly, loans.select("loan_id", "ticket_size"))

    stored = joined(layout["repayments"], layout["signals"], layout["loans"])
    plain = joined(D.repayments(spark), D.signals(spark), D.loans(spark))
    assert "Exchange" not in plan(stored) and plan(stored).count("SortMergeJoin") == 2
    assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect()))


def test_portfolio_is_built_once_until_its_files_change(spark, tmp_path, monkeypatch):
    frames = {"customers": D.customers(spark), "loans": D.loans(spark), "repayments": D.repayments(spark), "signals": D.signals(spark)}
    outcomes = J.build_outcomes(frames["loans"], loan_rollup(frames["repayments"]), frames["loans"].select("loan_id", F.lit(0.5).alias("recovery_rate")))
    folder = str(tmp_path)
    IO.write_artifacts({**frames, "outcomes": outcomes}, folder)
    built, assemble = [], IO.assemble
    monkeypatch.setattr(IO, "assemble", lambda *a, **b: built.append(1) or assemble(*a, **b))
    first = IO.shared_portfolio(spark, folder)
    n = first.active.count()
    assert IO.shared_portfolio(spark, folder) is first and len(built) == 1 and first.active.is_cached
    IO.write_table(D.loans(spark).limit(1), f"{folder}/loans")
    second = IO.shared_portfolio(spark, folder)
    assert second is not first and len(built) == 2 and not first.active.is_cached
    assert second.active.count() <= 1 <= n
    assert IO.release_portfolio(spark, folder) and not second.active.is_cached
    assert not IO.release_portfolio(spark, folder)


def test_broken_lines_are_rejected_with_their_reason(spark, tmp_path):
    lines = ["id,day,amount,note", "1,2021-01-02,1.5,fine", "2,2021-13-02,1.5,no such month", "3,2021-01-02,x,no number", '4,2021-01-02,2.5,"a, b"',
             "5,2021-01-02", "6,2021-01-02,2.5,n,extra", '7,2021-01-02,2.5,"open', "", "8,,,", "x,never,y,three", "9,2021-01-02,NaN,n"]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    (tmp_path / "b.csv").write_text("id,day,amount,note\n10,2021-02-03,3.5,z\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("day", T.DateType()), T.StructField("amount", T.DoubleType()),
                           T.StructField("note", T.StringType())])
    good, rejects = IO.read_csv_checked(spark, str(tmp_path), schema)
    day = datetime.date(2021, 1, 2)
    assert good.schema == schema
    assert {tuple(r) for r in good.collect()} == {(1, day, 1.5, "fine"), (4, day, 2.5, "a, b"), (8, None, None, None), (9, day, None, "n"),
                                                  (10, datetime.date(2021, 2, 3), 3.5, "z")}
    assert {r.record: r.reason for r in rejects.collect()} == {
        lines[2]: "day", lines[3]: "amount", lines[5]: "columns", lines[6]: "columns", lines[7]: "quote", lines[10]: "id,day,amount"}
    assert good.count() + rejects.count() == len([x for x in lines[1:] if x]) + 1
