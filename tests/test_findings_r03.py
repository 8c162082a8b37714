"""What the findings of the third round asked for: rows are shuffled once, narrow, and read once."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F
from test_partitions import SF_DIR, plan_of

from recogna.functions.skew import attach, marked
from recogna.operators import contracts as C
from recogna.operators import journal as J
from recogna.operators import reports as R
from recogna.operators import schedules as S
from recogna.operators import waterfall as W
from recogna.operators.run_state import RunState
from recogna.plans import base_queries, catalog
from recogna.session import cut
from recogna.sources.fiscal import FiscalCalendar

CALENDAR = FiscalCalendar.months(202401, 202512)


def test_totals_of_the_same_keys_share_the_shuffle_of_the_rows(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(40).select((F.col("id") % 3).alias("k"), "id")
        totals = [rows.groupBy("k").agg(F.sum("id").alias(f"t{i}")) for i in range(2)]
        out = attach(attach(marked(rows, ["k"]), totals[0], ["k"], premarked=True), totals[1], ["k"], premarked=True)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning\(k#\d+L, _key_hash", plan)) == 3  # the rows, and each total
        assert out.where("t0 <> t1").isEmpty() and out.count() == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["waterfall_sources", "waterfall_with_forecast", "waterfall_quarter_to_date"])
def test_lines_of_quarter_to_date_waterfalls_are_dealt_while_narrow(spark, name):
    shuffles = [x for x in plan_of(spark, name).split("\n") if re.search(r"Exchange hashpartitioning\((root_line_id|line_id)", x)]
    assert shuffles and all("REPARTITION_BY_COL" in x for x in shuffles)


def test_several_waterfalls_in_one_pass(spark):
    rows = spark.createDataFrame(
        [("a", 1, 202405, "R", "A", 5, 50), ("a", 1, 202406, "R", "A", 7, 70), ("a", 1, 202406, "R", "F", 1, 10), ("b", None, 202404, "R", "A", 2, 20), ("c", 3, 202406, "X", "A", 9, 90)],
        "root_line_id string, rc_id int, prd_id int, acct_type_id string, src string, x int, y int",
    )
    asked = [("one", F.col("src") == "A", "x", 202406, "A"), ("two", F.col("rc_id").isNotNull(), "y", 202405, "AF")]
    arguments = [{"run_prd": run, "end_prd": 202412, "n_prior": 1, "max_months": 3, "kind": "Revenue", "mode": mode, "calendar": CALENDAR} for _, _, _, run, mode in asked]
    got = R.waterfalls_qtd(rows, [(name, of, c, a) for (name, of, c, _, _), a in zip(asked, arguments)], ("qtd_amount", "total"))
    want = [
        (name, r["root_line_id"], r["rc_id"], r["qtd_amount"], r["total"])
        for (name, of, c, _, _), a in zip(asked, arguments)
        for r in R.waterfall_qtd(rows.where(of), amount=c, **a).collect()
    ]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr) and len(want) == 3


def test_rows_of_several_periods_come_from_their_sources(spark):
    live = spark.createDataFrame([("a", 1), ("b", 2)], "root_line_id string, amount int")
    frozen = spark.createDataFrame([("a", 9, 202404), (None, 8, 202404), ("z", 7, 202405)], "root_line_id string, amount int, run_prd int")
    log = spark.createDataFrame([("WF_PERIOD_END", "COMPLETED", 202404), ("WF_PERIOD_END", "COMPLETED", 202403), ("WF_PERIOD_END", "FAILED", 202405)], "process string, status string, run_prd int")
    runs = [202403, 202404, 202405]
    several = W.of_periods(live, frozen, log, runs)
    for run in runs:
        own = several.where(F.array_contains("runs", run)).drop("runs")
        assert sorted(map(tuple, own.collect()), key=repr) == sorted(map(tuple, W.of_period(live, frozen, log, run).collect()), key=repr)


def test_entries_of_no_journal_stay_out_of_the_join(spark):
    entries = spark.createDataFrame([(1, 7, "NAA"), (2, None, "NBB"), (3, 8, "NCC"), (3, 8, "NCC")], "line_id int, je_id int, indicators string")
    heads = spark.createDataFrame([(7,), (7,), (None,)], "je_id int")
    out = J.mark_interfaced(entries, heads)
    assert sorted((r["line_id"], r["indicators"]) for r in out.collect()) == [(1, "YAA"), (2, "NBB"), (3, "NCC"), (3, "NCC")]
    assert "isnull(je_id" in out._jdf.queryExecution().optimizedPlan().toString()  # a branch of their own


def test_period_sums_are_made_once(spark, monkeypatch):
    plans = []
    write = base_queries.sinks.write_snapshot
    monkeypatch.setattr(base_queries.sinks, "write_snapshot", lambda df, *a: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, *a))
    catalog.QUERIES["period_snapshot"](spark, SF_DIR)
    assert len(plans) == 4 and not any("l_orderkey" in p for p in plans)


def test_revision_reads_its_lines_once(spark):
    day = date
    lines = spark.createDataFrame(
        [("a", day(2024, 1, 1), day(2024, 12, 30), 365, 10), ("b", day(2024, 1, 1), day(2024, 3, 31), 91, 0), ("c", day(2024, 1, 1), day(2024, 3, 31), None, 0), ("d", day(2024, 6, 1), day(2024, 8, 31), -92, -92)],
        "line_id string, start_date date, end_date date, amount int, scheduled int",
    ).withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("amount", "scheduled")})
    out = S.recognize_prospective(lines, CALENDAR, 202406)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    got = sorted((r["line_id"], r["prd_id"], float(r["rel_amt"]), r["part"]) for r in out.collect())
    assert [g for g in got if g[0] != "a"] == [("b", 202406, 91.0, "CATCH-UP"), ("d", 202406, 62.0, "CATCH-UP"), ("d", 202407, -31.0, "REMAINDER"), ("d", 202408, -31.0, "REMAINDER")]
    assert [g[1:] for g in got if g[0] == "a"][:2] == [(202406, 172.0, "CATCH-UP"), (202407, 31.0, "REMAINDER")] and sum(g[2] for g in got if g[0] == "a") == 355


def test_invoices_are_dealt_once_for_all_levels(spark, monkeypatch):
    day = date(2024, 1, 1)
    bills = spark.createDataFrame(
        [("INV", i, f"I{i}", f"I{i // 2}" if i > 1 else None, day, day) for i in range(1, 9)] + [("INV", 8, "I8", "I4", day, day), ("INV", 9, None, "I1", day, day), ("INV", 1, "I1", "I8", day, day)],
        "type string, rc_id int, doc_num string, orig_doc_num string, start_date date, end_date date",
    )
    seeds = spark.createDataFrame([(8, 8, "I4", day)], "seed_id int, rc_id int, orig_doc_num string, start_date date")
    levels = []
    monkeypatch.setattr(C, "cut", lambda df: levels.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sorted((r["doc_num"], r["orig_doc_num"], r["depth"]) for r in C.lineage(bills, seeds).collect() if r["orig_doc_num"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [("I1", "I8", 3), ("I2", "I1", 2), ("I4", "I2", 1), ("I8", "I4", 4)]
    followed = [p.split("InMemoryTableScan")[0].rstrip().split("\n")[-3:] for p in levels]
    assert len(levels) == 5 and all("InMemoryTableScan" in p for p in levels) and not any("Exchange" in x or "Sort [" in x for tail in followed for x in tail)


def test_first_run_and_account_sums_shuffle_no_lines(spark, tmp_path):
    lines = spark.createDataFrame([("a", 1, 5, None), ("b", 2, None, None)], "line_id string, rc_id long, value int, updated_at timestamp")
    first = RunState(spark, str(tmp_path), "P").due(lines)
    assert "hashpartitioning(line_id" not in first._jdf.queryExecution().executedPlan().toString()
    assert [(r["line_id"], r["reason"]) for r in first.collect()] == [("a", "CHANGED")] and first.columns == [*lines.columns, "reason"]
    assert "hashpartitioning(line_id" not in plan_of(spark, "insight_totals")
