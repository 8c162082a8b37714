"""What the findings on long and wide runs asked for: positions once, narrow journals, few snapshot rows."""

from __future__ import annotations

from datetime import date
from decimal import Decimal as D

from test_partitions import SF_DIR, plan_of

from recogna.operators import journal as J
from recogna.operators import reports as R
from recogna.operators import waterfall as W
from recogna.sources.fiscal import FiscalCalendar

POSITIONS = "rc_id long, prod_ctgry string, net_value decimal(18,2), net_unbilled decimal(18,2)"
LINES = "rc_id long, line_id string, prod_ctgry string, unbilled_acct string, liability_acct string, f_cur string, f_ex_rate decimal(6,2)"


def _journal(spark):
    net = [
        (1, "Training", 5, 5), (1, "Marketing", -3, -3), (2, "Training", 5, 4), (2, "License - Term", 2, 0), (2, "License - Perpetual", -2, 7),
        (3, "Training", 4, None), (4, "Training", 6, 1), (4, "Marketing", 0, 5), (None, "Training", 6, 1), (5, None, 6, 1), (6, "Training", 1, 9), (6, "Training", 1, 9),
    ]
    net = spark.createDataFrame([(r, c, D(a), None if b is None else D(b)) for r, c, a, b in net], POSITIONS)
    lines = [(r, f"{r}-{i}", c, f"U-{i}" if i else None, f"L-{i}", "C1", D("1.5")) for r in (1, 2, 3, 4, 5, 6, None) for i, c in enumerate(("Training", "Marketing", "License - Term", "Training", None))]
    return net, spark.createDataFrame(lines, LINES)


def test_consistency_comes_from_the_same_pass(spark):
    net, lines = _journal(spark)
    plain = J.journal_lines(net, lines, "U-CONST")
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    marked = J.journal_lines(net, lines, "U-CONST", consistency=True)
    assert rows(marked) == rows(J.mark_consistency(plain, net)) and marked.columns == [*plain.columns, "consistent"]
    assert {(r["rc_id"], r["consistent"]) for r in marked.collect()} == {(1, None), (2, "N"), (3, None), (4, "N"), (6, "N")}
    assert plan_of(spark, "journal_consistency").count("Window [") == 2  # contract totals, consistency; positions are made once


def test_journal_report_shuffles_no_accounts(spark):
    net, lines = _journal(spark)
    sides = J.journal_lines(net, lines, "U-CONST").where("side = 'DR'").select("rc_id", "side", "activity", "amount")
    assert "unbilled_acct" not in sides._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD")[0]
    assert "min_by" not in plan_of(spark, "journal_report")


def test_report_leaves_other_contracts_lines_out_first(spark):
    heads = spark.createDataFrame([(1, 202401), (2, 202402), (3, None)], "header_id int, prd_id int")
    filters = [R.ReportFilter("prd_id", 202401, "BETWEEN", 202401), R.ReportFilter("side", "DR"), R.ReportFilter("prd_id", None)]
    assert [r["header_id"] for r in R.of_heads(heads, filters).collect()] == [1]
    assert plan_of(spark, "journal_report").count("LeftSemi") >= 2


def test_entries_that_say_nothing_are_not_summed(spark):
    day = (date(2024, 1, 5), date(2024, 3, 9))
    custom = spark.createDataFrame([("a", 1, 202402, D(9), *day), ("b", 1, 202403, D(5), *day), ("c", 1, 202402, None, *day)], "line_id string, org int, prd_id int, amount decimal(18,2), first_date date, last_date date")
    entries = spark.createDataFrame(
        [("a", 202401, D(4), "B", False), ("a", 202402, D(2), "A", True), ("a", 202401, D(1), "R", None), ("b", 202402, D(3), "R", False), ("b", None, D(1), "B", False), ("c", 202402, D(1), "R", True)],
        "line_id string, prd_id int, amount decimal(18,2), schd_type string, counted boolean",
    )
    out = W.snapshot_rows(custom, entries, FiscalCalendar.months(202301, 202512), 202402, 202402)
    assert "Filter (counted" in out._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r["line_id"], r["rev_type"], r["prd_id"], int(r["amount"])) for r in out.collect())
    a = [("a", "NO", 202402, 9), ("a", "OOH", 202401, 0), ("a", "OOH", 202402, 7), ("a", "OOH", 202403, 0), ("a", "REV", 202402, 2)]
    assert got == a + [("b", "NO", 202403, 5), ("b", "OOH", 202401, 0), ("b", "OOH", 202402, 0), ("b", "OOH", 202403, 5)]
