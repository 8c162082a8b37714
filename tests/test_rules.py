"""Report sources and totals, posting periods, and regrouping by rule."""

from dataclasses import replace
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from recogna.operators import contracts as C
from recogna.operators import journal as J
from recogna.operators import reports as R
from recogna.operators import waterfall as W
from recogna.sources.calendar import month_calendar, ranked_quarters
from recogna.sources.fiscal import FiscalCalendar

CAL = FiscalCalendar.months(202301, 202712)
ROWS = "root_line_id string, rc_id long, prd_id int, acct_type_id string, src string, t_at decimal(18,2), f_at decimal(18,2)"


def qtd_rows(spark, *rows):
    return spark.createDataFrame([(a, 1, p, "R", s, D(t), D(2 * t)) for a, p, s, t in rows], ROWS)


@pytest.mark.parametrize(("run", "status", "expected"), [(202405, "COMPLETED", "old"), (202405, "FAILED", "live"), (202404, "COMPLETED", "live")])
def test_closed_periods_show_what_was_frozen(spark, run, status, expected):
    live = qtd_rows(spark, ("live", run, "A", 5))
    frozen = qtd_rows(spark, ("old", 202405, "A", 3)).withColumn("run_prd", F.lit(202405))
    log = spark.createDataFrame([("WF_PERIOD_END", status, run), ("OTHER", "COMPLETED", 202405)], "process string, status string, run_prd int")
    got = W.of_period(live, frozen, log, run)
    assert got.columns == live.columns and [r["root_line_id"] for r in got.collect()] == [expected]


def test_quarter_to_date_in_currencies_and_modes(spark):
    rows = qtd_rows(spark, ("a", 202404, "A", 1), ("a", 202405, "A", 2), ("a", 202406, "A", 4), ("a", 202407, "A", 8), ("a", 202407, "F", 16), ("a", 202402, "A", 32), ("b", 202406, "F", 64))
    one = lambda **k: {r["root_line_id"]: r for r in R.waterfall_qtd(rows, 202406, 202409, 2, 6, "Revenue", calendar=CAL, **k).collect()}
    t = one(amount="t_at")["a"]
    assert (t["prior_amount"], t["p202404"], t["p202405"], t["qtd_amount"], t["p202407"], t["total"]) == (32, 1, 2, 7, 8, 15)
    assert one(amount="f_at")["a"]["total"] == 30
    both = one(amount="t_at", mode="AF")
    assert both["a"]["p202407"] == 24 and both["b"]["total"] == 64 and both["b"]["qtd_amount"] == 0
    forecast = one(amount="t_at", mode="F")
    assert "prior_amount" not in R.waterfall_qtd(rows, 202406, 202409, 2, 6, "Revenue", mode="F", amount="t_at").columns
    assert forecast["a"]["p202407"] == 16


def test_quarters_are_the_calendars(spark):
    weeks = FiscalCalendar.weeks(date(2023, 1, 2), 2023, 2, (4, 4, 5))
    rows = qtd_rows(spark, ("a", 202306, "A", 1), ("a", 202307, "A", 2), ("a", 202308, "A", 4))
    got = R.waterfall_qtd(rows, 202308, 202308, 1, 6, "Revenue", amount="t_at", calendar=weeks).collect()[0]
    assert (got["prior_amount"], got["p202307"], got["qtd_amount"]) == (1, 2, 6)
    ranked = {r["rnk"]: r["quarter_id"] for r in ranked_quarters(month_calendar(spark, 202301, 202612), 202406, 202612).collect()}
    assert ranked[1] == 20242 and ranked[8] == 20261 and max(ranked) == 11


def test_grand_total_comes_from_one_pass(spark, tmp_path):
    qtd_rows(spark, ("a", 202406, "A", 4), ("b", 202406, "A", 5), ("b", 202407, "A", 6)).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    out = R.waterfall_qtd(rows, 202406, 202409, 2, 6, "Revenue", amount="t_at", total_label="TOTAL")
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    got = {(r["root_line_id"], r["rc_id"]): r["total"] for r in out.collect()}
    assert got == {("a", 1): 4, ("b", 1): 11, ("TOTAL", None): 15}


def test_layout_totals_cover_rows_beyond_the_page(spark):
    spec = R.ReportSpec(fields=(R.ReportField("id", "ID", order="B"), R.ReportField("amount", "AMOUNT")), row_limit=2, totals=("amount",))
    df = spark.createDataFrame([("a", D(1)), ("b", D(2)), ("c", D(4))], "id string, amount decimal(18,2)")
    assert [tuple(r) for r in R.run_report(df, spec).collect()] == [("a", 1, False), ("b", 2, False), (None, 7, True)]
    assert R.run_report(df.where("false"), spec).collect() == []
    assert R.run_report(df, replace(spec, totals=())).columns == ["id", "amount"]


def test_entries_count_from_their_posting_period(spark):
    entries = spark.createDataFrame(
        [("a", 202405, 202405, D(1)), ("a", 202405, 202407, D(10)), ("a", 202407, 202406, D(100)), ("a", 202406, None, D(1000))],
        "line_id string, prd_id int, post_prd_id int, amount decimal(18,2)",
    ).withColumns({"dr_acct": F.lit("L"), "cr_acct": F.lit("R"), "indicators": F.lit("NLRYN")})
    accounts = spark.createDataFrame([("L", "Contract Liability"), ("R", "Revenue")], "acct_type_id string, acct_name string")
    got = J.ledger_balance(entries, accounts, {"revenue": ("Revenue",)}, 202406, unbilled={"unbilled": ("Revenue",)}).collect()[0]
    assert (got["revenue"], got["unbilled"]) == (1101, 1101)
    got = J.ledger_balance(entries.drop("post_prd_id"), accounts, {"revenue": ("Revenue",)}, 202406).collect()[0]
    assert got["revenue"] == 1011


def test_reversed_journals_have_status_r(spark):
    heads = spark.createDataFrame([(1, "A"), (2, "A"), (3, None)], "header_id long, status string")
    assert [tuple(r) for r in J.mark_reversed(heads, 2).orderBy("header_id").collect()] == [(1, "A"), (2, "R"), (3, None)]


def rule_tables(spark, kind, treatment="P"):
    events = spark.createDataFrame([(3, "Other", "R"), (7, "New POB not within SSP range", treatment)], "id int, name string, treatment string")
    durations = spark.createDataFrame([("x", "Y"), (kind, "N")], "mod_durn_type string, hist_flag string")
    return C.modification_rule(events, durations, CAL, 202405)


def test_the_rule_tables_decide_date_and_treatment(spark):
    assert tuple(rule_tables(spark, "RC Modified Period").first()) == (7, "P", date(2024, 5, 31))
    assert tuple(rule_tables(spark, "RC Modified Quarter").first()) == (7, "P", date(2024, 6, 30))
    assert tuple(rule_tables(spark, "RC Modified Period", None).first()) == (7, None, None)


def test_regrouping_by_rule(spark):
    moves = spark.createDataFrame([("a", 1, 2, "x"), ("b", 1, 3, "x"), ("b", 1, 2, "y")], "line_id string, source_rc long, target_rc long, rule string")
    contracts = spark.createDataFrame([(c, "R", date(2025, 1, 1), "N") for c in (1, 2, 3, 4)], "rc_id long, treatment string, ct_mod_end_dt date, posted string")
    lines = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "line_id string, rc_id long")
    status, detail, regrouped = C.regroup_by_rule(moves, contracts, lines, rule_tables(spark, "RC MODIFIED PERIOD"), 202405)
    assert sorted(tuple(r) for r in status.collect()) == [
        (1, "Y", "R", date(2025, 1, 1), "N"), (2, "N", "P", date(2024, 5, 31), "Y"), (3, "N", "P", date(2024, 5, 31), "Y"), (4, "N", "R", date(2025, 1, 1), "N"),
    ]
    assert sorted(tuple(r) for r in detail.collect()) == [(2, x, 7, date(2024, 5, 31), "P", 202405) for x in "ab"] + [(3, "b", 7, date(2024, 5, 31), "P", 202405)]
    assert sorted(tuple(r) for r in regrouped.collect()) == [("a", 2), ("b", 2), ("c", 1)]
    status, detail, _ = C.regroup_by_rule(moves, contracts, lines, rule_tables(spark, "RC MODIFIED PERIOD", None), 202405)
    assert detail.collect() == [] and {(r["rc_id"], r["closed"], r["posted"]) for r in status.collect()} == {(1, "Y", "N"), (2, "N", "N"), (3, "N", "N"), (4, "N", "N")}
