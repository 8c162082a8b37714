"""What the findings on disk asked for: lines stay where they met their order, and only narrow rows are sorted."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from recogna.operators import reports as R
from recogna.operators import waterfall as W
from recogna.plans import catalog, report_queries
from recogna.session import tune
from recogna.sources import model
from recogna.sources.calendar import month_calendar
from recogna.sources.fiscal import FiscalCalendar

LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Six orders, one of them without lines and one that comes twice; a line without order, one without number, one that comes twice."""
    d = str(tmp_path_factory.mktemp("tables"))
    flags = ("N", "R", "A")
    lines = [(o, 10 + n, 20 + o, n, float(n), 100.0 * n + o, 0.01 * (n + 4), 0.02, flags[(o + n) % 3], "FO"[n % 2], datetime(1999, 3 + n, 1 + o)) for o in range(5) for n in range(1, 5)]
    lines += [lines[3], (77, 1, 1, 1, 1.0, 5.0, 0.0, 0.0, "N", "F", datetime(1999, 6, 1)), (None, 1, 1, 1, 1.0, 5.0, 0.0, 0.0, "N", "F", datetime(1999, 6, 1)), (2, 3, None, None, None, 7.0, 0.0, 0.0, "N", "O", datetime(1999, 6, 1))]
    spark.createDataFrame(lines, LINES).write.parquet(f"{d}/lineitem.parquet")
    orders = [(o, o % 2, "FO"[o % 2], 1.0, datetime(1999, 2 + o % 4, 3), "2-HIGH") for o in range(6)]
    spark.createDataFrame([*orders, orders[4]], ORDERS).write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(0, "a", 1, 1.0, "x"), (1, "b", 2, 1.0, "x")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{d}/customer.parquet")
    spark.createDataFrame([(1, "n", 0), (2, "m", 2)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{d}/nation.parquet")
    spark.createDataFrame([(0, "r"), (2, "s")], "r_regionkey int, r_name string").write.parquet(f"{d}/region.parquet")
    yield d
    tune(spark)  # the settings that queries of other tests begin with


def test_lines_dealt_by_contract_are_the_same_lines(spark, tables):
    columns = ("rc_id", "line_id", "line_num", "start_date", "end_date", "alctd_xt_prc", "org", "f_ex_rate")
    rows = lambda dealt: sorted(map(tuple, model.lines(spark, tables, *columns, dealt=dealt).collect()), key=repr)
    assert rows("rc_id") == rows(None) == rows("line_id") and len(rows(None)) == 26
    with pytest.raises(ValueError):
        model.lines(spark, tables, "line_id", "start_date", dealt="rc_id")


@pytest.mark.parametrize("name", ["line_account_measures", "line_account_summary", "account_summary"])
def test_lines_are_shuffled_once_where_they_meet_their_order(spark, tables, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalog.QUERIES[name](spark, tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plan)
    assert dealt and all(re.fullmatch(r"(rc_id|o_custkey|c_custkey)#\d+L?", x) for x in dealt), dealt


def test_rows_are_narrow_until_they_met_their_balances(spark, tables):
    plan = catalog.QUERIES["line_account_measures"](spark, tables)._jdf.queryExecution().executedPlan().toString()
    join = next(i for i, x in enumerate(plan.split("\n")) if "LeftOuter" in x)
    assert all("AS r_at_yt" not in x for x in plan.split("\n")[join:])


def test_amounts_after_the_join_are_those_before_it(spark, tables):
    rows = {}
    for narrow in (False, True):
        summary = model.account_summary_rows(spark, tables, narrow=narrow)
        latest = model.account_summary_rows(spark, tables).select("root_line_id", "acct_type_id", "acct_segs", F.col("prd_id").alias("cal_prd_id"), *[F.col(f"{c}_eb").alias(f"lt_{c}_bal") for c in "tfr"])
        out = R.line_account_summary(summary, month_calendar(spark), model.account_types(spark), latest, amounts=model.summary_amounts() if narrow else None)
        rows[narrow] = sorted(map(tuple, out.collect()), key=repr)
    assert rows[True] == rows[False] and len(rows[True]) > 26


def test_snapshots_of_the_waterfalls_shuffle_no_line_by_itself(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = report_queries._snapshot(spark, tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(rc_id" in plan and "hashpartitioning(line_id" not in plan and "line_id" not in "".join(re.findall(r"hashpartitioning\(([^)]*)", plan))


def test_snapshot_rows_by_contract_and_line(spark):
    day = "DATE'2024-01-05' AS first_date, DATE'2024-03-09' AS last_date"
    custom = spark.sql(f"SELECT *, {day} FROM VALUES (1L, 'a', 1, 202402, 9BD), (1L, 'b', 1, 202403, 5BD), (2L, 'c', 2, 202402, 3BD) AS t(rc_id, line_id, org, prd_id, amount)")
    entries = spark.sql("SELECT * FROM VALUES (1L, 'a', 202402, 2BD, 'A', true), (1L, 'b', 202402, 3BD, 'R', false), (2L, 'c', 202401, 1BD, 'R', true) AS t(rc_id, line_id, prd_id, amount, schd_type, counted)")
    calendar = FiscalCalendar.months(202301, 202512)
    rows = lambda *by: sorted(map(tuple, W.snapshot_rows(custom, entries, calendar, 202402, 202402, *by).collect()))
    assert rows() == rows(model.BY_LINE) and len(rows()) == 14
