"""Small inputs with results worked out by hand."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from recogna.operators import allocation as A
from recogna.operators import contracts as C
from recogna.operators import journal as J
from recogna.operators import reports as R
from recogna.operators import schedules as S
from recogna.sources import sinks
from recogna.sources.calendar import month_calendar, next_period, quarter_to_date


@pytest.fixture(scope="module")
def cal(spark):
    return month_calendar(spark, 202301, 202712).cache()


def line(spark, value, first, last, **more):
    row = {"line_id": "a", "rc_id": 1, "amount": D(value), "start_date": first, "end_date": last, **more}
    schema = "line_id string, rc_id long, amount decimal(18,2), start_date date, end_date date"
    schema += "".join(f", {k} decimal(18,2)" for k in more)
    return spark.createDataFrame([tuple(row.values())], schema)


def amounts(df, col="rel_amt"):
    return {r["prd_id"]: r[col] for r in df.collect()}


def test_straight_line(spark, cal):
    ln = line(spark, "100.00", date(2024, 1, 15), date(2024, 3, 10))
    got = amounts(S.recognize(ln, cal, 202401))
    assert got == {202401: D("30.36"), 202402: D("51.79"), 202403: D("17.85")}


def test_straight_line_catches_up_in_the_open_period(spark, cal):
    ln = line(spark, "100.00", date(2024, 1, 15), date(2024, 3, 10))
    rows = {r["prd_id"]: r for r in S.recognize(ln, cal, 202402, splits=True).collect()}
    assert rows[202402]["rel_amt"] == D("82.15") and rows[202403]["rel_amt"] == D("17.85")
    assert (rows[202402]["pp_amt"], rows[202402]["pq_amt"], rows[202402]["py_amt"]) == (D("30.36"), D("0.00"), D("0.00"))


def test_dates_outside_the_calendar_fail(spark, cal):
    for first, last in ((date(2022, 12, 1), date(2023, 5, 31)), (date(2027, 6, 1), date(2028, 5, 31))):
        with pytest.raises(Exception, match="outside the calendar"):
            S.recognize(line(spark, "1200.00", first, last), cal, 202401).collect()


def test_default_calendar_loses_nothing(spark):
    ln = line(spark, "1200.00", date(2002, 6, 1), date(2003, 5, 31))
    assert sum(amounts(S.recognize(ln, month_calendar(spark), 200206)).values()) == D("1200.00")


def test_overlapping_lineages_have_one_target(spark):
    members = spark.createDataFrame([(1, 1), (1, 5), (2, 2), (2, 5), (9, 9)], "seed_id long, rc_id long")
    days = {1: date(2024, 1, 3), 2: date(2024, 1, 1), 5: date(2024, 1, 2), 9: date(2024, 1, 1)}
    bills = spark.createDataFrame([(k, "INV", v) for k, v in days.items()], "rc_id long, type string, doc_date date")
    got = sorted(tuple(r) for r in C.merge_lineage(members, bills).collect())
    assert got == [(1, 1, 2), (1, 5, 2)]


def test_initial_revenue_entry_makes_a_line_active(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "line_id string, prd_id int, amount decimal(18,2), schd_type string")
    custom = rows(("a", 202405, D(1), "R"), ("b", 202405, D(1), "R"))
    entries = rows(("a", 202404, D(1), "R"), ("b", 202404, D(1), "A"))
    got = S.waterfall_snapshot(entries.where("false"), custom, custom.where("false"), entries, 202404)
    assert [r["line_id"] for r in got.collect()] == ["a"]


def test_closed_window_posts_everything_in_the_open_period(spark, cal):
    ln = line(spark, "-70.00", date(2023, 3, 1), date(2023, 5, 31))
    assert amounts(S.recognize(ln, cal, 202402)) == {202402: D("-70.00")}


def test_small_amounts_use_the_smallest_unit_until_spent(spark, cal):
    ln = line(spark, "0.02", date(2024, 1, 1), date(2024, 6, 30))
    assert amounts(S.recognize(ln, cal, 202401)) == {202401: D("0.01"), 202402: D("0.01")}


@pytest.mark.parametrize("value", ["0.07", "1.00", "999.99", "-123456.78"])
@pytest.mark.parametrize("last", [date(2024, 2, 2), date(2024, 12, 31), date(2026, 7, 9)])
def test_schedules_sum_to_the_value(spark, cal, value, last):
    ln = line(spark, value, date(2024, 2, 1), last)
    assert sum(amounts(S.recognize(ln, cal, 202403)).values()) == D(value)


def test_prospective(spark, cal):
    ln = line(spark, "1200.00", date(2024, 1, 1), date(2024, 12, 31), scheduled=D("400.00"))
    rows = S.recognize_prospective(ln, cal, 202406).collect()
    now = [r["rel_amt"] for r in rows if r["part"] == "CATCH-UP"]
    later = {r["prd_id"]: r["rel_amt"] for r in rows if r["part"] == "REMAINDER"}
    assert now == [D("196.72")]
    assert sum(later.values()) == D("603.28") and min(later) == 202407


def test_order_on_hand(spark, cal):
    sched = lambda vals: spark.createDataFrame([("a", p, D(v)) for p, v in vals], "line_id string, prd_id int, amount decimal(18,2)")
    custom = sched([(202401, 100), (202402, 100), (202403, 100)])
    actual = sched([(202401, 80), (202402, 100), (202403, 50)])
    window = spark.createDataFrame([("a", date(2024, 1, 1), date(2024, 3, 31))], "line_id string, first_date date, last_date date")
    assert amounts(S.order_on_hand(custom, actual, window, cal, 202402), "amount") == {202401: D(20), 202402: D(20), 202403: D(50)}


def test_gl_batches(spark):
    sizes = {1: 5, 2: 20, 3: 50, 4: 60, 5: 70}
    gl = spark.createDataFrame([(9, rc) for rc, n in sizes.items() for _ in range(n)], "batch_id int, rc_id long")
    got = {r["rc_id"]: r["group_id"] for r in J.batch_contracts(gl, 100).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 2, 5: 3}


@pytest.mark.parametrize("limit", [3, 7, 20])
def test_gl_batches_follow_the_sequential_rule(spark, limit):
    sizes = {rc: (rc * 7919) % 11 + 1 for rc in range(1, 120)}
    gl = spark.createDataFrame([(1, rc) for rc, n in sizes.items() for _ in range(n)], "batch_id int, rc_id long")
    got = {r["rc_id"]: r["group_id"] for r in J.batch_contracts(gl, limit).collect()}
    import hashlib

    fill, group, expected = 0, 1, {}
    for rc in sorted(sizes, key=lambda r: (sizes[r], hashlib.md5(str(r).encode()).hexdigest()[:2], r)):
        fill += sizes[rc]
        if fill > limit:
            fill, group = sizes[rc], group + 1
        expected[rc] = group
    assert got == expected


def test_bundle_percentages(spark):
    pcts = A.BundlePercentages(D("1.2"), D("1.4"), D("70"))
    rows = [(1, "two", "a", "License - Term"), (1, "two", "b", "Maintenance - New"),
            (1, "three", "c", "License - Term"), (1, "three", "d", "Maintenance - New"), (1, "three", "e", "Content Subscription")]
    df = spark.createDataFrame(
        [(*r, "Y", "Y", "N", "F") for r in rows],
        "rc_id long, bundle_id string, line_id string, prod_ctgry string, eligible string, split_flag string, premium string, prod_fmly string",
    )
    got = {r["line_id"]: r["alloc_pct"] for r in A.split_bundles(df, pcts).collect()}
    assert got == {
        "a": D("83.3333333333"), "b": D("16.6666666667"),
        "c": D("71.4285714286"), "d": D("14.2857142857"), "e": D("14.2857142857"),
    }


def test_ramp(spark):
    years = [(2024, 10), (2025, 15), (2026, 20)]
    rows = [(str(y), 1, "F", "License - Term", date(y, 1, 1), date(y, 12, 31), D(q), D(100), 1, "N") for y, q in years]
    df = spark.createDataFrame(
        rows,
        "line_id string, rc_id long, prod_fmly string, prod_ctgry string, start_date date, end_date date, ord_qty decimal(18,2), "
        "alctd_xt_prc decimal(18,2), unit_price int, no_ramp string",
    )
    got = {r["line_id"]: r for r in A.ramp_allocate(df).collect()}
    assert [got[k]["incremental"] for k in sorted(got)] == [D(10), D(5), D(5)]
    assert [got[k]["relative"] for k in sorted(got)] == [D("360.3288"), D("120"), D("60")]
    assert [got[k]["ramp_amt"] for k in sorted(got)] == [D("200.06"), D("66.63"), D("33.31")]


def test_expected_deferred(spark):
    lines = spark.createDataFrame(
        [(1, "s", "SERVICES", D(60), D(50)), (1, "l", "LICENSE - TERM", D(40), D(30))],
        "rc_id long, line_id string, prod_ctgry string, alctd_xt_prc decimal(18,2), billed decimal(18,2)",
    )
    balances = spark.createDataFrame(
        [("s", D(20), D(30), D(0)), ("l", D(40), D(0), D(0))],
        "line_id string, revenue decimal(18,2), liability decimal(18,2), unbilled decimal(18,2)",
    )
    got = {r["prod_ctgry"]: r for r in J.expected_positions(lines, balances).collect()}
    assert (got["SERVICES"]["expected_deferred"], got["SERVICES"]["net_value"]) == (D("28.00"), D("-2.00"))
    assert got["LICENSE - TERM"]["net_value"] == 0
    accounts = lines.select("rc_id", "line_id", "prod_ctgry", F.lit(None).cast("string").alias("unbilled_acct"), F.lit("L1").alias("liability_acct"),
                            F.lit("USD").alias("f_cur"), F.lit(1).cast("decimal(6,2)").alias("f_ex_rate"))
    je = {r["side"]: r for r in J.journal_lines(J.expected_positions(lines, balances), accounts, "U0").collect()}
    assert (je["DR"]["activity"], je["DR"]["amount"], je["DR"]["account"]) == ("Contract Liability", D("2.00"), "L1")
    assert (je["CR"]["activity"], je["CR"]["amount"], je["CR"]["account"]) == ("Unbilled", D("2.00"), "U0")


def test_journal_balance(spark):
    rows = [("A", None, "x", 10), ("A", "x", None, 10), ("B", None, "x", 10), ("B", "x", None, 9)]
    df = spark.createDataFrame(
        [(1, s, 1, 1, dr, cr, D(a)) for s, dr, cr, a in rows],
        "header_id long, subsidiary string, org int, book_id int, dr_account string, cr_account string, amount decimal(18,2)",
    )
    assert [(r["subsidiary"], r["difference"]) for r in J.journal_imbalances(df).collect()] == [("B", D("1.00"))]


def test_validity_interval(spark, cal):
    df = spark.createDataFrame([(1, date(2024, 1, 31), date(2024, 3, 30))], "id int, a date, b date")
    got = sorted(r["cal_prd_id"] for r in R.interval_periods(df, cal, "a", "b").collect())
    assert got == [202401, 202402]


def test_merge_target(spark):
    bills = lambda rows: spark.createDataFrame([(rc, "INV", day) for rc, day in rows], "rc_id long, type string, doc_date date")
    all_ = [(5, date(2024, 2, 1)), (3, date(2024, 2, 1)), (9, date(2024, 1, 15))]
    for rows, target in ((all_, 9), (all_[:2], 3)):
        members = spark.createDataFrame([(1, rc) for rc, _ in rows], "seed_id long, rc_id long")
        moves = C.merge_lineage(members, bills(rows)).collect()
        assert {m["target_rc"] for m in moves} == {target} and len(moves) == len(rows) - 1


def test_lineage_ends_on_cycles(spark):
    day = date(2024, 1, 1)
    bills = spark.createDataFrame(
        [(i, f"I{i}", f"I{i % 3 + 1}", "INV", day, date(2024, 12, 31)) for i in (1, 2, 3)],
        "rc_id long, doc_num string, orig_doc_num string, type string, start_date date, end_date date",
    )
    seeds = spark.createDataFrame([(1, 1, "I2", day)], "seed_id long, rc_id long, orig_doc_num string, start_date date")
    walk = C.lineage(bills, seeds).collect()
    assert sorted((r["doc_num"], r["depth"]) for r in walk) == [("I1", 3), ("I2", 1), ("I3", 2)]


def test_merge_follows_long_chains(spark):
    links = [(i, f"k{i}") for i in range(1, 41)] + [(i + 1, f"k{i}") for i in range(1, 40)] + [(100, "other")]
    df = spark.createDataFrame(links, "rc_id long, key string")
    got = {r["rc_id"]: r["label"] for r in C.merge_by_key(df).collect()}
    assert {v for k, v in got.items() if k <= 40} == {1} and got[100] == 100


def test_tax_rounds_half_away_from_zero(spark):
    schd = spark.createDataFrame([("a", 202401, D("1005.00"), "NLRNN")], "root_line_id string, prd_id int, amount decimal(18,2), indicators string")
    lines = spark.createDataFrame([("a", 1, 7, "JPY", D("1.00"))], "line_id string, rc_id long, org int, curr string, f_ex_rate decimal(6,2)")
    none = spark.createDataFrame([], "prd_id int")
    _, je, _ = J.tax_reclass(schd, lines, none, 7, 202401, 10)
    assert [r["amount"] for r in je.collect()] == [D("101.00")]
    again = spark.createDataFrame([(202401,)], "prd_id int")
    assert J.tax_reclass(schd, lines, again, 7, 202401, 10)[1].isEmpty()


def test_snapshot_rules(spark, tmp_path):
    path = str(tmp_path / "snap")
    df = lambda v: spark.createDataFrame([("a", v)], "line_id string, v int")
    read = lambda: {r["snapshot_prd_id"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert sinks.write_snapshot(df(1), path, 202401, 202402)
    assert not sinks.write_snapshot(df(2), path, 202401, 202402)
    assert sinks.write_snapshot(df(3), path, 202402, 202402) and sinks.write_snapshot(df(4), path, 202402, 202402)
    assert read() == {202401: 1, 202402: 4}
    with pytest.raises(ValueError):
        sinks.write_snapshot(df(5), path, 202403, 202402)


def test_report_layout(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (3, "a")], "id int, name string")
    spec = R.ReportSpec((R.ReportField("id", "ID"), R.ReportField("name", order="E")), mandatory=("id",), row_limit=2)
    assert [r["id"] for r in R.run_report(df, spec, [R.ReportFilter("id", 1, "BETWEEN", 3)]).collect()] == [2, 3]
    with pytest.raises(ValueError):
        R.run_report(df, spec)


def test_calendar_helpers(spark, cal):
    assert next_period(cal, 202312).first()["next_prd_id"] == 202401
    for prd, bounds in ((202401, (202401, 202401)), (202402, (202401, 202402)), (202403, (202401, 202403))):
        assert tuple(quarter_to_date(cal, prd).first()) == bounds


def test_year_columns_after_months():
    labels = [c.label for c in R.month_then_year_columns(202401, 202512, 3)]
    assert labels == ["p202401", "p202402", "p202403", "=> 2024", "2025"]
