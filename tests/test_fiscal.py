"""Calendars of any period length, and runs over several open periods."""

import random
from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from recogna.operators import schedules as S
from recogna.sources.calendar import month_calendar
from recogna.sources.fiscal import FiscalCalendar, Period

LINE = "line_id string, amount decimal(18,2), start_date date, end_date date, open_prd int"
WEEKS = FiscalCalendar.weeks(date(2023, 1, 2), 2023, 4, (4, 4, 5), (2024,))


def by_hand(cal, amount, start, end, opened):
    """Period by period: amounts by period id, and what fell into the year, quarter and period before."""
    units, sign = abs(int(amount * 100)), 1 if amount > 0 else -1
    span, total, out, held = (end - start).days + 1, 0, {}, 0
    at_open = next(i for i, p in enumerate(cal.periods) if p.id == opened)
    ends = {}
    for i in range(at_open):
        p, q = cal.periods[i], cal.periods[i + 1]
        if p.year != q.year:
            ends["py"] = p.id
        if (p.year, p.quarter) != (q.year, q.quarter):
            ends["pq"] = p.id
    ends["pp"] = cal.periods[at_open - 1].id
    parts = dict.fromkeys(("py", "pq", "pp"), 0)
    for p in cal.periods:
        if p.end < start or p.start > end or not units:
            continue
        days = (p.end - max(p.start, start)).days + 1
        part = max((2 * days * units + span) // (2 * span), 1)
        last = p.end >= end
        if last:
            part = units - total - held
        part = min(part, units - total - held)
        if p.id < opened:
            held += part
            if not last:
                if p.id == ends.get("py"):
                    parts["py"] = held * sign
                elif p.id == ends.get("pq"):
                    parts["pq"] = (held - parts["py"]) * sign
                elif p.id == ends["pp"]:
                    parts["pp"] = (held - parts["py"] - parts["pq"]) * sign
            continue
        part, held, total = part + held, 0, total + part + held
        if part:
            out[p.id] = sign * part
    if held:
        out[opened] = out.get(opened, 0) + sign * held
    return out, parts


def test_lookups_find_every_day(spark):
    for cal in (WEEKS, FiscalCalendar.months(202301, 202612)):
        last = (cal.periods[-1].end - cal.origin).days
        days = spark.range(-3, last + 4).select(F.date_add(F.lit(cal.origin), F.col("id").cast("int")).alias("d"))
        at = cal.place(F.col("d"))
        rows = days.select("d", cal.id_at(at).alias("prd"), cal.start_at(at).alias("a"), cal.end_at(at).alias("b"), cal.place_of(cal.id_at(at)).alias("back"), at.alias("at")).collect()
        for r in rows:
            p = next((p for p in cal.periods if p.start <= r["d"] <= p.end), None)
            assert (r["prd"], r["a"], r["b"]) == ((p.id, p.start, p.end) if p else (None, None, None))
            assert r["back"] == r["at"]
    ids = spark.createDataFrame([(202300,), (202313,), (202201,), (202701,), (None,), (202412,)], "p int").select(WEEKS.place_of(F.col("p")).alias("at"))
    assert [r["at"] for r in ids.collect()] == [None, None, None, None, None, 23]


def test_calendars_have_no_gaps():
    with pytest.raises(ValueError, match="does not follow"):
        FiscalCalendar([Period(202401, date(2024, 1, 1), date(2024, 1, 28), 1), Period(202402, date(2024, 1, 30), date(2024, 2, 25), 1)])
    assert {p.days for p in WEEKS.periods} == {28, 35, 42}
    assert WEEKS.periods[23].days == 42 and sum(p.days for p in WEEKS.periods[12:24]) == 53 * 7


def test_table_and_rule_give_the_same_calendar(spark):
    assert FiscalCalendar.of(month_calendar(spark, 202301, 202412)).periods == FiscalCalendar.months(202301, 202412).periods
    assert FiscalCalendar.read(WEEKS.frame(spark)).periods == WEEKS.periods


@pytest.mark.parametrize("cal", [WEEKS, FiscalCalendar.months(202301, 202612)])
def test_periods_of_any_length_sum_to_the_value(spark, cal):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        start = date(2023, 1, 2) + timedelta(rng.randrange(700))
        end = start + timedelta(rng.choice((0, 1, 27, 28, 34, 90, 400)))
        opened = rng.choice([p.id for p in cal.periods[1:30]])
        rows.append((f"l{i}", D(rng.choice((1, 2, 7, 12345, 100000, 99999))) / 100, start, end, opened))
    df = spark.createDataFrame(rows, LINE)
    got = {}
    for r in S.recognize(df, cal, "open_prd", splits=True).collect():
        got.setdefault(r["line_id"], {})[r["prd_id"]] = r
    for line, amount, start, end, opened in rows:
        amounts, parts = by_hand(cal, amount, start, end, opened)
        assert {p: int(r["rel_amt"] * 100) for p, r in got[line].items()} == amounts
        assert sum(r["rel_amt"] for r in got[line].values()) == amount
        if opened in got[line]:
            assert {k: int(got[line][opened][f"{k}_amt"] * 100) for k in parts} == parts


def test_negative_values_catch_up(spark):
    df = spark.createDataFrame([("a", D("-100.00"), date(2024, 1, 15), date(2024, 3, 10), 202402)], LINE)
    rows = {r["prd_id"]: r for r in S.recognize(df, FiscalCalendar.months(202301, 202612), "open_prd", splits=True).collect()}
    assert {p: r["rel_amt"] for p, r in rows.items()} == {202402: D("-82.15"), 202403: D("-17.85")}
    # the part before the quarter is signed before it is taken off the unsigned running amount
    assert (rows[202402]["py_amt"], rows[202402]["pq_amt"], rows[202402]["pp_amt"]) == (D(0), D(0), D("-30.36"))


RUN = "line_id string, rc_id long, amount decimal(18,2), start_date date, end_date date, init_expiry date, org int, book_id int"
HISTORY = "line_id string, rc_id long, prd_id int, amount decimal(18,2), version int"


def run_inputs(spark):
    one = (D("1200.00"), date(2024, 1, 1), date(2024, 12, 31))
    lines = spark.createDataFrame(
        [("a", 1, *one, date(2024, 2, 1), 1, 1), ("b", 1, *one, date(2024, 2, 1), 2, 1), ("c", 2, *one, date(2030, 1, 1), 1, 1), ("d", 3, *one, date(2024, 2, 1), 3, 1),
         ("h", 4, *one, date(2024, 2, 1), 1, 1), ("k", 4, *one, date(2024, 2, 1), 2, 1)], RUN)
    history = spark.createDataFrame(
        [("a", 1, 202401, D(400), 1), ("a", 1, 202407, D(7), 1), ("b", 1, 202401, D(400), 2), ("d", 3, 202401, D(1), 1), ("d", 3, 202408, D(2), 1), ("k", 4, 202407, D(9), 1), ("z", 9, 202409, D(5), 3)],
        HISTORY)
    periods = spark.createDataFrame([(1, 1, 202406, "OPEN"), (1, 1, 202405, "CLOSED"), (1, 2, 202407, "OPEN"), (1, 2, 202408, "OPEN"), (1, 3, 202407, "CLOSED")], "book_id int, org int, prd_id int, status string")
    held = spark.createDataFrame([("h",), ("k",), ("k",)], "line_id string")
    return S.with_open_period(lines, periods), history, held


def test_one_run_serves_every_open_period(spark):
    lines, history, held = run_inputs(spark)
    out = S.generate_schedules(lines, history, held, FiscalCalendar.months(202301, 202712), "open_prd")
    rows = {}
    for r in out.collect():
        rows.setdefault(r["line_id"], []).append((r["prd_id"], r["rule"], r["version"], r["amount"]))
    a = sorted(rows["a"])
    assert a[0] == (202401, "CLOSED", 1, D(400)) and a[1] == (202406, "REVISION", 2, D("196.72"))
    assert a[2][0] == 202407 and sum(x[3] for x in a) == 1200  # as in the single-period fixture
    b = sorted(rows["b"])
    assert b[1][:3] == (202407, "REVISION", 3) and b[2][0] == 202408 and sum(x[3] for x in b) == 1200
    c = sorted(rows["c"])
    assert c[0][:3] == (202406, "INITIAL", 1) and len(c) == 7 and sum(x[3] for x in c) == 1200
    assert sorted(rows["d"]) == [(202401, "KEPT", 1, D(1)), (202408, "KEPT", 1, D(2))]  # no open period
    assert rows["h"] == [(202406, "HELD", 1, D(0))] and rows["k"] == [(202407, "KEPT", 1, D(9))]
    assert rows["z"] == [(202409, "KEPT", 3, D(5))]  # not part of the run


def test_a_run_reads_lines_once_and_recognition_only_maps(spark, tmp_path):
    lines, history, held = run_inputs(spark)
    lines.write.parquet(str(tmp_path / "lines"))
    stored = spark.read.parquet(str(tmp_path / "lines"))
    plan = S.generate_schedules(stored, history, held, FiscalCalendar.months(202301, 202712), "open_prd")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 or plan.count("FileScan parquet") == 1
    plan = S.recognize(stored, WEEKS, "open_prd", splits=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Window" not in plan


def test_planning_starts_no_job(spark):
    lines, history, held = run_inputs(spark)
    windows = lines.select("line_id", F.col("start_date").alias("first_date"), F.col("end_date").alias("last_date"), "open_prd")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    cal = FiscalCalendar.months()
    S.generate_schedules(lines, history, held, cal, "open_prd")
    S.recognize_prospective(lines.withColumn("scheduled", F.lit(0).cast("decimal(18,2)")), cal, "open_prd")
    S.order_on_hand(history, history, windows, cal, "open_prd")
    assert list(tracker.getJobIdsForGroup("planning")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_lines_have_their_own_open_period_on_hand_and_in_replacement(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "line_id string, prd_id int, amount decimal(18,2)")
    custom = rows(*[(x, p, D(100)) for x in "ab" for p in (202401, 202402, 202403)])
    actual = rows(*[(x, 202401, D(80)) for x in "ab"], *[(x, 202402, D(100)) for x in "ab"], *[(x, 202403, D(50)) for x in "ab"])
    windows = spark.createDataFrame([("a", date(2024, 1, 5), date(2024, 3, 9), 202402), ("b", date(2024, 1, 5), date(2024, 3, 9), 202403)], "line_id string, first_date date, last_date date, open_prd int")
    got = {(r["line_id"], r["prd_id"]): r["amount"] for r in S.order_on_hand(custom, actual, windows, FiscalCalendar.months(202301, 202612), "open_prd").collect()}
    assert got == {("a", 202401): 20, ("a", 202402): 20, ("a", 202403): 50, ("b", 202401): 20, ("b", 202402): 0, ("b", 202403): 70}
    fresh = spark.createDataFrame([("a", 202402, D(1), 202402), ("b", 202403, D(2), 202403)], "line_id string, prd_id int, amount decimal(18,2), open_prd int")
    history = rows(*[(x, p, D(9)) for x in "abc" for p in (202401, 202402, 202403)])
    kept = sorted((r["line_id"], r["prd_id"], int(r["amount"])) for r in S.replace_future(history, fresh, "open_prd").collect())
    assert kept == [("a", 202401, 9), ("a", 202402, 1), ("b", 202401, 9), ("b", 202402, 9), ("b", 202403, 2), ("c", 202401, 9), ("c", 202402, 9), ("c", 202403, 9)]
