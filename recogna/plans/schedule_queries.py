"""Registered schedule jobs."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recogna.functions.scalars import period_of
from recogna.operators import schedules as S
from recogna.operators.run_state import RunState
from recogna.plans.base_queries import _scratch
from recogna.plans.duck import duck
from recogna.plans.registry import query
from recogna.sources import model
from recogna.sources.fiscal import FiscalCalendar

OPEN = model.OPEN_PRD

# offsets kept as text, as uploads deliver them
OFFSETS = """CASE discount_pct % 4 WHEN 0 THEN NULL WHEN 1 THEN 'N/A' ELSE CAST(discount_pct AS VARCHAR(10)) END"""
OFFSETS_END = """CASE discount_pct % 3 WHEN 0 THEN 'NA' ELSE CAST(discount_pct * 2 AS VARCHAR(10)) END"""


def _offset_lines(spark: SparkSession, d: str) -> DataFrame:
    base = model.lines(spark, d, "rc_id", "line_id", "doc_date", "end_date", "ship_date", "discount_pct", "alctd_xt_prc", "ext_sll_prc", "return_flag")
    p = F.col("discount_pct")
    return base.withColumn("a13", F.when(p % 4 == 0, None).when(p % 4 == 1, "N/A").otherwise(p.cast("string"))).withColumn(
        "a14", F.when(p % 3 == 0, "NA").otherwise((p * 2).cast("string"))
    )


_WINDOW_SQL = f"""offs AS (SELECT *, try_cast(CASE WHEN a13 IN ('N/A','NA') THEN NULL ELSE a13 END AS INTEGER) AS s,
  try_cast(CASE WHEN a14 IN ('N/A','NA') THEN NULL ELSE a14 END AS INTEGER) AS e
 FROM (SELECT *, {OFFSETS} AS a13, {OFFSETS_END} AS a14 FROM lines)),
win AS (SELECT *, CASE WHEN s IS NULL THEN doc_date WHEN e IS NULL THEN greatest(doc_date, ship_date - s) ELSE ship_date - e END AS no_start
 FROM offs),
win2 AS (SELECT *, CASE WHEN e IS NOT NULL THEN end_date - e ELSE no_start END AS no_end FROM win)"""


@query(
    "schedule_window", "RS1", "SC16",
    sql=duck("lines", "SELECT line_id, CAST(no_start AS VARCHAR) AS no_start, CAST(no_end AS VARCHAR) AS no_end FROM win2", _WINDOW_SQL),
)
def schedule_window(spark, d):
    out = S.schedule_window(_offset_lines(spark, d), "a13", "a14", "ship_date")
    return out.select("line_id", F.col("no_start_date").cast("string").alias("no_start"), F.col("no_end_date").cast("string").alias("no_end"))


@query(
    "changed_lines", "RS2", "SC4",
    sql=duck("lines", """SELECT line_id, CAST(v AS DECIMAL(18,2)) AS contract_value FROM (SELECT line_id,
 coalesce(CASE WHEN return_flag = 'A' THEN alctd_xt_prc END, CASE WHEN return_flag = 'N' THEN alctd_xt_prc + 1 END, ext_sll_prc) AS v,
 CASE WHEN discount_pct % 2 = 0 THEN ext_sll_prc END AS last FROM lines) WHERE coalesce(v, -999) <> coalesce(last, -999)"""),
)
def changed_lines(spark, d):
    ln = model.lines(spark, d, "line_id", "return_flag", "alctd_xt_prc", "ext_sll_prc", "discount_pct")
    ln = ln.select(
        "line_id",
        S.contract_value(
            F.when(F.col("return_flag") == "A", F.col("alctd_xt_prc")),
            F.when(F.col("return_flag") == "N", F.col("alctd_xt_prc") + 1),
            F.col("ext_sll_prc"),
        ).cast("decimal(18,2)").alias("contract_value"),
        F.when(F.col("discount_pct") % 2 == 0, F.col("ext_sll_prc")).alias("last"),
    )
    return S.changed_lines(ln, "contract_value", "last").select("line_id", "contract_value")


# straight-line rule written period by period with running sums
_RECOGNIZE = f"""per AS (
 SELECT l.line_id, l.rc_id, c.prd_id, CAST(alctd_xt_prc * 100 AS BIGINT) AS total,
  date_diff('day', l.start_date, l.end_date) + 1 AS span, c.end_date >= l.end_date AS is_last,
  date_diff('day', greatest(c.start_date, l.start_date), c.end_date) + 1 AS days
 FROM lines l JOIN cal c ON c.end_date >= l.start_date AND c.start_date <= l.end_date WHERE alctd_xt_prc <> 0),
run AS (SELECT *, sum(greatest((2 * days * total + span) // (2 * span), 1)) OVER (PARTITION BY line_id ORDER BY prd_id) AS cum FROM per),
cap AS MATERIALIZED (SELECT *, CASE WHEN is_last THEN total ELSE least(cum, total) END AS done FROM run),
inc AS (SELECT *, done - coalesce(lag(done) OVER (PARTITION BY line_id ORDER BY prd_id), 0) AS part FROM cap),
rec AS MATERIALIZED (SELECT line_id, rc_id, greatest(prd_id, {OPEN}) AS prd_id, sum(part) AS units FROM inc GROUP BY ALL),
sched AS (SELECT line_id, rc_id, prd_id, CAST(units / 100.0 AS DECIMAL(18,2)) AS amount FROM rec WHERE units <> 0)"""


def _sched_lines(spark, d, *more, dealt=None):
    return model.lines(spark, d, *dict.fromkeys(("rc_id", "line_id", "alctd_xt_prc", "start_date", "end_date", *more)), dealt=dealt)


def custom_schedules(spark, d, *more, dealt=None):
    """Straight-line schedules of all lines; the input of the order-on-hand and waterfall jobs."""
    rec = S.recognize(_sched_lines(spark, d, *more, dealt=dealt), FiscalCalendar.months(), OPEN, "alctd_xt_prc")
    return rec.select("line_id", "rc_id", "prd_id", F.col("rel_amt").alias("amount"), *more)


@query("revenue_schedules", "RS3", "W9", "SC7", sql=duck("cal lines", "SELECT line_id, prd_id, amount FROM sched", _RECOGNIZE))
def revenue_schedules(spark, d):
    return custom_schedules(spark, d).select("line_id", "prd_id", "amount")


@query(
    "schedule_catch_up", "RS4", "W11",
    sql=duck("cal lines", f"""SELECT r.line_id, CAST(r.units / 100.0 AS DECIMAL(18,2)) AS amount,
 CAST(coalesce(y.done, 0) / 100.0 AS DECIMAL(18,2)) AS py_amt,
 CAST(CASE WHEN q.done IS NULL THEN 0 ELSE q.done - coalesce(y.done, 0) END / 100.0 AS DECIMAL(18,2)) AS pq_amt,
 CAST(CASE WHEN m.done IS NULL THEN 0 ELSE m.done - coalesce(q.done, y.done, 0) END / 100.0 AS DECIMAL(18,2)) AS pp_amt
FROM rec r LEFT JOIN cap y ON y.line_id = r.line_id AND y.prd_id = 199812 AND NOT y.is_last
 LEFT JOIN cap q ON q.line_id = r.line_id AND q.prd_id = 199903 AND NOT q.is_last
 LEFT JOIN cap m ON m.line_id = r.line_id AND m.prd_id = 199905 AND NOT m.is_last
WHERE r.prd_id = {OPEN} AND r.units <> 0""", _RECOGNIZE),
)
def schedule_catch_up(spark, d):
    rec = S.recognize(_sched_lines(spark, d), FiscalCalendar.months(), OPEN, "alctd_xt_prc", splits=True)
    return rec.where(F.col("prd_id") == OPEN).select("line_id", F.col("rel_amt").alias("amount"), "py_amt", "pq_amt", "pp_amt")


_PROSPECTIVE = f"""pv AS (
 SELECT line_id, rc_id, start_date, end_date, CAST(alctd_xt_prc * 100 AS BIGINT) AS v,
  CAST(round(alctd_xt_prc * CAST(0.25 AS DECIMAL(3,2)), 2) * 100 AS BIGINT) AS past,
  date_diff('day', start_date, end_date) + 1 AS span,
  date_diff('day', start_date, CASE WHEN end_date <= DATE '1999-06-01' THEN end_date ELSE DATE '1999-06-30' END) + 1 AS used FROM lines),
pn AS (SELECT *, CAST(sign(v * used - past * span) AS BIGINT) * ((2 * abs(v * used - past * span) + span) // (2 * span)) AS now_units FROM pv),
pr AS (SELECT *, v - past - now_units AS rest, greatest(end_date, DATE '1999-07-01') AS to_day FROM pn),
pper AS (SELECT p.line_id, c.prd_id, abs(rest) AS total, sign(rest) AS sg, date_diff('day', DATE '1999-07-01', to_day) + 1 AS span,
  c.end_date >= to_day AS is_last, date_diff('day', c.start_date, c.end_date) + 1 AS days
 FROM pr p JOIN cal c ON c.start_date >= DATE '1999-07-01' AND c.start_date <= to_day WHERE rest <> 0),
prun AS (SELECT *, sum(greatest((2 * days * total + span) // (2 * span), 1)) OVER (PARTITION BY line_id ORDER BY prd_id) AS cum FROM pper),
pcap AS (SELECT *, CASE WHEN is_last THEN total ELSE least(cum, total) END AS done FROM prun),
pinc AS (SELECT *, done - coalesce(lag(done) OVER (PARTITION BY line_id ORDER BY prd_id), 0) AS units FROM pcap),
pall AS (SELECT line_id, {OPEN} AS prd_id, CAST(now_units / 100.0 AS DECIMAL(18,2)) AS amount, 'CATCH-UP' AS part FROM pn WHERE now_units <> 0
 UNION ALL SELECT line_id, prd_id, CAST(sg * units / 100.0 AS DECIMAL(18,2)), 'REMAINDER' FROM pinc WHERE units <> 0)"""


@query("prospective_revision", "RS5", "SC10", sql=duck("cal lines", "SELECT * FROM pall", _PROSPECTIVE))
def prospective_revision(spark, d):
    ln = _sched_lines(spark, d).withColumn("scheduled", F.round(F.col("alctd_xt_prc") * F.lit("0.25").cast("decimal(3,2)"), 2).cast("decimal(18,2)"))
    out = S.recognize_prospective(ln, FiscalCalendar.months(), OPEN, "alctd_xt_prc", "scheduled")
    return out.select("line_id", "prd_id", F.col("rel_amt").alias("amount"), "part")


MODEL_ROWS = "(1,1,60.0,'REV-A'),(1,2,40.0,'REV-B'),(2,1,33.3,'REV-A'),(2,2,33.3,'REV-B'),(2,3,33.4,'REV-C'),(3,1,50.0,'REV-A'),(3,2,30.0,'REV-D')"


@query(
    "distribution_model", "RS6",
    sql=duck("lines", """SELECT line_id, dist_seq, account, CAST(part AS DECIMAL(28,4)) AS part_amt FROM (
  SELECT line_id, dist_seq, account, CASE WHEN cum >= 100 THEN cv_amt - coalesce(sum(raw) OVER (PARTITION BY line_id ORDER BY dist_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) ELSE raw END AS part FROM parts
  UNION ALL SELECT line_id, 0, 'DEFAULT', any_value(cv_amt) - sum(raw) FROM parts GROUP BY line_id HAVING max(cum) < 100) WHERE part <> 0""",
 f"""dm(model_id, dist_seq, pct, account) AS (VALUES {MODEL_ROWS}),
 dmc AS (SELECT *, sum(pct) OVER (PARTITION BY model_id ORDER BY dist_seq) AS cum FROM dm),
 parts AS (SELECT line_id, cv_amt, dist_seq, account, cum,
   CAST(round(CAST(CAST(sign(cv_amt) AS INTEGER) * CAST(abs(cv_amt) * 100 AS BIGINT) * CAST(pct * 10 AS BIGINT) * 0.0000100 AS DECIMAL(28,5)), 4) AS DECIMAL(28,4)) AS raw
  FROM lines JOIN dmc ON dmc.model_id = line_num % 3 + 1)"""),
)
def distribution_model(spark, d):
    ln = model.lines(spark, d, "line_id", "cv_amt", "line_num").select("line_id", "cv_amt", (F.col("line_num") % 3 + 1).alias("model_id"))
    dist = spark.sql(f"SELECT model_id, dist_seq, CAST(pct AS DECIMAL(6,2)) AS pct, account FROM VALUES {MODEL_ROWS} AS t(model_id, dist_seq, pct, account)")
    return S.distribute(ln, dist, "cv_amt").select("line_id", "dist_seq", "account", "part_amt")


ACCOUNTS = {
    "revenue_dr": "LIABILITY", "revenue_cr": "REVENUE", "adjustment_dr": "ADJ-LIABILITY", "adjustment_cr": "ADJ-REVENUE",
    "initial_dr": "CONTRA", "initial_cr": "ADJ-LIABILITY", "cost_dr": "COST", "cost_cr": "DEF-COST",
}


@query(
    "schedule_accounts", "RS7", "SC2",
    sql=duck("schedules", """SELECT line_id, seq, CASE schd_type WHEN 'R' THEN 'LIABILITY' WHEN 'A' THEN CASE WHEN line_num = 1 THEN 'CONTRA' ELSE 'ADJ-LIABILITY' END ELSE 'COST' END AS dr_account,
 CASE schd_type WHEN 'R' THEN 'REVENUE' WHEN 'A' THEN CASE WHEN line_num = 1 THEN 'ADJ-LIABILITY' ELSE 'ADJ-REVENUE' END ELSE 'DEF-COST' END AS cr_account FROM schedules"""),
)
def schedule_accounts(spark, d):
    sc = model.schedules(spark, d, "line_num")
    return S.assign_accounts(sc, ACCOUNTS, F.col("line_num") == 1).select("line_id", "seq", "dr_account", "cr_account")


@query(
    "actual_schedules", "RS11", "SC18",
    sql=duck("schedules", "SELECT line_id, seq, prd_id, amount FROM schedules WHERE (schd_type = 'R' AND initial_flag <> 'Y') OR schd_type = 'A'"),
)
def actual_schedules(spark, d):
    return S.actual_schedules(model.schedules(spark, d)).select("line_id", "seq", "prd_id", "amount")


_RUNS = "last_run AS (SELECT max(CAST(o_orderdate AS DATE)) - 730 AS mark FROM orders)"


def _completed_run(spark, d):
    """A run log whose last completed run was requested two years before the last order; a later run failed."""
    state = RunState(spark, _scratch(spark), "SUMMARISE")
    last = model.table(spark, d, "orders").agg(F.to_date(F.max("o_orderdate")).alias("day")).first()["day"]
    state.advance(state.processed(), datetime.combine(last - timedelta(days=730), time()))
    state.advance(state.processed(), datetime.combine(last, time()), "E")
    return state


@query(
    "moved_lines", "RS9",
    sql=duck("lines", """SELECT line_id, rc_id, rc_id - 1 AS schd_rc_id FROM lines, last_run WHERE return_flag <> 'R' AND line_num % 2 = 0 AND ship_date >= mark""", _RUNS),
)
def moved_lines(spark, d):
    """Lines changed since the last completed run whose schedule has another contract; returned lines have no schedule."""
    ln = model.lines(spark, d, "line_id", "rc_id", "ship_date", "line_num", "return_flag").join(F.broadcast(_completed_run(spark, d).mark()))
    on_schedule = F.when(F.col("return_flag") == "R", None).when(F.col("line_num") % 2 == 0, F.col("rc_id") - 1).otherwise(F.col("rc_id"))
    sched = ln.select("line_id", on_schedule.alias("rc_id"))
    return S.invalidate_moved(ln, sched, F.col("ship_date") >= F.col("mark")).select("line_id", "rc_id", "schd_rc_id")


_VALUE = "CASE WHEN discount_pct = 4 THEN NULL ELSE alctd_xt_prc END"


@query(
    "incremental_runs", "RS2", "RS9",
    sql=duck("lines", f"""SELECT 1 AS run, line_id, rc_id, CAST({_VALUE} AS DECIMAL(18,2)) AS value, 'CHANGED' AS reason FROM lines WHERE discount_pct <> 4
 UNION ALL SELECT 3, line_id, rc_id + CASE WHEN discount_pct IN (2, 3) THEN 1 ELSE 0 END, CAST(CASE WHEN discount_pct = 5 THEN NULL WHEN discount_pct IN (1, 4) THEN alctd_xt_prc + 1 ELSE alctd_xt_prc END AS DECIMAL(18,2)),
  CASE discount_pct WHEN 2 THEN 'MOVED' ELSE 'CHANGED' END FROM lines WHERE discount_pct IN (1, 2, 4, 5)"""),
)
def incremental_runs(spark, d):
    """Four runs over the same lines. The first processes all that have a value, the second finds nothing changed. Before
    the third some values change, some lines move to another contract and some moved without a trace in their change
    date; the fourth finds nothing again."""
    base = model.lines(spark, d, "line_id", "rc_id", "alctd_xt_prc", "discount_pct")
    p, long_ago = F.col("discount_pct"), F.lit("2019-12-31 10:00:00").cast("timestamp")
    before = base.select("line_id", "rc_id", F.when(p != 4, F.col("alctd_xt_prc")).alias("value"), long_ago.alias("updated_at"))
    value = F.when(p.isin(1, 4), F.col("alctd_xt_prc") + 1).when(p != 5, F.col("alctd_xt_prc")).cast("decimal(18,2)")
    touched = F.when(p == 3, long_ago).otherwise(F.lit("2020-01-02 08:00:00").cast("timestamp"))
    after = base.select("line_id", F.when(p.isin(2, 3), F.col("rc_id") + 1).otherwise(F.col("rc_id")).alias("rc_id"), value.alias("value"), touched.alias("updated_at"))
    state, path = RunState(spark, _scratch(spark), "SCHEDULES"), _scratch(spark)
    for run, lines in enumerate((before, before, after, after), 1):
        state.due(lines).write.parquet(f"{path}/run={run}")
        state.advance(spark.read.parquet(f"{path}/run={run}"), datetime(2020, 1, run))
    return spark.read.parquet(path).select("run", "line_id", "rc_id", "value", "reason")


_HISTORY = """hist AS (SELECT line_id, rc_id, CAST(strftime(start_date, '%Y%m') AS INTEGER) AS prd_id,
 CAST(round(alctd_xt_prc * CAST(0.25 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) AS amount, 1 AS version
 FROM lines WHERE sales_action <> 'NEW')"""


def _history(ln):
    # a new line has no schedule yet
    return ln.where("sales_action <> 'NEW'").select(
        "line_id", "rc_id", period_of(F.col("start_date")).alias("prd_id"),
        F.round(F.col("alctd_xt_prc") * F.lit("0.25").cast("decimal(3,2)"), 2).cast("decimal(18,2)").alias("amount"),
        F.lit(1).alias("version"),
    )


@query(
    "schedule_run", "RS8", "SNK8", "SRC3", "J6",
    sql=duck("cal lines", f"""SELECT line_id, version, prd_id, amount, rule FROM (
 SELECT line_id, 1 AS version, {OPEN} AS prd_id, CAST(0 AS DECIMAL(18,2)) AS amount, 'HELD' AS rule FROM state WHERE hold AND NOT has
 UNION ALL SELECT line_id, version, prd_id, CAST(units / 100.0 AS DECIMAL(18,2)), 'INITIAL' FROM rrec WHERE units <> 0
 UNION ALL SELECT line_id, version, {OPEN}, CAST(now_units / 100.0 AS DECIMAL(18,2)), 'REVISION' FROM qn WHERE now_units <> 0
 UNION ALL SELECT line_id, version, prd_id, CAST(sg * units / 100.0 AS DECIMAL(18,2)), 'REVISION' FROM qinc WHERE units <> 0
 UNION ALL SELECT line_id, version, prd_id, amount, 'CLOSED' FROM hist WHERE prd_id < {OPEN}
 UNION ALL SELECT line_id, version, prd_id, amount, 'KEPT' FROM hist WHERE prd_id >= {OPEN} AND line_id IN (SELECT line_id FROM state WHERE hold))""", _HISTORY, f"""
state AS (SELECT l.line_id, l.start_date, l.end_date, CAST(alctd_xt_prc * 100 AS BIGINT) AS v,
  CAST(coalesce(CASE WHEN h.prd_id < {OPEN} THEN h.amount END, 0) * 100 AS BIGINT) AS past, coalesce(h.version, 0) + 1 AS version,
  h.line_id IS NOT NULL AS has, discount_pct = 10 AS hold, l.start_date + 60 < DATE '1999-06-30' AS revised
 FROM lines l LEFT JOIN hist h ON h.line_id = l.line_id),
rper AS (SELECT s.line_id, s.version, c.prd_id, abs(v - past) AS total, sign(v - past) AS sg, date_diff('day', s.start_date, s.end_date) + 1 AS span,
  c.end_date >= s.end_date AS is_last, date_diff('day', greatest(c.start_date, s.start_date), c.end_date) + 1 AS days
 FROM state s JOIN cal c ON c.end_date >= s.start_date AND c.start_date <= s.end_date WHERE NOT hold AND NOT revised AND v <> past),
rrun AS (SELECT *, sum(greatest((2 * days * total + span) // (2 * span), 1)) OVER (PARTITION BY line_id ORDER BY prd_id) AS cum FROM rper),
rcap AS (SELECT *, CASE WHEN is_last THEN total ELSE least(cum, total) END AS done FROM rrun),
rinc AS (SELECT *, done - coalesce(lag(done) OVER (PARTITION BY line_id ORDER BY prd_id), 0) AS part FROM rcap),
rrec AS (SELECT line_id, version, greatest(prd_id, {OPEN}) AS prd_id, sum(sg * part) AS units FROM rinc GROUP BY ALL),
qv AS (SELECT *, date_diff('day', start_date, end_date) + 1 AS span,
  date_diff('day', start_date, CASE WHEN end_date <= DATE '1999-06-01' THEN end_date ELSE DATE '1999-06-30' END) + 1 AS used
 FROM state WHERE NOT hold AND revised),
qn AS (SELECT *, CAST(sign(v * used - past * span) AS BIGINT) * ((2 * abs(v * used - past * span) + span) // (2 * span)) AS now_units FROM qv),
qr AS (SELECT *, v - past - now_units AS rest, greatest(end_date, DATE '1999-07-01') AS to_day FROM qn),
qper AS (SELECT p.line_id, p.version, c.prd_id, abs(rest) AS total, sign(rest) AS sg, date_diff('day', DATE '1999-07-01', to_day) + 1 AS span,
  c.end_date >= to_day AS is_last, date_diff('day', c.start_date, c.end_date) + 1 AS days
 FROM qr p JOIN cal c ON c.start_date >= DATE '1999-07-01' AND c.start_date <= to_day WHERE rest <> 0),
qrun AS (SELECT *, sum(greatest((2 * days * total + span) // (2 * span), 1)) OVER (PARTITION BY line_id ORDER BY prd_id) AS cum FROM qper),
qcap AS (SELECT *, CASE WHEN is_last THEN total ELSE least(cum, total) END AS done FROM qrun),
qinc AS (SELECT *, done - coalesce(lag(done) OVER (PARTITION BY line_id ORDER BY prd_id), 0) AS units FROM qcap)"""),
)
def schedule_run(spark, d):
    ln = _sched_lines(spark, d, "sales_action", "discount_pct")
    job = ln.select("line_id", "rc_id", F.col("alctd_xt_prc").alias("amount"), "start_date", "end_date", F.date_add("start_date", 60).alias("init_expiry"))
    suspended = ln.where(F.col("discount_pct") == 10).select("line_id")
    out = S.generate_schedules(job, _history(ln), suspended, FiscalCalendar.months(), OPEN)
    return out.select("line_id", "version", "prd_id", "amount", "rule")


@query(
    "future_replacement", "SNK8",
    sql=duck("lines", f"""SELECT line_id, prd_id, amount FROM hist WHERE prd_id < {OPEN} OR line_id NOT IN (SELECT line_id FROM fresh)
 UNION ALL SELECT line_id, prd_id, amount FROM fresh""", _HISTORY,
 f"fresh AS (SELECT line_id, {OPEN} AS prd_id, ext_sll_prc AS amount FROM lines WHERE line_num % 2 = 0)"),
)
def future_replacement(spark, d):
    ln = model.lines(spark, d, "line_id", "rc_id", "line_num", "sales_action", "start_date", "alctd_xt_prc", "ext_sll_prc")
    fresh = ln.where("line_num % 2 = 0").select("line_id", F.lit(OPEN).alias("prd_id"), F.col("ext_sll_prc").alias("amount"))
    return S.replace_future(_history(ln).select("line_id", "prd_id", "amount"), fresh, OPEN)


_OOH = f"""act AS (SELECT line_id, prd_id, sum(amount) AS amount FROM schedules WHERE (schd_type = 'R' AND initial_flag <> 'Y') OR schd_type = 'A' GROUP BY ALL),
skel AS (SELECT line_id, prd_id FROM lines l JOIN cal c ON c.end_date >= l.start_date AND c.start_date <= l.end_date),
dif AS (SELECT k.line_id, k.prd_id, coalesce(s.amount, 0) - coalesce(a.amount, 0) AS diff FROM skel k
 LEFT JOIN sched s ON s.line_id = k.line_id AND s.prd_id = k.prd_id LEFT JOIN act a ON a.line_id = k.line_id AND a.prd_id = k.prd_id),
ooh AS (SELECT line_id, prd_id, CAST(diff + CASE WHEN prd_id = {OPEN} THEN coalesce(sum(CASE WHEN prd_id < {OPEN} THEN diff END) OVER (PARTITION BY line_id), 0) ELSE 0 END AS DECIMAL(18,2)) AS amount FROM dif)"""


def _on_hand_inputs(spark, d):
    """Custom and actual amounts and windows, dealt by line as lines; what follows keeps to that."""
    custom = custom_schedules(spark, d, dealt="line_id")
    actual = S.actual_schedules(model.schedules(spark, d, dealt="line_id")).select("line_id", "prd_id", "amount")
    windows = model.lines(spark, d, "line_id", "start_date", "end_date", dealt="line_id").select(
        "line_id", F.col("start_date").alias("first_date"), F.col("end_date").alias("last_date")
    )
    return custom, actual, windows


@query("order_on_hand", "RS10", "W11", sql=duck("cal schedules", "SELECT line_id, prd_id, amount FROM ooh", _RECOGNIZE, _OOH))
def order_on_hand(spark, d):
    custom, actual, windows = _on_hand_inputs(spark, d)
    return S.order_on_hand(custom, actual, windows, FiscalCalendar.months(), OPEN)


SNAPSHOT_SQL = (_RECOGNIZE, _OOH, f"""active AS (SELECT line_id FROM schedules WHERE schd_type = 'R' AND prd_id = {OPEN} UNION SELECT line_id FROM sched WHERE prd_id = {OPEN}),
snap AS (SELECT line_id, prd_id, amount, 'REV' AS rev_type FROM schedules WHERE ((schd_type = 'R' AND initial_flag <> 'Y') OR schd_type = 'A') AND line_id IN (SELECT line_id FROM active) AND line_id IN (SELECT line_id FROM sched)
 UNION ALL SELECT line_id, prd_id, amount, 'NO' FROM sched WHERE line_id IN (SELECT line_id FROM active)
 UNION ALL SELECT line_id, prd_id, amount, 'OOH' FROM ooh WHERE line_id IN (SELECT line_id FROM active) AND line_id IN (SELECT line_id FROM sched))""")


def snapshot(spark, d):
    custom, actual, windows = _on_hand_inputs(spark, d)
    on_hand = S.order_on_hand(custom, actual, windows, FiscalCalendar.months(), OPEN)
    return S.waterfall_snapshot(actual, custom, on_hand, model.schedules(spark, d, dealt="line_id"), OPEN)


@query("waterfall_snapshot", "RS12", "J9", "SE1", sql=duck("cal schedules", "SELECT line_id, prd_id, amount, rev_type FROM snap", *SNAPSHOT_SQL))
def waterfall_snapshot(spark, d):
    return snapshot(spark, d).select("line_id", "prd_id", "amount", "rev_type")


# weeks of 4-4-5 a quarter; every fifth year has a 53rd week, in its last period
FISCAL = FiscalCalendar.weeks(date(1994, 12, 26), 1995, 12, (4, 4, 5), (1999, 2004))
FISCAL_OPEN = 199906

_FISCAL_CAL = """fweeks(fy, first_day) AS (SELECT CAST(1995 + i AS INTEGER), DATE '1994-12-26' + CAST(364 * i + 7 * CASE WHEN i > 9 THEN 2 WHEN i > 4 THEN 1 ELSE 0 END AS INTEGER)
  FROM range(12) t(i)),
fcal AS (SELECT CAST(fy * 100 + n AS INTEGER) AS prd_id,
  first_day + CAST(7 * (13 * ((n - 1) // 3) + 4 * ((n - 1) % 3)) AS INTEGER) AS start_date,
  first_day + CAST(7 * (13 * ((n - 1) // 3) + 4 * ((n - 1) % 3) + CASE WHEN n % 3 = 0 THEN 5 ELSE 4 END + CASE WHEN n = 12 AND fy IN (1999, 2004) THEN 1 ELSE 0 END) - 1 AS INTEGER) AS end_date
  FROM fweeks, range(1, 13) p(n))"""


@query(
    "fiscal_schedules", "RS3", "RS4",
    sql=duck("lines", f"""SELECT r.line_id, r.prd_id, CAST(r.units / 100.0 AS DECIMAL(18,2)) AS amount,
 CAST(CASE WHEN r.prd_id = {FISCAL_OPEN} THEN coalesce(y.done, 0) ELSE 0 END / 100.0 AS DECIMAL(18,2)) AS py_amt,
 CAST(CASE WHEN r.prd_id <> {FISCAL_OPEN} OR q.done IS NULL THEN 0 ELSE q.done - coalesce(y.done, 0) END / 100.0 AS DECIMAL(18,2)) AS pq_amt,
 CAST(CASE WHEN r.prd_id <> {FISCAL_OPEN} OR m.done IS NULL THEN 0 ELSE m.done - coalesce(q.done, y.done, 0) END / 100.0 AS DECIMAL(18,2)) AS pp_amt
FROM frec r LEFT JOIN fcap y ON y.line_id = r.line_id AND y.prd_id = 199812 AND NOT y.is_last
 LEFT JOIN fcap q ON q.line_id = r.line_id AND q.prd_id = 199903 AND NOT q.is_last
 LEFT JOIN fcap m ON m.line_id = r.line_id AND m.prd_id = 199905 AND NOT m.is_last
WHERE r.units <> 0""", _FISCAL_CAL, f"""fper AS (
 SELECT l.line_id, c.prd_id, CAST(alctd_xt_prc * 100 AS BIGINT) AS total, date_diff('day', l.start_date, l.end_date) + 1 AS span,
  c.end_date >= l.end_date AS is_last, date_diff('day', greatest(c.start_date, l.start_date), c.end_date) + 1 AS days
 FROM lines l JOIN fcal c ON c.end_date >= l.start_date AND c.start_date <= l.end_date WHERE alctd_xt_prc <> 0),
frun AS (SELECT *, sum(greatest((2 * days * total + span) // (2 * span), 1)) OVER (PARTITION BY line_id ORDER BY prd_id) AS cum FROM fper),
fcap AS MATERIALIZED (SELECT *, CASE WHEN is_last THEN total ELSE least(cum, total) END AS done FROM frun),
finc AS (SELECT *, done - coalesce(lag(done) OVER (PARTITION BY line_id ORDER BY prd_id), 0) AS part FROM fcap),
frec AS MATERIALIZED (SELECT line_id, greatest(prd_id, {FISCAL_OPEN}) AS prd_id, sum(part) AS units FROM finc GROUP BY ALL)"""),
)
def fiscal_schedules(spark, d):
    """Recognition over fiscal periods of four, five and six weeks, with the parts of earlier periods."""
    rec = S.recognize(_sched_lines(spark, d), FISCAL, FISCAL_OPEN, "alctd_xt_prc", splits=True)
    return rec.select("line_id", "prd_id", F.col("rel_amt").alias("amount"), "py_amt", "pq_amt", "pp_amt")


_OPENS = """opens AS (SELECT CAST(r_regionkey AS INTEGER) AS org, CAST(strftime(add_on, '%Y%m') AS INTEGER) AS open_prd, add_on AS open_start, last_day(add_on) AS open_end,
  CAST(add_on + INTERVAL 1 MONTH AS DATE) AS next_start
 FROM (SELECT r_regionkey, CAST(DATE '1999-06-01' - to_months(CAST(r_regionkey % 3 AS INTEGER)) AS DATE) AS add_on FROM region WHERE r_regionkey < 4))"""


def org_periods(spark, d):
    """Periods by book and organisation: a region is an organisation, its open period one to three months back, the
    one before is closed, and the last region has none open."""
    region = model.table(spark, d, "region").select(F.lit(1).alias("book_id"), F.col("r_regionkey").alias("org"))
    own = period_of(F.add_months(F.lit("1999-06-01").cast("date"), (-(F.col("org") % 3)).cast("int")))
    before = period_of(F.add_months(F.lit("1999-05-01").cast("date"), (-(F.col("org") % 3)).cast("int")))
    status = F.when(F.col("org") < 4, "OPEN").otherwise("CLOSED")
    both = F.array(F.struct(own.alias("prd_id"), status.alias("status")), F.struct(before.alias("prd_id"), F.lit("CLOSED").alias("status")))
    return region.select("book_id", "org", F.explode(both).alias("p")).select("book_id", "org", "p.*")


@query(
    "schedule_run_orgs", "RS8", "RS5", "RS4", "SNK8", "SRC3",
    sql=duck("cal lines", """SELECT line_id, version, prd_id, amount, rule FROM (
 SELECT line_id, 1 AS version, open_prd AS prd_id, CAST(0 AS DECIMAL(18,2)) AS amount, 'HELD' AS rule FROM state WHERE open_prd IS NOT NULL AND hold AND NOT has
 UNION ALL SELECT line_id, version, prd_id, CAST(units / 100.0 AS DECIMAL(18,2)), 'INITIAL' FROM rrec WHERE units <> 0
 UNION ALL SELECT line_id, version, open_prd, CAST(now_units / 100.0 AS DECIMAL(18,2)), 'REVISION' FROM qn WHERE now_units <> 0
 UNION ALL SELECT line_id, version, prd_id, CAST(sg * units / 100.0 AS DECIMAL(18,2)), 'REVISION' FROM qinc WHERE units <> 0
 UNION ALL SELECT h.line_id, h.version, h.prd_id, h.amount, CASE WHEN h.prd_id < s.open_prd THEN 'CLOSED' ELSE 'KEPT' END FROM hist h JOIN state s USING (line_id)
  WHERE s.open_prd IS NULL OR s.hold OR h.prd_id < s.open_prd)""", _HISTORY, _OPENS, """
state AS MATERIALIZED (SELECT l.line_id, l.start_date, l.end_date, open_prd, open_start, open_end, next_start, CAST(alctd_xt_prc * 100 AS BIGINT) AS v,
  CAST(coalesce(CASE WHEN h.prd_id < open_prd THEN h.amount END, 0) * 100 AS BIGINT) AS past, coalesce(h.version, 0) + 1 AS version,
  h.line_id IS NOT NULL AS has, discount_pct = 10 AS hold, l.start_date + 60 < open_end AS revised
 FROM lines l LEFT JOIN opens USING (org) LEFT JOIN hist h ON h.line_id = l.line_id),
rper AS (SELECT s.line_id, s.version, s.open_prd, c.prd_id, abs(v - past) AS total, sign(v - past) AS sg, date_diff('day', s.start_date, s.end_date) + 1 AS span,
  c.end_date >= s.end_date AS is_last, date_diff('day', greatest(c.start_date, s.start_date), c.end_date) + 1 AS days
 FROM state s JOIN cal c ON c.end_date >= s.start_date AND c.start_date <= s.end_date WHERE open_prd IS NOT NULL AND NOT hold AND NOT revised AND v <> past),
rrun AS (SELECT *, sum(greatest((2 * days * total + span) // (2 * span), 1)) OVER (PARTITION BY line_id ORDER BY prd_id) AS cum FROM rper),
rcap AS MATERIALIZED (SELECT *, CASE WHEN is_last THEN total ELSE least(cum, total) END AS done FROM rrun),
rinc AS (SELECT *, done - coalesce(lag(done) OVER (PARTITION BY line_id ORDER BY prd_id), 0) AS part FROM rcap),
rrec AS (SELECT line_id, version, greatest(prd_id, open_prd) AS prd_id, sum(sg * part) AS units FROM rinc GROUP BY ALL),
qv AS (SELECT *, date_diff('day', start_date, end_date) + 1 AS span,
  date_diff('day', start_date, CASE WHEN end_date <= open_start THEN end_date ELSE open_end END) + 1 AS used
 FROM state WHERE open_prd IS NOT NULL AND NOT hold AND revised),
qn AS MATERIALIZED (SELECT *, CAST(sign(v * used - past * span) AS BIGINT) * ((2 * abs(v * used - past * span) + span) // (2 * span)) AS now_units FROM qv),
qr AS (SELECT *, v - past - now_units AS rest, greatest(end_date, next_start) AS to_day FROM qn),
qper AS (SELECT p.line_id, p.version, c.prd_id, abs(rest) AS total, sign(rest) AS sg, date_diff('day', next_start, to_day) + 1 AS span,
  c.end_date >= to_day AS is_last, date_diff('day', c.start_date, c.end_date) + 1 AS days
 FROM qr p JOIN cal c ON c.start_date >= next_start AND c.start_date <= to_day WHERE rest <> 0),
qrun AS (SELECT *, sum(greatest((2 * days * total + span) // (2 * span), 1)) OVER (PARTITION BY line_id ORDER BY prd_id) AS cum FROM qper),
qcap AS MATERIALIZED (SELECT *, CASE WHEN is_last THEN total ELSE least(cum, total) END AS done FROM qrun),
qinc AS (SELECT *, done - coalesce(lag(done) OVER (PARTITION BY line_id ORDER BY prd_id), 0) AS units FROM qcap)"""),
)
def schedule_run_orgs(spark, d):
    """One run for the open periods of all books and organisations."""
    ln = _sched_lines(spark, d, "org", "sales_action", "discount_pct")
    job = ln.select(
        "line_id", "rc_id", F.lit(1).alias("book_id"), "org", F.col("alctd_xt_prc").alias("amount"), "start_date", "end_date",
        F.date_add("start_date", 60).alias("init_expiry"),
    )
    job = S.with_open_period(job, org_periods(spark, d))
    suspended = ln.where(F.col("discount_pct") == 10).select("line_id")
    out = S.generate_schedules(job, _history(ln), suspended, FiscalCalendar.months(), "open_prd")
    return out.select("line_id", "version", "prd_id", "amount", "rule")
