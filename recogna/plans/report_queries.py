"""Registered reports."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import functions as F

from recogna.functions.scalars import convert, flag_at, period_list
from recogna.operators import journal as J
from recogna.operators import reports as R
from recogna.operators import waterfall as W
from recogna.plans import journal_queries as jq
from recogna.plans import schedule_queries as sq
from recogna.plans.base_queries import _scratch
from recogna.plans.duck import duck
from recogna.plans.registry import query
from recogna.sources import model
from recogna.sources.calendar import month_calendar
from recogna.sources.fiscal import FiscalCalendar

OPEN = model.OPEN_PRD
LAST = 200212


def _summary_sql() -> str:
    t = ", ".join(
        f"CAST(round(ext_sll_prc * CAST({i + 1} AS DECIMAL(3,0)) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) AS t_{n}"
        for i, n in enumerate(model.SUMMARY_AMOUNTS)
    )
    fr = ", ".join(
        f"CAST(round(t_{n} * f_ex_rate, 2) AS DECIMAL(18,2)) AS f_{n}, CAST(round(t_{n} * f_ex_rate * g_ex_rate, 2) AS DECIMAL(18,2)) AS r_{n}"
        for n in model.SUMMARY_AMOUNTS
    )
    return f"""summ0 AS (SELECT rc_id, line_id, line_id AS root_line_id, 1 AS book_id, f_ex_rate, g_ex_rate,
 (['R','X','L','A','U','T','B'])[(line_num + supp_key) % 7 + 1] AS acct_type_id, concat('SEG-', supp_key % 3) AS acct_segs,
 CASE discount_pct WHEN 9 THEN 'M' WHEN 10 THEN 'D' ELSE 'S' END AS schd_type, CAST(strftime(start_date, '%Y%m') AS INTEGER) AS prd_id,
 last_day(start_date) AS valid_from, last_day(start_date + to_months(line_num % 3)) AS valid_until,
 last_day(CAST(date_trunc('quarter', start_date) AS DATE) + INTERVAL 2 MONTH) AS pd_qt, make_date(year(start_date), 12, 31) AS pd_yr, {t} FROM lines),
summ AS (SELECT *, {fr} FROM summ0),
per AS (SELECT s.*, c.prd_id AS cal_prd_id, c.period_name, c.qtr_end_dt, c.year_end_dt, a.* EXCLUDE (acct_type_id)
 FROM summ s JOIN cal c ON c.end_date BETWEEN s.valid_from AND s.valid_until JOIN acct a ON a.acct_type_id = s.acct_type_id)"""


_IN = {"p": "cal_prd_id = prd_id", "q": "qtr_end_dt = pd_qt", "y": "year_end_dt = pd_yr"}


def _measure_sql() -> dict[str, str]:
    """Each measure as a CASE over the joined summary row, per currency."""
    out: dict[str, str] = {}

    def add(name: str, test: str, value: str) -> None:
        for c in ("t", "f", "r"):
            out[f"{c}_{name}"] = f"CAST(CASE WHEN {test} THEN {value.replace('$', c + '_')} ELSE 0 END AS DECIMAL(18,2))"

    def gated(name: str, test: str, base: str, other: str = "0", sign: str = "") -> None:
        for suffix, g in (("", "p"), ("_qt", "q"), ("_yt", "y")):
            add(f"{name}{suffix}", test, f"CASE WHEN {_IN[g]} THEN {sign}${base}{suffix} ELSE {other} END")

    def now(name: str, test: str, base: str) -> None:
        add(name, test, f"CASE WHEN {_IN['p']} THEN ${base} ELSE 0 END")

    rec, erec = "def_rec_flag = 'REC'", "def_rec_flag = 'EREC'"
    any_rec, any_def = "def_rec_flag IN ('REC','EREC')", "def_rec_flag IN ('DEF','EDEF')"
    for name, test in (("tl_at", any_rec), ("at", rec), ("ar_at", erec)):
        gated(name, test, "at")
    for name, test in (("tl_at", any_rec), ("at", rec), ("ar", erec)):
        now(f"{name}_ps", test, "ps")
        now(f"{name}_un", test, "un")
    add("tl_at_ut", f"{any_rec} AND acct_type_id <> 'S'", "$at_ut")
    add("rv_at_ut", rec, "$at_ut")
    add("ar_at_ut", erec, "$at_ut")
    for name, test in (("rt_ar", any_rec), ("rt", rec), ("ar_rt", erec)):
        gated(name, test, "rt_ar")
    for p, q, test in (("tl_", "tl_rl", any_def), ("", "rl", "def_rec_flag = 'DEF'"), ("al_", "al", "def_rec_flag = 'EDEF'")):
        gated(f"{p}bb", test, "bb", other="$eb")
        gated(f"{p}ad", test, "ad")
        gated(f"{p}rl", test, "rl")
        gated(f"{p}ca_im", test, "ca_im", sign="-")
        add(f"{p}eb", test, "$eb")
        now(f"{q}_ps", test, "ps")
        now(f"{q}_un", test, "un")
        now(f"{p}nt", test, "nt")
        now(f"{p}nt_rl", test, "nt_rl")
        for b in ("bb", "ad", "rl"):
            add(f"{p}{b}_ut", test, f"${b}_ut")
        add(f"{p}ca_im_ut", test, "-$ca_im_ut")
    gated("unbl_at", "acct_type_id = 'U'", "at")
    now("unbl_ps", "acct_type_id = 'U'", "ps")
    now("unbl_un", "acct_type_id = 'U'", "un")
    add("unbl_at_ut", "acct_type_id = 'U'", "$at_ut")
    add("unbl_utd", "acct_type_id IN ('U','Z')", "$eb")
    add("contra_rl_ut", "acct_type_id = 'T'", "$rl_ut")
    for s in ("", "_qt", "_yt"):
        for b in ("bb", "ad", "rl"):
            add(f"vc_{b}{s}", "vc_flag = 'Y'", f"${b}{s}")
        add(f"vc_clm{s}", "vc_flag = 'Y' AND vc_clr_flag = 'Y'", f"$rl{s}")
    add("vc_eb", "vc_flag = 'Y'", "$eb")
    add("vc_un", "vc_flag = 'Y'", "$un")
    add("vc_ps", "vc_flag = 'Y'", "$ps")
    add("tl_vc_ut", "vc_flag = 'Y'", "$at_ut")
    add("cum_bill_utd", "def_rec_flag = 'DEF' AND incl_netting_flag = 'Y' AND payables_acct_flag <> 'Y'", "$ad_ut")
    out.pop("r_cum_bill_utd")
    return out


_SUMMARY = _summary_sql()
_MEASURES = _measure_sql()
LINE_COLUMNS = (
    "t_tl_at", "t_at_qt", "t_ar_at_yt", "t_tl_at_ut", "t_tl_bb", "t_bb_qt", "t_al_bb_yt", "t_tl_eb", "t_rl_ps", "t_nt", "t_tl_nt_rl", "t_al_ca_im",
    "t_unbl_at", "t_unbl_utd", "t_contra_rl_ut", "t_vc_bb", "t_vc_clm_qt", "t_rt_ar", "t_ar_rt_qt", "t_cum_bill_utd", "f_tl_at", "r_tl_bb_qt",
)
BALANCES = ("lt_t_bal", "lt_f_bal", "lt_r_bal")


def _insight_inputs(spark, d, dealt="rc_id"):
    return model.account_summary_rows(spark, d, dealt), month_calendar(spark), model.account_types(spark)


def _latest(spark, d):
    src = model.account_summary_rows(spark, d)
    return src.select(
        "rc_id", "root_line_id", "acct_type_id", "acct_segs", F.col("prd_id").alias("cal_prd_id"),
        F.col("t_eb").alias("lt_t_bal"), F.col("f_eb").alias("lt_f_bal"), F.col("r_eb").alias("lt_r_bal"),
    )


def _line_sql(measures) -> str:
    latest = ", ".join(f"CAST(CASE WHEN cal_prd_id = prd_id AND schd_type <> 'D' THEN {c}_eb ELSE 0 END AS DECIMAL(18,2)) AS lt_{c}_bal" for c in "tfr")
    return f"SELECT per.cal_prd_id, per.line_id, per.acct_type_id, acct_group, schd_type, {', '.join(f'{_MEASURES[m]} AS {m}' for m in measures)}, {latest} FROM per"


def _line_summary(spark, d, measures):
    summary = model.account_summary_rows(spark, d, narrow=True)
    out = R.line_account_summary(
        summary, month_calendar(spark), model.account_types(spark), _latest(spark, d), measures, by=("rc_id", "root_line_id"), amounts=model.summary_amounts()
    )
    return out.select("cal_prd_id", "line_id", "acct_type_id", "acct_group", "schd_type", *measures, *BALANCES)


@query("line_account_summary", "RP7", "RP8", "J3", "J4", "SRC2", line_joins=True, sql=duck("cal lines acct", _line_sql(LINE_COLUMNS), _SUMMARY))
def line_account_summary(spark, d):
    return _line_summary(spark, d, LINE_COLUMNS)


@query("line_account_measures", "RP7", "RP8", "J3", line_joins=True, sql=duck("cal lines acct", _line_sql(_MEASURES), _SUMMARY))
def line_account_measures(spark, d):
    """All measures of the report and its three latest balances."""
    return _line_summary(spark, d, tuple(_MEASURES))


@query(
    "insight_totals", "RP7",
    sql=duck("cal lines acct", f"""SELECT cal_prd_id, acct_type_id, {', '.join(f'CAST(sum({sql}) AS DECIMAL(28,2)) AS {m}' for m, sql in _MEASURES.items())} FROM per GROUP BY ALL""", _SUMMARY),
)
def insight_totals(spark, d):
    """All measures of all three currencies, summed per report period and account."""
    return R.insight_totals(*_insight_inputs(spark, d, dealt=None))  # summed by account: no need to deal lines


def _account_sql() -> str:
    rev = "acct_group IN ('EREV','REV') AND pl_flag = 'Y'"
    adj = "acct_group = 'EREV' AND pl_flag = 'Y'"
    bal = "acct_group IN ('DREV','EDREV') AND incl_netting_flag = 'Y' AND payables_acct_flag <> 'Y'"
    table = [
        ("cum_revenue_utd", rev, "tl_at_ut"), ("cum_adj_revenue_utd", adj, "ar_at_ut"), ("adj_mtd_revenue", adj, "ar_at"), ("adj_qtd_revenue", adj, "ar_at_qt"),
        ("adj_ytd_revenue", adj, "ar_at_yt"), ("total_revenue_activity", rev, "tl_at"), ("total_revenue_activity_qtd", rev, "tl_at_qt"),
        ("total_revenue_activity_ytd", rev, "tl_at_yt"), ("total_ending_balance", bal, "tl_eb"), ("alloc_ending_balance", bal, "al_eb"),
        ("unbill_ending_balance", "acct_type_id IN ('Z','U')", "unbl_utd"), ("contra_ar_balance", "acct_type_id = 'T'", "contra_rl_ut"),
        ("cum_billing_utd", "acct_group IN ('DREV','EDREV')", "cum_bill_utd"),
    ]
    cols = [
        f"CAST(sum(CASE WHEN {test} THEN {_MEASURES[f'{c}_{m}']} ELSE 0 END) AS DECIMAL(28,2)) AS {c}_{name}"
        for c in ("t", "f", "r") for name, test, m in table if f"{c}_{m}" in _MEASURES
    ]
    return ", ".join(cols)


_ACCOUNTS = f"""accounts AS (SELECT cal_prd_id, period_name, book_id, rc_id, line_id, root_line_id, acct_name, acct_segs, vc_flag, cost_flag,
 CASE schd_type WHEN 'M' THEN 'Y' WHEN 'T' THEN 'Y' ELSE 'N' END AS mje_flag, {_account_sql()} FROM per GROUP BY ALL)"""
ACCOUNT_KEYS = ("cal_prd_id", "rc_id", "line_id", "acct_name", "acct_segs", "vc_flag", "cost_flag", "mje_flag")
ACCOUNT_COLUMNS = tuple(
    f"{c}_{m}" for c in ("t", "f", "r") for m in (
        "cum_revenue_utd", "cum_adj_revenue_utd", "adj_mtd_revenue", "adj_qtd_revenue", "adj_ytd_revenue", "total_revenue_activity", "total_revenue_activity_qtd",
        "total_revenue_activity_ytd", "total_ending_balance", "alloc_ending_balance", "unbill_ending_balance", "contra_ar_balance", "cum_billing_utd")
    if (c, m) != ("r", "cum_billing_utd")
)


@query("account_summary", "RP9", "AG2", sql=duck("cal lines acct", f"SELECT {', '.join(ACCOUNT_KEYS + ACCOUNT_COLUMNS)} FROM accounts", _SUMMARY, _ACCOUNTS))
def account_summary(spark, d):
    return R.account_summary(*_insight_inputs(spark, d)).select(*ACCOUNT_KEYS, *ACCOUNT_COLUMNS)


_BILLED = """lb AS (SELECT rc_id, line_id, CASE line_num WHEN 1 THEN 'RORD' ELSE 'INV' END AS type, bld_def_amt AS amt, f_ex_rate FROM lines WHERE line_status = 'F'
 UNION ALL SELECT rc_id, line_id, 'INV', bld_rec_amt, f_ex_rate FROM lines WHERE line_status = 'F'),
bsum AS (SELECT rc_id, line_id, CAST(sum(amt) AS DECIMAL(28,2)) AS cum_bill_amt, CAST(sum(amt * f_ex_rate) AS DECIMAL(28,4)) AS f_cum_bill_amt FROM lb WHERE type <> 'RORD' GROUP BY ALL),
billing AS (SELECT l.rc_id, l.line_id, l.contract_num, CASE WHEN line_status = 'O' THEN 'Y' ELSE 'N' END AS right_to_bill, cum_bill_amt, f_cum_bill_amt, CAST(alctd_xt_prc AS DECIMAL(28,2)) AS t_price,
 CAST(alctd_xt_prc * f_ex_rate AS DECIMAL(28,4)) AS f_price, CAST(alctd_xt_prc * g_ex_rate AS DECIMAL(28,4)) AS r_price FROM lines l LEFT JOIN bsum USING (rc_id, line_id) WHERE l.rc_id <> 1)"""


def _billing(spark, d):
    ln = model.lines(spark, d, "rc_id", "line_id", "line_num", "contract_num", "line_status", "bld_def_amt", "bld_rec_amt", "alctd_xt_prc", "f_ex_rate", "g_ex_rate")
    billed = ln.where("line_status = 'F'").select(
        "rc_id", "line_id", "f_ex_rate",
        F.explode(F.array(
            F.struct(F.when(F.col("line_num") == 1, "RORD").otherwise("INV").alias("type"), F.col("bld_def_amt").alias("ext_sll_prc")),
            F.struct(F.lit("INV").alias("type"), F.col("bld_rec_amt").alias("ext_sll_prc")),
        )).alias("b"),
    ).select("rc_id", "line_id", "f_ex_rate", "b.*")
    job = ln.select(
        "rc_id", "line_id", "contract_num", F.when(F.col("line_status") == "O", "Y").otherwise("N").alias("right_to_bill"),
        F.col("alctd_xt_prc").alias("net_sll_prc"), "f_ex_rate", "g_ex_rate",
    )
    return R.line_billing(job, billed).drop("net_sll_prc", "f_ex_rate", "g_ex_rate")


@query("line_billing", "RP10", "AG1", "J2", "SC22", "SRC1", sql=duck("lines", "SELECT * FROM billing", _BILLED))
def line_billing(spark, d):
    return _billing(spark, d)


@query(
    "revenue_insight", "RP11", "J1",
    sql=duck("cal lines acct contracts", f"""SELECT b.rc_id, b.line_id, b.contract_num, b.right_to_bill, a.cal_prd_id, a.acct_name, a.acct_segs, a.mje_flag, b.cum_bill_amt, b.f_cum_bill_amt, b.t_price, b.f_price, b.r_price,
 {', '.join(f'a.{c}' for c in ACCOUNT_COLUMNS)}, c.treatment, c.posted
 FROM billing b JOIN accounts a ON b.line_id = a.root_line_id JOIN contracts c ON c.rc_id = b.rc_id""", _BILLED, _SUMMARY, _ACCOUNTS),
)
def revenue_insight(spark, d):
    accounts = R.account_summary(*_insight_inputs(spark, d, dealt="line_id"))
    out = R.revenue_insight(_billing(spark, d), accounts, model.contracts(spark, d).drop("contract_num"))
    return out.select(
        "rc_id", "line_id", "contract_num", "right_to_bill", "cal_prd_id", "acct_name", "acct_segs", "mje_flag", "cum_bill_amt", "f_cum_bill_amt", "t_price", "f_price", "r_price",
        *ACCOUNT_COLUMNS, "treatment", "posted",
    )


MONTHS = FiscalCalendar.months()


def one_period(spark, d):
    """All organisations are enabled and have the same open period."""
    org = model.table(spark, d, "region").select(F.col("r_regionkey").alias("org"), F.lit("Y").alias("enabled"))
    return W.gate(org.select("org", F.lit(OPEN).alias("prd_id"), F.lit("OPEN").alias("status")), org)


def _snapshot(spark, d):
    windows = (F.col("start_date").alias("first_date"), F.col("end_date").alias("last_date"))
    custom = sq.custom_schedules(spark, d, "org", "start_date", "end_date", dealt="rc_id").select(*model.BY_LINE, "org", "prd_id", "amount", *windows)
    counted = ((F.col("schd_type") == "R") & (flag_at(F.col("indicators"), 5) != "Y")) | ((F.col("schd_type") == "A") & (flag_at(F.col("indicators"), 6) != "Y"))
    entries = model.schedules(spark, d, dealt="rc_id").select(*model.BY_LINE, "prd_id", "amount", "schd_type", counted.alias("counted"))
    return W.snapshot_rows(custom, entries, MONTHS, OPEN, OPEN, model.BY_LINE)


def _waterfall_inputs(spark, d, gate):
    """The run period's snapshot, stored once and read back, the gate and the lines with their rates."""
    store = W.SnapshotStore(spark, _scratch(spark))
    store.take(_snapshot(spark, d), gate, OPEN, OPEN)
    return store.read(OPEN, gate), gate, model.lines(spark, d, "line_id", "f_ex_rate", "g_ex_rate", dealt="line_id")


_MONTHS = period_list(OPEN, LAST)


@query(
    "waterfall_monthly", "RP1", "PV1", "J13",
    sql=duck("cal schedules", f"""SELECT line_id, rev_type, CAST(coalesce(sum(amount) FILTER (prd_id < {OPEN}), 0) AS DECIMAL(28,2)) AS prior_amt,
 {', '.join(f'CAST(coalesce(sum(amount * g_ex_rate * f_ex_rate) FILTER (prd_id = {p}), 0) AS DECIMAL(28,4)) AS p{p}' for p in _MONTHS)}
 FROM snap JOIN lines USING (line_id) GROUP BY ALL""", *sq.SNAPSHOT_SQL),
)
def waterfall_monthly(spark, d):
    out = W.monthly(*_waterfall_inputs(spark, d, one_period(spark, d)), MONTHS, OPEN, LAST, "R")
    return out.drop("warning")


_QUARTERS = R.quarter_columns(OPEN, 8)


@query(
    "waterfall_quarters", "RP2", "PV2", "W4", "AG10",
    sql=duck("cal schedules", f"""SELECT line_id, rev_type, CAST(coalesce(sum(amount) FILTER (q < 19992), 0) AS DECIMAL(28,2)) AS prior_amt,
 {', '.join(f'CAST(coalesce(sum(amount * f_ex_rate) FILTER (q = {q}), 0) AS DECIMAL(28,4)) AS q{q}' for q in _QUARTERS)},
 CAST(coalesce(sum(amount) FILTER (q > coalesce((SELECT qid FROM (SELECT period_year * 10 + qtr_num AS qid, dense_rank() OVER (ORDER BY period_year * 10 + qtr_num) AS rk FROM cal WHERE prd_id >= {OPEN}) WHERE rk = 8 LIMIT 1), 99999)), 0) AS DECIMAL(28,2)) AS remaining_bal
 FROM (SELECT s.*, f_ex_rate, CASE WHEN s.prd_id < {OPEN} THEN 0 ELSE period_year * 10 + qtr_num END AS q FROM snap s JOIN cal USING (prd_id) JOIN (SELECT line_id, f_ex_rate FROM lines) USING (line_id)) GROUP BY ALL""", *sq.SNAPSHOT_SQL),
)
def waterfall_quarters(spark, d):
    out = W.quarterly(*_waterfall_inputs(spark, d, one_period(spark, d)), MONTHS, OPEN, LAST, OPEN, "F")
    return out.drop("warning")


@query(
    "waterfall_orgs", "RP3",
    sql=duck("", f"""SELECT CAST(NULL AS INTEGER) AS org, CAST(NULL AS INTEGER) AS prd_id, concat('Org Name ''All'' is not supported', ' in Waterfall Report for Multiple Open Periods') AS reason, 'all' AS asked
 UNION ALL SELECT org, open_prd, NULL, 'some' FROM opens WHERE org IN (0, 2)
 UNION ALL SELECT org, {OPEN}, NULL, 'one period' FROM opens WHERE org <> 1""", sq._OPENS),
)
def waterfall_orgs(spark, d):
    """What the gate says of all organisations while their open periods differ, of two of them, and of all when they agree."""
    periods = sq.org_periods(spark, d)
    orgs = model.table(spark, d, "region").select(F.col("r_regionkey").alias("org"), F.when(F.col("r_regionkey") == 1, "N").otherwise("Y").alias("enabled"))
    same = periods.withColumn("prd_id", F.lit(OPEN))
    asked = (("all", W.gate(periods, orgs)), ("some", W.gate(periods, orgs, [0, 2])), ("one period", W.gate(same.where("status = 'OPEN'"), orgs)))
    return reduce(lambda a, b: a.unionByName(b), [g.withColumn("asked", F.lit(name)) for name, g in asked])


@query(
    "waterfall_all_orgs", "RP3", "SNK3", "RP1",
    sql=duck("cal schedules", f"""SELECT line_id, rev_type, CAST(coalesce(sum(amount) FILTER (prd_id < {OPEN}), 0) AS DECIMAL(28,2)) AS prior_amt,
 CAST(coalesce(sum(amount) FILTER (prd_id = {OPEN}), 0) AS DECIMAL(28,4)) AS p{OPEN}, CAST(NULL AS VARCHAR) AS warning, asked
 FROM snap JOIN (SELECT line_id, org FROM lines) USING (line_id) JOIN (VALUES (2, 'one'), (2, 'three'), (0, 'three'), (3, 'three')) a(org, asked) USING (org) GROUP BY ALL
 UNION ALL SELECT NULL, NULL, NULL, NULL, concat('Org Name ''All'' is not supported', ' in Waterfall Report for Multiple Open Periods'), 'all'""", *sq.SNAPSHOT_SQL),
)
def waterfall_all_orgs(spark, d):
    """One stored snapshot, three reports: one organisation, whose partition alone is read; three of them; and all,
    refused because their open periods differ."""
    periods = sq.org_periods(spark, d)
    orgs = model.table(spark, d, "region").select(F.col("r_regionkey").alias("org"), F.lit("Y").alias("enabled"))
    store = W.SnapshotStore(spark, _scratch(spark))
    store.take(_snapshot(spark, d), W.gate(periods, orgs, range(5)), OPEN, OPEN)
    rates = model.lines(spark, d, "line_id", "f_ex_rate", "g_ex_rate")
    asked = (("one", W.gate(periods, orgs, [2])), ("three", W.gate(periods, orgs, [0, 2, 3])), ("all", W.gate(periods, orgs)))
    reports = [W.monthly(store.read(OPEN, g), g, rates, MONTHS, OPEN, OPEN).withColumn("asked", F.lit(name)) for name, g in asked]
    return reduce(lambda a, b: a.unionByName(b), reports)


def _qtd_rows(spark, d, dealt="line_id"):
    """Actual and forecast rows; ``dealt`` ones lie together by line, so that a line's sums need no shuffle."""
    actual = J.both_sides(model.schedules(spark, d, dealt=dealt)).select("root_line_id", "rc_id", "prd_id", "acct_type_id", F.col("net").alias("amount"), F.lit("A").alias("src"))
    rec = sq.custom_schedules(spark, d, dealt=dealt).select(F.col("line_id").alias("root_line_id"), "rc_id", "prd_id", F.lit("R").alias("acct_type_id"), "amount", F.lit("F").alias("src"))
    return actual.unionByName(rec)


_QTD = """qr AS (SELECT line_id AS root_line_id, rc_id, prd_id, acct_type_id, net AS amount, 'A' AS src FROM ledger
 UNION ALL SELECT line_id, rc_id, prd_id, 'R', amount, 'F' FROM sched)"""


def _qtd_sql(kinds: str, mode: tuple[str, ...]) -> str:
    src = ",".join(f"'{m}'" for m in mode)
    s = lambda cond: f"CAST(coalesce(sum(amount) FILTER ({cond}), 0) AS DECIMAL(28,2))"
    months = [199903, 199904, 199905]
    cols = [f"{s(f'src = {chr(39)}A{chr(39)} AND prd_id < 199903')} AS prior_amount"]
    cols += [f"{s(f'src = {chr(39)}A{chr(39)} AND prd_id = {m}')} AS p{m}" for m in months]
    cols += [f"{s(f'src = {chr(39)}A{chr(39)} AND prd_id BETWEEN 199904 AND 199906')} AS qtd_amount"]
    cols += [f"{s(f'src IN ({src}) AND prd_id = {p}')} AS p{p}" for p in period_list(199906, 199911)]
    cols += [f"{s(f'src IN ({src}) AND prd_id = 199912')} AS \"=> 1999\""]
    cols += [f"{s(f'src IN ({src}) AND prd_id // 100 = {y}')} AS \"{y}\"" for y in (2000, 2001, 2002)]
    cols += [f"{s(f'(src IN ({src}) AND prd_id BETWEEN 199906 AND 200212) OR (src = {chr(39)}A{chr(39)} AND prd_id BETWEEN 199903 AND 199905)')} AS total"]
    return f"SELECT root_line_id, rc_id, {', '.join(cols)} FROM qr WHERE acct_type_id IN ({kinds}) AND src IN ('A', {src}) GROUP BY ALL"


@query("waterfall_quarter_to_date", "RP4", "RP6", "PV3", "PV4", sql=duck("cal ledger", _qtd_sql("'R','Y','X'", ("A",)), sq._RECOGNIZE, _QTD))
def waterfall_quarter_to_date(spark, d):
    return R.waterfall_qtd(_qtd_rows(spark, d).where("src = 'A'"), OPEN, LAST, 3, 6, "Net Revenue")


@query("waterfall_with_forecast", "RP4", "SE3", sql=duck("cal ledger", _qtd_sql("'R','Y'", ("A", "F")), sq._RECOGNIZE, _QTD))
def waterfall_with_forecast(spark, d):
    return R.waterfall_qtd(_qtd_rows(spark, d), OPEN, LAST, 3, 6, "Revenue", mode="AF")


@query(
    "waterfall_grand_total", "AG9",
    sql=duck("cal ledger", f"""SELECT root_line_id, prior_amount, qtd_amount, total FROM w UNION ALL
 SELECT 'TOTAL', CAST(sum(prior_amount) AS DECIMAL(28,2)), CAST(sum(qtd_amount) AS DECIMAL(28,2)), CAST(sum(total) AS DECIMAL(28,2)) FROM w""",
 sq._RECOGNIZE, _QTD, f"w AS ({_qtd_sql(chr(39) + 'X' + chr(39), ('A',))})"),
)
def waterfall_grand_total(spark, d):
    rows = R.waterfall_qtd(_qtd_rows(spark, d, dealt=None).where("src = 'A'"), OPEN, LAST, 3, 6, "Adjustments", total_label="TOTAL")
    return rows.select("root_line_id", "prior_amount", "qtd_amount", "total")


_SOURCES = f"""qc AS (SELECT qr.*, f_ex_rate AS fx, g_ex_rate AS gx FROM qr JOIN (SELECT line_id, f_ex_rate, g_ex_rate FROM lines) l ON l.line_id = qr.root_line_id),
src AS (SELECT 'T closed' AS asked, *, amount AS v FROM qc WHERE src = 'A' AND prd_id < {OPEN}
 UNION ALL SELECT 'F open', *, CAST(amount * fx AS DECIMAL(28,6)) FROM qc WHERE src = 'A'
 UNION ALL SELECT 'R forecast', *, CAST(amount * gx * fx AS DECIMAL(28,6)) FROM qc WHERE src = 'F'
 UNION ALL SELECT 'F both, closed', *, CAST(amount * fx AS DECIMAL(28,6)) FROM qc WHERE prd_id < {OPEN}
 UNION ALL SELECT 'T not frozen', *, amount FROM qc WHERE src = 'A')"""


@query(
    "waterfall_sources", "RP4", line_joins=True,
    sql=duck("cal ledger", f"""SELECT asked, root_line_id, rc_id, CAST(coalesce(sum(v) FILTER (src = 'A' AND prd_id BETWEEN 199904 AND CASE asked WHEN 'T not frozen' THEN 199904 WHEN 'F open' THEN {OPEN} WHEN 'R forecast' THEN {OPEN} ELSE 199905 END), 0) AS DECIMAL(28,2)) AS qtd_amount,
 CAST(coalesce(sum(v) FILTER (prd_id BETWEEN CASE asked WHEN 'T not frozen' THEN 199904 WHEN 'F open' THEN {OPEN} WHEN 'R forecast' THEN {OPEN} ELSE 199905 END AND {LAST}
   OR src = 'A' AND prd_id BETWEEN CASE asked WHEN 'T not frozen' THEN 199902 WHEN 'F open' THEN 199904 WHEN 'R forecast' THEN 199904 ELSE 199903 END AND CASE asked WHEN 'T not frozen' THEN 199903 WHEN 'F open' THEN 199905 WHEN 'R forecast' THEN 199905 ELSE 199904 END), 0) AS DECIMAL(28,2)) AS total
 FROM src WHERE acct_type_id IN ('R', 'Y') GROUP BY ALL""", sq._RECOGNIZE, _QTD, _SOURCES),
)
def waterfall_sources(spark, d):
    """Reports of a closed period from what was frozen at its end, of the open one and of a closed one that nothing was
    frozen for from live rows; in the three currencies, of actual amounts, forecasts and both."""
    rates = model.lines(spark, d, "line_id", "f_ex_rate", "g_ex_rate", dealt="line_id").withColumnRenamed("line_id", "root_line_id")
    money = lambda c: c.cast("decimal(28,6)")
    amount, f, g = F.col("amount"), F.col("f_ex_rate"), F.col("g_ex_rate")
    live = _qtd_rows(spark, d).join(rates, "root_line_id").select(
        "root_line_id", "rc_id", "prd_id", "acct_type_id", "src", *[money(convert(amount, f, g, c)).alias(f"{c.lower()}_at") for c in "TFR"]
    )
    # at the end of May only what was posted until then was there
    frozen = live.where(F.col("prd_id") < OPEN).withColumn("run_prd", F.lit(199905))
    run_log = spark.createDataFrame(
        [("WF_PERIOD_END", "COMPLETED", 199905), ("WF_PERIOD_END", "COMPLETED", 199904), ("WF_PERIOD_END", "FAILED", OPEN), ("OTHER", "COMPLETED", OPEN)],
        "process string, status string, run_prd int",
    )
    asked = (("T closed", 199905, "t_at", "A"), ("F open", OPEN, "f_at", "A"), ("R forecast", OPEN, "r_at", "F"), ("F both, closed", 199905, "f_at", "AF"), ("T not frozen", 199904, "t_at", "A"))
    rows = W.of_periods(live, frozen, run_log, sorted({run for _, run, _, _ in asked}))
    reports = [
        (
            name, F.array_contains("runs", run) & F.col("src").isin(*mode), column,
            {"run_prd": run, "end_prd": LAST, "n_prior": 2, "max_months": 6, "kind": "Revenue", "mode": mode, "calendar": MONTHS},
        )
        for name, run, column, mode in asked
    ]
    out = R.waterfalls_qtd(rows, reports, ("qtd_amount", "total"))
    return out.select("asked", "root_line_id", "rc_id", "qtd_amount", "total")


@query(
    "quarter_to_date_bounds", "RP5", "SO3",
    sql=duck("cal", """SELECT o.prd_id, (SELECT min(c.prd_id) FROM cal c WHERE c.qtr_start_dt = o.qtr_start_dt) AS min_prd, o.prd_id AS max_prd
 FROM cal o WHERE o.prd_id IN (SELECT CAST(strftime(max(o_orderdate) - INTERVAL 2 YEAR, '%Y%m') AS INTEGER) FROM orders)"""),
)
def quarter_to_date_bounds(spark, d):
    # the run period is two years before the last order
    last = model.table(spark, d, "orders").agg(F.add_months(F.max("o_orderdate"), -24).alias("day"))
    at = MONTHS.place(F.col("day"))
    run = last.select(MONTHS.id_at(at).alias("prd_id"), MONTHS.id_at(MONTHS.quarter_end_before(at) + 1).alias("min_prd"))
    return run.withColumn("max_prd", F.col("prd_id"))


_UNBILLED = f"""ubl AS (SELECT *, bld_def_amt + bld_rec_amt AS billed,
  CAST(CASE WHEN bld_def_amt + bld_rec_amt = 0 THEN 0 ELSE round(CAST((bld_def_amt + bld_rec_amt)::DOUBLE / alctbl_xt_prc::DOUBLE * 100 AS DECIMAL(28,8)), 2) END AS DECIMAL(18,2)) AS bld_pct FROM lines),
ubc AS (SELECT rc_id, CAST(sum(bld_pct * cv_amt * CAST(0.01 AS DECIMAL(3,2))) FILTER (cv_amt < 0) AS DECIMAL(28,6)) AS tb, sum(cv_amt) FILTER (cv_amt < 0) AS tc
  FROM ubl GROUP BY rc_id HAVING sum(alctbl_xt_prc) <> sum(billed) AND sum(cv_amt) FILTER (cv_amt < 0) IS NOT NULL),
uba AS (SELECT line_id, sum(net) FILTER (acct_name = 'Revenue') AS rev, sum(net) FILTER (acct_name = 'Adjustment Revenue') AS adj FROM ledger JOIN acct USING (acct_type_id) WHERE post_prd_id <= {OPEN} GROUP BY line_id),
ubr AS (SELECT u.rc_id, u.line_id, CAST(billed AS DECIMAL(28,2)) AS billed, CAST(cv_amt AS DECIMAL(28,2)) AS cv_amt, bld_pct,
  CAST(round(CAST(CASE WHEN cv_amt < 0 THEN (bld_pct * cv_amt * CAST(0.01 AS DECIMAL(3,2)))::DOUBLE WHEN cv_amt > 0 THEN cv_amt::DOUBLE / tc::DOUBLE * tb::DOUBLE ELSE 0 END AS DECIMAL(28,8)), 4) AS DECIMAL(28,4)) AS billed_cv,
  CAST(coalesce(rev, 0) AS DECIMAL(28,2)) AS revenue, CAST(coalesce(adj, 0) AS DECIMAL(28,2)) AS adj_revenue
 FROM ubl u JOIN ubc USING (rc_id) LEFT JOIN uba USING (line_id) WHERE bill_pending = 'Y' AND eligible = 'Y')"""


@query(
    "unbilled_report", "RP12",
    sql=duck("ledger acct", """SELECT *, CAST(deferred_cv - open_cv AS DECIMAL(28,4)) AS deferred_je FROM (SELECT *, CAST(revenue + adj_revenue AS DECIMAL(28,2)) AS revenue_to_date,
 CAST(CASE WHEN abs(adj_revenue) > abs(billed_cv) THEN 0 ELSE billed_cv - adj_revenue END AS DECIMAL(28,4)) AS deferred_cv,
 CAST(CASE WHEN abs(adj_revenue) > abs(billed_cv) THEN adj_revenue - billed_cv ELSE 0 END AS DECIMAL(28,4)) AS unbilled_cv, CAST(cv_amt - adj_revenue AS DECIMAL(28,2)) AS open_cv FROM ubr)""", _UNBILLED),
)
def unbilled_report(spark, d):
    ln = model.lines(spark, d, "rc_id", "line_id", "alctbl_xt_prc", "bld_def_amt", "bld_rec_amt", "cv_amt", "bill_pending", "eligible")
    ln = ln.withColumn("billed", F.col("bld_def_amt") + F.col("bld_rec_amt"))
    bal = jq._balances(spark, d, {"revenue": ("Revenue",), "adj_revenue": ("Adjustment Revenue",)})
    return R.unbilled_report(ln, bal)


JOURNAL_SPEC = R.ReportSpec(
    fields=(
        R.ReportField("rc_id", "ID", order="B"), R.ReportField("prod_ctgry", order="B"), R.ReportField("side", order="E"),
        R.ReportField("activity"), R.ReportField("amount", "AMOUNT"), R.ReportField("name"),
    ),
    mandatory=("prd_id",),
)


@query(
    "journal_report", "RP13",
    sql=duck("ledger acct contracts", """SELECT jl.rc_id, prod_ctgry, side, activity, amount, concat('JE-', jl.rc_id) AS name FROM jl JOIN contracts c ON c.rc_id = jl.rc_id
 WHERE crtd_prd_id BETWEEN 199801 AND 199906 AND side = 'DR'""", jq._BAL, jq._POS, jq._JOURNAL),
)
def journal_report(spark, d):
    heads = model.contracts(spark, d).select(F.col("rc_id").alias("header_id"), F.col("crtd_prd_id").alias("prd_id"), F.concat(F.lit("JE-"), "rc_id").alias("name"))
    filters = [R.ReportFilter("prd_id", 199801, "BETWEEN", 199906), R.ReportFilter("side", "DR"), R.ReportFilter("activity", None)]
    # a journal is made of its contract's lines alone, so other contracts' lines needn't be shuffled
    wanted = R.of_heads(heads, filters).select(F.col("header_id").alias("rc_id"))
    rows = jq._journal(spark, d, wanted).withColumn("header_id", F.col("rc_id"))
    return R.journal_report(heads, rows, JOURNAL_SPEC, filters)


LINE_SPEC = R.ReportSpec(
    fields=(
        R.ReportField("return_date", "DATE", order="A"), R.ReportField("ext_sll_prc", "AMOUNT", order="E"), R.ReportField("line_id", "ID", order="B"),
        R.ReportField("ord_qty", "QUANTITY"), R.ReportField("discount", "PERCENT"),
    ),
    row_limit=10000,
)


def _report_lines(spark, d):
    ln = model.lines(spark, d, "line_id", "ship_date", "ext_sll_prc", "ord_qty", "discount_pct", "return_flag")
    return ln.select("line_id", F.when(F.col("return_flag") == "R", F.col("ship_date")).alias("return_date"), "ext_sll_prc", "ord_qty", F.col("discount_pct").cast("decimal(10,2)").alias("discount"))


@query(
    "report_page", "RP14", "SO1", "SO2",
    sql=duck("lines", """SELECT CAST(rd AS VARCHAR) AS return_date, line_id, ext_sll_prc FROM (SELECT *, CASE WHEN return_flag = 'R' THEN ship_date END AS rd FROM lines)
 ORDER BY rd ASC NULLS FIRST, ext_sll_prc DESC NULLS LAST, line_id LIMIT 10000"""),
)
def report_page(spark, d):
    return R.run_report(_report_lines(spark, d), LINE_SPEC).select(F.col("return_date").cast("string").alias("return_date"), "line_id", "ext_sll_prc")


@query(
    "report_totals", "RP14", "AG9",
    sql=duck("lines", """SELECT CAST(rd AS VARCHAR) AS return_date, line_id, ext_sll_prc, ord_qty, false AS is_total FROM (SELECT *, CASE WHEN return_flag = 'R' THEN ship_date END AS rd FROM lines
  ORDER BY rd ASC NULLS FIRST, ext_sll_prc DESC NULLS LAST, line_id LIMIT 10000)
 UNION ALL SELECT NULL, NULL, CAST(sum(ext_sll_prc) AS DECIMAL(18,2)), CAST(sum(ord_qty) AS DECIMAL(18,2)), true FROM lines"""),
)
def report_totals(spark, d):
    """A page of a report and the totals of all its rows."""
    out = R.run_report(_report_lines(spark, d), replace(LINE_SPEC, totals=("ext_sll_prc", "ord_qty")))
    return out.select(F.col("return_date").cast("string").alias("return_date"), "line_id", "ext_sll_prc", "ord_qty", "is_total")


@query(
    "formatted_report", "SC20", "RP14",
    sql=duck("lines", """SELECT line_id, strftime(CASE WHEN return_flag = 'R' THEN ship_date END, '%d-%b-%Y') AS return_date, format('{:,.2f}', ext_sll_prc::DOUBLE) AS ext_sll_prc, format('{:,.1f}', ord_qty::DOUBLE) AS ord_qty,
 concat(format('{:,.2f}', discount_pct::DOUBLE), '%') AS discount FROM lines"""),
)
def formatted_report(spark, d):
    return R.format_report(_report_lines(spark, d), LINE_SPEC)
