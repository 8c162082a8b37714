"""Report jobs: insight measures, waterfalls, billing and unbilled reports, report layouts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recogna.functions.scalars import convert, decode, non_zero, period_list, shift_period
from recogna.functions.skew import attach
from recogna.sources.fiscal import FiscalCalendar

CURRENCIES = ("t", "f", "r")

# fixed values: account classes and account sets of the reports
REVENUE = ("REC", "EREC")
DEFERRED = ("DEF", "EDEF")
ACCOUNT_SETS = {"Revenue": ("R", "Y"), "Net Revenue": ("R", "Y", "X"), "Adjustments": ("X",)}


def account_set(kind: str) -> tuple[str, ...]:
    """Account types behind a report type."""
    return ACCOUNT_SETS[kind]


def interval_periods(rows: DataFrame, calendar: DataFrame, valid_from: str, valid_until: str) -> DataFrame:
    """One row per calendar period whose end lies in the validity interval.

    Month ends inside the interval are generated per row and meet the calendar in an
    equi-join, so nothing is compared with every period.
    """
    first = F.date_trunc("month", valid_from)
    whole = F.col(valid_until) == F.last_day(valid_until)
    last = F.when(whole, F.date_trunc("month", valid_until)).otherwise(F.add_months(F.date_trunc("month", valid_until), -1))
    months = F.when(F.to_date(last) >= F.to_date(first), F.sequence(F.to_date(first), F.to_date(last), F.expr("interval 1 month")))
    cal = calendar.select(
        F.col("prd_id").alias("cal_prd_id"), F.col("start_date").alias("_month"), "period_name",
        F.col("qtr_end_dt").alias("cal_qtr_end"), F.col("year_end_dt").alias("cal_year_end"),
    )
    return rows.withColumn("_month", F.explode(months)).join(F.broadcast(cal), "_month").drop("_month")


# Gates: how a row of one period shows in a report period. Measures are SQL text: several hundred of them, each
# put together from Column objects, took longer to plan than to run.


def in_period(value: str, otherwise: str = "0") -> str:
    return f"CASE WHEN cal_prd_id = prd_id THEN {value} ELSE {otherwise} END"


def in_quarter(value: str, otherwise: str = "0") -> str:
    return f"CASE WHEN cal_qtr_end = pd_qt_ed_dt THEN {value} ELSE {otherwise} END"


def in_year(value: str, otherwise: str = "0") -> str:
    return f"CASE WHEN cal_year_end = pd_yr_ed_dt THEN {value} ELSE {otherwise} END"


def up_to_date(value: str) -> str:
    return f"coalesce({value}, 0)"


def as_is(value: str) -> str:
    return value


GATES = {"": in_period, "_qt": in_quarter, "_yt": in_year}


def _among(column: str, values: Sequence[str]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


def insight_measures(wanted: Sequence[str] | None = None, currencies: Sequence[str] = CURRENCIES, amount_type: str = "decimal(18,2)") -> dict[str, str]:
    """Every measure of the line-account report by output name, as SQL.

    A measure is an account test, a period gate and a base amount; families repeat over
    total, contractual and allocated classes, over period, quarter, year and cumulative
    amounts, and over the three currencies.
    """
    names = None if wanted is None else set(wanted)
    out: dict[str, str] = {}

    def put(name: str, test: str, gate, base: str, other: str | None = None, sign: str = "") -> None:
        """Register the measure for every currency that is asked for."""
        for c in currencies:
            if names is None or f"{c}_{name}" in names:
                value = gate(f"{sign}{c}_{base}", *([f"{c}_{other}"] if other else []))
                out[f"{c}_{name}"] = f"CAST(CASE WHEN {test} THEN {value} ELSE 0 END AS {amount_type})"

    revenue = _among("def_rec_flag", REVENUE)
    for scope, test in (("tl_", revenue), ("", "def_rec_flag = 'REC'"), ("ar_", "def_rec_flag = 'EREC'")):
        tag = "ar" if scope == "ar_" else f"{scope}at"
        for suffix, gate in GATES.items():
            put(f"{scope}at{suffix}", test, gate, f"at{suffix}")
        put(f"{tag}_ps", test, in_period, "ps")
        put(f"{tag}_un", test, in_period, "un")
    put("tl_at_ut", f"{revenue} AND acct_type_id <> 'S'", up_to_date, "at_ut")
    put("rv_at_ut", "def_rec_flag = 'REC'", up_to_date, "at_ut")
    put("ar_at_ut", "def_rec_flag = 'EREC'", up_to_date, "at_ut")
    for suffix, gate in GATES.items():
        put(f"rt_ar{suffix}", revenue, gate, f"rt_ar{suffix}")
        put(f"rt{suffix}", "def_rec_flag = 'REC'", gate, f"rt_ar{suffix}")
        put(f"ar_rt{suffix}", "def_rec_flag = 'EREC'", gate, f"rt_ar{suffix}")
    for scope, test in (("tl_", _among("def_rec_flag", DEFERRED)), ("", "def_rec_flag = 'DEF'"), ("al_", "def_rec_flag = 'EDEF'")):
        tag = "al" if scope == "al_" else f"{scope}rl"
        for suffix, gate in GATES.items():
            put(f"{scope}bb{suffix}", test, gate, f"bb{suffix}", other="eb")
            put(f"{scope}ad{suffix}", test, gate, f"ad{suffix}")
            put(f"{scope}rl{suffix}", test, gate, f"rl{suffix}")
            put(f"{scope}ca_im{suffix}", test, gate, f"ca_im{suffix}", sign="-")
        put(f"{scope}eb", test, up_to_date, "eb")
        put(f"{tag}_ps", test, in_period, "ps")
        put(f"{tag}_un", test, in_period, "un")
        put(f"{scope}nt", test, in_period, "nt")
        put(f"{scope}nt_rl", test, in_period, "nt_rl")
        for name in ("bb", "ad", "rl"):
            put(f"{scope}{name}_ut", test, up_to_date, f"{name}_ut")
        put(f"{scope}ca_im_ut", test, up_to_date, "ca_im_ut", sign="-")
    unbilled = "acct_type_id = 'U'"
    for suffix, gate in GATES.items():
        put(f"unbl_at{suffix}", unbilled, gate, f"at{suffix}")
    put("unbl_ps", unbilled, in_period, "ps")
    put("unbl_un", unbilled, in_period, "un")
    put("unbl_at_ut", unbilled, up_to_date, "at_ut")
    put("unbl_utd", _among("acct_type_id", ("U", "Z")), up_to_date, "eb")
    put("contra_rl_ut", "acct_type_id = 'T'", up_to_date, "rl_ut")
    variable = "vc_flag = 'Y'"
    clears = f"{variable} AND vc_clr_flag = 'Y'"
    for suffix in GATES:
        for name in ("bb", "ad", "rl"):
            put(f"vc_{name}{suffix}", variable, as_is, f"{name}{suffix}")
        put(f"vc_clm{suffix}", clears, as_is, f"rl{suffix}")
    put("vc_eb", variable, as_is, "eb")
    put("vc_un", variable, as_is, "un")
    put("vc_ps", variable, as_is, "ps")
    put("tl_vc_ut", variable, as_is, "at_ut")
    billing = "def_rec_flag = 'DEF' AND incl_netting_flag = 'Y' AND payables_acct_flag <> 'Y'"
    put("cum_bill_utd", billing, up_to_date, "ad_ut")
    out.pop("r_cum_bill_utd", None)  # cumulative billing exists in two currencies only
    return out


def line_account_summary(
    summary: DataFrame,
    calendar: DataFrame,
    groups: DataFrame,
    latest: DataFrame | None = None,
    measures: Sequence[str] | None = None,
    by: Sequence[str] = ("root_line_id",),
    amounts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Insight measures per line, account and report period.

    A summary row shows in every period its validity covers; the account group decides
    which measures it feeds.  ``latest`` adds the latest balance of the line, account and
    period, which type-D rows show without one; ``by`` are the columns that name a line there. ``measures`` limits the
    columns; the scan then reads only their inputs. ``amounts``, if the summary is without them, are made of its rows when
    these have met everything, so that narrow rows are sorted.
    """
    valid = interval_periods(summary, calendar, "valid_from", "valid_until")
    rows = valid.join(F.broadcast(groups), "acct_type_id")
    balances: list[Column] = []
    if latest is not None:
        keys = [*by, "acct_type_id", "acct_segs", "cal_prd_id"]
        rows = rows.join(latest.select(*[F.col(k) for k in keys], "lt_t_bal", "lt_f_bal", "lt_r_bal"), keys, "left")
        dated = F.coalesce(F.col("schd_type") != "D", F.lit(False))
        balances = [F.when(dated & F.col(c).isNotNull(), F.col(c)).otherwise(0).cast("decimal(18,2)").alias(c) for c in ("lt_t_bal", "lt_f_bal", "lt_r_bal")]
    keep = insight_measures(measures)
    return rows.withColumns(dict(amounts or {})).select(
        "cal_prd_id", "period_name", "rc_id", "line_id", "root_line_id", "acct_type_id", "acct_segs", "acct_name",
        F.coalesce("acct_group", F.lit("UNKNOWN")).alias("acct_group"), "pl_flag", "vc_flag", "cost_flag",
        "incl_netting_flag", "payables_acct_flag", "schd_type", "book_id",
        *[F.expr(v).alias(k) for k, v in keep.items()],
        *balances,
    )


def insight_totals(summary: DataFrame, calendar: DataFrame, groups: DataFrame) -> DataFrame:
    """All measures summed per report period and account.

    Every measure is a base amount behind tests on the account and on the row's own dates,
    so rows that agree in those can be summed before they are spread over periods; the
    explode and the several hundred measures then see a few rows per account and period.
    """
    amounts = [c for c in summary.columns if c[:2] in ("t_", "f_", "r_")]
    keys = ["acct_type_id", "prd_id", "valid_from", "valid_until", "pd_qt_ed_dt", "pd_yr_ed_dt"]
    summed = summary.groupBy(*keys).agg(*[F.sum(a).cast("decimal(28,2)").alias(a) for a in amounts])
    rows = interval_periods(summed, calendar, "valid_from", "valid_until").join(F.broadcast(groups), "acct_type_id")
    return rows.groupBy("cal_prd_id", "acct_type_id").agg(
        *[F.expr(f"CAST(sum({v}) AS decimal(28,2))").alias(k) for k, v in insight_measures(amount_type="decimal(28,2)").items()]
    )


def account_measures() -> dict[str, Column]:
    """Sums of the account-level report over the line-account measures."""
    revenue = F.col("acct_group").isin("EREV", "REV") & (F.col("pl_flag") == "Y")
    adjustment = (F.col("acct_group") == "EREV") & (F.col("pl_flag") == "Y")
    balance = (
        F.col("acct_group").isin("DREV", "EDREV") & (F.col("incl_netting_flag") == "Y") & (F.col("payables_acct_flag") != "Y")
    )
    spec: dict[str, tuple[Column, str]] = {}
    for c in CURRENCIES:
        spec |= {
            f"{c}_cum_revenue_utd": (revenue, f"{c}_tl_at_ut"),
            f"{c}_cum_adj_revenue_utd": (adjustment, f"{c}_ar_at_ut"),
            f"{c}_adj_mtd_revenue": (adjustment, f"{c}_ar_at"),
            f"{c}_adj_qtd_revenue": (adjustment, f"{c}_ar_at_qt"),
            f"{c}_adj_ytd_revenue": (adjustment, f"{c}_ar_at_yt"),
            f"{c}_total_revenue_activity": (revenue, f"{c}_tl_at"),
            f"{c}_total_revenue_activity_qtd": (revenue, f"{c}_tl_at_qt"),
            f"{c}_total_revenue_activity_ytd": (revenue, f"{c}_tl_at_yt"),
            f"{c}_total_ending_balance": (balance, f"{c}_tl_eb"),
            f"{c}_alloc_ending_balance": (balance, f"{c}_al_eb"),
            f"{c}_unbill_ending_balance": (F.col("acct_type_id").isin("Z", "U"), f"{c}_unbl_utd"),
            f"{c}_contra_ar_balance": (F.col("acct_type_id") == "T", f"{c}_contra_rl_ut"),
        }
        if c != "r":
            spec[f"{c}_cum_billing_utd"] = (F.col("acct_group").isin("DREV", "EDREV"), f"{c}_cum_bill_utd")
    return {k: F.sum(F.when(test, F.col(src)).otherwise(0)).cast("decimal(28,2)") for k, (test, src) in spec.items()}


ACCOUNT_SOURCES = (
    "tl_at_ut", "ar_at_ut", "ar_at", "ar_at_qt", "ar_at_yt", "tl_at", "tl_at_qt", "tl_at_yt", "tl_eb", "al_eb", "unbl_utd", "contra_rl_ut",
)


def account_summary(summary: DataFrame, calendar: DataFrame, groups: DataFrame) -> DataFrame:
    """Account-level sums per period, line and account."""
    needed = [f"{c}_{m}" for c in CURRENCIES for m in ACCOUNT_SOURCES] + ["t_cum_bill_utd", "f_cum_bill_utd"]
    detail = line_account_summary(summary, calendar, groups, measures=needed)
    manual = decode(F.col("schd_type"), "M", "Y", "T", "Y", "N")
    return detail.groupBy(
        "cal_prd_id", "period_name", "book_id", "rc_id", "line_id", "root_line_id", "acct_name", "acct_segs", "vc_flag", "cost_flag",
        manual.alias("mje_flag"),
    ).agg(*[v.alias(k) for k, v in account_measures().items()])


def line_billing(lines: DataFrame, bills: DataFrame) -> DataFrame:
    """Lines with converted price, right-to-bill flag and cumulative billing.

    Bills are summed per contract and line before the outer join; the reporting price uses
    the reporting rate alone.
    """
    summed = (
        bills.where((F.col("type") != "RORD") & (F.col("rc_id") != 0))
        .groupBy("rc_id", "line_id")
        .agg(
            F.sum("ext_sll_prc").cast("decimal(28,2)").alias("cum_bill_amt"),
            F.sum(F.col("ext_sll_prc") * F.col("f_ex_rate")).cast("decimal(28,4)").alias("f_cum_bill_amt"),
        )
    )
    price = F.col("net_sll_prc")
    f, g = F.col("f_ex_rate"), F.col("g_ex_rate")
    return (
        lines.where(F.col("rc_id") != 1)
        .join(summed, ["rc_id", "line_id"], "left")
        .withColumns(
            {
                "t_price": convert(price, f, g, "T").cast("decimal(28,2)"),
                "f_price": convert(price, f, g, "F").cast("decimal(28,4)"),
                "r_price": convert(price, f, g, "R", reporting_via_functional=False).cast("decimal(28,4)"),
            }
        )
    )


def revenue_insight(billing: DataFrame, accounts: DataFrame, contracts: DataFrame) -> DataFrame:
    """Billing lines with their account sums and contract header."""
    # narrow lines meet their headers, not the wide account sums, which stay where they were summed
    headed = billing.join(contracts, "rc_id")
    return headed.join(accounts.drop("rc_id", "line_id"), headed["line_id"] == accounts["root_line_id"])


def waterfall(snapshot: DataFrame, lines: DataFrame, run_prd: int, end_prd: int, currency: str = "T") -> DataFrame:
    """Monthly waterfall per line and revenue type: prior amount and one column per period.

    Period amounts are converted, the prior amount stays in transaction currency as the
    report shows it.  Earlier rows pivot into the pseudo period 0, so one pass serves both.
    """
    periods = period_list(run_prd, end_prd)
    rates = lines.select("line_id", "f_ex_rate", "g_ex_rate")
    past = F.col("prd_id") < run_prd
    amount = F.when(past, F.col("amount")).otherwise(convert(F.col("amount"), F.col("f_ex_rate"), F.col("g_ex_rate"), currency))
    cells = snapshot.join(rates, "line_id").select(
        "line_id", "rev_type", F.when(past, 0).otherwise(F.col("prd_id")).alias("cell"), amount.cast("decimal(28,4)").alias("v")
    )
    pivoted = cells.groupBy("line_id", "rev_type").pivot("cell", [0, *periods]).agg(F.sum("v"))
    zero = F.lit(0)
    return pivoted.select(
        "line_id",
        "rev_type",
        F.coalesce(F.col("0"), zero).cast("decimal(28,2)").alias("prior_amt"),
        *[F.coalesce(F.col(str(p)), zero).cast("decimal(28,4)").alias(f"p{p}") for p in periods],
    )


def quarter_columns(run_prd: int, n: int = 8) -> list[int]:
    """Quarter ids yyyyq from the run period on."""
    year, q = run_prd // 100, (run_prd % 100 - 1) // 3 + 1
    out = []
    for _ in range(n):
        out.append(year * 10 + q)
        year, q = (year + 1, 1) if q == 4 else (year, q + 1)
    return out


def waterfall_quarterly(
    snapshot: DataFrame, lines: DataFrame, run_prd: int, end_prd: int, open_prd: int, currency: str = "T", n: int = 8
) -> DataFrame:
    """Quarterly waterfall: up to ``n`` quarters, the amount before them and the balance after them.

    When the run period is the open one, months before it count as prior, not in their
    quarter.  Prior and remaining amounts stay in transaction currency.
    """
    last = end_prd // 100 * 10 + (end_prd % 100 - 1) // 3 + 1
    quarters = [q for q in quarter_columns(run_prd, n) if q <= last]
    own = (F.col("prd_id") / 100).cast("int") * 10 + ((F.col("prd_id") % 100 - 1) / 3).cast("int") + 1
    quarter = F.when(F.col("prd_id") < open_prd, 0).otherwise(own) if run_prd == open_prd else own
    first = quarter_columns(run_prd, 1)[0]
    full = len(quarter_columns(run_prd, n)) == len(quarters) and len(quarters) == n
    beyond = quarters[-1] if full else 99999
    rates = lines.select("line_id", "f_ex_rate", "g_ex_rate")
    cells = snapshot.join(rates, "line_id").withColumn("q", quarter)
    shown = convert(F.col("amount"), F.col("f_ex_rate"), F.col("g_ex_rate"), currency)
    total = lambda test, v: F.coalesce(F.sum(F.when(test, v)), F.lit(0))
    return cells.groupBy("line_id", "rev_type").agg(
        total(F.col("q") < first, F.col("amount")).cast("decimal(28,2)").alias("prior_amt"),
        *[total(F.col("q") == q, shown).cast("decimal(28,4)").alias(f"q{q}") for q in quarters],
        total(F.col("q") > beyond, F.col("amount")).cast("decimal(28,2)").alias("remaining_bal"),
    )


def resolve_orgs(periods: DataFrame, orgs: DataFrame, requested: Sequence[int] | None = None) -> DataFrame:
    """Organisations a waterfall may cover.

    A list is taken as given; all organisations are possible only while the enabled ones
    share one open period.
    """
    open_ = periods.where("status = 'OPEN'").join(orgs.where("enabled = 'Y'"), "org").select("org", "prd_id")
    if requested is not None:
        return open_.where(F.col("org").isin(*requested))
    single = open_.agg(F.countDistinct("prd_id").alias("n")).where("n = 1")
    return open_.join(F.broadcast(single), F.col("prd_id").isNotNull()).drop("n")


@dataclass(frozen=True)
class PeriodColumn:
    label: str
    first: int
    last: int


def month_then_year_columns(first: int, last: int, max_months: int) -> list[PeriodColumn]:
    """Month columns up to ``max_months``, then one column per year (``=> year`` when the first is partial)."""
    periods = period_list(first, last)
    columns = [PeriodColumn(f"p{p}", p, p) for p in periods[:max_months]]
    rest = periods[max_months:]
    for year in sorted({p // 100 for p in rest}):
        own = [p for p in rest if p // 100 == year]
        partial = year == rest[0] // 100
        columns.append(PeriodColumn(f"=> {year}" if partial else str(year), own[0], own[-1]))
    return columns


def waterfall_qtd(
    rows: DataFrame,
    run_prd: int,
    end_prd: int,
    n_prior: int,
    max_months: int,
    kind: str,
    mode: str = "A",
    amount: str = "amount",
    calendar: FiscalCalendar | None = None,
    total_label: str | None = None,
) -> DataFrame:
    """Quarter-to-date waterfall per line.

    ``rows``: root_line_id, rc_id, prd_id, acct_type_id, ``amount`` (the column of the report's currency), src ('A'
    actual, 'F' forecast).  Columns: prior amount (everything up to the run period less the run period
    and the listed prior months), the listed prior months, the quarter to date, months then
    years, and the total.  ``mode``: actual (A), forecast (F, without prior amount) or both
    (AF). Quarters and prior periods are the calendar's. With ``total_label`` a row of that name sums all lines up; the
    same pass makes it, as a grouping set without keys.
    """
    scope, tests = _qtd_tests(run_prd, end_prd, n_prior, max_months, kind, mode, calendar)
    scoped = rows.where(scope)
    sums = [_qtd_sum(test, amount).alias(name) for name, test in tests.items()]
    if total_label is None:
        return scoped.groupBy("root_line_id", "rc_id").agg(*sums)
    keys = [F.col("root_line_id"), F.col("rc_id")]
    both = scoped.groupingSets([keys, []], *keys).agg(F.grouping_id().alias("_level"), *sums)
    label = F.when(F.col("_level") == 0, F.col("root_line_id")).otherwise(F.lit(total_label))
    return both.withColumn("root_line_id", label).drop("_level")


def waterfalls_qtd(rows: DataFrame, reports: Sequence[tuple[str, Column, str, dict]], shown: Sequence[str]) -> DataFrame:
    """Columns ``shown`` of several quarter-to-date waterfalls of the same rows, in one pass over them.

    ``reports``: name (``asked``), which rows it is made of, their amount column and the other arguments of
    ``waterfall_qtd``. A line is in a report that has a row of it.
    """
    sums, parts = [], []
    for i, (name, of, amount, arguments) in enumerate(reports):
        scope, tests = _qtd_tests(**arguments)
        mine = of & scope
        sums += [F.count(F.when(mine, 1)).alias(f"_n{i}"), *[_qtd_sum(mine & tests[c], amount).alias(f"_{c}{i}") for c in shown]]
        parts.append(F.when(F.col(f"_n{i}") > 0, F.struct(F.lit(name).alias("asked"), *[F.col(f"_{c}{i}").alias(c) for c in shown])))
    lines = rows.groupBy("root_line_id", "rc_id").agg(*sums)
    each = lines.select("root_line_id", "rc_id", F.explode(F.array(*parts)).alias("r")).where("r IS NOT NULL")
    return each.select("r.asked", "root_line_id", "rc_id", *[f"r.{c}" for c in shown])


def _qtd_sum(test: Column, amount: str) -> Column:
    return F.coalesce(F.sum(F.when(test, F.col(amount))), F.lit(0)).cast("decimal(28,2)")


def _qtd_tests(
    run_prd: int, end_prd: int, n_prior: int, max_months: int, kind: str, mode: str = "A", calendar: FiscalCalendar | None = None
) -> tuple[Column, dict[str, Column]]:
    """Which rows a quarter-to-date waterfall is made of, and which of them each of its columns sums up."""
    periods = (calendar or FiscalCalendar.months()).periods
    at = next(i for i, p in enumerate(periods) if p.id == run_prd)
    months = [p.id for p in periods[max(0, at - n_prior) : at]]
    quarter_first = next(p.id for p in periods if (p.year, p.quarter) == (periods[at].year, periods[at].quarter))
    src = {"A": ("A",), "F": ("F",), "AF": ("A", "F")}[mode]
    actual, prd = F.col("src") == "A", F.col("prd_id")
    shown = F.col("src").isin(*src)
    scope = F.col("acct_type_id").isin(*account_set(kind)) & (actual | shown)
    listed = actual & prd.between(months[0], months[-1]) if months else F.lit(False)
    tests = {}
    if mode != "F":
        tests["prior_amount"] = actual & (prd < (months[0] if months else run_prd))
    tests |= {f"p{m}": actual & (prd == m) for m in months}
    tests["qtd_amount"] = actual & prd.between(quarter_first, run_prd)
    tests |= {c.label: shown & prd.between(c.first, c.last) for c in month_then_year_columns(run_prd, end_prd, max_months)}
    tests["total"] = (shown & prd.between(run_prd, end_prd)) | listed
    return scope, tests


def prior_period_pivot(rows: DataFrame, run_prd: int, n: int, keys: Sequence[str]) -> DataFrame:
    """Amounts of the ``n`` periods before the run period as columns; empty cells are zero."""
    months = [shift_period(run_prd, -i) for i in range(n, 0, -1)]
    pivoted = rows.where(F.col("prd_id").between(months[0], months[-1])).groupBy(*keys).pivot("prd_id", months).agg(F.sum("amount"))
    return pivoted.select(*keys, *[F.coalesce(F.col(str(m)), F.lit(0)).cast("decimal(28,2)").alias(f"p{m}") for m in months])


def with_grand_total(detail: DataFrame, keys: Sequence[str], label: str = "TOTAL") -> DataFrame:
    """Detail rows followed by one row of column sums."""
    sums = [c for c in detail.columns if c not in keys]
    first = F.lit(label).cast(detail.schema[keys[0]].dataType).alias(keys[0])
    total = detail.agg(*[F.sum(c).cast(detail.schema[c].dataType).alias(c) for c in sums]).select(
        first, *[F.lit(None).cast(detail.schema[k].dataType).alias(k) for k in keys[1:]], *sums
    )
    return detail.unionByName(total)


def unbilled_report(lines: DataFrame, balances: DataFrame) -> DataFrame:
    """Billed share, billed carve amount and the deferred and unbilled split of pending contracts.

    ``lines``: rc_id, line_id, alctbl_xt_prc, billed, cv_amt, bill_pending, eligible.
    ``balances``: line_id, revenue, adj_revenue to date.  The carve total comes from lines
    with a negative carve amount; positive ones share it in proportion.
    """
    d2 = "decimal(28,2)"
    pct_units = F.when(
        F.coalesce("billed", F.lit(0)) == 0, F.lit(0)
    ).otherwise(F.round((F.col("billed").cast("double") / non_zero(F.col("alctbl_xt_prc")).cast("double") * 100).cast("decimal(28,8)"), 2))
    rated = lines.withColumn("bld_pct", pct_units.cast("decimal(18,2)"))
    negative = F.col("cv_amt") < 0
    hundredth = F.lit("0.01").cast("decimal(3,2)")
    contract = rated.groupBy("rc_id").agg(
        F.sum("alctbl_xt_prc").alias("a"),
        F.sum("billed").alias("b"),
        F.sum(F.when(negative, F.col("bld_pct") * F.col("cv_amt") * hundredth)).cast("decimal(28,6)").alias("total_bld_cv"),
        F.sum(F.when(negative, F.col("cv_amt"))).cast(d2).alias("total_cv"),
    ).where((F.col("a") != F.col("b")) & F.col("total_cv").isNotNull()).select("rc_id", "total_bld_cv", "total_cv")
    shown = attach(rated.where((F.col("bill_pending") == "Y") & (F.col("eligible") == "Y")), contract, ["rc_id"]).where("total_cv IS NOT NULL")
    zero = F.lit(0).cast(d2)
    billed_cv = (
        F.when(negative, (F.col("bld_pct") * F.col("cv_amt") * hundredth).cast("double"))
        .when(F.col("cv_amt") > 0, F.col("cv_amt").cast("double") / F.col("total_cv").cast("double") * F.col("total_bld_cv").cast("double"))
        .otherwise(F.lit(0.0))
    )
    rows = shown.join(balances, "line_id", "left").select(
        "rc_id", "line_id", F.col("billed").cast(d2).alias("billed"), F.col("cv_amt").cast(d2).alias("cv_amt"), "bld_pct",
        F.round(billed_cv.cast("decimal(28,8)"), 4).cast("decimal(28,4)").alias("billed_cv"),
        F.coalesce("revenue", zero).cast(d2).alias("revenue"), F.coalesce("adj_revenue", zero).cast(d2).alias("adj_revenue"),
    )
    over = F.abs("adj_revenue") > F.abs("billed_cv")
    d4 = "decimal(28,4)"
    deferred = F.when(over, 0).otherwise(F.col("billed_cv") - F.col("adj_revenue")).cast(d4)
    unbilled = F.when(over, F.col("adj_revenue") - F.col("billed_cv")).otherwise(0).cast(d4)
    open_cv = (F.col("cv_amt") - F.col("adj_revenue")).cast(d2)
    return rows.select(
        "*",
        (F.col("revenue") + F.col("adj_revenue")).cast(d2).alias("revenue_to_date"),
        deferred.alias("deferred_cv"),
        unbilled.alias("unbilled_cv"),
        open_cv.alias("open_cv"),
        (deferred - open_cv).cast(d4).alias("deferred_je"),
    )


@dataclass(frozen=True)
class ReportField:
    """Column of a report layout; ``order`` is one of B, A (ascending) and E, D (descending).

    B and E put nulls last, A and D first.
    """

    name: str
    kind: str = "TEXT"
    label: str | None = None
    order: str | None = None


@dataclass(frozen=True)
class ReportSpec:
    fields: tuple[ReportField, ...]
    mandatory: tuple[str, ...] = ()
    totals: tuple[str, ...] = ()
    row_limit: int | None = None


@dataclass(frozen=True)
class ReportFilter:
    column: str
    value: object
    operator: str = "="
    upper: object | None = None

    def condition(self) -> Column:
        if self.operator == "BETWEEN":
            return F.col(self.column).between(self.value, self.upper)
        if self.operator == "=":
            return F.col(self.column) == self.value
        raise ValueError(f"unsupported operator {self.operator!r}")


def filter_report(df: DataFrame, spec: ReportSpec, filters: Sequence[ReportFilter]) -> DataFrame:
    given = {f.column for f in filters if f.value is not None}
    missing = [m for m in spec.mandatory if m not in given]
    if missing:
        raise ValueError(f"missing mandatory filters: {missing}")
    return reduce(lambda d, f: d.where(f.condition()) if f.value is not None else d, filters, df)


def order_columns(spec: ReportSpec) -> list[Column]:
    rule = {
        "B": lambda c: c.asc_nulls_last(),
        "A": lambda c: c.asc_nulls_first(),
        "E": lambda c: c.desc_nulls_last(),
        "D": lambda c: c.desc_nulls_first(),
    }
    return [rule[f.order](F.col(f.name)) for f in spec.fields if f.order]


def format_report(df: DataFrame, spec: ReportSpec) -> DataFrame:
    """Formatted text per column type."""
    style = {
        "AMOUNT": lambda c: F.format_number(c, 2),
        "NUMBER": lambda c: F.format_number(c, 0),
        "PERCENT": lambda c: F.concat(F.format_number(c, 2), F.lit("%")),
        "QUANTITY": lambda c: F.format_number(c, 1),
        "DATE": lambda c: F.date_format(c, "dd-MMM-yyyy"),
        "ID": lambda c: c.cast("string"),
        "TEXT": lambda c: c,
    }
    return df.select(*[style[f.kind](F.col(f.name)).alias(f.label or f.name) for f in spec.fields])


def run_report(df: DataFrame, spec: ReportSpec, filters: Sequence[ReportFilter] = ()) -> DataFrame:
    """Filter, order, limit and select the columns of a layout.

    With totals, a row follows that sums those columns over all rows of the filter, also those beyond the limit;
    ``is_total`` marks it. Where no row is found there is no total either.
    """
    rows = filter_report(df, spec, filters).select(*[f.name for f in spec.fields])
    order = order_columns(spec)
    page = rows.orderBy(*order) if order else rows
    page = page.limit(spec.row_limit) if spec.row_limit else page
    if not spec.totals:
        return page
    sums = [(F.sum(f.name).cast(rows.schema[f.name].dataType) if f.name in spec.totals else F.lit(None).cast(rows.schema[f.name].dataType)).alias(f.name) for f in spec.fields]
    total = rows.agg(F.count("*").alias("_n"), *sums).where("_n > 0").drop("_n")
    return page.withColumn("is_total", F.lit(False)).unionByName(total.withColumn("is_total", F.lit(True)))


def of_heads(heads: DataFrame, filters: Sequence[ReportFilter]) -> DataFrame:
    """The heads that the filters on their own columns leave."""
    return reduce(lambda d, f: d.where(f.condition()) if f.column in heads.columns and f.value is not None else d, filters, heads)


def journal_report(heads: DataFrame, lines: DataFrame, spec: ReportSpec, filters: Sequence[ReportFilter]) -> DataFrame:
    """Journal lines with their heads by declarative filters."""
    return run_report(lines.join(heads, "header_id"), spec, filters)
