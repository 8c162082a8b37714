"""Revenue schedule jobs: windows, straight-line and prospective recognition, distribution, order-on-hand."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recogna.functions.scalars import flag_at, inclusive_days
from recogna.functions.skew import attach
from recogna.sources.fiscal import FiscalCalendar


def _offset(text: Column) -> Column:
    """Day offset kept as text; 'N/A', 'NA' and null mean no offset."""
    return F.when(F.coalesce(text, F.lit("N/A")).isin("N/A", "NA"), None).otherwise(text.try_cast("int"))


def schedule_window(lines: DataFrame, start_offset: str, end_offset: str, anchor: str) -> DataFrame:
    """Add ``no_start_date`` and ``no_end_date`` from day offsets before an anchor date."""
    s, e = _offset(F.col(start_offset)), _offset(F.col(end_offset))
    from_anchor = (
        F.when(s.isNull(), F.col("doc_date"))
        .when(e.isNull(), F.when(F.col(anchor).isNotNull(), F.greatest("doc_date", F.date_sub(F.col(anchor), s))))
        .otherwise(F.date_sub(F.col(anchor), e))
    )
    return lines.withColumn("no_start_date", from_anchor).withColumn(
        "no_end_date", F.when(e.isNotNull(), F.date_sub(F.col("end_date"), e)).otherwise(from_anchor)
    )


def contract_value(cumulative: Column, allocated: Column, net: Column) -> Column:
    return F.coalesce(cumulative, allocated, net)


def changed_lines(lines: DataFrame, value: str, last_processed: str) -> DataFrame:
    """Lines whose contract value differs from the value used by the previous run."""
    unset = F.lit(-999)
    return lines.where(F.coalesce(F.col(value), unset) != F.coalesce(F.col(last_processed), unset))


def _units(amount: Column, digits: int) -> Column:
    """Amount as a whole number of smallest currency units."""
    return F.round(amount * 10**digits, 0).cast("bigint")


def _prorated(days: Column, total: Column, span: Column) -> Column:
    """days x total / span in whole units, half up, never below one unit."""
    return F.greatest(F.call_function("div", days * total * 2 + span, span * 2), F.lit(1).cast("bigint"))


def _period(prd: int | str | Column) -> Column:
    """An open period given as an id, as the name of a column or as a column."""
    return F.col(prd) if isinstance(prd, str) else prd if isinstance(prd, Column) else F.lit(prd)


def _sum(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def _back(units: Column, digits: int) -> Column:
    return (units * F.col("_sign") / 10**digits).cast(f"decimal(18,{digits})")


def _spread(rows: DataFrame, cal: FiscalCalendar, open_p: Column, value: Column, start: str, end: str, keep_zero: Column) -> tuple[DataFrame, Callable[[Column], Column]]:
    """One row for each period that ``value`` units are recognised in, with ``_p`` (its place) and ``_units``.

    Only rounding makes the rule sequential, and all full periods of one length round alike, so the running total is
    closed arithmetic over the calendar's counts of periods by length. Also returns that running total, capped by
    the value, as a function of a place.
    """
    base = rows.where(((value != 0) & (F.col(end) >= F.col(start))) | keep_zero)
    # Steps of a few columns that are read more than once stay apart in the plan, and so do their generated methods:
    # one method of more than 8,000 bytes would never be compiled.
    base = base.withColumns({"_so": cal.off(F.col(start)), "_eo": cal.off(F.col(end)), "_total": F.abs(value), "_sign": F.signum(value.cast("double")).cast("int")})
    base = base.withColumns(
        {
            **{name: cal.sure(cal.place_at(F.col(off)), F.col(off)) for name, off in (("_b", "_so"), ("_e", "_eo"))},
            "_o": cal.sure(cal.place_of(open_p), open_p),
            "_span": (F.col("_eo") - F.col("_so") + 1).cast("bigint"),
        }
    )
    # everything that depends on the line alone is computed before the rows multiply
    base = base.withColumns({f"_full{n}": _prorated(F.lit(n).cast("bigint"), F.col("_total"), F.col("_span")) for n in cal.lengths})
    began = _sum([cal.count_at(n, F.col("_b")) * F.col(f"_full{n}") for n in cal.lengths])
    first = _prorated((cal.end_off_at(F.col("_b")) - F.col("_so") + 1).cast("bigint"), F.col("_total"), F.col("_span"))
    base = base.withColumns({"_before": first - began, "_from": F.greatest("_b", "_o"), "_to": F.greatest("_e", "_o")})
    out = base.withColumn("_p", F.explode(F.sequence("_from", "_to")))

    def running(at: Column) -> Column:
        return F.col("_before") + _sum([cal.count_at(n, at) * F.col(f"_full{n}") for n in cal.lengths])

    def capped(at: Column) -> Column:
        return F.least(running(at), F.col("_total"))

    own = reduce(lambda acc, n: F.when(F.col("_days") == n, F.col(f"_full{n}")).otherwise(acc), cal.lengths[:-1], F.col(f"_full{cal.lengths[-1]}"))
    out = out.withColumns({"_days": cal.days_at(F.col("_p")), "_run": running(F.col("_p"))})
    done = F.when(F.col("_p") >= F.col("_e"), F.col("_total")).otherwise(F.least("_run", "_total"))
    before = F.when(F.col("_p") == F.col("_from"), F.lit(0).cast("bigint")).otherwise(F.least(F.col("_run") - own, F.col("_total")))
    # generated, so that the filter on it doesn't repeat the expression
    return out.withColumn("_units", F.explode(F.array(done - before))).where((F.col("_units") > 0) | keep_zero), capped


def recognize(
    lines: DataFrame,
    calendar: FiscalCalendar | DataFrame,
    open_prd: int | str | Column,
    amount: str = "amount",
    start: str = "start_date",
    end: str = "end_date",
    digits: int = 2,
    splits: bool = False,
) -> DataFrame:
    """Straight-line daily recognition over the calendar's periods, of whatever length.

    Each period takes its days times the daily amount, rounded; the first period counts
    from the start date, the running total never passes the value and the period that
    holds the end date takes what is left.  Periods before the open one are posted with
    the open one, which may differ from line to line.  Zero period amounts count as the smallest currency unit.

    No join, no window and no shuffle: one exploded row per emitted period. A line whose dates the
    calendar doesn't cover fails the job.

    With ``splits`` the amounts belonging to the previous year, quarter and period are
    added to the row of the open period.
    """
    cal = FiscalCalendar.of(calendar)
    rows, capped = _spread(lines, cal, _period(open_prd), _units(F.col(amount), digits), start, end, F.lit(False))
    out = [*lines.columns, cal.id_at(F.col("_p")).alias("prd_id"), _back(F.col("_units"), digits).alias("rel_amt")]
    if splits:
        parts = _prior_splits(cal, capped)
        out += [_back(parts[k], digits).alias(f"{k}_amt") for k in ("py", "pq", "pp")]
    return rows.select(*out)


def _prior_splits(cal: FiscalCalendar, capped: Callable[[Column], Column]) -> dict[str, Column]:
    opened = F.col("_o")
    year, quarter, period = cal.year_end_before(opened), cal.quarter_end_before(opened), cal.period_before(opened)

    def reached(at: Column, taken: Column) -> Column:
        inside = (at >= F.col("_b")) & (at < F.col("_e")) & (F.col("_p") == opened)
        return F.when(inside & ~taken, capped(at)).otherwise(F.lit(0).cast("bigint"))

    # a period that is both year and quarter end counts for the year only, and so on; the
    # earlier parts are signed before they are taken off the unsigned running amount
    sign = F.col("_sign")
    same = lambda a, b: a.eqNullSafe(b)
    py = reached(year, F.lit(False))
    at_q = reached(quarter, same(quarter, year))
    pq = F.when(at_q > 0, at_q - py * sign).otherwise(0)
    at_m = reached(period, same(period, year) | same(period, quarter))
    pp = F.when(at_m > 0, at_m - (py * sign + pq * sign)).otherwise(0)
    return {"py": py, "pq": pq, "pp": pp}


def _earned(cal: FiscalCalendar, opened: Column, value: Column, past: Column, start: str, end: str) -> Column:
    """Consumed days over all days times the value, less what is scheduled already, as of the end of the open period."""
    total_days = inclusive_days(F.col(start), F.col(end))
    until = F.when(F.col(end) <= cal.start_at(opened), F.col(end)).otherwise(cal.end_at(opened))
    consumed = inclusive_days(F.col(start), until)
    # numerator in whole cents, so the rounding is exact
    above = _units(value, 2) * consumed - _units(past, 2) * total_days
    earned = F.call_function("div", F.abs(above) * 2 + total_days, total_days.cast("bigint") * 2) * F.signum(above.cast("double")).cast("bigint")
    return (earned / 100).cast("decimal(18,2)")


def recognize_prospective(
    lines: DataFrame, calendar: FiscalCalendar | DataFrame, open_prd: int | str | Column, amount: str = "amount", scheduled: str = "scheduled",
    start: str = "start_date", end: str = "end_date",
) -> DataFrame:
    """Revision of a running schedule: catch up in the open period, the rest straight-line after it.

    Consumed days over all days times the value, less what is already scheduled, goes to
    the open period; the remainder is recognised from the following period on.
    """
    cal = FiscalCalendar.of(calendar)
    value, past = F.col(amount), F.col(scheduled)
    base = lines.withColumn("_at", cal.sure(cal.place_of(_period(open_prd)), _period(open_prd)))
    base = base.withColumn("_now", _earned(cal, F.col("_at"), value, past, start, end)).withColumn(
        "_rest", (value - past - F.col("_now")).cast("decimal(18,2)")
    )
    at = F.col("_at")
    after = cal.start_at(at + 1)

    def one(part: str, value: Column, first: Column, last: Column, prd: Column) -> Column:
        return F.when(value != 0, F.struct(F.lit(part).alias("_part"), value.alias("_value"), first.alias("_from_day"), last.alias("_to_day"), prd.cast("int").alias("_prd")))

    # both parts of a line in one pass; the catch-up is a job whose only period is the open one
    jobs = F.array(
        one("CATCH-UP", F.col("_now"), cal.start_at(at), cal.end_at(at), cal.id_at(at)),
        one("REMAINDER", F.col("_rest"), after, F.greatest(F.col(end), after), cal.id_at(at + 1)),
    )
    each = base.select(*lines.columns, F.explode(F.filter(jobs, lambda j: j.isNotNull())).alias("_j")).select(*lines.columns, "_j.*")
    rows, _ = _spread(each, cal, F.col("_prd"), _units(F.col("_value"), 2), "_from_day", "_to_day", F.lit(False))
    return rows.select(*lines.columns, cal.id_at(F.col("_p")).alias("prd_id"), _back(F.col("_units"), 2).alias("rel_amt"), F.col("_part").alias("part"))


def distribute(amounts: DataFrame, model: DataFrame, amount: str = "amount", digits: int = 4) -> DataFrame:
    """Split each amount over the accounts of its distribution model.

    ``model``: model_id, dist_seq, pct, account.  Parts are rounded; the part at which the
    percentages reach 100 takes the rest; a shortfall goes to a DEFAULT account row.  A
    model has a handful of rows, so it travels as one array per model id and every amount
    is split in place, without a window over the parts.
    """
    scale = f"decimal(28,{digits})"
    spec = model.groupBy("model_id").agg(
        F.array_sort(F.collect_list(F.struct("dist_seq", "pct", "account"))).alias("_spec")
    )
    joined = attach(amounts, spec, ["model_id"], "inner")
    total = F.abs(F.col(amount)).cast(scale)
    zero = F.lit(0).cast(scale)

    def step(acc, d):
        pct_so_far = (acc["pct"] + d["pct"]).cast("decimal(10,4)")
        raw = F.when(pct_so_far >= 100, total - acc["done"]).otherwise(F.round(total * d["pct"] / 100, digits)).cast(scale)
        part = F.least(raw, total - acc["done"]).cast(scale)
        row = F.struct(d["dist_seq"].alias("dist_seq"), d["account"].alias("account"), part.alias("part"))
        return F.struct(
            pct_so_far.alias("pct"),
            (acc["done"] + part).cast(scale).alias("done"),
            F.concat(acc["rows"], F.array(row)).alias("rows"),
        )

    start = F.struct(
        F.lit(0).cast("decimal(10,4)").alias("pct"),
        zero.alias("done"),
        F.array().cast(f"array<struct<dist_seq:int,account:string,part:{scale}>>").alias("rows"),
    )
    folded = joined.withColumn("_f", F.aggregate("_spec", start, step))
    default = F.struct(F.lit(0).alias("dist_seq"), F.lit("DEFAULT").alias("account"), (total - F.col("_f.done")).cast(scale).alias("part"))
    return (
        folded.withColumn("_d", F.explode(F.concat(F.col("_f.rows"), F.array(default))))
        .where(F.col("_d.part") != 0)
        .select(
            *amounts.columns,
            F.col("_d.dist_seq").alias("dist_seq"),
            F.col("_d.account").alias("account"),
            (F.col("_d.part") * F.signum(F.col(amount).cast("double")).cast("int")).cast(scale).alias("part_amt"),
        )
    )


def assign_accounts(schedules: DataFrame, accounts: dict[str, str], initial_reporting: Column | None = None) -> DataFrame:
    """Debit and credit account names by schedule type.

    Revenue rows debit the liability and credit revenue; allocation rows use the
    adjustment pair (contra pair for the initial reporting entry); any other type uses the
    cost pair.
    """
    first = initial_reporting if initial_reporting is not None else F.lit(False)
    kind = F.col("schd_type")

    def pick(side: str) -> Column:
        return (
            F.when(kind == "R", accounts[f"revenue_{side}"])
            .when((kind == "A") & first, accounts[f"initial_{side}"])
            .when(kind == "A", accounts[f"adjustment_{side}"])
            .otherwise(accounts[f"cost_{side}"])
        )

    return schedules.withColumn("dr_account", pick("dr")).withColumn("cr_account", pick("cr"))


def actual_schedules(schedules: DataFrame, initial: Column | None = None, initial_reporting: Column | None = None) -> DataFrame:
    """Entries that count as actual: revenue rows but the initial one, allocation rows but the initial reporting one."""
    initial = initial if initial is not None else flag_at(F.col("indicators"), 5)
    reporting = initial_reporting if initial_reporting is not None else flag_at(F.col("indicators"), 6)
    kind = flag_at(F.col("indicators"), 10)
    return schedules.where(((kind == "R") & (initial != "Y")) | ((kind == "A") & (reporting != "Y")))


def invalidate_moved(lines: DataFrame, schedules: DataFrame, moved_since: Column) -> DataFrame:
    """Lines whose contract id differs from the one on their custom schedule and that changed since the last run."""
    on_schedule = schedules.select("line_id", F.col("rc_id").alias("schd_rc_id")).distinct()
    moved = lines.where(moved_since).join(on_schedule, "line_id").where(F.col("rc_id") != F.col("schd_rc_id"))
    return moved.withColumn("last_processed", F.lit(None).cast("decimal(18,2)"))


def order_on_hand(
    custom: DataFrame, actual: DataFrame, windows: DataFrame, calendar: FiscalCalendar | DataFrame, open_prd: int | str | Column
) -> DataFrame:
    """Custom minus actual amount per line and period of the line's window.

    The differences of periods before the open one are kept and also carried into the
    open one, which ``windows`` may name line by line; zero differences are kept.  Amounts are summed per line and
    period first, so the map that gathers a line's periods never exceeds the calendar, and the window's
    periods are generated from it without another shuffle.
    """
    cal = FiscalCalendar.of(calendar)
    signed = custom.select("line_id", "prd_id", F.col("amount").cast("decimal(18,2)").alias("amount")).unionByName(
        actual.select("line_id", "prd_id", (-F.col("amount")).cast("decimal(18,2)").alias("amount"))
    )
    per_period = signed.groupBy("line_id", "prd_id").agg(F.sum("amount").cast("decimal(18,2)").alias("diff"))
    per_line = per_period.groupBy("line_id").agg(
        F.map_from_entries(F.collect_list(F.struct("prd_id", "diff"))).alias("diffs")
    )
    zero = F.lit(0).cast("decimal(18,2)")
    bounds = windows.select("line_id", _period(open_prd).alias("_open"), F.col("first_date").alias("_fd"), F.col("last_date").alias("_ld"))
    bounds = bounds.withColumns({"_first": cal.sure(cal.place(F.col("_fd")), F.col("_fd")), "_last": cal.sure(cal.place(F.col("_ld")), F.col("_ld"))})
    from_prd, to_prd = cal.id_at(F.col("_first")), cal.id_at(F.col("_last"))
    bounds = bounds.select("line_id", "_open", "_first", "_last", from_prd.alias("_from"), to_prd.alias("_to"))
    earlier = F.map_filter(F.col("diffs"), lambda prd, _: prd.between(F.col("_from"), F.least(F.col("_to"), F.col("_open") - 1)))
    carried = F.aggregate(F.map_values(F.col("_earlier")), zero, lambda acc, v: (acc + v).cast("decimal(18,2)"))
    rows = (
        bounds.join(per_line, "line_id", "left")
        .withColumn("_earlier", earlier)
        .withColumn("_carried", F.coalesce(carried, zero))
        .withColumn("_p", F.explode(F.when(F.col("_last") >= F.col("_first"), F.sequence("_first", "_last"))))
        .withColumn("prd_id", cal.id_at(F.col("_p")))
    )
    own = F.coalesce(F.try_element_at("diffs", F.col("prd_id")), zero)
    amount = own + F.when(F.col("prd_id") == F.col("_open"), F.col("_carried")).otherwise(zero)
    return rows.select("line_id", "prd_id", amount.cast("decimal(18,2)").alias("amount"))


def replace_future(history: DataFrame, fresh: DataFrame, open_prd: int | str) -> DataFrame:
    """Keep closed periods of the lines in ``fresh`` and replace the open and later ones.

    The open period is an id, or a column of ``fresh`` that holds each line's own.
    """
    touched = fresh.select("line_id", _period(open_prd).alias("_open")).groupBy("line_id").agg(F.min("_open").alias("_open"))
    kept = history.join(touched, "line_id", "left").where(F.col("_open").isNull() | (F.col("prd_id") < F.col("_open")))
    return kept.select(*history.columns).unionByName(fresh.select(*history.columns))


def with_open_period(lines: DataFrame, periods: DataFrame, keys: Sequence[str] = ("book_id", "org")) -> DataFrame:
    """Add ``open_prd``, the open period of the line's book and organisation; null where none is open.

    ``periods``: one row for each of the keys, period and status. If several are open for one of them,
    the earliest counts: the run that follows it finds nothing changed.
    """
    opened = periods.where("status = 'OPEN'").groupBy(*keys).agg(F.min("prd_id").alias("open_prd"))
    return attach(lines, opened, list(keys))


def generate_schedules(
    lines: DataFrame, history: DataFrame, suspended: DataFrame, calendar: FiscalCalendar | DataFrame, open_prd: int | str
) -> DataFrame:
    """One run of the schedule job for every open period.

    ``lines``: line_id, rc_id, amount, start_date, end_date, init_expiry and, if ``open_prd`` names a column,
    the open period of each line.  ``history``: line_id, rc_id, prd_id, amount, version.  Suspended lines get one zero
    row when they have no schedule yet and are skipped otherwise.  The others keep closed periods, take the next
    version and are rebuilt: straight-line in the initial period, prospectively after it. Lines
    that are held, have no open period or are not part of the run keep their later periods too.

    Lines and history meet once. What a line is to emit becomes an array of jobs - its own stored rows
    (a line has one for each period at most), the catch-up, the remainder or the whole value - and all jobs are spread
    over their periods by one expression.
    """
    cal = FiscalCalendar.of(calendar)
    zero = F.lit(0).cast("decimal(18,2)")
    stored = F.struct("prd_id", F.col("amount").cast("decimal(18,2)").alias("amount"), F.col("version").cast("int").alias("version"), F.col("rc_id").cast("long").alias("rc_id"))
    past = history.groupBy("line_id").agg(F.collect_list(stored).alias("_rows"))
    hold = suspended.select("line_id").distinct().withColumn("_hold", F.lit(True))
    job = lines.select(
        "line_id", F.col("rc_id").cast("long").alias("rc_id"), F.col("amount").cast("decimal(18,2)").alias("value"), "start_date", "end_date", "init_expiry", _period(open_prd).alias("open_prd")
    )
    state = job.join(hold, "line_id", "left").join(past, "line_id", "full").withColumn("_at", cal.sure(cal.place_of(F.col("open_prd")), F.col("open_prd")))
    opened, at, rows = F.col("open_prd"), F.col("_at"), F.coalesce("_rows", F.array())
    closed = F.filter(rows, lambda r: r["prd_id"] < opened)
    state = state.withColumns(
        {
            "scheduled": F.aggregate(closed, zero, lambda a, r: (a + r["amount"]).cast("decimal(18,2)")),
            "version": F.aggregate(rows, F.lit(0), lambda a, r: F.greatest(a, r["version"])) + 1,
            "_in_run": opened.isNotNull(),
            "_held": F.coalesce("_hold", F.lit(False)),
        }
    )
    live = F.col("_in_run") & ~F.col("_held")
    state = state.withColumn("_live", F.coalesce(live, F.lit(False))).withColumns(
        {
            "_revised": F.col("_live") & F.coalesce(F.col("init_expiry") < cal.end_at(at), F.lit(False)),
            "_now": _earned(cal, at, F.col("value"), F.col("scheduled"), "start_date", "end_date"),
        }
    )

    def one(version: Column, rc: Column, rule: Column | str, amount: Column, first: Column, last: Column, prd: Column) -> Column:
        rule = F.lit(rule) if isinstance(rule, str) else rule
        return F.struct(
            version.cast("int").alias("version"), rc.alias("rc_id"), rule.alias("rule"), amount.cast("decimal(18,2)").alias("amount"),
            first.alias("first"), last.alias("last"), prd.cast("int").alias("prd"),
        )

    begin, finish = cal.start_at(at), cal.end_at(at)
    after = cal.start_at(at + 1)
    rest = F.col("value") - F.col("scheduled") - F.col("_now")
    version, rc = F.col("version"), F.col("rc_id")
    jobs = F.array(
        F.when(F.col("_in_run") & F.col("_held") & F.col("_rows").isNull(), one(F.lit(1), rc, "HELD", zero, begin, finish, opened)),
        F.when(F.col("_live") & ~F.col("_revised"), one(version, rc, "INITIAL", F.col("value") - F.col("scheduled"), F.col("start_date"), F.col("end_date"), opened)),
        F.when(F.col("_revised") & (F.col("_now") != 0), one(version, rc, "REVISION", F.col("_now"), begin, finish, opened)),
        F.when(F.col("_revised") & (rest != 0), one(version, rc, "REVISION", rest, after, F.greatest("end_date", after), cal.id_at(at + 1))),
    )
    kept = F.filter(rows, lambda r: ~F.col("_live") | (r["prd_id"] < opened))
    # a stored row is a job whose only period is its own
    own = F.transform(
        kept,
        lambda r: one(
            r["version"], r["rc_id"], F.when(r["prd_id"] < opened, "CLOSED").otherwise("KEPT"), r["amount"],
            cal.start_at(cal.place_of(r["prd_id"])), cal.end_at(cal.place_of(r["prd_id"])), r["prd_id"],
        ),
    )
    each = state.select("line_id", F.explode(F.filter(F.concat(jobs, own), lambda j: j.isNotNull())).alias("j")).select("line_id", "j.*")
    spread, _ = _spread(each, cal, F.col("prd"), _units(F.col("amount"), 2), "first", "last", F.col("rule").isin("HELD", "CLOSED", "KEPT"))
    return spread.select("line_id", "rc_id", "version", cal.id_at(F.col("_p")).alias("prd_id"), _back(F.col("_units"), 2).alias("amount"), "rule")


def waterfall_snapshot(
    actual: DataFrame, custom: DataFrame, on_hand: DataFrame, entries: DataFrame, run_prd: int
) -> DataFrame:
    """Actual, custom and order-on-hand rows of the lines with a schedule in the run period.

    ``entries`` are all accounting entries: any revenue entry of the run period makes a line active, an initial
    one too; allocation entries don't.
    """
    active_actual = entries.where((F.col("prd_id") == run_prd) & (F.col("schd_type") == "R")).select("line_id")
    active_custom = custom.where(F.col("prd_id") == run_prd).select("line_id")
    has_custom = custom.select("line_id").distinct()
    active = active_actual.union(active_custom).distinct().join(has_custom, "line_id", "left_semi")

    def part(df: DataFrame, tag: str) -> DataFrame:
        return df.select("line_id", "prd_id", F.col("amount").cast("decimal(18,2)").alias("amount"), F.lit(tag).alias("rev_type"))

    rows = part(actual, "REV").unionByName(part(custom, "NO")).unionByName(part(on_hand, "OOH"))
    return rows.join(active, "line_id", "left_semi")
