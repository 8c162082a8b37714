"""Registered readers, sinks, scalar rules and plain relational shapes."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from recogna.functions import scalars as X
from recogna.operators.journal import both_sides
from recogna.operators.reports import prior_period_pivot
from recogna.plans.duck import duck
from recogna.plans.registry import query
from recogna.session import ensure_checkpoint_dir
from recogna.sources import model, readers, sinks
from recogna.sources import calendar as cal

OPEN = model.OPEN_PRD


@query(
    "open_period_lines", "SRC3", "J1",
    sql=duck("cal lines", """SELECT org, c.prd_id, count(*) AS n_lines, CAST(sum(ext_sll_prc) AS DECIMAL(28,2)) AS amount FROM lines l
 JOIN cal c ON c.prd_id = CASE WHEN org < 3 THEN 199906 ELSE 199905 END AND l.start_date BETWEEN c.start_date AND c.end_date GROUP BY ALL"""),
)
def open_period_lines(spark, d):
    periods = model.table(spark, d, "region").select(
        F.col("r_regionkey").alias("org"), F.when(F.col("r_regionkey") < 3, 199906).otherwise(199905).alias("prd_id"), F.lit("OPEN").alias("status")
    )
    opened = cal.open_periods(periods, cal.month_calendar(spark)).select("org", "prd_id", "start_date", "end_date")
    ln = model.lines(spark, d, "org", "doc_date", "ext_sll_prc")
    # five regions, one open period each
    hit = ln.join(F.broadcast(opened), "org").where(F.col("doc_date").between(F.col("start_date"), F.col("end_date")))
    return hit.groupBy("org", "prd_id").agg(F.count(F.lit(1)).alias("n_lines"), X.money(F.sum("ext_sll_prc")).alias("amount"))


_UP = "up AS (SELECT p_brand AS brand, p_type AS kind, p_partkey // 50 AS batch_id, p_size AS line_number, p_partkey AS id FROM part)"


def _upload(spark, d):
    return model.table(spark, d, "part").select(
        F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), F.expr("p_partkey div 50").alias("batch_id"), F.col("p_size").alias("line_number"), F.col("p_partkey").alias("id")
    )


@query("latest_upload", "SRC4", sql=duck("", "SELECT * FROM up WHERE batch_id = (SELECT max(batch_id) FROM up u WHERE u.brand = up.brand)", _UP))
def latest_upload(spark, d):
    return readers.latest_batch(_upload(spark, d), ["brand"])


@query(
    "latest_upload_line", "SRC5",
    sql=duck("", """SELECT * FROM up WHERE batch_id = (SELECT max(batch_id) FROM up u WHERE u.brand = up.brand AND u.kind = up.kind)
 AND line_number = (SELECT max(line_number) FROM up u WHERE u.brand = up.brand AND u.kind = up.kind)""", _UP),
)
def latest_upload_line(spark, d):
    return readers.latest_batch_line(_upload(spark, d), ["brand", "kind"])


@query(
    "change_set", "SNK2",
    sql=duck("lines", """SELECT line_id, ext_sll_prc FROM lines WHERE discount_pct NOT IN (1, 2)
 UNION ALL SELECT line_id, CAST(ext_sll_prc + 1 AS DECIMAL(18,2)) FROM lines WHERE discount_pct = 1
 UNION ALL SELECT concat('N-', line_id), ext_sll_prc FROM lines WHERE discount_pct = 3"""),
)
def change_set(spark, d):
    ln = model.lines(spark, d, "line_id", "ext_sll_prc", "discount_pct")
    base = ln.select("line_id", "ext_sll_prc")
    p = F.col("discount_pct")
    changes = ln.where(p.between(1, 4)).select(
        F.when(p == 3, F.concat(F.lit("N-"), "line_id")).otherwise(F.col("line_id")).alias("line_id"),
        F.when(p == 1, F.col("ext_sll_prc") + 1).otherwise(F.col("ext_sll_prc")).cast("decimal(18,2)").alias("ext_sll_prc"),
        F.when(p == 1, "U").when(p == 2, "D").when(p == 3, "I").otherwise("N").alias("change"),
    )
    return sinks.apply_changes(base, changes, ["line_id"])


def _scratch(spark) -> str:
    """A new folder beside the checkpoints, which all executors can reach."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def _by_period(spark, d):
    sc = model.schedules(spark, d)
    return sc.groupBy("rc_id", "prd_id").agg(F.sum("amount").cast("decimal(18,2)").alias("amount"))


_PERIOD_SQL = "ps AS (SELECT rc_id, prd_id, CAST(sum(amount) AS DECIMAL(18,2)) AS amount FROM schedules GROUP BY ALL)"


@query(
    "period_reload", "SNK4",
    sql=duck("schedules", "SELECT rc_id, prd_id, CAST(CASE WHEN prd_id = 199906 THEN amount * 2 ELSE amount END AS DECIMAL(18,2)) AS amount FROM ps", _PERIOD_SQL),
)
def period_reload(spark, d):
    path, rows = _scratch(spark), _by_period(spark, d)
    sinks.reload_period(rows, path)
    again = rows.where(F.col("prd_id") == OPEN).withColumn("amount", (F.col("amount") * 2).cast("decimal(18,2)"))
    sinks.reload_period(again, path, periods=[OPEN])
    return spark.read.parquet(path).select("rc_id", F.col("prd_id").cast("int").alias("prd_id"), "amount")


@query(
    "work_table_refill", "SNK6",
    sql=duck("schedules", "SELECT rc_id, prd_id, CAST(amount * 2 AS DECIMAL(18,2)) AS amount FROM ps WHERE prd_id >= 199906", _PERIOD_SQL),
)
def work_table_refill(spark, d):
    """A work table filled twice holds the second filling alone."""
    path, rows = _scratch(spark), _by_period(spark, d)
    sinks.refill(rows, path)
    sinks.refill(rows.where(F.col("prd_id") >= OPEN).withColumn("amount", (F.col("amount") * 2).cast("decimal(18,2)")), path)
    return spark.read.parquet(path)


@query(
    "error_log", "SNK7",
    sql=duck("lines", """SELECT line_id, 'price outside its range' AS error FROM lines WHERE in_range = 'N'
 UNION ALL SELECT line_id, 'billing pending' FROM lines WHERE bill_pending = 'Y'"""),
)
def error_log(spark, d):
    """Two checks append to one log; a line may be in it twice."""
    path, ln = _scratch(spark), model.lines(spark, d, "line_id", "in_range", "bill_pending")
    sinks.append_errors(ln.where("in_range = 'N'").select("line_id", F.lit("price outside its range").alias("error")), path)
    sinks.append_errors(ln.where("bill_pending = 'Y'").select("line_id", F.lit("billing pending").alias("error")), path)
    return spark.read.parquet(path)


@query(
    "period_snapshot", "SNK3",
    sql=duck("schedules", """SELECT rc_id, CAST(CASE WHEN s = 199906 THEN amount * 3 ELSE amount END AS DECIMAL(18,2)) AS amount, s AS snapshot_prd_id
 FROM ps CROSS JOIN (VALUES (199905), (199906)) v(s) WHERE prd_id = s""", _PERIOD_SQL),
)
def period_snapshot(spark, d):
    """Each period is stored twice; only the open one takes the second version."""
    path, sums = _scratch(spark), _scratch(spark)
    _by_period(spark, d).where(F.col("prd_id").isin(199905, OPEN)).write.parquet(sums)  # summed up once for all four takes
    rows = spark.read.parquet(sums)
    for factor in (1, 3):
        for prd in (199905, OPEN):
            part = rows.where(F.col("prd_id") == prd).select("rc_id", (F.col("amount") * factor).cast("decimal(18,2)").alias("amount"))
            sinks.write_snapshot(part, path, prd, OPEN)
    return spark.read.parquet(path).select("rc_id", "amount", F.col("snapshot_prd_id").cast("int").alias("snapshot_prd_id"))


@query(
    "prior_period_table", "SNK5", "PV3",
    sql=duck("schedules", f"""SELECT rc_id, {', '.join(f'CAST(coalesce(sum(amount) FILTER (prd_id = {p}), 0) AS DECIMAL(28,2)) AS p{p}' for p in (199903, 199904, 199905))}
 FROM schedules WHERE prd_id BETWEEN 199903 AND 199905 GROUP BY rc_id"""),
)
def prior_period_table(spark, d):
    pivoted = prior_period_pivot(model.schedules(spark, d), OPEN, 3, ["rc_id"])
    # a named table, which the next run replaces
    return sinks.materialise(pivoted, "recogna_prior_periods", _scratch(spark))


@query(
    "key_cleanup", "SC1", "SC12", "SC13", "SC14", "SC19",
    sql=duck("", """SELECT p_partkey, upper(trim(concat('  ', p_name, ' '))) AS clean_name, regexp_replace(upper(p_name || '/' || p_type), '[^A-Z0-9]+', '_', 'g') AS ident,
 concat('P ', upper(left(p_type, 1)), lower(substr(p_type, 2))) AS label,
 concat('A:', p_size, ':', p_type, ':NEW') AS segments FROM part"""),
)
def key_cleanup(spark, d):
    part = model.table(spark, d, "part")
    text = F.concat(F.lit("A::"), "p_size", F.lit(":"), "p_type", F.lit(":old:x"))
    return part.select(
        "p_partkey", X.clean_key(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("clean_name"),
        X.to_identifier(F.concat_ws("/", "p_name", "p_type")).alias("ident"),
        X.label_of(F.concat(F.lit("P_"), "p_type")).alias("label"),
        X.replace_segment(text, 3, F.lit("NEW")).alias("segments"),
    )


@query(
    "account_list_totals", "SC13", "RP6",
    sql=duck("ledger", "SELECT acct_type_id, CAST(sum(net) AS DECIMAL(28,2)) AS net FROM ledger WHERE acct_type_id IN ('R','Y','X') GROUP BY ALL"),
)
def account_list_totals(spark, d):
    wanted = spark.sql("SELECT explode(split('R,Y,X', ',')) AS acct_type_id")
    return both_sides(model.schedules(spark, d)).join(wanted, "acct_type_id", "left_semi").groupBy("acct_type_id").agg(X.money(F.sum("net")).alias("net"))


@query(
    "null_rules", "SC3", "SC4", "SC5", "J10",
    sql=duck("lines", """SELECT line_id, CASE WHEN f IS NULL THEN 'REV' WHEN f = 'A' THEN 'NO' ELSE 'OOH' END AS rev_type,
 coalesce(f, 'none') AS flag, CASE WHEN f IS NOT NULL THEN ext_sll_prc ELSE alctd_xt_prc END AS picked,
 CAST(CASE WHEN f IS NULL THEN NULL ELSE greatest(start_date, ship_date) END AS VARCHAR) AS later, CAST(CASE WHEN f IS NULL THEN NULL ELSE least(start_date, ship_date) END AS VARCHAR) AS earlier,
 f IS NOT DISTINCT FROM g AS same FROM (SELECT *, CASE WHEN return_flag <> 'R' THEN return_flag END AS f, CASE WHEN line_status = 'F' THEN 'A' END AS g FROM lines)"""),
)
def null_rules(spark, d):
    ln = model.lines(spark, d, "line_id", "return_flag", "line_status", "ext_sll_prc", "alctd_xt_prc", "start_date", "ship_date")
    f = F.when(F.col("return_flag") != "R", F.col("return_flag"))
    day = F.when(f.isNotNull(), F.col("ship_date"))
    return ln.select(
        "line_id", X.decode(f, None, "REV", "A", "NO", "OOH").alias("rev_type"), F.coalesce(f, F.lit("none")).alias("flag"),
        F.nvl2(f, F.col("ext_sll_prc"), F.col("alctd_xt_prc")).alias("picked"),
        X.greatest_strict(F.col("start_date"), day).cast("string").alias("later"), X.least_strict(F.col("start_date"), day).cast("string").alias("earlier"),
        X.same_or_both_null(f, F.when(F.col("line_status") == "F", "A")).alias("same"),
    )


PRECISION = "('C0',0),('C1',0),('C2',1),('C3',3),('C4',4),('C5',2)"


@query(
    "currency_rounding", "SC6", "SC7", "SC8", "SC9",
    sql=duck("lines", f"""SELECT line_id, CAST(round(v, 0) AS DECIMAL(28,4)) AS whole, CAST(CASE coalesce(digits, 2) WHEN 0 THEN round(v, 0) WHEN 1 THEN round(v, 1) WHEN 2 THEN round(v, 2) WHEN 3 THEN round(v, 3) ELSE v END AS DECIMAL(28,4)) AS rounded,
 CAST(sign(cv_amt) AS INTEGER) AS sgn, CAST(abs(cv_amt) AS DECIMAL(18,2)) AS magnitude, CAST(round(CAST(ext_sll_prc::DOUBLE / CASE WHEN billed = 0 THEN 1 ELSE billed::DOUBLE END AS DECIMAL(28,8)), 4) AS DECIMAL(28,4)) AS price_per_billed
 FROM (SELECT *, CAST(cv_amt * CAST(1.2345 AS DECIMAL(5,4)) AS DECIMAL(28,6)) AS v0, CAST(round(CAST(cv_amt * CAST(1.2345 AS DECIMAL(5,4)) AS DECIMAL(28,6)), 4) AS DECIMAL(28,4)) AS v, bld_def_amt + bld_rec_amt AS billed FROM lines)
 LEFT JOIN (VALUES {PRECISION}) p(c, digits) ON c = curr"""),
)
def currency_rounding(spark, d):
    ln = model.lines(spark, d, "line_id", "curr", "cv_amt", "ext_sll_prc", "bld_def_amt", "bld_rec_amt")
    v = F.round((F.col("cv_amt") * F.lit("1.2345").cast("decimal(5,4)")).cast("decimal(28,6)"), 4).cast("decimal(28,4)")
    ln = ln.withColumn("v", v)
    precision = spark.sql(f"SELECT * FROM VALUES {PRECISION} AS t(currency, digits)")
    out = X.round_by_currency(ln, "v", "curr", precision, "rounded")
    return out.select(
        "line_id", F.round("v", 0).cast("decimal(28,4)").alias("whole"), "rounded", F.signum(F.col("cv_amt").cast("double")).cast("int").alias("sgn"),
        F.abs("cv_amt").cast("decimal(18,2)").alias("magnitude"),
        F.round(X.ratio(F.col("ext_sll_prc"), F.col("bld_def_amt") + F.col("bld_rec_amt")).cast("decimal(28,8)"), 4).cast("decimal(28,4)").alias("price_per_billed"),
    )


@query(
    "date_rules", "SC10", "SC11", "SC21",
    sql=duck("lines", """SELECT line_id, CAST(strftime(start_date, '%Y%m') AS INTEGER) AS prd_id, upper(strftime(start_date, '%b')) AS month_name, CAST(year(start_date) AS INTEGER) AS yr,
 CAST(CAST(start_date + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS next_month, CAST(last_day(start_date) AS VARCHAR) AS month_end, date_diff('day', start_date, end_date) + 1 AS days,
 DATE '1999-06-15' BETWEEN coalesce(CASE WHEN return_flag <> 'A' THEN start_date END, DATE '1999-06-15') AND coalesce(CASE WHEN return_flag <> 'N' THEN end_date END, DATE '1999-06-15') AS effective FROM lines"""),
)
def date_rules(spark, d):
    ln = model.lines(spark, d, "line_id", "start_date", "end_date", "return_flag")
    prd = X.period_of(F.col("start_date"))
    return ln.select(
        "line_id", prd.alias("prd_id"), X.month_label(prd).alias("month_name"), F.year("start_date").alias("yr"),
        F.add_months("start_date", 1).cast("string").alias("next_month"), F.last_day("start_date").cast("string").alias("month_end"),
        X.inclusive_days(F.col("start_date"), F.col("end_date")).alias("days"),
        X.effective_on(F.lit(model.AS_OF).cast("date"), F.when(F.col("return_flag") != "A", F.col("start_date")), F.when(F.col("return_flag") != "N", F.col("end_date"))).alias("effective"),
    )


@query(
    "account_classes", "SC16", "SC17",
    sql=duck("", """SELECT p_partkey, coalesce(try_cast(a AS BIGINT), -1) AS number, CASE WHEN try_cast(a AS BIGINT) BETWEEN 1000 AND 1999 THEN 'Unbilled' WHEN try_cast(a AS BIGINT) BETWEEN 2000 AND 2999 THEN 'Contract Liability'
 WHEN try_cast(a AS BIGINT) BETWEEN 3000 AND 9999 THEN 'Revenue' END AS activity FROM (SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN concat('x', p_partkey) ELSE CAST(p_partkey % 4000 + 500 AS VARCHAR) END AS a FROM part)"""),
)
def account_classes(spark, d):
    a = F.when(F.col("p_size") % 7 == 0, F.concat(F.lit("x"), "p_partkey")).otherwise((F.col("p_partkey") % 4000 + 500).cast("string"))
    n = X.number_or(a)
    return model.table(spark, d, "part").select("p_partkey", n.alias("number"), X.account_class(n).alias("activity"))


@query(
    "flag_codec", "SC18",
    sql=duck("schedules", """SELECT line_id, seq, concat(dr_acct, cr_acct) AS pair, schd_type AS kind, concat('Y', dr_acct, cr_acct, unbilled_flag, initial_flag, 'NNNN', 'C', repeat('N', 30)) AS changed FROM schedules"""),
)
def flag_codec(spark, d):
    sc = model.schedules(spark, d)
    ind = F.col("indicators")
    return sc.select("line_id", "seq", X.flag_at(ind, 2, 2).alias("pair"), X.flag_at(ind, 10).alias("kind"), X.with_flag(X.with_flag(ind, 1, "Y"), 10, "C").alias("changed"))


@query(
    "currency_conversion", "SC22",
    sql=duck("lines", """SELECT line_id, ext_sll_prc AS t, CAST(ext_sll_prc * f_ex_rate AS DECIMAL(28,4)) AS f, CAST(ext_sll_prc * g_ex_rate * f_ex_rate AS DECIMAL(28,4)) AS r_waterfall, CAST(ext_sll_prc * g_ex_rate AS DECIMAL(28,4)) AS r_billing FROM lines"""),
)
def currency_conversion(spark, d):
    ln = model.lines(spark, d, "line_id", "ext_sll_prc", "f_ex_rate", "g_ex_rate")
    a, f, g = F.col("ext_sll_prc"), F.col("f_ex_rate"), F.col("g_ex_rate")
    d4 = "decimal(28,4)"
    return ln.select(
        "line_id", X.convert(a, f, g, "T").alias("t"), X.convert(a, f, g, "F").cast(d4).alias("f"),
        X.convert(a, f, g, "R").cast(d4).alias("r_waterfall"), X.convert(a, f, g, "R", reporting_via_functional=False).cast(d4).alias("r_billing"),
    )


@query(
    "period_labels", "W5", "J15", "PV4", "SE2",
    sql=duck("cal schedules", """SELECT label, column_type, CAST(sum(amount) AS DECIMAL(28,2)) AS amount FROM schedules JOIN (
 SELECT prd_id, CASE WHEN rn <= 18 THEN 'MON' ELSE 'YEAR' END AS column_type, CASE WHEN rn <= 18 THEN period_name WHEN end_date <= (SELECT year_end_dt FROM cal WHERE prd_id = 200007) THEN concat('=> ', period_year) ELSE CAST(period_year AS VARCHAR) END AS label
 FROM (SELECT *, row_number() OVER (ORDER BY prd_id) AS rn FROM cal WHERE prd_id BETWEEN 199901 AND 200212)) USING (prd_id) GROUP BY ALL"""),
)
def period_labels(spark, d):
    labels = cal.period_labels(cal.month_calendar(spark), 199901, 200212, 18)
    sc = model.schedules(spark, d).join(F.broadcast(labels), "prd_id")
    return sc.groupBy("label", "column_type").agg(X.money(F.sum("amount")).alias("amount"))


@query(
    "category_lists", "AG8", "AG7",
    sql=duck("lines", "SELECT rc_id, string_agg(prod_ctgry, ',' ORDER BY prod_ctgry) AS categories FROM (SELECT DISTINCT rc_id, prod_ctgry FROM lines) GROUP BY rc_id"),
)
def category_lists(spark, d):
    # one entry per category and contract after distinct, so the list is as short as the category list
    pairs = model.lines(spark, d, "rc_id", "prod_ctgry").distinct()
    return spark.sql("SELECT rc_id, listagg(prod_ctgry, ',') WITHIN GROUP (ORDER BY prod_ctgry) AS categories FROM {pairs} GROUP BY rc_id", pairs=pairs)


@query(
    "prior_period_amounts", "SO3", "AG8", "PV3",
    sql=duck("cal schedules", """SELECT prd_id, periods, CAST(sum(amount) AS DECIMAL(28,2)) AS amount FROM schedules CROSS JOIN (SELECT string_agg(CAST(prd_id AS VARCHAR), ',' ORDER BY prd_id) AS periods
 FROM (SELECT prd_id FROM cal WHERE prd_id < 199906 ORDER BY prd_id DESC LIMIT 4)) WHERE prd_id IN (SELECT prd_id FROM cal WHERE prd_id < 199906 ORDER BY prd_id DESC LIMIT 4) GROUP BY ALL"""),
)
def prior_period_amounts(spark, d):
    calendar = cal.month_calendar(spark)
    before = cal.previous_periods(calendar, OPEN, 4).select("prd_id")
    text = cal.prior_period_text(calendar, OPEN, 4)
    sums = model.schedules(spark, d).join(F.broadcast(before), "prd_id", "left_semi").groupBy("prd_id").agg(X.money(F.sum("amount")).alias("amount"))
    return sums.crossJoin(F.broadcast(text))


@query(
    "first_quarters", "AG10", "W4",
    sql=duck("cal schedules", """SELECT quarter_id, CAST(sum(amount) AS DECIMAL(28,2)) AS amount FROM (SELECT s.amount, period_year * 10 + qtr_num AS quarter_id FROM schedules s JOIN cal USING (prd_id)) JOIN (
 SELECT DISTINCT period_year * 10 + qtr_num AS quarter_id FROM cal WHERE prd_id >= 199906 ORDER BY 1 LIMIT 8) USING (quarter_id) GROUP BY ALL"""),
)
def first_quarters(spark, d):
    calendar = cal.month_calendar(spark)
    quarters = calendar.select("prd_id", (F.col("period_year") * 10 + F.col("qtr_num")).alias("quarter_id"))
    wanted = quarters.join(F.broadcast(cal.first_quarters(calendar, OPEN)), "quarter_id")
    return model.schedules(spark, d).join(F.broadcast(wanted), "prd_id").groupBy("quarter_id").agg(X.money(F.sum("amount")).alias("amount"))
