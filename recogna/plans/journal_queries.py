"""Registered journal, ledger, tax and rebill jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from recogna.functions.scalars import period_of, with_flag
from recogna.operators import journal as J
from recogna.plans.duck import duck
from recogna.plans.registry import query
from recogna.sources import model
from recogna.sources.calendar import following_periods, month_calendar

OPEN = model.OPEN_PRD

BALANCES = {
    "revenue": ("Revenue", "Adjustment Revenue"),
    "liability": ("Contract Liability", "Adjustment Liability"),
}

_BAL = f"""bal AS (SELECT line_id, CAST(coalesce(sum(CASE WHEN acct_name IN ('Revenue','Adjustment Revenue') THEN net END), 0) AS DECIMAL(18,2)) AS revenue,
 CAST(coalesce(sum(CASE WHEN acct_name IN ('Contract Liability','Adjustment Liability') THEN net END), 0) AS DECIMAL(18,2)) AS liability
 FROM ledger JOIN acct USING (acct_type_id) WHERE post_prd_id <= {OPEN} GROUP BY line_id),
ub AS (SELECT line_id, CAST(coalesce(sum(CASE WHEN acct_name = 'Revenue' THEN net END), 0) AS DECIMAL(18,2)) AS unbilled
 FROM ledger JOIN acct USING (acct_type_id) WHERE post_prd_id <= {OPEN} AND unbilled_flag = 'Y' GROUP BY line_id)"""


UNBILLED = {"unbilled": ("Revenue",)}


def _balances(spark, d, balances=BALANCES, unbilled=None):
    return J.ledger_balance(model.schedules(spark, d), model.account_types(spark), balances, OPEN, unbilled=unbilled)


@query("ledger_balance", "JE1", "J14", "AG1", sql=duck("ledger acct", "SELECT * FROM bal", _BAL))
def ledger_balance(spark, d):
    return _balances(spark, d)


@query("unbilled_balance", "JE2", sql=duck("ledger acct", "SELECT * FROM ub", _BAL))
def unbilled_balance(spark, d):
    return _balances(spark, d, {}, UNBILLED)


@query(
    "pending_contracts", "JE3", "AG3",
    sql=duck("lines", """SELECT rc_id, CAST(sum(alctbl_xt_prc) AS DECIMAL(18,2)) AS alctbl, CAST(sum(bld_rec_amt) + sum(bld_def_amt) AS DECIMAL(18,2)) AS billed
 FROM lines WHERE rc_id IN (SELECT rc_id FROM lines WHERE bill_pending = 'Y') AND rc_id IN (SELECT rc_id FROM lines WHERE eligible = 'Y')
 GROUP BY rc_id HAVING sum(alctbl_xt_prc) <> sum(bld_rec_amt) + sum(bld_def_amt)"""),
)
def pending_contracts(spark, d):
    return J.pending_contracts(model.lines(spark, d, "rc_id", "alctbl_xt_prc", "bld_rec_amt", "bld_def_amt", "bill_pending", "eligible"))


_POS = """cat0 AS (SELECT rc_id, prod_ctgry, sum(alctd_xt_prc) AS alctd, sum(bld_def_amt + bld_rec_amt) AS bld, sum(coalesce(revenue, 0)) AS revenue,
  sum(coalesce(liability, 0)) AS liability, sum(coalesce(unbilled, 0)) AS unbilled, count(*) AS n
 FROM lines l LEFT JOIN bal USING (line_id) LEFT JOIN ub USING (line_id) WHERE eligible = 'Y' GROUP BY ALL),
cat1 AS (SELECT *, upper(prod_ctgry) AS uc, sum(bld) OVER w AS total_billed,
  (CASE WHEN sum(n) OVER w = 1 THEN 1.0::DOUBLE ELSE alctd::DOUBLE END) / (CASE WHEN sum(alctd) OVER w = 0 THEN 1.0::DOUBLE ELSE (sum(alctd) OVER w)::DOUBLE END) AS share
 FROM cat0 WINDOW w AS (PARTITION BY rc_id)),
cat2 AS (SELECT *, CAST(round(CAST(share * total_billed::DOUBLE AS DECIMAL(28,8)), 2) AS DECIMAL(18,2)) AS b,
  CAST(round(CAST(share * total_billed::DOUBLE - alctd::DOUBLE AS DECIMAL(28,8)), 2) AS DECIMAL(18,2)) AS b_less FROM cat1),
pos AS (SELECT rc_id, prod_ctgry, CAST(total_billed AS DECIMAL(18,2)) AS total_billed, CAST(alctd AS DECIMAL(18,2)) AS alctd,
  CAST(revenue AS DECIMAL(18,2)) AS revenue, CAST(liability AS DECIMAL(18,2)) AS liability, b AS share_of_billed,
  CAST(CASE WHEN uc = 'MARKETING' THEN b WHEN uc IN ('LICENSE - TERM','LICENSE - PERPETUAL') THEN greatest(alctd - revenue, 0) ELSE greatest(b - revenue, 0) END AS DECIMAL(18,2)) AS expected_deferred,
  CAST((CASE WHEN uc = 'MARKETING' THEN b_less WHEN uc IN ('LICENSE - TERM','LICENSE - PERPETUAL') THEN greatest(alctd - revenue, 0) ELSE greatest(b - revenue, 0) END) - liability AS DECIMAL(18,2)) AS net_value,
  CAST(CASE WHEN uc = 'MARKETING' THEN 0 WHEN uc IN ('LICENSE - TERM','LICENSE - PERPETUAL') THEN greatest(alctd - b, 0) ELSE greatest(revenue - b, 0) END AS DECIMAL(18,2)) AS expected_unbilled,
  CAST((CASE WHEN uc = 'MARKETING' THEN 0 WHEN uc IN ('LICENSE - TERM','LICENSE - PERPETUAL') THEN greatest(alctd - b, 0) ELSE greatest(revenue - b, 0) END) - unbilled AS DECIMAL(18,2)) AS net_unbilled
 FROM cat2)"""


def _of(lines, contracts):
    """The lines of some ``contracts`` (rc_id) only, or of all where none are given."""
    return lines if contracts is None else lines.join(contracts, "rc_id", "left_semi")


def positions(spark, d, contracts=None):
    ledger = _balances(spark, d, unbilled=UNBILLED)
    ln = model.lines(spark, d, "rc_id", "line_id", "prod_ctgry", "alctd_xt_prc", "bld_def_amt", "bld_rec_amt", "eligible").where("eligible = 'Y'")
    ln = _of(ln, contracts)
    ln = ln.withColumn("billed", F.col("bld_def_amt") + F.col("bld_rec_amt"))
    return J.expected_positions(ln, ledger)


@query(
    "expected_deferred", "JE4", "W1", "W2", "SC3",
    sql=duck("ledger acct", "SELECT rc_id, prod_ctgry, total_billed, alctd, revenue, liability, share_of_billed, expected_deferred, net_value FROM pos", _BAL, _POS),
)
def expected_deferred(spark, d):
    return positions(spark, d).drop("expected_unbilled", "net_unbilled")


@query(
    "expected_unbilled", "JE5",
    sql=duck("ledger acct", "SELECT rc_id, prod_ctgry, expected_unbilled, net_unbilled FROM pos", _BAL, _POS),
)
def expected_unbilled(spark, d):
    return positions(spark, d).select("rc_id", "prod_ctgry", "expected_unbilled", "net_unbilled")


_JOURNAL = """src AS (SELECT *, CASE WHEN return_flag = 'N' THEN NULL ELSE concat('U-', supp_key % 10) END AS uacct, concat('L-', supp_key % 7) AS lacct,
  CASE WHEN upper(prod_ctgry) IN ('LICENSE - TERM','LICENSE - PERPETUAL') THEN 'LICENSE - TERM' ELSE prod_ctgry END AS grp FROM lines),
acc AS (SELECT rc_id, grp, min_by(struct_pack(u := uacct, l := lacct, c := curr, f := f_ex_rate), line_id) AS a FROM src GROUP BY ALL),
nets AS (SELECT rc_id, CASE WHEN upper(prod_ctgry) IN ('LICENSE - TERM','LICENSE - PERPETUAL') THEN 'LICENSE - TERM' ELSE prod_ctgry END AS grp, sum(net_value) AS net
 FROM pos WHERE net_value <> 0 GROUP BY ALL HAVING sum(net_value) <> 0),
jl AS (SELECT n.rc_id, n.grp AS prod_ctgry, s.side, CASE WHEN (net > 0) = (s.side = 'DR') THEN 'Unbilled' ELSE 'Contract Liability' END AS activity,
  CASE WHEN (net > 0) = (s.side = 'DR') THEN coalesce(a.u, 'U-CONST') ELSE a.l END AS account, CAST(abs(net) AS DECIMAL(18,2)) AS amount, a.c AS curr,
  CAST(round(abs(net) * a.f, 4) AS DECIMAL(18,4)) AS func_amount
 FROM nets n JOIN acc USING (rc_id, grp) CROSS JOIN (VALUES ('DR'),('CR')) s(side))"""


def _journal(spark, d, contracts=None, consistency=False):
    ln = model.lines(spark, d, "rc_id", "line_id", "prod_ctgry", "supp_key", "return_flag", "curr", "f_ex_rate").select(
        "rc_id", "line_id", "prod_ctgry",
        F.when(F.col("return_flag") != "N", F.concat(F.lit("U-"), F.col("supp_key") % 10)).alias("unbilled_acct"),
        F.concat(F.lit("L-"), F.col("supp_key") % 7).alias("liability_acct"),
        F.col("curr").alias("f_cur"), "f_ex_rate",
    )
    return J.journal_lines(positions(spark, d, contracts), _of(ln, contracts), "U-CONST", consistency)


@query("journal_lines", "JE6", "J17", sql=duck("ledger acct", "SELECT * FROM jl", _BAL, _POS, _JOURNAL))
def journal_lines(spark, d):
    return _journal(spark, d)


@query(
    "journal_consistency", "JE7",
    sql=duck("ledger acct", """SELECT jl.rc_id, prod_ctgry, side, consistent FROM jl LEFT JOIN (SELECT rc_id, 'N' AS consistent FROM pos WHERE net_value <> 0
 GROUP BY rc_id HAVING sum(net_unbilled) <> sum(net_value)) b ON b.rc_id = jl.rc_id""", _BAL, _POS, _JOURNAL),
)
def journal_consistency(spark, d):
    return _journal(spark, d, consistency=True).select("rc_id", "prod_ctgry", "side", "consistent")


def _journal_schedules(spark, d):
    return model.schedules(spark, d, "batch_id").withColumn("je_id", F.when(F.col("schd_type") == "A", F.col("batch_id")))


@query(
    "journal_reversal", "JE8",
    sql=duck("schedules", """SELECT line_id, seq, prd_id, amount, 'N' AS is_reversal FROM schedules WHERE NOT (schd_type = 'A' AND batch_id = 1999) OR interfaced_flag = 'Y'
 UNION ALL SELECT line_id, seq, greatest(prd_id, 199906), -amount, 'Y' FROM schedules WHERE schd_type = 'A' AND batch_id = 1999 AND interfaced_flag = 'Y'"""),
)
def journal_reversal(spark, d):
    out = J.reverse_journal(_journal_schedules(spark, d), 1999, OPEN)
    return out.select("line_id", "seq", "prd_id", F.col("amount").cast("decimal(18,2)").alias("amount"), "is_reversal")


@query(
    "journal_reversal_heads", "JE8",
    sql=duck("contracts", """SELECT rc_id AS header_id, CASE WHEN rc_id = (SELECT min(rc_id) FROM contracts WHERE posted = 'Y') THEN 'R' WHEN posted = 'Y' THEN 'A' ELSE 'N' END AS status FROM contracts"""),
)
def journal_reversal_heads(spark, d):
    """Journal heads after the first approved one is taken back."""
    heads = model.contracts(spark, d).select(F.col("rc_id").alias("header_id"), F.when(F.col("posted") == "Y", "A").otherwise("N").alias("status"))
    first = heads.where("status = 'A'").agg(F.min("header_id").alias("header_id")).first()["header_id"]
    return J.mark_reversed(heads, first)


@query(
    "reversal_period", "JE10",
    sql=duck("cal schedules", """SELECT s.prd_id, (SELECT min(c.prd_id) FROM cal c WHERE c.prd_id > s.prd_id) AS reversal_prd_id, s.amount
 FROM (SELECT prd_id, CAST(sum(-amount) AS DECIMAL(28,2)) AS amount FROM schedules WHERE schd_type = 'A' GROUP BY prd_id) s"""),
)
def reversal_period(spark, d):
    """What the allocation entries of each period take back in the period that follows it."""
    entries = model.schedules(spark, d).where("schd_type = 'A'").groupBy("prd_id").agg(F.sum(-F.col("amount")).cast("decimal(28,2)").alias("amount"))
    following = F.broadcast(following_periods(month_calendar(spark)))
    return entries.join(following, "prd_id").select("prd_id", F.col("next_prd_id").alias("reversal_prd_id"), "amount")


@query(
    "journal_purge", "JE9", "J7",
    sql=duck("lines contracts", """SELECT rc_id AS header_id, line_id FROM lines WHERE rc_id NOT IN (SELECT rc_id FROM contracts WHERE crtd_prd_id = 199906 AND posted = 'N' AND treatment = 'P')"""),
)
def journal_purge(spark, d):
    heads = model.contracts(spark, d).select(
        F.col("rc_id").alias("header_id"), F.col("crtd_prd_id").alias("prd_id"),
        F.when(F.col("posted") == "Y", "A").otherwise("N").alias("status"),
        F.when(F.col("treatment") == "P", "UNBILL").otherwise("OTHER").alias("tag"),
    )
    ln = model.lines(spark, d, "rc_id", "line_id").withColumnRenamed("rc_id", "header_id")
    return J.purge_unapproved(heads, ln, OPEN, "UNBILL")[1]


def _je_validation(spark, d):
    src = model.lines(spark, d, "rc_id", "line_id", "line_num", "prod_ctgry", "sales_action", "nation_key", "org", "part_key", "ext_sll_prc", "discount_pct")
    number = (F.lit(900) + F.col("part_key") % 4000).cast("string")
    je = src.select(
        F.col("rc_id").alias("header_id"), "line_id",
        F.when(F.col("discount_pct") != 10, F.col("prod_ctgry")).alias("class_name"),
        F.col("sales_action").alias("department"),
        F.concat(F.lit("NATION_"), "nation_key").alias("location"),
        F.concat(F.lit("ORG-"), "org").alias("subsidiary"),
        "org", F.lit(1).alias("book_id"), F.col("ext_sll_prc").alias("amount"),
        F.when(F.col("line_num") % 2 == 1, number).alias("dr_account"),
        F.when(F.col("line_num") % 2 == 0, number).alias("cr_account"),
    )
    nation, region = model.table(spark, d, "nation"), model.table(spark, d, "region")
    accounts = model.table(spark, d, "part").where("p_size > 2").select((F.lit(900) + F.col("p_partkey") % 4000).cast("string").alias("a"))
    one = lambda rows: spark.sql(f"SELECT * FROM VALUES {rows} AS t(v)")
    refs = {
        "class_name": one("('License - Term'),('License - Perpetual'),('Maintenance - New'),('Professional Services'),('Subscription'),('Content Subscription'),('Marketing'),('Training')"),
        "department": one("('UPGRADE'),('DOWNGRADE'),('NEW'),('RENEWAL'),('ADD-ON')"),
        "location": nation.where("n_nationkey < 24").select("n_name"),
        "subsidiary": region.select(F.concat(F.lit("ORG-"), "r_regionkey")),
        "dr_account": accounts,
        "cr_account": accounts,
    }
    return je, refs


_JEV = """je AS (SELECT rc_id AS header_id, line_id, CASE WHEN discount_pct <> 10 THEN prod_ctgry END AS class_name, concat('NATION_', nation_key) AS location,
  concat('ORG-', org) AS subsidiary, org, ext_sll_prc AS amount, CASE WHEN line_num % 2 = 1 THEN CAST(900 + part_key % 4000 AS VARCHAR) END AS dr_account,
  CASE WHEN line_num % 2 = 0 THEN CAST(900 + part_key % 4000 AS VARCHAR) END AS cr_account FROM lines),
good AS (SELECT DISTINCT CAST(900 + p_partkey % 4000 AS VARCHAR) AS a FROM part WHERE p_size > 2),
errs AS (SELECT header_id, line_id, 'class_name' AS check_name, '@' AS value FROM je WHERE class_name IS NULL
 UNION ALL SELECT header_id, line_id, 'location', location FROM je WHERE location NOT IN (SELECT n_name FROM nation WHERE n_nationkey < 24)
 UNION ALL SELECT header_id, line_id, 'dr_account', dr_account FROM je WHERE dr_account IS NOT NULL AND dr_account NOT IN (SELECT a FROM good)
 UNION ALL SELECT header_id, line_id, 'cr_account', cr_account FROM je WHERE cr_account IS NOT NULL AND cr_account NOT IN (SELECT a FROM good)),
imb AS (SELECT header_id, subsidiary, org, CAST(sum(CASE WHEN cr_account IS NOT NULL THEN amount ELSE -amount END) AS DECIMAL(18,2)) AS difference
 FROM je GROUP BY ALL HAVING sum(CASE WHEN cr_account IS NOT NULL THEN amount ELSE -amount END) <> 0)"""


@query(
    "journal_validation", "JE11", "SNK7",
    sql=duck("lines", """SELECT header_id, line_id, check_name AS type, concat('not in reference: ', replace(value, '@', '')) AS description FROM errs
 UNION ALL SELECT header_id, NULL, 'balance', concat('debit and credit differ for ', subsidiary) FROM imb""", _JEV),
)
def journal_validation(spark, d):
    return J.validate_journal(*_je_validation(spark, d))


@query("journal_balance_check", "JE12", sql=duck("lines", "SELECT header_id, subsidiary, org, 1 AS book_id, difference FROM imb", _JEV))
def journal_balance_check(spark, d):
    return J.journal_imbalances(_je_validation(spark, d)[0])


@query(
    "journal_activity", "JE13", "SC17",
    sql=duck("lines", """SELECT je.header_id, je.line_id,
 CASE WHEN bad IS NULL OR je.line_id < bad THEN CASE WHEN dr_account::INT BETWEEN 1000 AND 1999 THEN 'Unbilled' WHEN dr_account::INT BETWEEN 2000 AND 2999 THEN 'Contract Liability' WHEN dr_account::INT BETWEEN 3000 AND 9999 THEN 'Revenue' END END AS dr_activity,
 CASE WHEN bad IS NULL OR je.line_id < bad THEN CASE WHEN cr_account::INT BETWEEN 1000 AND 1999 THEN 'Unbilled' WHEN cr_account::INT BETWEEN 2000 AND 2999 THEN 'Contract Liability' WHEN cr_account::INT BETWEEN 3000 AND 9999 THEN 'Revenue' END END AS cr_activity
 FROM je LEFT JOIN (SELECT header_id, min(line_id) AS bad FROM errs GROUP BY ALL) e USING (header_id)""", _JEV),
)
def journal_activity(spark, d):
    je, refs = _je_validation(spark, d)
    return J.assign_activity(je, J.journal_errors(je, refs)).select("header_id", "line_id", "dr_activity", "cr_activity")


def _batch_sql(limit: int) -> str:
    return duck(
        "", "SELECT batch_id, rc_id, cnt, group_id FROM f",
        f"""cnts AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS batch_id, l_orderkey + 2 AS rc_id, count(*) AS cnt FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
 rk AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY cnt, substr(md5(CAST(rc_id AS VARCHAR)), 1, 2), rc_id) AS rn FROM cnts),
 f AS (SELECT batch_id, rc_id, cnt, rn, cnt AS fill, CAST(CASE WHEN cnt > {limit} THEN 2 ELSE 1 END AS BIGINT) AS group_id FROM rk WHERE rn = 1
  UNION ALL SELECT k.batch_id, k.rc_id, k.cnt, k.rn, CASE WHEN f.fill + k.cnt > {limit} THEN k.cnt ELSE f.fill + k.cnt END,
   f.group_id + CASE WHEN f.fill + k.cnt > {limit} THEN 1 ELSE 0 END FROM f JOIN rk k ON k.batch_id = f.batch_id AND k.rn = f.rn + 1)""",
        recursive=True,
    )


def _gl_counts(spark, d):
    return model.lines(spark, d, "rc_id", "batch_id")


@query("gl_batches_100", "GL1", "W10", sql=_batch_sql(100))
def gl_batches_100(spark, d):
    return J.batch_contracts(_gl_counts(spark, d), 100)


# the limit is below the largest contracts, so oversized contracts are covered too
@query("gl_batches_oversize", "GL1", "W8", sql=_batch_sql(6))
def gl_batches_oversize(spark, d):
    return J.batch_contracts(_gl_counts(spark, d), 6)


@query(
    "gl_enrichment", "GL2", "J12", "SRC4",
    sql=duck("lines", """SELECT line_id, account_id, location_id, department_id, subsidiary_id FROM lines l
 LEFT JOIN (SELECT DISTINCT n_name, CAST(n_nationkey + 500 AS VARCHAR) AS location_id FROM nation WHERE n_nationkey > 1) ON n_name = concat('NATION_', l.nation_key)
 LEFT JOIN (SELECT DISTINCT p_brand, concat('ACC-', p_brand) AS account_id FROM part) ON p_brand = l.prod_fmly
 LEFT JOIN (VALUES ('UPGRADE','D1'),('NEW','D2'),('RENEWAL','D3')) dep(dn, department_id) ON dn = l.sales_action
 LEFT JOIN (SELECT upper(concat('Org-', s_nationkey % 5)) AS sn, max_by(concat('SUB-', s_suppkey), s_suppkey) AS subsidiary_id FROM supplier GROUP BY ALL) ON sn = upper(concat('org-', l.org))"""),
)
def gl_enrichment(spark, d):
    gl = model.lines(spark, d, "line_id", "nation_key", "prod_fmly", "sales_action", "org").select(
        "line_id", F.concat(F.lit("NATION_"), "nation_key").alias("location"), "prod_fmly", "sales_action",
        F.concat(F.lit("org-"), "org").alias("subsidiary"),
    )
    nation = model.table(spark, d, "nation").where("n_nationkey > 1").select("n_name", (F.col("n_nationkey") + 500).cast("string").alias("x"))
    acc = model.table(spark, d, "part").select("p_brand", F.concat(F.lit("ACC-"), "p_brand").alias("x"))
    dep = spark.sql("SELECT * FROM VALUES ('UPGRADE','D1'),('NEW','D2'),('RENEWAL','D3') AS t(k, x)")
    subs = model.table(spark, d, "supplier").select(
        F.concat(F.lit("Org-"), F.col("s_nationkey") % 5).alias("name"), F.concat(F.lit("SUB-"), "s_suppkey").alias("external_id"), F.col("s_suppkey").alias("batch_id")
    )
    refs = {
        "location_id": (nation, "n_name", "x", "location"),
        "account_id": (acc, "p_brand", "x", "prod_fmly"),
        "department_id": (dep, "k", "x", "sales_action"),
    }
    return J.enrich_gl(gl, refs, subs).select("line_id", "account_id", "location_id", "department_id", "subsidiary_id")


_TAX = """rev AS (SELECT line_id, sum(amount) AS rev FROM schedules WHERE prd_id = 199906 AND concat(dr_acct, cr_acct) IN ('LR','UR') GROUP BY line_id HAVING sum(amount) <> 0),
taxed AS (SELECT l.line_id, l.rc_id, l.curr, l.f_ex_rate, CAST((abs(CAST(rev * 100 AS BIGINT)) * 2 + 1000) // 2000 AS DECIMAL(18,2)) AS amount FROM lines l JOIN rev USING (line_id) WHERE org = 2)"""


def _tax(spark, d):
    prior = spark.sql("SELECT 199905 AS prd_id")
    ln = model.lines(spark, d, "line_id", "rc_id", "org", "curr", "f_ex_rate")
    return J.tax_reclass(model.schedules(spark, d), ln, prior, 2, OPEN, 10)


@query("tax_journal_heads", "TX1", sql=duck("schedules", "SELECT concat('TAX_', curr, '_199906') AS head, curr AS fn_cur, 199906 AS prd_id, count(*) AS n_lines FROM taxed GROUP BY curr", _TAX))
def tax_journal_heads(spark, d):
    return _tax(spark, d)[0]


@query("tax_journal_lines", "TX1", sql=duck("schedules", "SELECT concat('TAX_', curr, '_199906') AS head, line_id, rc_id, amount, CAST(round(amount * f_ex_rate, 2) AS DECIMAL(18,2)) AS func_amount FROM taxed", _TAX))
def tax_journal_lines(spark, d):
    return _tax(spark, d)[1]


@query("tax_schedules", "TX1", sql=duck("schedules", "SELECT line_id, rc_id, 199906 AS prd_id, amount, 'Y' AS interfaced, 'Y' AS initial_reporting FROM taxed", _TAX))
def tax_schedules(spark, d):
    return _tax(spark, d)[2]


@query(
    "tax_interfaced", "TX2", "J11",
    sql=duck("schedules", """SELECT line_id, seq, CASE WHEN schd_type = 'A' AND batch_id % 2 = 0 THEN 'Y' ELSE interfaced_flag END AS interfaced FROM schedules"""),
)
def tax_interfaced(spark, d):
    heads = model.contracts(spark, d).where("batch_id % 2 = 0").select(F.col("batch_id").alias("je_id"))
    out = J.mark_interfaced(_journal_schedules(spark, d), heads)
    return out.select("line_id", "seq", F.substring("indicators", 1, 1).alias("interfaced"))


_STAGE = """stg AS (SELECT line_id, CASE WHEN return_flag = 'R' THEN 'INV' ELSE 'SO' END AS type, concat('S', rc_id) AS so_num, line_id AS so_line_id,
  CASE WHEN discount_pct % 3 = 0 THEN 'Y' WHEN discount_pct % 3 = 1 THEN 'N' END AS split0, prod_ctgry, CASE WHEN line_num % 2 = 0 THEN concat('B', rc_id // 2) END AS bundle0,
  CASE WHEN line_num % 3 = 0 THEN 'Y' ELSE 'N' END AS event_required, CASE WHEN line_num = 3 THEN 'N' ELSE 'Y' END AS upfront, eligible,
  CASE WHEN supp_key % 2 = 0 THEN 'Y' ELSE 'N' END AS offering, CASE WHEN supp_key % 3 = 0 THEN 'Y' ELSE 'N' END AS premium0,
  CASE WHEN part_key % 5 <> 0 THEN unit_ssp END AS price0 FROM lines),
stg1 AS (SELECT *, CASE WHEN split0 = 'Y' THEN 'Y' ELSE 'N' END AS split_flag, CASE WHEN event_required = 'Y' AND upfront = 'N' THEN 'N' ELSE eligible END AS elig,
  CASE WHEN (CASE WHEN split0 = 'Y' THEN 'Y' ELSE 'N' END = 'Y' AND upper(prod_ctgry) = 'LICENSE - TERM') OR (offering = 'Y' AND upper(prod_ctgry) IN ('LICENSE - TERM','SUBSCRIPTION')) THEN coalesce(bundle0, so_line_id) ELSE bundle0 END AS bundle_id FROM stg),
stg2 AS (SELECT a.line_id, a.split_flag, a.elig AS eligible, a.bundle_id,
  CASE WHEN a.type = 'SO' AND a.prod_ctgry = 'License - Term' AND EXISTS (SELECT 1 FROM stg1 b WHERE b.bundle_id = a.bundle_id AND b.type = 'SO' AND b.split_flag = 'Y' AND b.premium0 = 'Y') THEN 'Y' ELSE a.premium0 END AS premium,
  CASE WHEN a.type = 'SO' AND a.so_line_id <> a.bundle_id AND a.offering = 'Y' AND (upper(a.prod_ctgry) LIKE '%SERVICES%' OR upper(a.prod_ctgry) LIKE '%TRAINING%') AND a.price0 IS NOT NULL
   AND EXISTS (SELECT 1 FROM stg1 b WHERE b.type = 'SO' AND b.so_line_id = b.bundle_id AND b.offering = 'Y' AND b.bundle_id = a.bundle_id AND b.price0 IS NOT NULL AND b.so_num = a.so_num)
   THEN 0 ELSE a.price0 END AS list_price FROM stg1 a)"""


@query("stage_flags", "CR2", "SNK1", "SC1", "SC15", sql=duck("lines", "SELECT line_id, split_flag, eligible, bundle_id, premium, CAST(list_price AS DECIMAL(18,2)) AS list_price FROM stg2", _STAGE))
def stage_flags(spark, d):
    ln = model.lines(spark, d, "line_id", "rc_id", "return_flag", "discount_pct", "prod_ctgry", "line_num", "eligible", "supp_key", "part_key", "unit_ssp")
    p = F.col("discount_pct") % 3
    yn = lambda c: F.when(c, "Y").otherwise("N")
    stage = ln.select(
        "line_id", yn(F.col("return_flag") == "R").alias("x"), F.when(F.col("return_flag") == "R", "INV").otherwise("SO").alias("type"),
        F.concat(F.lit("S"), "rc_id").alias("so_num"), F.col("line_id").alias("so_line_id"),
        F.when(p == 0, "Y").when(p == 1, "N").alias("split_flag"), "prod_ctgry",
        F.when(F.col("line_num") % 2 == 0, F.concat(F.lit("B"), F.expr("rc_id div 2"))).alias("bundle_id"),
        yn(F.col("line_num") % 3 == 0).alias("event_required"), F.when(F.col("line_num") == 3, "N").otherwise("Y").alias("upfront_billing"), "eligible",
        yn(F.col("supp_key") % 2 == 0).alias("offering"), yn(F.col("supp_key") % 3 == 0).alias("premium"), F.lit("N").alias("no_bundle"),
        F.when(F.col("part_key") % 5 != 0, F.col("unit_ssp")).alias("list_price"),
    ).drop("x")
    return J.stage_flags(stage).select("line_id", "split_flag", "eligible", "bundle_id", "premium", F.col("list_price").cast("decimal(18,2)").alias("list_price"))


_REBILL = """ol AS (SELECT concat('S', rc_id) AS doc_num, line_id AS doc_line_id, supp_key % 4 AS attr_a, line_num AS attr_b, ext_sll_prc, bld_def_amt + bld_rec_amt AS billed
  FROM lines WHERE return_flag = 'A'),
rs AS (SELECT line_id, CASE WHEN return_flag = 'R' THEN 'INV' ELSE 'SO' END AS type, concat('S', rc_id) AS so_num, line_id AS so_line_id, concat('S', rc_id // 2) AS orig_so,
  supp_key % 4 AS attr_a, line_num AS attr_b, CASE WHEN discount_pct <> 3 THEN 'Y' END AS rebill_flag, ext_sll_prc AS inv_price FROM lines WHERE return_flag <> 'A'),
pp AS (SELECT doc_num AS orig_so, attr_a, attr_b, count(*) AS n, min(doc_line_id) AS ln FROM ol GROUP BY ALL),
ss AS (SELECT so_num AS orig_so, attr_a, attr_b, count(*) AS n, min(so_line_id) AS ln FROM rs WHERE type = 'SO' GROUP BY ALL),
mp AS (SELECT rs.*, CASE WHEN type = 'INV' AND rebill_flag = 'Y' THEN CASE WHEN pp.n = 1 THEN pp.ln WHEN pp.n IS NULL AND ss.n = 1 THEN ss.ln END END AS hit
  FROM rs LEFT JOIN pp USING (orig_so, attr_a, attr_b) LEFT JOIN ss USING (orig_so, attr_a, attr_b)),
mq AS (SELECT line_id, type, rebill_flag, inv_price, CASE WHEN hit IS NOT NULL THEN so_num END AS old_so_num, CASE WHEN hit IS NOT NULL THEN so_line_id END AS old_so_line_id,
  CASE WHEN hit IS NOT NULL THEN orig_so ELSE so_num END AS so_num, coalesce(hit, so_line_id) AS so_line_id FROM mp)"""


@query(
    "rebill_mapping", "CR1", "J2",
    sql=duck("lines", """SELECT mq.line_id, old_so_num, old_so_line_id, mq.so_num, mq.so_line_id,
 CASE WHEN type = 'INV' AND rebill_flag = 'Y' AND o.amt < inv_price THEN 'REBILL_CHECK' END AS check_flag FROM mq
 LEFT JOIN (SELECT doc_num, doc_line_id, sum(ext_sll_prc - billed) AS amt FROM ol GROUP BY ALL) o ON o.doc_num = mq.so_num AND o.doc_line_id = mq.so_line_id""", _REBILL),
)
def rebill_mapping(spark, d):
    ln = model.lines(spark, d, "line_id", "rc_id", "return_flag", "supp_key", "line_num", "discount_pct", "ext_sll_prc", "bld_def_amt", "bld_rec_amt")
    attrs = [(F.col("supp_key") % 4).alias("attr_a"), F.col("line_num").alias("attr_b")]
    posted = ln.where("return_flag = 'A'").select(
        F.lit("SO").alias("type"), F.concat(F.lit("S"), "rc_id").alias("doc_num"), F.col("line_id").alias("doc_line_id"), *attrs, "ext_sll_prc",
        (F.col("bld_def_amt") + F.col("bld_rec_amt")).alias("billed"),
    )
    stage = ln.where("return_flag <> 'A'").select(
        "line_id", F.when(F.col("return_flag") == "R", "INV").otherwise("SO").alias("type"), F.concat(F.lit("S"), "rc_id").alias("so_num"),
        F.col("line_id").alias("so_line_id"), F.concat(F.lit("S"), F.expr("rc_id div 2")).alias("orig_so"), *attrs,
        F.when(F.col("discount_pct") != 3, "Y").alias("rebill_flag"), F.lit("N").alias("processed"), F.col("ext_sll_prc").alias("inv_price"),
    )
    return J.map_rebill(stage, posted).select("line_id", "old_so_num", "old_so_line_id", "so_num", "so_line_id", "check_flag")


_RELEASE = """rl AS (SELECT line_id, line_id AS pob_id, concat('S', rc_id) AS doc_num, concat('S', rc_id // 2) AS orig_doc, supp_key % 5 AS project,
  CASE WHEN discount_pct = 4 THEN 20 ELSE 0 END AS rel_pct, ext_sll_prc FROM lines),
ra AS (SELECT line_id AS pob_id, CASE WHEN line_num % 2 = 0 THEN 'D' ELSE 'R' END AS action, bld_rec_amt AS amt FROM lines
  UNION ALL SELECT line_id, 'R', bld_def_amt FROM lines),
rp AS (SELECT rl.doc_num, project, rl.pob_id, rel_pct, sum(CASE WHEN action = 'R' THEN amt ELSE -amt END)::DOUBLE / any_value(ext_sll_prc)::DOUBLE * 100 AS pct
  FROM rl JOIN ra USING (pob_id) GROUP BY ALL),
rr AS (SELECT doc_num AS orig_doc, project, CAST(round(CAST(greatest(coalesce(max(pct), 0), max(rel_pct)) AS DECIMAL(28,8)), 0) AS INTEGER) AS release_pct FROM rp GROUP BY ALL)"""


@query(
    "rebill_release", "CR3", "AG6",
    sql=duck("lines", "SELECT line_id, pob_id, orig_doc, project, release_pct FROM rl JOIN rr USING (orig_doc, project) WHERE rel_pct = 0 AND rl.orig_doc <> rl.doc_num AND release_pct > 0 AND release_pct <= 100", _RELEASE),
)
def rebill_release(spark, d):
    ln = model.lines(spark, d, "line_id", "rc_id", "supp_key", "discount_pct", "line_num", "ext_sll_prc", "bld_rec_amt", "bld_def_amt")
    job = ln.select(
        "line_id", F.col("line_id").alias("pob_id"), F.lit("SO").alias("type"), F.concat(F.lit("S"), "rc_id").alias("doc_num"),
        F.concat(F.lit("S"), F.expr("rc_id div 2")).alias("orig_doc"), (F.col("supp_key") % 5).alias("project"),
        F.when(F.col("discount_pct") == 4, 20).otherwise(0).alias("rel_pct"), F.lit("N").alias("released"), "ext_sll_prc",
    )
    actions = ln.select(
        F.col("line_id").alias("pob_id"),
        F.explode(F.array(
            F.struct(F.when(F.col("line_num") % 2 == 0, "D").otherwise("R").alias("action"), F.col("bld_rec_amt").alias("prcssd_amt")),
            F.struct(F.lit("R").alias("action"), F.col("bld_def_amt").alias("prcssd_amt")),
        )).alias("a"),
    ).select("pob_id", "a.*")
    return J.rebill_release(job, actions)
