"""DuckDB text of the model views, for the side-by-side check of registered queries."""

from __future__ import annotations

CAL = """cal AS (
 SELECT CAST(strftime(d, '%Y%m') AS INTEGER) AS prd_id, strftime(d, '%b-%y') AS period_name, d AS start_date,
  last_day(d) AS end_date, CAST(year(d) AS INTEGER) AS period_year, CAST(quarter(d) AS INTEGER) AS qtr_num,
  CAST(date_trunc('quarter', d) AS DATE) AS qtr_start_dt,
  last_day(CAST(date_trunc('quarter', d) AS DATE) + INTERVAL 2 MONTH) AS qtr_end_dt,
  make_date(year(d), 1, 1) AS year_start_dt, make_date(year(d), 12, 31) AS year_end_dt
 FROM (SELECT CAST(g AS DATE) AS d FROM generate_series(TIMESTAMP '1990-01-01', TIMESTAMP '2039-12-01', INTERVAL 1 MONTH) t(g)))"""

LINES = """lines AS (
 SELECT b.*, CAST(alctd_xt_prc - ext_sll_prc AS DECIMAL(18,2)) AS cv_amt FROM (
 SELECT l_orderkey + 2 AS rc_id, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER)) AS line_id,
  l_linenumber AS line_num, l_partkey AS part_key, l_suppkey AS supp_key, concat('ITEM-', l_partkey) AS item_num,
  CAST(l_quantity AS DECIMAL(18,2)) AS ord_qty,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS ext_sll_prc, CAST(l_extendedprice AS DECIMAL(18,2)) AS alctbl_xt_prc,
  CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 + CAST(l_tax AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2)) AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS alctd_xt_prc,
  CAST(CASE WHEN l_linestatus = 'F' THEN round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.4 AS DECIMAL(2,1)), 2) ELSE 0 END AS DECIMAL(18,2)) AS bld_def_amt,
  CAST(CASE WHEN l_linestatus = 'F' THEN round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.5 AS DECIMAL(2,1)), 2) ELSE 0 END AS DECIMAL(18,2)) AS bld_rec_amt,
  CASE WHEN l_returnflag = 'R' THEN 'N' ELSE 'Y' END AS eligible,
  CASE WHEN CAST(l_discount AS DECIMAL(3,2)) <= 0.05 THEN 'Y' ELSE 'N' END AS in_range,
  CASE WHEN l_returnflag = 'A' THEN 'Y' ELSE 'N' END AS bill_pending,
  l_linestatus AS line_status, l_returnflag AS return_flag, CAST(round(l_discount * 100) AS INTEGER) AS discount_pct,
  l_linenumber = 1 AS is_parent, CAST(l_shipdate AS DATE) AS ship_date,
  CAST(o_orderdate AS DATE) AS doc_date, CAST(o_orderdate AS DATE) AS start_date,
  CAST(o_orderdate AS DATE) + CAST(abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) % 336 + 29 AS INTEGER) AS end_date,
  CAST(year(o_orderdate) AS INTEGER) AS batch_id, o_custkey AS contract_num, concat_ws('-', o_custkey, year(o_orderdate)) AS mod_doc,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'UPGRADE' WHEN '2-HIGH' THEN 'DOWNGRADE' WHEN '3-MEDIUM' THEN 'NEW'
   WHEN '4-NOT SPECIFIED' THEN 'RENEWAL' ELSE 'ADD-ON' END AS sales_action,
  CASE WHEN o_orderstatus = 'F' THEN 'R' ELSE 'P' END AS treatment, o_orderstatus AS order_status,
  n_regionkey AS org, c_nationkey AS nation_key, concat('C', c_nationkey) AS curr,
  CAST(1 + CAST(c_nationkey / 100 AS DECIMAL(4,2)) AS DECIMAL(6,2)) AS f_ex_rate,
  CAST(1 + CAST(n_regionkey / 10 AS DECIMAL(3,1)) AS DECIMAL(6,1)) AS g_ex_rate,
  CASE p_type WHEN 'ECONOMY' THEN 'License - Term' WHEN 'STANDARD' THEN 'License - Perpetual' WHEN 'SMALL' THEN 'Maintenance - New'
   WHEN 'MEDIUM' THEN 'Professional Services'
   WHEN 'LARGE' THEN CASE WHEN p_size % 2 = 0 THEN 'Subscription' ELSE 'Content Subscription' END
   ELSE CASE WHEN p_size % 2 = 0 THEN 'Marketing' ELSE 'Training' END END AS prod_ctgry,
  p_brand AS prod_fmly, CAST(p_retailprice AS DECIMAL(18,2)) AS unit_ssp, p_size % 12 + 1 AS term
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey) b)"""

CONTRACTS = """contracts AS (
 SELECT o_orderkey + 2 AS rc_id, 1 AS book_id, 1 AS obj_version, CASE WHEN o_orderstatus = 'F' THEN 'R' ELSE 'P' END AS treatment,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Y' ELSE 'N' END AS posted, CAST(year(o_orderdate) AS INTEGER) AS batch_id,
  CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS crtd_prd_id, CAST(o_orderdate AS DATE) + 30 AS init_pob_exp_dt,
  CAST(o_orderdate AS DATE) + 365 AS ct_mod_end_dt, o_custkey AS contract_num, CAST(o_orderdate AS DATE) AS doc_date
 FROM orders)"""

BILLS = """bills AS (
 SELECT o_orderkey + 2 AS rc_id, concat('I', o_orderkey) AS doc_num,
  CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey > 1 THEN concat('I', o_orderkey // 2) END AS orig_doc_num,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'UPGRADE' WHEN '2-HIGH' THEN 'DOWNGRADE' WHEN '3-MEDIUM' THEN 'NEW'
   WHEN '4-NOT SPECIFIED' THEN 'RENEWAL' ELSE 'ADD-ON' END AS sales_action,
  CASE WHEN o_orderkey % 3 = 0 THEN 'N' ELSE 'Y' END AS mod_flag, 'INV' AS type,
  CAST(o_orderdate AS DATE) AS doc_date, CAST(o_orderdate AS DATE) AS start_date,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 1500 + 300 AS INTEGER) AS end_date, CAST(year(o_orderdate) AS INTEGER) AS batch_id
 FROM orders)"""

ACCT = """acct(acct_type_id, acct_name, acct_group, def_rec_flag, pl_flag, vc_flag, vc_clr_flag, cost_flag, incl_netting_flag, payables_acct_flag) AS (VALUES
 ('R','Revenue','REV','REC','Y','N','N','N','N','N'),
 ('X','Adjustment Revenue','EREV','EREC','Y','N','N','N','N','N'),
 ('L','Contract Liability','DREV','DEF','N','N','N','N','Y','N'),
 ('A','Adjustment Liability','EDREV','EDEF','N','Y','Y','N','Y','N'),
 ('U','Unbilled','UNBILL','UBL','N','N','N','N','N','N'),
 ('T','Contra','CONTRA','CTR','N','N','N','N','N','N'),
 ('B','Billing','AR','ARC','N','N','N','N','N','Y'))"""

SCHEDULES = """schedules AS (
 SELECT l.*, l.line_id AS root_line_id, e.seq, e.schd_type, e.dr_acct, e.cr_acct,
  CAST(strftime(CASE WHEN e.seq = 3 THEN end_date ELSE start_date END, '%Y%m') AS INTEGER) AS prd_id,
  CAST(strftime(CASE WHEN e.seq = 3 AND return_flag = 'R' THEN end_date + INTERVAL 1 MONTH WHEN e.seq = 3 THEN end_date ELSE start_date END, '%Y%m') AS INTEGER) AS post_prd_id,
  CAST(CASE e.seq WHEN 1 THEN CASE WHEN line_status = 'F' THEN ext_sll_prc ELSE 0 END
   WHEN 2 THEN round(alctd_xt_prc * CAST(0.6 AS DECIMAL(2,1)), 2) ELSE cv_amt END AS DECIMAL(18,2)) AS amount,
  CASE WHEN e.seq = 2 AND line_status = 'O' THEN 'Y' ELSE 'N' END AS unbilled_flag,
  CASE WHEN e.seq = 2 AND line_num = 1 THEN 'Y' ELSE 'N' END AS initial_flag,
  CASE WHEN return_flag = 'N' THEN 'Y' ELSE 'N' END AS interfaced_flag
 FROM lines l CROSS JOIN (VALUES (1,'B','B','L'),(2,'R','L','R'),(3,'A','A','X')) e(seq, schd_type, dr_acct, cr_acct))"""

# net credit minus debit of an entry, seen from the account on each side
LEDGER = """ledger AS (
 SELECT rc_id, line_id, prd_id, post_prd_id, dr_acct AS acct_type_id, unbilled_flag, -amount AS net FROM schedules
 UNION ALL SELECT rc_id, line_id, prd_id, post_prd_id, cr_acct, unbilled_flag, amount FROM schedules)"""

PARTS = {
    "cal": (CAL, ()),
    "lines": (LINES, ()),
    "contracts": (CONTRACTS, ()),
    "bills": (BILLS, ()),
    "acct": (ACCT, ()),
    "schedules": (SCHEDULES, ("lines",)),
    "ledger": (LEDGER, ("lines", "schedules")),
}


def duck(views: str, body: str, *ctes: str, recursive: bool = False) -> str:
    """A statement whose WITH clause holds the named model views and the given CTEs."""
    wanted: list[str] = []
    for name in views.split():
        for dep in (*PARTS[name][1], name):
            if dep not in wanted:
                wanted.append(dep)
    clauses = [PARTS[n][0] for n in wanted] + list(ctes)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + ",\n".join(clauses) + "\n" if clauses else "") + body
