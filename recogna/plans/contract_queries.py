"""Registered contract modification jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from recogna.functions.scalars import clean_key
from recogna.operators import contracts as C
from recogna.plans.duck import duck
from recogna.plans.registry import query
from recogna.sources import model
from recogna.sources.fiscal import FiscalCalendar

OPEN_END = "1999-06-30"


def _day(text: str):
    return F.lit(text).cast("date")


def _bundle_stage(spark, d):
    ln = model.lines(spark, d, "rc_id", "line_id", "line_num", "return_flag", "prod_ctgry", "sales_action", "doc_date", "ship_date", "end_date", "discount_pct", "supp_key", "org")
    kind = F.when(F.col("return_flag") == "A", "SO").when(F.col("return_flag") == "N", "INV").otherwise("CM")
    return ln.select(
        "line_id", "rc_id", kind.alias("type"), F.concat(F.lit("I"), "rc_id").alias("inv_num"),
        F.concat(F.lit("E"), F.col("line_num") % 3).alias("entitlement"), "sales_action",
        F.when(F.col("prod_ctgry") == "License - Term", "Term License").when(F.col("prod_ctgry") == "License - Perpetual", "Stack License").otherwise(F.col("prod_ctgry")).alias("item_num"),
        F.col("doc_date").alias("so_date"), F.col("ship_date").alias("inv_date"),
        F.date_add("doc_date", F.col("discount_pct") * 10 - 40).alias("start_date"), "end_date",
        F.concat(F.lit("01:"), "org", F.lit("::"), "supp_key", F.lit(":9999")).alias("rev_segments"),
        F.when(F.col("line_num") % 2 == 0, F.concat(F.lit("N"), "line_num")).alias("segment4"),
        (F.col("line_num") % 4).alias("bundle_config"),
        F.when(F.col("line_num") == 1, F.col("line_id")).otherwise(F.concat(F.lit("P"), "rc_id")).alias("bundle_parent"),
        F.col("line_id").alias("so_line_id"), F.col("line_id").alias("inv_line_id"), F.lit("P").alias("credit_rule"),
    )


_BUNDLE = """bs AS (SELECT line_id, rc_id, CASE return_flag WHEN 'A' THEN 'SO' WHEN 'N' THEN 'INV' ELSE 'CM' END AS type, concat('E', line_num % 3) AS ent, sales_action AS act,
  CASE prod_ctgry WHEN 'License - Term' THEN 'Term License' WHEN 'License - Perpetual' THEN 'Stack License' ELSE prod_ctgry END AS item,
  doc_date, ship_date, doc_date + (discount_pct * 10 - 40) AS st, end_date, line_num, supp_key, org FROM lines),
b1 AS (SELECT *, CASE type WHEN 'SO' THEN doc_date WHEN 'INV' THEN ship_date END AS dd, item IN ('Term License','Stack License') AS lic FROM bs),
b2 AS (SELECT *, CASE WHEN act = 'RENEWAL' AND lic AND dd > st THEN dd ELSE st END AS st2, lic AND act IN ('NEW','UPGRADE','DOWNGRADE','RENEWAL') AND type IN ('SO','INV') AS al FROM b1),
b3 AS (SELECT rc_id, ent, type, greatest(min(dd), min(st2)) AS f FROM b2 WHERE al GROUP BY ALL)"""


@query(
    "bundle_preparation", "CM1", "AG5", "SC5", "SC12",
    sql=duck("lines", """SELECT line_id, CAST(CASE WHEN al THEN f ELSE st2 END AS VARCHAR) AS start_date,
 CAST(CASE WHEN item LIKE '%Lic%' AND line_num <> 1 THEN NULL ELSE end_date END AS VARCHAR) AS end_date,
 CASE WHEN line_num % 2 = 0 AND line_num % 4 <> 0 THEN concat('01:', org, ':', supp_key, ':N', line_num) ELSE concat('01:', org, '::', supp_key, ':9999') END AS rev_segments,
 CASE WHEN type IN ('INV','CM') AND item LIKE '%Lic%' AND line_num <> 1 THEN NULL ELSE 'P' END AS credit_rule
 FROM b2 LEFT JOIN b3 USING (rc_id, ent, type)""", _BUNDLE),
)
def bundle_preparation(spark, d):
    out = C.prepare_bundles(_bundle_stage(spark, d))
    return out.select("line_id", F.col("start_date").cast("string").alias("start_date"), F.col("end_date").cast("string").alias("end_date"), "rev_segments", "credit_rule")


@query(
    "stage_validation", "CM2", "SNK1", "SC1", "SC2",
    sql=duck("lines", """SELECT line_id, concat('S', rc_id) AS so_num, sales_action,
 CASE WHEN line_num = 7 THEN 'Q' WHEN return_flag = 'R' THEN CASE WHEN supp_key % 3 = 0 THEN 'F' ELSE 'P' END END AS credit_rule,
 CAST(CASE WHEN return_flag = 'N' AND line_num <> 7 AND sales_action IN ('NEW','UPGRADE','DOWNGRADE') AND part_key IN (SELECT p_partkey FROM part WHERE p_size > 10)
  THEN greatest(doc_date, ship_date) ELSE doc_date END AS VARCHAR) AS start_date FROM lines"""),
)
def stage_validation(spark, d):
    ln = model.lines(spark, d, "line_id", "rc_id", "line_num", "return_flag", "sales_action", "supp_key", "item_num", "doc_date", "ship_date")
    pad = lambda c: F.concat(F.lit("  "), c, F.lit(" "))
    action = F.when(F.col("line_num") != 7, F.lower("sales_action")).otherwise(F.col("sales_action"))
    stage = ln.select(
        "line_id", F.when(F.col("line_num") == 7, "Y").alias("processed"),
        F.when(F.col("return_flag") == "N", "INV").when(F.col("return_flag") == "R", "CM").otherwise("SO").alias("type"),
        pad(F.concat(F.lit("S"), "rc_id")).alias("so_num"), pad(F.lit("i")).alias("inv_num"), pad(F.lit("o")).alias("orig_inv"), pad(F.lit("e")).alias("entitlement"),
        action.alias("sales_action"), F.when(F.col("supp_key") % 3 == 0, "Recast").when(F.col("supp_key") % 3 == 1, "other").alias("reason"),
        F.lit("Q").alias("credit_rule"), "item_num", F.col("doc_date").alias("start_date"), F.col("ship_date").alias("inv_date"),
    )
    items = model.table(spark, d, "part").where("p_size > 10").select(F.concat(F.lit("ITEM-"), "p_partkey").alias("item"))
    return C.validate_stage(stage, items).select("line_id", "so_num", "sales_action", "credit_rule", F.col("start_date").cast("string").alias("start_date"))


def _revision_inputs(spark, d):
    ln = model.lines(spark, d, "line_id", "rc_id", "line_num", "contract_num", "sales_action", "return_flag", "mod_doc")
    stage = ln.select(
        "line_id", "rc_id", F.when(F.col("return_flag") == "A", "SO").when(F.col("return_flag") == "R", "CM").otherwise("INV").alias("type"), F.col("line_id").alias("so_line_id"),
        F.when(F.col("contract_num") % 7 != 0, F.col("contract_num")).alias("contract_num"), "sales_action", F.col("mod_doc").alias("so_num"),
        F.when(F.col("line_num") == 2, "Y").otherwise("N").alias("mod_flag"),
    )
    known = ln.where("line_num <= 2").where("contract_num % 3 = 0").select("contract_num", F.col("line_id").alias("doc_line_id"))
    return stage, known


_REV = """rst AS (SELECT line_id, rc_id, CASE return_flag WHEN 'A' THEN 'SO' WHEN 'R' THEN 'CM' ELSE 'INV' END AS type, CASE WHEN contract_num % 7 <> 0 THEN contract_num END AS cn, sales_action, mod_doc,
  CASE WHEN line_num = 2 THEN 'Y' ELSE 'N' END AS flag FROM lines),
kn AS (SELECT contract_num, line_id FROM lines WHERE line_num <= 2 AND contract_num % 3 = 0)"""


@query(
    "revision_tags", "CM3", "J10",
    sql=duck("lines contracts", """SELECT line_id, CASE WHEN type = 'SO' AND line_id NOT IN (SELECT line_id FROM kn) AND rc_id IN (SELECT r.rc_id FROM rst r JOIN contracts c USING (rc_id)
  WHERE c.init_pob_exp_dt <= DATE '1999-06-30' AND r.cn IN (SELECT contract_num FROM kn)) THEN rc_id END AS orig_rc_id FROM rst""", _REV),
)
def revision_tags(spark, d):
    stage, known = _revision_inputs(spark, d)
    return C.tag_revisions(stage, model.contracts(spark, d), known, _day(OPEN_END)).select("line_id", "orig_rc_id")


@query(
    "modification_flags", "CM4", "J10",
    sql=duck("lines", """SELECT line_id, CASE WHEN mod_doc IN (SELECT mod_doc FROM rst WHERE sales_action IN ('UPGRADE','DOWNGRADE') OR (sales_action = 'NEW' AND cn IN (SELECT contract_num FROM kn)))
  THEN 'Y' ELSE flag END AS mod_flag FROM rst""", _REV),
)
def modification_flags(spark, d):
    stage, known = _revision_inputs(spark, d)
    return C.flag_modifications(stage, known).select("line_id", "mod_flag")


@query(
    "mixed_range_skip", "CM5",
    sql=duck("lines", """SELECT line_id, CASE WHEN contract_num = m.cn THEN 'Y' ELSE 'N' END AS skip_mod FROM lines LEFT JOIN (
 SELECT mod_doc, max_by(contract_num, line_id) AS cn FROM lines WHERE sales_action = 'UPGRADE' AND batch_id = 1999 GROUP BY mod_doc
 HAVING count(*) FILTER (in_range = 'Y') > 0 AND count(*) FILTER (in_range = 'N') > 0) m USING (mod_doc)"""),
)
def mixed_range_skip(spark, d):
    ln = model.lines(spark, d, "line_id", "mod_doc", "contract_num", "sales_action", "batch_id", "in_range")
    return C.skip_mixed_range(ln, F.lit(1999)).select("line_id", "skip_mod")


def _routing_lines(spark, d):
    ln = model.lines(spark, d, "line_id", "rc_id", "line_num", "batch_id", "contract_num", "mod_doc", "eligible", "in_range")
    return ln.select(
        "*", F.when(F.col("line_num") % 2 == 0, F.expr("rc_id div 2")).alias("orig_rc_id"),
        F.when(F.col("line_num") == 6, F.col("line_id")).alias("bundle_parent"), F.when(F.col("line_num") == 4, "bad").alias("err_msg"),
    )


_ROUTES = """rt AS (SELECT *, CASE WHEN line_num % 2 = 0 THEN rc_id // 2 END AS orig_rc_id FROM lines),
r6 AS (SELECT line_id, rc_id AS source_rc, orig_rc_id AS target_rc, 'IN-RANGE' AS rule FROM rt a WHERE orig_rc_id IS NOT NULL AND eligible = 'Y' AND in_range = 'Y' AND line_num NOT IN (4, 6)
  AND EXISTS (SELECT 1 FROM rt b WHERE b.batch_id = a.batch_id AND b.eligible = 'Y' AND b.in_range = 'N' AND b.rc_id <> a.rc_id AND b.contract_num = a.contract_num AND b.mod_doc = a.mod_doc)),
fit AS (SELECT batch_id, contract_num, mod_doc, min(rc_id) AS lo, max(rc_id) AS hi FROM rt WHERE eligible = 'Y' AND in_range = 'Y' GROUP BY ALL),
r7 AS (SELECT line_id, rc_id AS source_rc, CASE WHEN lo <> rc_id THEN lo ELSE hi END AS target_rc, 'NON-ELIGIBLE' AS rule FROM rt a JOIN fit USING (batch_id, contract_num, mod_doc)
  WHERE orig_rc_id IS NOT NULL AND eligible = 'N' AND in_range = 'N' AND line_num <> 4 AND (lo <> rc_id OR hi <> rc_id)
  AND NOT EXISTS (SELECT 1 FROM rt b WHERE b.batch_id = a.batch_id AND b.eligible = 'Y' AND b.in_range = 'N' AND b.rc_id = a.rc_id AND b.contract_num = a.contract_num AND b.mod_doc = a.mod_doc))"""


@query("in_range_routes", "CM6", "J8", "J6", sql=duck("lines", "SELECT * FROM r6", _ROUTES))
def in_range_routes(spark, d):
    return C.route_in_range(_routing_lines(spark, d))


@query("non_eligible_routes", "CM7", "J7", "J17", sql=duck("lines", "SELECT * FROM r7", _ROUTES))
def non_eligible_routes(spark, d):
    return C.route_non_eligible(_routing_lines(spark, d))


@query("all_routes", "CM8", sql=duck("lines", "SELECT * FROM r6 UNION ALL SELECT * FROM r7", _ROUTES))
def all_routes(spark, d):
    return C.route_all(_routing_lines(spark, d))


@query("route_probe", "CM8", "AG11", sql=duck("lines", "SELECT (SELECT count(*) FROM r6) + (SELECT count(*) FROM r7) > 0 AS has_work", _ROUTES))
def route_probe(spark, d):
    return C.has_routes(_routing_lines(spark, d))


@query(
    "regrouped_contracts", "CM9",
    sql=duck("lines contracts", """SELECT rc_id, CASE WHEN rc_id IN (SELECT source_rc FROM mv) THEN 'Y' ELSE 'N' END AS closed,
 CASE WHEN rc_id IN (SELECT target_rc FROM mv) THEN 'P' ELSE treatment END AS treatment,
 CAST(CASE WHEN rc_id IN (SELECT target_rc FROM mv) THEN DATE '1999-06-30' ELSE ct_mod_end_dt END AS VARCHAR) AS ct_mod_end_dt,
 CASE WHEN rc_id IN (SELECT target_rc FROM mv) THEN 'Y' ELSE posted END AS posted FROM contracts""", _ROUTES,
 "mv AS (SELECT * FROM r6 UNION ALL SELECT * FROM r7)"),
)
def regrouped_contracts(spark, d):
    status, _ = C.regroup(C.route_all(_routing_lines(spark, d)), model.contracts(spark, d), "P", _day(OPEN_END))
    return status.withColumn("ct_mod_end_dt", F.col("ct_mod_end_dt").cast("string"))


@query(
    "regroup_details", "CM9",
    sql=duck("lines", "SELECT target_rc AS rc_id, line_id, '1999-06-30' AS ct_mod_end_date, 'P' AS treatment FROM (SELECT * FROM r6 UNION ALL SELECT * FROM r7)", _ROUTES),
)
def regroup_details(spark, d):
    _, detail = C.regroup(C.route_all(_routing_lines(spark, d)), model.contracts(spark, d), "P", _day(OPEN_END))
    return detail.withColumn("ct_mod_end_date", F.col("ct_mod_end_date").cast("string"))


_RULE = """mv AS (SELECT * FROM r6 UNION ALL SELECT * FROM r7), rule AS (SELECT 7 AS rule_id, 'R' AS treatment, DATE '1999-06-30' AS mod_date)"""


def _by_rule(spark, d):
    """Regrouping in May: the date rule that isn't history takes the end of the quarter."""
    events = spark.sql("SELECT * FROM VALUES (5, 'Contract split', 'P'), (7, 'New POB not within SSP range', 'R') AS t(id, name, treatment)")
    durations = spark.sql("SELECT * FROM VALUES ('RC Modified Period', 'Y'), ('RC Modified Quarter', 'N') AS t(mod_durn_type, hist_flag)")
    rule = C.modification_rule(events, durations, FiscalCalendar.months(), 199905)
    return C.regroup_by_rule(C.route_all(_routing_lines(spark, d)), model.contracts(spark, d), model.lines(spark, d, "line_id", "rc_id"), rule, 199905)


@query(
    "regroup_rule_status", "CM9",
    sql=duck("lines contracts", """SELECT rc_id, CASE WHEN rc_id IN (SELECT source_rc FROM mv) THEN 'Y' ELSE 'N' END AS closed, CASE WHEN t THEN rule.treatment ELSE c.treatment END AS treatment,
 CAST(CASE WHEN t THEN mod_date ELSE ct_mod_end_dt END AS VARCHAR) AS ct_mod_end_dt, CASE WHEN t THEN 'Y' ELSE posted END AS posted
 FROM (SELECT *, rc_id IN (SELECT target_rc FROM mv) AS t FROM contracts) c, rule""", _ROUTES, _RULE),
)
def regroup_rule_status(spark, d):
    return _by_rule(spark, d)[0].withColumn("ct_mod_end_dt", F.col("ct_mod_end_dt").cast("string"))


@query(
    "regroup_rule_details", "CM9",
    sql=duck("lines", "SELECT target_rc AS rc_id, line_id, rule_id, CAST(mod_date AS VARCHAR) AS ct_mod_end_date, treatment, 199905 AS crtd_prd_id FROM mv, rule", _ROUTES, _RULE),
)
def regroup_rule_details(spark, d):
    return _by_rule(spark, d)[1].withColumn("ct_mod_end_date", F.col("ct_mod_end_date").cast("string"))


@query(
    "regrouped_lines", "CM9",
    sql=duck("lines", "SELECT l.line_id, coalesce(t, rc_id) AS rc_id FROM lines l LEFT JOIN (SELECT line_id, min(target_rc) AS t FROM mv GROUP BY line_id) m ON m.line_id = l.line_id", _ROUTES, _RULE),
)
def regrouped_lines(spark, d):
    return _by_rule(spark, d)[2]


_WALK = """inv AS (SELECT * FROM bills WHERE type = 'INV' AND rc_id > 0 AND doc_num <> coalesce(orig_doc_num, 'X')),
seeds AS (SELECT rc_id AS seed_id, rc_id, orig_doc_num, start_date FROM inv a WHERE mod_flag = 'Y' AND sales_action = 'UPGRADE' AND (
  EXISTS (SELECT 1 FROM bills b WHERE b.doc_num = a.orig_doc_num AND b.sales_action = 'UPGRADE')
  OR EXISTS (SELECT 1 FROM bills b WHERE b.doc_num = a.orig_doc_num AND b.sales_action <> 'UPGRADE' AND a.start_date < b.end_date))),
walk AS (SELECT s.seed_id, i.doc_num, i.orig_doc_num, i.rc_id, i.start_date, 1 AS depth FROM seeds s JOIN inv i ON i.doc_num = s.orig_doc_num AND i.rc_id <> s.rc_id AND i.end_date >= s.start_date
 UNION ALL SELECT w.seed_id, i.doc_num, i.orig_doc_num, i.rc_id, i.start_date, w.depth + 1 FROM walk w JOIN inv i ON i.doc_num = w.orig_doc_num AND i.rc_id <> w.rc_id AND i.end_date >= w.start_date)"""


def _walk(spark, d):
    bills = model.bills(spark, d)
    seeds = C.upgrade_seeds(bills, ["rc_id", "orig_doc_num", "start_date"]).withColumn("seed_id", F.col("rc_id"))
    return bills, seeds, C.lineage(bills, seeds)


@query("invoice_lineage", "CM10", "J18", sql=duck("bills", "SELECT seed_id, doc_num, orig_doc_num, rc_id, depth FROM walk", _WALK, recursive=True))
def invoice_lineage(spark, d):
    return _walk(spark, d)[2]


@query(
    "lineage_members", "CM10", "AG7",
    sql=duck("bills", "SELECT seed_id, rc_id FROM walk UNION SELECT seed_id, rc_id FROM seeds", _WALK, recursive=True),
)
def lineage_members(spark, d):
    _, seeds, walk = _walk(spark, d)
    return C.lineage_members(walk, seeds)


_MERGE = """cand AS (SELECT rc_id FROM (SELECT rc_id, sales_action, count(*) FILTER (line_num <> 7) AS n, max(CASE WHEN in_range = 'N' AND eligible = 'Y' THEN 1 ELSE 0 END) AS q
  FROM lines WHERE supp_key % 2 = 0 AND sales_action IN ('UPGRADE','DOWNGRADE') AND batch_id = 1999 GROUP BY ALL) WHERE q = 1 GROUP BY rc_id HAVING sum(n) > 1),
mem0 AS (SELECT DISTINCT seed_id, rc_id FROM (SELECT seed_id, rc_id FROM walk UNION SELECT seed_id, rc_id FROM seeds) WHERE seed_id IN (SELECT rc_id FROM cand)),
tied AS (SELECT DISTINCT seed_id, seed_id AS other FROM mem0 UNION SELECT t.seed_id, b.seed_id FROM tied t JOIN mem0 a ON a.seed_id = t.other JOIN mem0 b ON b.rc_id = a.rc_id),
mem AS (SELECT DISTINCT s.seed_id, rc_id FROM mem0 JOIN (SELECT seed_id AS own, min(other) AS seed_id FROM tied GROUP BY ALL) s ON s.own = mem0.seed_id),
tgt AS (SELECT seed_id, rc_id AS target_rc FROM (SELECT seed_id, m.rc_id, row_number() OVER (PARTITION BY seed_id ORDER BY doc_date, m.rc_id) AS rn FROM mem m JOIN bills b ON b.rc_id = m.rc_id) WHERE rn = 1),
mv AS (SELECT seed_id, rc_id AS source_rc, target_rc FROM mem JOIN tgt USING (seed_id) WHERE rc_id <> target_rc),
trt AS (SELECT seed_id, target_rc, CASE WHEN max(treatment) = 'R' THEN 'R' ELSE 'P' END AS treatment FROM mv JOIN contracts ON contracts.rc_id = source_rc GROUP BY ALL)"""


def _merge(spark, d):
    ln = model.lines(spark, d, "rc_id", "line_num", "sales_action", "batch_id", "in_range", "eligible", "supp_key").select(
        "*", F.when(F.col("supp_key") % 2 == 0, "Y").alias("multi_ref"), F.when(F.col("line_num") == 7, "Y").alias("done_flag")
    )
    eligible = C.merge_candidates(ln, F.lit(1999)).select(F.col("rc_id").alias("seed_id"))
    bills = model.bills(spark, d)
    seeds = C.upgrade_seeds(bills, ["rc_id", "orig_doc_num", "start_date"]).withColumn("seed_id", F.col("rc_id")).join(eligible, "seed_id", "left_semi")
    walk = C.lineage(bills, seeds)
    return walk, C.merge_lineage(C.lineage_members(walk, seeds), bills)


@query("lineage_merge", "CM11", "W3", sql=duck("lines bills contracts", "SELECT * FROM mv", _WALK, _MERGE, recursive=True))
def lineage_merge(spark, d):
    return _merge(spark, d)[1]


@query("merged_treatment", "CM12", sql=duck("lines bills contracts", "SELECT seed_id, target_rc, treatment, concat('Y-', treatment, '-Jun-99') AS stamp FROM trt", _WALK, _MERGE, recursive=True))
def merged_treatment(spark, d):
    return C.treatment(_merge(spark, d)[1], model.contracts(spark, d), "Jun-99")


@query(
    "treatment_switches", "CM13",
    sql=duck("lines bills contracts", """SELECT DISTINCT c.rc_id, c.treatment AS old, t.treatment AS new, CASE t.treatment WHEN 'P' THEN 'Prospective' ELSE 'Retrospective' END AS allocation
 FROM trt t JOIN contracts c ON c.rc_id = t.target_rc WHERE c.treatment <> t.treatment""", _WALK, _MERGE, recursive=True),
)
def treatment_switches(spark, d):
    heads = model.contracts(spark, d)
    after = C.treatment(_merge(spark, d)[1], heads, "Jun-99").select(F.col("target_rc").alias("rc_id"), "treatment").distinct()
    return C.treatment_changes(heads, after)


@query(
    "lineage_audit", "CM16",
    sql=duck("lines bills contracts", """SELECT DISTINCT w.rc_id, doc_num AS invoice_num, orig_doc_num AS orig_inv_num, CASE WHEN w.rc_id IN (SELECT source_rc FROM mv) THEN 'Y' ELSE 'N' END AS delink
 FROM walk w WHERE seed_id IN (SELECT rc_id FROM cand)""", _WALK, _MERGE, recursive=True),
)
def lineage_audit(spark, d):
    walk, moves = _merge(spark, d)
    return C.lineage_audit(walk, moves.select(F.col("source_rc").alias("rc_id")))


def _links(spark, d, *more):
    ln = model.lines(spark, d, "rc_id", "line_num", "contract_num", *more)
    key = F.when(F.col("line_num") <= 5, F.concat(F.lit("C"), "contract_num")).otherwise(F.concat(F.lit("G"), F.expr("contract_num div 3")))
    return ln.withColumn("key", key)


_LINKS = "lk AS (SELECT DISTINCT rc_id, CASE WHEN line_num <= 5 THEN concat('C', contract_num) ELSE concat('G', contract_num // 3) END AS key FROM lines)"


@query(
    "shared_key_merge", "CM14",
    sql=duck("lines", "SELECT rc_id, min(other) AS label FROM reach GROUP BY rc_id", _LINKS,
             """reach AS (SELECT rc_id, rc_id AS other FROM lk
 UNION SELECT r.rc_id, b.rc_id FROM reach r JOIN lk a ON a.rc_id = r.other JOIN lk b ON b.key = a.key)""", recursive=True),
)
def shared_key_merge(spark, d):
    return C.merge_by_key(_links(spark, d))


@query(
    "range_classes", "CM15", "AG4",
    sql=duck("lines", """SELECT rc_id, CASE WHEN max(CASE WHEN eligible = 'Y' AND (alctbl_xt_prc < unit_ssp * term * ord_qty * CAST(0.8 AS DECIMAL(2,1)) OR alctbl_xt_prc > unit_ssp * term * ord_qty * CAST(1.2 AS DECIMAL(2,1))) THEN 1 ELSE 0 END) = 1
  THEN 'CONTRACT MOD' ELSE 'WITH IN RANGE' END AS label FROM lines WHERE rc_id IN (SELECT rc_id FROM lk WHERE key IN (SELECT key FROM lk GROUP BY key HAVING count(*) > 1)) GROUP BY rc_id""", _LINKS),
)
def range_classes(spark, d):
    ln = _links(spark, d, "eligible", "alctbl_xt_prc", "unit_ssp", "term", "ord_qty")
    return C.classify_range(ln, ln.select("rc_id", "key"))
