"""Contract modification jobs: staging, routing, lineage, merging and regrouping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recogna.functions.scalars import greatest_strict, replace_segment
from recogna.functions.skew import attach
from recogna.session import cut, keep_dealt
from recogna.sources.fiscal import FiscalCalendar

# fixed values: sales actions and the license items whose dates are aligned
DATED_ACTIONS = ("NEW", "UPGRADE", "DOWNGRADE", "RENEWAL")
LICENSE_ITEMS = ("Term License", "Term License (incremental)", "Stack License", "Stack License (incremental)")


def prepare_bundles(stage: DataFrame) -> DataFrame:
    """Dates, account segments and credit rule of exploded bundles.

    A renewal license starts no earlier than its document.  All license lines of one
    invoice, entitlement and type share the later of their first document and first start
    date.  The fourth revenue segment is replaced where one is given.  License children
    lose their end date, invoiced ones also their credit rule.
    """
    is_inv, is_so = F.col("type") == "INV", F.col("type") == "SO"
    doc_day = F.when(is_inv, F.col("inv_date")).when(is_so, F.col("so_date"))
    license_line = F.col("item_num").isin(*LICENSE_ITEMS)
    renewed = stage.withColumn(
        "start_date",
        F.when((F.col("sales_action") == "RENEWAL") & license_line & (doc_day > F.col("start_date")), doc_day).otherwise(F.col("start_date")),
    )
    aligned = license_line & F.col("sales_action").isin(*DATED_ACTIONS) & (is_inv | is_so)
    keys = ["inv_num", "entitlement", "type"]
    firsts = (
        renewed.where(aligned & F.col("inv_num").isNotNull() & F.col("entitlement").isNotNull())
        .groupBy(*keys)
        .agg(greatest_strict(F.min(doc_day), F.min("start_date")).alias("_first"), F.lit(True).alias("_grouped"))
    )
    dated = attach(renewed, firsts, keys).withColumn(
        "start_date", F.when(aligned & F.col("_grouped"), F.col("_first")).otherwise(F.col("start_date"))
    )
    rewrite = (
        (F.coalesce("bundle_config", F.lit(0)) != 0) & (F.coalesce("rc_id", F.lit(0)) != 0) & F.col("segment4").isNotNull()
    )
    ordered = F.col("type").isin("SO", "RORD")
    order_child = ordered & F.col("item_num").like("%License%") & (F.col("so_line_id") != F.col("bundle_parent"))
    bill_child = ~ordered & F.col("item_num").like("%Lic%") & (F.col("inv_line_id") != F.col("bundle_parent"))
    return dated.withColumns(
        {
            "rev_segments": F.when(rewrite, replace_segment(F.col("rev_segments"), 3, F.col("segment4"))).otherwise(F.col("rev_segments")),
            "end_date": F.when(~F.coalesce(order_child | bill_child, F.lit(False)), F.col("end_date")),
            "credit_rule": F.when(~F.coalesce(bill_child, F.lit(False)), F.col("credit_rule")),
        }
    ).drop("_first", "_grouped")


def validate_stage(stage: DataFrame, items: DataFrame) -> DataFrame:
    """Trim keys, upper-case the action, derive the credit rule and move listed items' start dates."""
    open_row = F.coalesce("processed", F.lit("N")) != "Y"
    credit = F.col("type").isin("CM", "CM-R")
    recast = F.upper("reason")
    tidy = stage.withColumns(
        {
            "orig_inv": F.trim("orig_inv"),
            "entitlement": F.trim("entitlement"),
            "so_num": F.trim("so_num"),
            "inv_num": F.trim("inv_num"),
            "sales_action": F.when(open_row, F.upper("sales_action")).otherwise(F.col("sales_action")),
            "credit_rule": F.when(
                open_row,
                F.when(credit & (recast == "RECAST"), "F").when(credit & (F.coalesce(recast, F.lit("X")) != "RECAST"), "P"),
            ).otherwise(F.col("credit_rule")),
        }
    )
    listed = items.select(F.col(items.columns[0]).alias("item_num")).distinct().withColumn("_listed", F.lit(True))
    move = open_row & (F.col("type") == "INV") & F.col("sales_action").isin("NEW", "UPGRADE", "DOWNGRADE") & F.col("_listed")
    return attach(tidy, listed, ["item_num"]).withColumn(
        "start_date", F.when(move, greatest_strict(F.col("start_date"), F.col("inv_date"))).otherwise(F.col("start_date"))
    ).drop("_listed")


def _known_contracts(lines: DataFrame) -> DataFrame:
    return lines.select(F.coalesce(F.col("contract_num").cast("string"), F.lit("X")).alias("_cn")).distinct()


def tag_revisions(stage: DataFrame, contracts: DataFrame, lines: DataFrame, as_of: Column) -> DataFrame:
    """Remember the contract on new order lines of contracts past their initial period.

    A staged contract is in revision when its initial period ended by ``as_of`` and one of
    its contract numbers is known; only order lines without an existing line are tagged.
    """
    expired = contracts.where(F.col("init_pob_exp_dt") <= as_of).select("rc_id")
    numbered = stage.withColumn("_cn", F.coalesce(F.col("contract_num").cast("string"), F.lit("X")))
    revised = (
        numbered.select("rc_id", "_cn").distinct()
        .join(expired, "rc_id", "left_semi")
        .join(_known_contracts(lines), "_cn", "left_semi")
        .select("rc_id").distinct()
        .withColumn("_revised", F.lit(True))
    )
    existing = lines.select(F.col("doc_line_id").alias("so_line_id")).distinct().withColumn("_exists", F.lit(True))
    return (
        attach(stage, revised, ["rc_id"])
        .join(existing, "so_line_id", "left")
        .withColumn("orig_rc_id", F.when(F.col("_revised") & F.col("_exists").isNull() & (F.col("type") == "SO"), F.col("rc_id")))
        .drop("_revised", "_exists")
    )


def flag_modifications(stage: DataFrame, lines: DataFrame) -> DataFrame:
    """Set the modification flag on every line of an order with an upgrade, a downgrade or a new line on a known contract."""
    numbered = stage.withColumn("_cn", F.coalesce(F.col("contract_num").cast("string"), F.lit("X")))
    known = _known_contracts(lines)
    changed = numbered.where(F.col("sales_action").isin("UPGRADE", "DOWNGRADE")).select("so_num")
    added = numbered.where(F.col("sales_action") == "NEW").join(known, "_cn", "left_semi").select("so_num")
    orders = changed.union(added).distinct().withColumn("_mod", F.lit(True))
    return attach(stage, orders, ["so_num"]).withColumn("mod_flag", F.when(F.col("_mod"), "Y").otherwise(F.col("mod_flag"))).drop("_mod")


def skip_mixed_range(lines: DataFrame, batch: Column) -> DataFrame:
    """Skip contract modification for orders with upgrades both in and out of range.

    The skip applies to the lines of the order that carry the contract number of its last
    upgrade line (by line id).
    """
    upgrades = lines.where((F.col("sales_action") == "UPGRADE") & (F.col("batch_id") == batch) & F.col("in_range").isin("Y", "N"))
    mixed = (
        upgrades.groupBy("mod_doc")
        .agg(
            F.max((F.col("in_range") == "Y").cast("int")).alias("y"),
            F.max((F.col("in_range") == "N").cast("int")).alias("n"),
            F.max_by("contract_num", "line_id").alias("contract_num"),
        )
        .where("y = 1 AND n = 1")
        .select("mod_doc", "contract_num", F.lit("Y").alias("skip_mod"))
    )
    return attach(lines, mixed, ["mod_doc", "contract_num"]).withColumn("skip_mod", F.coalesce("skip_mod", F.lit("N")))


def _siblings(lines: DataFrame, in_range: str, prefix: str) -> DataFrame:
    """Smallest and largest contract with an eligible line per batch, contract number and document.

    Another contract exists for a line exactly when one of the two differs from its own, so
    no pairs of lines are formed.
    """
    return lines.where((F.col("eligible") == "Y") & (F.col("in_range") == in_range)).groupBy("batch_id", "contract_key", "mod_doc").agg(
        F.min("rc_id").alias(f"{prefix}_lo"), F.max("rc_id").alias(f"{prefix}_hi")
    )


def _keyed(lines: DataFrame) -> DataFrame:
    return lines.withColumn("contract_key", F.coalesce(F.col("contract_num").cast("string"), F.lit("X")))


def route_in_range(lines: DataFrame) -> DataFrame:
    """Moves of in-range eligible revision lines back to their original contract.

    They move when a sibling line of the same document on another contract is out of range.
    """
    keyed = _keyed(lines)
    others = _siblings(keyed, "N", "out")
    movable = keyed.where(
        F.col("orig_rc_id").isNotNull()
        & (F.col("eligible") == "Y")
        & (F.col("in_range") == "Y")
        & (F.coalesce("bundle_parent", F.lit("X")) != F.col("line_id"))
        & F.col("err_msg").isNull()
    )
    return (
        attach(movable, others, ["batch_id", "contract_key", "mod_doc"], "inner")
        .where((F.col("out_lo") != F.col("rc_id")) | (F.col("out_hi") != F.col("rc_id")))
        .select("line_id", F.col("rc_id").alias("source_rc"), F.col("orig_rc_id").alias("target_rc"), F.lit("IN-RANGE").alias("rule"))
    )


def route_non_eligible(lines: DataFrame) -> DataFrame:
    """Moves of non-eligible out-of-range lines to an eligible in-range sibling contract.

    Lines stay when their own contract has an eligible out-of-range line of the document.
    The target is the smallest other contract, or the largest when the line's own contract
    is the smallest.
    """
    keyed = _keyed(lines)
    key = ["batch_id", "contract_key", "mod_doc"]
    fitting = _siblings(keyed, "Y", "in")
    own_out = keyed.where((F.col("eligible") == "Y") & (F.col("in_range") == "N")).select(*key, "rc_id").distinct()
    target = F.when(F.col("in_lo") != F.col("rc_id"), F.col("in_lo")).otherwise(F.col("in_hi"))
    stranded = keyed.where(
        F.col("orig_rc_id").isNotNull() & (F.col("eligible") == "N") & (F.col("in_range") == "N") & F.col("err_msg").isNull()
    )
    alone = attach(stranded, own_out.withColumn("_own", F.lit(True)), [*key, "rc_id"]).where("_own IS NULL").drop("_own")
    return (
        attach(alone, fitting, key, "inner")
        .withColumn("target_rc", target)
        .where(F.col("target_rc") != F.col("rc_id"))
        .select("line_id", F.col("rc_id").alias("source_rc"), "target_rc", F.lit("NON-ELIGIBLE").alias("rule"))
    )


def route_all(lines: DataFrame) -> DataFrame:
    return route_in_range(lines).unionByName(route_non_eligible(lines))


def has_routes(lines: DataFrame) -> DataFrame:
    """One row telling whether either routing rule has work."""
    return route_all(lines).select("rule").limit(1).agg((F.count(F.lit(1)) > 0).alias("has_work"))


def regroup(
    moves: DataFrame, contracts: DataFrame, treatment: str | None, mod_date: Column
) -> tuple[DataFrame, DataFrame]:
    """Contract status and modification detail after line moves.

    Sources are closed.  Destinations take the rule's treatment and modification date and
    are posted when the rule has a treatment; every moved line yields one detail row then.
    """
    sources = moves.select(F.col("source_rc").alias("rc_id")).distinct().withColumn("_src", F.lit(True))
    targets = moves.select(F.col("target_rc").alias("rc_id")).distinct().withColumn("_dst", F.lit(treatment is not None))
    dst = F.coalesce("_dst", F.lit(False))
    status = (
        contracts.join(sources, "rc_id", "left")
        .join(targets, "rc_id", "left")
        .select(
            "rc_id",
            F.when(F.col("_src"), "Y").otherwise("N").alias("closed"),
            F.when(dst, F.lit(treatment)).otherwise(F.col("treatment")).alias("treatment"),
            F.when(dst, mod_date).otherwise(F.col("ct_mod_end_dt")).alias("ct_mod_end_dt"),
            F.when(dst, "Y").otherwise(F.col("posted")).alias("posted"),
        )
    )
    detail = moves.where(F.lit(treatment is not None)).select(
        F.col("target_rc").alias("rc_id"), "line_id", mod_date.alias("ct_mod_end_date"), F.lit(treatment).alias("treatment")
    )
    return status, detail


# fixed values: the event whose rule treats regrouped lines, and the duration that ends with the open period
NOT_IN_RANGE_EVENT = "NEW POB NOT WITHIN SSP RANGE"
PERIOD_DURATION = "RC MODIFIED PERIOD"


def modification_rule(events: DataFrame, durations: DataFrame, calendar: FiscalCalendar, open_prd: int) -> DataFrame:
    """One row: rule_id, treatment and mod_date for regrouped lines, from the rule tables.

    ``events``: id, name, treatment. ``durations``: mod_durn_type, hist_flag; the row that isn't history decides
    whether a modification ends with the open period or with its quarter. Without a rule all are null.
    """
    at = next(i for i, p in enumerate(calendar.periods) if p.id == open_prd)
    own = calendar.periods[at]
    quarter_end = max(p.end for p in calendar.periods if (p.year, p.quarter) == (own.year, own.quarter))
    rule = events.where(F.upper("name") == NOT_IN_RANGE_EVENT).agg(F.max("id").alias("rule_id"), F.max("treatment").alias("treatment"))
    kind = durations.where("hist_flag = 'N'").agg(F.max(F.upper("mod_durn_type")).alias("kind"))
    ends = F.when(F.col("kind") == PERIOD_DURATION, F.lit(own.end)).otherwise(F.lit(quarter_end))
    return rule.crossJoin(kind).select("rule_id", "treatment", F.when(F.col("treatment").isNotNull(), ends).alias("mod_date"))  # one row each


def regroup_by_rule(moves: DataFrame, contracts: DataFrame, lines: DataFrame, rule: DataFrame, open_prd: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Contract status, modification details and lines after the moves, as the rule has it.

    Sources are closed. Where the rule has a treatment, destinations take it with its date and are posted, and every moved
    line yields one detail row. Moved lines (line_id, rc_id, ...) belong to their destination; a line moves once, to the
    smallest one, if several routes name it.
    """
    rule = F.broadcast(rule)  # one row
    sources = moves.select(F.col("source_rc").alias("rc_id")).distinct().withColumn("_src", F.lit(True))
    targets = moves.select(F.col("target_rc").alias("rc_id")).distinct().withColumn("_dst", F.lit(True))
    rows = contracts.join(sources, "rc_id", "left").join(targets, "rc_id", "left").crossJoin(rule.withColumnRenamed("treatment", "_treatment"))
    dst = F.coalesce("_dst", F.lit(False)) & F.col("_treatment").isNotNull()
    status = rows.select(
        "rc_id",
        F.when(F.col("_src"), "Y").otherwise("N").alias("closed"),
        F.when(dst, F.col("_treatment")).otherwise(F.col("treatment")).alias("treatment"),
        F.when(dst, F.col("mod_date")).otherwise(F.col("ct_mod_end_dt")).alias("ct_mod_end_dt"),
        F.when(dst, "Y").otherwise(F.col("posted")).alias("posted"),
    )
    detail = moves.crossJoin(rule).where("treatment IS NOT NULL").select(
        F.col("target_rc").alias("rc_id"), "line_id", "rule_id", F.col("mod_date").alias("ct_mod_end_date"), "treatment", F.lit(open_prd).alias("crtd_prd_id")
    )
    target = moves.groupBy("line_id").agg(F.min("target_rc").alias("_target"))
    regrouped = lines.join(target, "line_id", "left").withColumn("rc_id", F.coalesce("_target", "rc_id")).select(*lines.columns)
    return status, detail, regrouped


def upgrade_seeds(bills: DataFrame, keep: list[str]) -> DataFrame:
    """Upgrade invoices whose original invoice is an upgrade too, or is still running at their start."""
    inv = bills.where((F.col("type") == "INV") & (F.col("rc_id") > 0))
    upgrade = (F.col("mod_flag") == "Y") & (F.upper("sales_action") == "UPGRADE") & (F.col("doc_num") != F.coalesce("orig_doc_num", F.lit("X")))
    originals = inv.groupBy(F.col("doc_num").alias("orig_doc_num")).agg(
        F.max((F.upper("sales_action") == "UPGRADE").cast("int")).alias("_up"),
        F.max(F.when(F.upper("sales_action") != "UPGRADE", F.col("end_date"))).alias("_until"),
    )
    return (
        attach(inv.where(upgrade), originals, ["orig_doc_num"], "inner")
        .where((F.col("_up") == 1) | (F.col("start_date") < F.col("_until")))
        .select(*keep)
        .distinct()
    )


def lineage(bills: DataFrame, seeds: DataFrame) -> DataFrame:
    """Walk original-invoice references from seed invoices.

    ``seeds``: seed_id, rc_id, orig_doc_num, start_date.  A referenced invoice joins while
    it ends no earlier than its child starts and belongs to another contract.  Each seed
    visits an invoice once, so the walk ends on cyclic references too.  One level is one
    join; levels are cut with checkpoints so lost executors do not replay the whole walk.  Invoices are
    dealt and sorted by number once, so a level shuffles what it follows, not all invoices again.
    """
    inv = bills.where(
        (F.col("type") == "INV") & (F.col("rc_id") > 0) & (F.col("doc_num") != F.coalesce("orig_doc_num", F.lit("X")))
    ).select("doc_num", "orig_doc_num", "rc_id", "start_date", "end_date")
    inv = keep_dealt(inv, "doc_num")

    def follow(frontier: DataFrame) -> DataFrame:
        child = frontier.select("seed_id", F.col("orig_doc_num").alias("doc_num"), F.col("rc_id").alias("_child_rc"), F.col("start_date").alias("_child_start"))
        return (
            child.join(inv, "doc_num")
            .where((F.col("rc_id") != F.col("_child_rc")) & (F.col("end_date") >= F.col("_child_start")))
            .select("seed_id", "doc_num", "orig_doc_num", "rc_id", "start_date")
            .distinct()
        )

    level, depth = cut(follow(seeds.where("orig_doc_num IS NOT NULL"))), 1
    found = [level.withColumn("depth", F.lit(1))]
    while not level.where("orig_doc_num IS NOT NULL").isEmpty():
        depth += 1
        visited = reduce(DataFrame.unionByName, found).select("seed_id", "doc_num", "rc_id")
        level = cut(
            follow(level.where("orig_doc_num IS NOT NULL")).join(visited, ["seed_id", "doc_num", "rc_id"], "left_anti")
        )
        found.append(level.withColumn("depth", F.lit(depth)))
    inv.unpersist()  # every level is stored
    return reduce(DataFrame.unionByName, found).select("seed_id", "doc_num", "orig_doc_num", "rc_id", "depth")


def lineage_audit(walk: DataFrame, moved: DataFrame) -> DataFrame:
    """Contract, invoice and original invoice of every walked row with its delink mark."""
    mark = moved.select("rc_id").distinct().withColumn("delink", F.lit("Y"))
    return (
        walk.select("rc_id", F.col("doc_num").alias("invoice_num"), F.col("orig_doc_num").alias("orig_inv_num"))
        .distinct()
        .join(mark, "rc_id", "left")
        .withColumn("delink", F.coalesce("delink", F.lit("N")))
    )


def lineage_members(walk: DataFrame, seeds: DataFrame) -> DataFrame:
    """Contracts of each lineage, as rows; the seed's own contract is one of them."""
    return (
        walk.select("seed_id", "rc_id").unionByName(seeds.select("seed_id", "rc_id")).distinct()
    )


def merge_candidates(lines: DataFrame, batch: Column) -> DataFrame:
    """Contracts with several flagged upgrade or downgrade lines, one of whose actions has an eligible out-of-range line."""
    flagged = lines.where(
        (F.col("multi_ref") == "Y") & F.upper("sales_action").isin("UPGRADE", "DOWNGRADE") & (F.col("batch_id") == batch) & (F.col("rc_id") > 0)
    )
    per_action = flagged.groupBy("rc_id", "sales_action").agg(
        F.sum(F.when(F.col("done_flag").isNull(), 1).otherwise(0)).alias("n"),
        F.max(((F.col("in_range") == "N") & (F.col("eligible") == "Y")).cast("int")).alias("qualifies"),
    )
    return per_action.where("qualifies = 1").groupBy("rc_id").agg(F.sum("n").alias("n")).where("n > 1").select("rc_id")


def merge_lineage(members: DataFrame, bills: DataFrame) -> DataFrame:
    """Move every contract of a lineage into the one with the earliest (document date, contract).

    Lineages that share a contract are one set, named after its smallest seed, so every contract has one target.
    """
    first_doc = bills.where("type = 'INV'").groupBy("rc_id").agg(F.min("doc_date").alias("doc_date"))
    # a seed is a contract and belongs to its own lineage, so its id serves as the key that ties the lineage together
    members = cut(members.distinct())
    sets = merge_by_key(members.select("rc_id", F.col("seed_id").alias("key")))
    named = members.join(sets, "rc_id").groupBy("label").agg(F.min("seed_id").alias("seed_id"))
    members = sets.join(named, "label").select("seed_id", "rc_id")
    targets = members.join(first_doc, "rc_id").groupBy("seed_id").agg(F.min(F.struct("doc_date", "rc_id")).alias("t"))
    return (
        attach(members, targets.select("seed_id", F.col("t.rc_id").alias("target_rc")), ["seed_id"], "inner")
        .where(F.col("rc_id") != F.col("target_rc"))
        .select("seed_id", F.col("rc_id").alias("source_rc"), "target_rc")
    )


def treatment(moves: DataFrame, contracts: DataFrame, period_name: str) -> DataFrame:
    """Allocation treatment of each merged set: R as soon as one member has it, else P."""
    held = contracts.select(F.col("rc_id").alias("source_rc"), "treatment")
    return (
        moves.join(held, "source_rc")
        .groupBy("seed_id", "target_rc")
        .agg(F.max((F.col("treatment") == "R").cast("int")).alias("r"))
        .withColumn("treatment", F.when(F.col("r") == 1, "R").otherwise("P"))
        .select("seed_id", "target_rc", "treatment", F.concat_ws("-", F.lit("Y"), "treatment", F.lit(period_name)).alias("stamp"))
    )


def treatment_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Contracts whose treatment differs after a merge, with the allocation to switch to."""
    return (
        before.select("rc_id", F.col("treatment").alias("old"))
        .join(after.select("rc_id", F.col("treatment").alias("new")), "rc_id")
        .where("old <> new")
        .withColumn("allocation", F.when(F.col("new") == "P", "Prospective").otherwise("Retrospective"))
    )


def merge_by_key(links: DataFrame) -> DataFrame:
    """Smallest contract of every set of contracts connected through shared keys.

    ``links``: rc_id, key.  Labels spread through keys as minima (map-side combined) and
    are shortened by following the label's own label, so the number of rounds grows with
    the logarithm of the longest chain.  No pair of contracts is ever built.
    """
    edges = cut(links.where("rc_id > 0 AND key IS NOT NULL").select("rc_id", "key").distinct())
    labels = edges.select("rc_id", F.col("rc_id").alias("label")).distinct()
    while True:
        by_key = edges.join(labels, "rc_id").groupBy("key").agg(F.min("label").alias("key_label"))
        spread = attach(edges, by_key, ["key"]).groupBy("rc_id").agg(F.min("key_label").alias("label"))
        jump = spread.select(F.col("rc_id").alias("label"), F.col("label").alias("next"))
        merged = cut(
            spread.join(jump, "label", "left")
            .join(labels.withColumnRenamed("label", "old"), "rc_id")
            .select("rc_id", F.least("label", F.coalesce("next", "label")).alias("label"), "old")
        )
        labels = merged.select("rc_id", "label")
        if merged.where("label <> old").isEmpty():
            return labels


def classify_range(lines: DataFrame, links: DataFrame, tolerance: str = "0.2") -> DataFrame:
    """Label contracts that share a key with another contract.

    CONTRACT MOD when an eligible line's allocatable price lies outside unit price x term x
    quantity by more than the tolerance, WITH IN RANGE otherwise.
    """
    shared_keys = links.groupBy("key").agg(F.min("rc_id").alias("lo"), F.max("rc_id").alias("hi")).where("lo <> hi").select("key")
    sharing = links.join(shared_keys, "key", "left_semi").select("rc_id").distinct()
    base = F.col("unit_ssp") * F.col("term") * F.col("ord_qty")
    tol = F.lit(tolerance).cast("decimal(4,2)")
    one = F.lit("1.00").cast("decimal(4,2)")
    outside = (F.col("eligible") == "Y") & ((F.col("alctbl_xt_prc") < base * (one - tol)) | (F.col("alctbl_xt_prc") > base * (one + tol)))
    per_contract = lines.groupBy("rc_id").agg(F.max(F.when(outside, 1).otherwise(0)).alias("out"))
    return per_contract.join(sharing, "rc_id", "left_semi").select(
        "rc_id", F.when(F.col("out") == 1, "CONTRACT MOD").otherwise("WITH IN RANGE").alias("label")
    )
