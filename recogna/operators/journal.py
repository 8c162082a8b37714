"""Journal, ledger, tax and rebill jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recogna.functions.scalars import account_class, flag_at, number_or, with_flag
from recogna.functions.skew import attach, running_before

# fixed values: category names with their own rules
LICENSE = ("LICENSE - TERM", "LICENSE - PERPETUAL")
MARKETING = "MARKETING"


def _r2(c: Column) -> Column:
    return F.round(c.cast("decimal(28,8)"), 2).cast("decimal(18,2)")


def both_sides(schedules: DataFrame) -> DataFrame:
    """Debit and credit side of every entry as rows with ``net`` = credit - debit."""
    side = F.explode(
        F.array(
            F.struct(F.col("dr_acct").alias("acct_type_id"), (-F.col("amount")).alias("net")),
            F.struct(F.col("cr_acct").alias("acct_type_id"), F.col("amount").alias("net")),
        )
    )
    rest = [c for c in schedules.columns if c not in ("dr_acct", "cr_acct", "amount")]
    return schedules.withColumn("_s", side).select(*rest, "_s.acct_type_id", "_s.net")


def ledger_balance(
    schedules: DataFrame,
    accounts: DataFrame,
    balances: dict[str, Sequence[str]],
    prd: int,
    key: str = "line_id",
    unbilled: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Credit minus debit per key of what is posted up to ``prd``, one column per set of account names.

    An entry counts from its posting period on, ``post_prd_id``, which may differ from the period it belongs to;
    schedules without that column post in their own period. ``unbilled`` sets count unbilled entries only; all columns
    come from one pass.
    """
    is_unbilled = flag_at(F.col("indicators"), 4) == "Y"
    posted = F.coalesce("post_prd_id", "prd_id") if "post_prd_id" in schedules.columns else F.col("prd_id")
    rows = schedules.where(posted <= prd)
    if not balances:
        rows = rows.where(is_unbilled)
    wanted = [(out, names, F.lit(True)) for out, names in balances.items()]
    wanted += [(out, names, is_unbilled) for out, names in (unbilled or {}).items()]
    named = both_sides(rows.select(key, "amount", "dr_acct", "cr_acct", "indicators")).join(
        F.broadcast(accounts.select("acct_type_id", "acct_name")), "acct_type_id"
    )
    return named.groupBy(key).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("acct_name").isin(*names) & only, F.col("net"))), F.lit(0)).cast("decimal(18,2)").alias(out)
            for out, names, only in wanted
        ]
    )


def pending_contracts(lines: DataFrame) -> DataFrame:
    """Contracts with a pending-billing line and allocatable amount different from the billed one."""
    totals = lines.groupBy("rc_id").agg(
        F.sum("alctbl_xt_prc").alias("alctbl"),
        F.sum("bld_rec_amt").alias("rec"),
        F.sum("bld_def_amt").alias("deferred"),
        F.max(F.when(F.col("bill_pending") == "Y", 1).otherwise(0)).alias("flagged"),
        F.max(F.when(F.col("eligible") == "Y", 1).otherwise(0)).alias("any_eligible"),
    )
    return totals.where(
        (F.col("flagged") == 1) & (F.col("any_eligible") == 1) & (F.col("alctbl") != F.col("rec") + F.col("deferred"))
    ).select("rc_id", F.col("alctbl").cast("decimal(18,2)").alias("alctbl"), (F.col("rec") + F.col("deferred")).cast("decimal(18,2)").alias("billed"))


def expected_positions(lines: DataFrame, balances: DataFrame) -> DataFrame:
    """Expected deferred and unbilled position per contract and product category.

    ``lines``: rc_id, line_id, prod_ctgry, alctd_xt_prc, billed.  ``balances``: line_id,
    revenue, liability, unbilled (ledger, credit - debit).  The contract total is summed
    over the category rows, so the only window holds one row per category.
    """
    zero = F.lit(0).cast("decimal(18,2)")
    per_category = (
        lines.join(balances, "line_id", "left")
        .groupBy("rc_id", "prod_ctgry")
        .agg(
            F.sum("alctd_xt_prc").alias("alctd"),
            F.sum("billed").alias("ctgry_billed"),
            F.sum(F.coalesce("revenue", zero)).alias("revenue"),
            F.sum(F.coalesce("liability", zero)).alias("liability"),
            F.sum(F.coalesce("unbilled", zero)).alias("unbilled"),
            F.count(F.lit(1)).alias("n_lines"),
        )
    )
    contract = Window.partitionBy("rc_id")
    total = F.sum("alctd").over(contract)
    cat = F.upper("prod_ctgry")
    share_num = F.when(F.sum("n_lines").over(contract) == 1, F.lit(1.0)).otherwise(F.col("alctd").cast("double"))
    share = share_num / F.when(total == 0, F.lit(1.0)).otherwise(total.cast("double"))
    staged = per_category.select(
        "*", cat.alias("_cat"), share.alias("share"), F.sum("ctgry_billed").over(contract).alias("total_billed")
    ).select("*", _r2(F.col("share") * F.col("total_billed").cast("double")).alias("B"))
    license_ = F.col("_cat").isin(*LICENSE)
    positive = lambda c: F.greatest(c, zero)
    by_kind = (
        F.when(license_, positive(F.col("alctd") - F.col("revenue"))).otherwise(positive(F.col("B") - F.col("revenue")))
    )
    expected = F.when(F.col("_cat") == MARKETING, F.col("B")).otherwise(by_kind)
    before_liability = F.when(
        F.col("_cat") == MARKETING,
        _r2(F.col("share") * F.col("total_billed").cast("double") - F.col("alctd").cast("double")),
    ).otherwise(by_kind)
    expected_unbilled = (
        F.when(F.col("_cat") == MARKETING, zero)
        .when(license_, positive(F.col("alctd") - F.col("B")))
        .otherwise(positive(F.col("revenue") - F.col("B")))
    )
    m = lambda c: c.cast("decimal(18,2)")
    return staged.select(
        "rc_id",
        "prod_ctgry",
        m(F.col("total_billed")).alias("total_billed"),
        m(F.col("alctd")).alias("alctd"),
        m(F.col("revenue")).alias("revenue"),
        m(F.col("liability")).alias("liability"),
        m(F.col("B")).alias("share_of_billed"),
        m(expected).alias("expected_deferred"),
        m(before_liability - F.col("liability")).alias("net_value"),
        m(expected_unbilled).alias("expected_unbilled"),
        m(expected_unbilled - F.col("unbilled")).alias("net_unbilled"),
    )


def journal_lines(net: DataFrame, lines: DataFrame, unbilled_default: str, consistency: bool = False) -> DataFrame:
    """Debit and credit lines for every non-zero net value.

    License categories are summed per contract.  A positive net debits Unbilled and credits
    Contract Liability, a negative one the reverse.  Account strings come from the first
    line (by id) of the contract and category; a missing unbilled account falls back to
    the default. With ``consistency`` the lines are marked as ``mark_consistency`` does, from the
    same pass over the positions: the only window holds one row per category of a contract.
    """
    is_license = F.upper(F.col("prod_ctgry")).isin(*LICENSE)
    group = F.when(is_license, LICENSE[0]).otherwise(F.col("prod_ctgry")).alias("grp")
    sums = {"net": "net_value", **({"net_ub": "net_unbilled"} if consistency else {})}
    wanted = net.where("net_value <> 0").groupBy("rc_id", group).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    if consistency:
        contract = Window.partitionBy("rc_id")
        differs = F.sum("net_ub").over(contract) != F.sum("net").over(contract)
        wanted = wanted.withColumn("consistent", F.when(differs, "N"))
    source = lines.groupBy("rc_id", group).agg(
        F.min_by(F.struct("unbilled_acct", "liability_acct", "f_cur", "f_ex_rate"), "line_id").alias("a")
    )
    paired = wanted.where("net <> 0").join(source, ["rc_id", "grp"])
    # sides are plain values, so that accounts nobody asks for are neither looked up nor shuffled
    sides = paired.withColumn("side", F.explode(F.array(F.lit("DR"), F.lit("CR"))))
    on_unbilled = (F.col("net") > 0) == (F.col("side") == "DR")
    return sides.select(
        "rc_id",
        F.col("grp").alias("prod_ctgry"),
        "side",
        F.when(on_unbilled, "Unbilled").otherwise("Contract Liability").alias("activity"),
        F.when(on_unbilled, F.coalesce("a.unbilled_acct", F.lit(unbilled_default))).otherwise(F.col("a.liability_acct")).alias("account"),
        F.abs(F.col("net")).cast("decimal(18,2)").alias("amount"),
        F.col("a.f_cur").alias("curr"),
        F.round(F.abs(F.col("net")) * F.col("a.f_ex_rate"), 4).cast("decimal(18,4)").alias("func_amount"),
        *(["consistent"] if consistency else []),
    )


def mark_consistency(journal: DataFrame, positions: DataFrame) -> DataFrame:
    """Flag 'N' on the journal lines of contracts whose net unbilled differs from their net value."""
    bad = (
        positions.where("net_value <> 0")
        .groupBy("rc_id")
        .agg(F.sum("net_unbilled").alias("u"), F.sum("net_value").alias("v"))
        .where("u <> v")
        .select("rc_id", F.lit("N").alias("consistent"))
    )
    return attach(journal, bad, ["rc_id"])


def reverse_journal(schedules: DataFrame, journal_id: int, prd: int) -> DataFrame:
    """Take back an approved journal: posted rows get a negated twin, unposted rows go.

    Twins of rows up to the current period ``prd`` move to it, later ones keep their period. Where ``rel_pct`` is
    there and not zero, the twin has the percentage negated and the amount as it was.
    """
    of_journal = F.col("je_id").eqNullSafe(F.lit(journal_id))
    posted = flag_at(F.col("indicators"), 1) == "Y"
    has_share = "rel_pct" in schedules.columns
    by_share = F.coalesce(F.col("rel_pct") != 0, F.lit(False)) if has_share else F.lit(False)
    shares = {"rel_pct": -F.col("rel_pct")} if has_share else {}
    kept = schedules.where(~of_journal | posted).withColumn("is_reversal", F.lit("N"))
    twins = (
        schedules.where(of_journal & posted)
        .withColumns({"amount": F.when(by_share, F.col("amount")).otherwise(-F.col("amount")), **shares})
        .withColumn("prd_id", F.greatest("prd_id", F.lit(prd)))
        .withColumn("indicators", with_flag(F.col("indicators"), 1, "N"))
        .withColumn("is_reversal", F.lit("Y"))
    )
    return kept.unionByName(twins)


def mark_reversed(heads: DataFrame, journal_id: int) -> DataFrame:
    """Heads after a reversal: the journal's status is R, the others keep theirs."""
    status = F.when(F.col("header_id") == journal_id, "R").otherwise(F.col("status"))
    return heads.withColumn("status", status)


def purge_unapproved(heads: DataFrame, lines: DataFrame, prd: int, tag: str) -> tuple[DataFrame, DataFrame]:
    """Drop unapproved journals of a period with their lines."""
    gone = heads.where(
        (F.col("prd_id") == prd) & (F.col("tag") == tag) & F.col("status").isin("E", "V", "N", "P")
    ).select("header_id")
    return heads.join(gone, "header_id", "left_anti"), lines.join(gone, "header_id", "left_anti")


def journal_errors(lines: DataFrame, references: dict[str, DataFrame]) -> DataFrame:
    """Values of journal lines that are missing from their reference table.

    ``references`` maps a line column to a one-column frame of known values.  A missing
    class, department, location or subsidiary is an error too; debit and credit accounts
    are checked only where present.  All checks run as one anti join on (check, value).
    """
    must_exist = {"class_name", "department", "location", "subsidiary"}
    checks = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("check_name"),
                    (F.coalesce(F.col(c), F.lit("@")) if c in must_exist else F.col(c)).alias("value"),
                )
                for c in references
            ]
        )
    )
    asked = lines.select("header_id", "line_id", checks.alias("c")).select("header_id", "line_id", "c.*").where("value IS NOT NULL")
    known = None
    for c, ref in references.items():
        part = ref.select(F.lit(c).alias("check_name"), F.col(ref.columns[0]).cast("string").alias("value")).distinct()
        known = part if known is None else known.unionByName(part)
    return asked.join(known, ["check_name", "value"], "left_anti")


def journal_imbalances(lines: DataFrame) -> DataFrame:
    """Subsidiary, organisation and book whose credits and debits differ."""
    signed = F.when(F.col("cr_account").isNotNull(), F.col("amount")).when(F.col("dr_account").isNotNull(), -F.col("amount"))
    return (
        lines.groupBy("header_id", "subsidiary", "org", "book_id")
        .agg(F.sum(signed).cast("decimal(18,2)").alias("difference"))
        .where("difference <> 0")
    )


def validate_journal(lines: DataFrame, references: dict[str, DataFrame]) -> DataFrame:
    """Error rows of a journal: unknown reference values and unbalanced groups."""
    value_errors = journal_errors(lines, references).select(
        "header_id", "line_id", F.col("check_name").alias("type"), F.concat(F.lit("not in reference: "), F.replace("value", F.lit("@"), F.lit(""))).alias("description")
    )
    balance_errors = journal_imbalances(lines).select(
        "header_id",
        F.lit(None).cast("string").alias("line_id"),
        F.lit("balance").alias("type"),
        F.concat(F.lit("debit and credit differ for "), F.col("subsidiary")).alias("description"),
    )
    return value_errors.unionByName(balance_errors)


def assign_activity(lines: DataFrame, errors: DataFrame) -> DataFrame:
    """Activity types from the account ranges for lines (by id) ahead of the first faulty one.

    The check stops assigning at the first error of a journal; line order is the line id.
    """
    first_bad = errors.where("line_id IS NOT NULL").groupBy("header_id").agg(F.min("line_id").alias("_bad"))
    clean = F.col("_bad").isNull() | (F.col("line_id") < F.col("_bad"))

    def activity(col: str) -> Column:
        return F.when(clean & F.col(col).isNotNull(), account_class(number_or(F.col(col))))

    return (
        attach(lines, first_bad, ["header_id"])
        .withColumn("dr_activity", activity("dr_account"))
        .withColumn("cr_activity", activity("cr_account"))
        .drop("_bad")
    )


def batch_contracts(gl: DataFrame, limit: int) -> DataFrame:
    """Number the contracts of each batch into groups of at most ``limit`` rows.

    Contracts are taken smallest first and stay whole; one that does not fit opens the next
    group.  Ties are ordered by hash bucket and contract id.  The fold that fills groups is
    sequential, but contracts of one size behave alike: it runs over the distinct sizes up
    to the limit (at most ``limit`` entries per batch), and each contract finds its group
    from its rank among the contracts of its size.
    """
    counts = gl.groupBy("batch_id", "rc_id").agg(F.count(F.lit(1)).alias("cnt"))
    sizes = counts.groupBy("batch_id", "cnt").agg(F.count(F.lit(1)).alias("m"))
    small = sizes.where(F.col("cnt") <= limit).groupBy("batch_id").agg(
        F.array_sort(F.collect_list(F.struct("cnt", "m"))).alias("sizes")
    )
    cap = F.lit(limit).cast("bigint")
    div = lambda a, b: F.call_function("div", a, b)

    def step(acc, x):
        first_fit = div(cap - acc["fill"], x["cnt"])
        per_group = div(cap, x["cnt"])
        over = F.greatest(x["m"] - first_fit, F.lit(0).cast("bigint"))
        new_groups = div(over + per_group - 1, per_group)
        fill = F.when(over == 0, acc["fill"] + x["m"] * x["cnt"]).otherwise((over - (new_groups - 1) * per_group) * x["cnt"])
        row = F.struct(x["cnt"].alias("cnt"), acc["grp"].alias("grp0"), first_fit.alias("first_fit"), per_group.alias("per_group"))
        return F.struct(
            fill.alias("fill"), (acc["grp"] + new_groups).alias("grp"), F.concat(acc["rows"], F.array(row)).alias("rows")
        )

    zero = F.lit(0).cast("bigint")
    start = F.struct(
        zero.alias("fill"),
        F.lit(1).cast("bigint").alias("grp"),
        F.array().cast("array<struct<cnt:bigint,grp0:bigint,first_fit:bigint,per_group:bigint>>").alias("rows"),
    )
    folded = small.withColumn("f", F.aggregate("sizes", start, step))
    fit = folded.select("batch_id", F.explode("f.rows").alias("r")).select("batch_id", "r.*")
    ends = folded.select("batch_id", F.col("f.grp").alias("grp"))
    # sizes above the limit: every contract opens a group of its own, after all smaller ones
    smaller = F.sum("m").over(Window.partitionBy("batch_id").orderBy("cnt").rowsBetween(Window.unboundedPreceding, -1))
    large = (
        sizes.where(F.col("cnt") > limit)
        .withColumn("_before", F.coalesce(smaller, zero))
        .join(ends, "batch_id", "left")
        .select(
            "batch_id",
            "cnt",
            (F.coalesce(F.col("grp"), F.lit(1).cast("bigint")) + F.col("_before")).alias("grp0"),
            zero.alias("first_fit"),
            F.lit(1).cast("bigint").alias("per_group"),
        )
    )
    ranked = running_before(counts, ["batch_id"], ["cnt"], "rc_id", {"_all_before": ("sum", F.lit(1).cast("bigint"))})
    offset = sizes.withColumn(
        "_size_before",
        F.coalesce(F.sum("m").over(Window.partitionBy("batch_id").orderBy("cnt").rowsBetween(Window.unboundedPreceding, -1)), zero),
    ).select("batch_id", "cnt", "_size_before")
    spec = fit.unionByName(large).join(offset, ["batch_id", "cnt"])
    rank = F.col("_all_before") - F.col("_size_before") + 1
    group = F.when(rank <= F.col("first_fit"), F.col("grp0")).otherwise(
        F.col("grp0") + 1 + div(rank - F.col("first_fit") - 1, F.col("per_group"))
    )
    return attach(ranked, spec, ["batch_id", "cnt"], "inner").select("batch_id", "rc_id", "cnt", group.alias("group_id"))


def unique_lookup(ref: DataFrame, key: str, value: str, on: str, out: str) -> DataFrame:
    """Key (named ``on``) to value, failing on a key with several values as a scalar lookup would."""
    found = ref.groupBy(F.col(key).alias(on)).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    several = F.raise_error(F.concat(F.lit(f"several {out} values for "), F.col(on).cast("string"))).cast("string")
    return found.select(on, F.when(F.col("lo") != F.col("hi"), several).otherwise(F.col("lo").cast("string")).alias(out))


def enrich_gl(gl: DataFrame, refs: dict[str, tuple[DataFrame, str, str, str]], subsidiaries: DataFrame) -> DataFrame:
    """Add external ids to ledger rows.

    ``refs`` maps an output column to (reference, key, value, ledger column).
    ``subsidiaries`` (name, external_id, batch_id) is versioned: the latest batch of a name
    counts, compared without case.
    """
    out = gl
    for name, (ref, key, value, col) in refs.items():
        out = attach(out, unique_lookup(ref, key, value, col, name), [col])
    latest = subsidiaries.groupBy(F.upper("name").alias("_sub")).agg(F.max_by("external_id", "batch_id").alias("subsidiary_id"))
    return attach(out.withColumn("_sub", F.upper("subsidiary")), latest, ["_sub"]).drop("_sub")


def tax_reclass(
    schedules: DataFrame, lines: DataFrame, prior_heads: DataFrame, org: int, prd: int, divisor: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tax journal heads, lines and schedules for one organisation and period.

    Net revenue per line (debit/credit flags LR or UR) divided by the rate and rounded to
    whole units; one head per functional currency.  Nothing comes out when a head of the
    period exists already.
    """
    revenue = (
        schedules.where((F.col("prd_id") == prd) & flag_at(F.col("indicators"), 2, 2).isin("LR", "UR"))
        .groupBy(F.col("root_line_id").alias("line_id"))
        .agg(F.sum("amount").alias("rev"))
        .where("rev <> 0")
    )
    done = F.broadcast(prior_heads.where(F.col("prd_id") == prd).select("prd_id").limit(1))
    units = F.col("rev").cast("decimal(28,2)") * 100
    whole = F.call_function("div", F.abs(units).cast("bigint") * 2 + 100 * divisor, F.lit(200 * divisor).cast("bigint"))
    amount = F.abs(whole).cast("decimal(18,2)")
    out = (
        lines.where(F.col("org") == org)
        .join(revenue, "line_id")
        .withColumn("prd_id", F.lit(prd))
        .join(done, "prd_id", "left_anti")
        .select("line_id", "rc_id", "curr", "prd_id", "rev", amount.alias("amount"), F.round(amount * F.col("f_ex_rate"), 2).cast("decimal(18,2)").alias("func_amount"))
    )
    heads = out.groupBy(F.col("curr").alias("fn_cur"), "prd_id").agg(F.count(F.lit(1)).alias("n_lines"))
    named = heads.select(F.concat_ws("_", F.lit("TAX"), "fn_cur", "prd_id").alias("head"), "fn_cur", "prd_id", "n_lines")
    je_lines = out.select(F.concat_ws("_", F.lit("TAX"), "curr", "prd_id").alias("head"), "line_id", "rc_id", "amount", "func_amount")
    schd = out.select("line_id", "rc_id", "prd_id", F.col("amount"), F.lit("Y").alias("interfaced"), F.lit("Y").alias("initial_reporting"))
    return named, je_lines, schd


def mark_interfaced(schedules: DataFrame, journals: DataFrame) -> DataFrame:
    """Set the interfaced flag on the schedules of the given journals.

    Entries of no journal, which may be most of them, stay out of the join: as one hot key they would be shuffled for nothing.
    """
    hit = journals.select("je_id").distinct().withColumn("_hit", F.lit(True))
    flag = F.when(F.col("_hit"), with_flag(F.col("indicators"), 1, "Y")).otherwise(F.col("indicators"))
    marked = attach(schedules.where("je_id IS NOT NULL"), hit, ["je_id"]).withColumn("indicators", flag).drop("_hit")
    return schedules.where("je_id IS NULL").unionByName(marked)


def stage_flags(stage: DataFrame) -> DataFrame:
    """Default flags of staged lines: split flag, eligibility, bundle id, premium, zeroed service price."""
    cat = F.upper(F.trim("prod_ctgry"))
    split = F.when(F.coalesce("split_flag", F.lit("X")) == "Y", "Y").otherwise("N")
    own = F.coalesce("bundle_id", "so_line_id")
    staged = stage.withColumns(
        {
            "split_flag": split,
            "eligible": F.when((F.col("event_required") == "Y") & (F.col("upfront_billing") == "N"), "N").otherwise(F.col("eligible")),
            "bundle_id": F.when(
                ((F.coalesce("no_bundle", F.lit("N")) == "N") & (split == "Y") & (cat == "LICENSE - TERM"))
                | ((F.coalesce("offering", F.lit("N")) == "Y") & cat.isin("LICENSE - TERM", "SUBSCRIPTION")),
                own,
            ).otherwise(F.col("bundle_id")),
        }
    )
    # one row per bundle with what its lines ask for, attached as a lookup
    asks = staged.where((F.col("type") == "SO") & F.col("bundle_id").isNotNull()).groupBy("bundle_id", "so_num").agg(
        F.max(F.when((F.col("split_flag") == "Y") & (F.col("premium") == "Y"), 1).otherwise(0)).alias("_premium"),
        F.max(
            F.when((F.col("so_line_id") == F.col("bundle_id")) & (F.col("offering") == "Y") & F.col("list_price").isNotNull(), 1).otherwise(0)
        ).alias("_parent"),
    )
    premium = asks.groupBy("bundle_id").agg(F.max("_premium").alias("_premium"))
    parent = asks.select("bundle_id", "so_num", "_parent")
    is_so = F.col("type") == "SO"
    service_child = (
        is_so
        & (F.col("so_line_id") != F.col("bundle_id"))
        & (F.col("offering") == "Y")
        & (F.upper("prod_ctgry").contains("SERVICES") | F.upper("prod_ctgry").contains("TRAINING"))
        & F.col("list_price").isNotNull()
        & (F.col("_parent") == 1)
    )
    return (
        attach(attach(staged, premium, ["bundle_id"]), parent, ["bundle_id", "so_num"])
        .withColumn("premium", F.when(is_so & (F.col("_premium") == 1) & (F.col("prod_ctgry") == "License - Term"), "Y").otherwise(F.col("premium")))
        .withColumn("list_price", F.when(service_child, F.lit(0).cast("decimal(18,2)")).otherwise(F.col("list_price")))
        .drop("_premium", "_parent")
    )


def map_rebill(stage: DataFrame, lines: DataFrame) -> DataFrame:
    """Point rebilled invoices at the original order line and check the open amount.

    An unprocessed invoice with the rebill flag is matched by original order number and two
    attributes: one posted order line if exactly one matches, else one staged order line
    when no posted line exists.  The old numbers are kept; an invoice above the open amount
    of its line is marked REBILL_CHECK.
    """
    match = ["orig_so", "attr_a", "attr_b"]

    def candidates(df: DataFrame, num: str, line: str, tag: str) -> DataFrame:
        return df.where("type = 'SO'").groupBy(F.col(num).alias("orig_so"), "attr_a", "attr_b").agg(
            F.count(F.lit(1)).alias(f"{tag}_n"), F.min(line).alias(f"{tag}_line")
        )

    posted = candidates(lines, "doc_num", "doc_line_id", "posted")
    staged = candidates(stage, "so_num", "so_line_id", "staged")
    rebill = (F.col("type") == "INV") & (F.coalesce("rebill_flag", F.lit("N")) == "Y") & (F.coalesce("processed", F.lit("N")) == "N")
    found = F.when(
        rebill,
        F.when(F.col("posted_n") == 1, F.col("posted_line")).when(
            F.col("posted_n").isNull() & (F.col("staged_n") == 1), F.col("staged_line")
        ),
    )
    mapped = attach(attach(stage, posted, match), staged, match).withColumn("_line", found)
    hit = F.col("_line").isNotNull()
    mapped = mapped.select(
        *[c for c in stage.columns if c not in ("so_num", "so_line_id")],
        F.when(hit, F.col("so_num")).alias("old_so_num"),
        F.when(hit, F.col("so_line_id")).alias("old_so_line_id"),
        F.when(hit, F.col("orig_so")).otherwise(F.col("so_num")).alias("so_num"),
        F.coalesce(F.col("_line"), F.col("so_line_id")).alias("so_line_id"),
    )
    open_amt = lines.groupBy(F.col("doc_num").alias("so_num"), F.col("doc_line_id").alias("so_line_id")).agg(
        F.sum(F.col("ext_sll_prc") - F.col("billed")).alias("_open")
    )
    return attach(mapped, open_amt, ["so_num", "so_line_id"]).withColumn(
        "check_flag",
        F.when(rebill & (F.col("_open") < F.col("inv_price")), "REBILL_CHECK"),
    ).drop("_open")


def rebill_release(lines: DataFrame, actions: DataFrame) -> DataFrame:
    """Release percentage of rebilled project lines.

    Per original order and project: the largest signed processed share of a performance
    obligation or the percentage already released, whichever is greater; only values above
    0 and up to 100 count, for lines without a release.
    """
    signed = F.when(F.col("action") == "R", F.col("prcssd_amt")).when(F.col("action") == "D", -F.col("prcssd_amt"))
    priced = lines.where("ext_sll_prc <> 0").select("pob_id", "project", "doc_num", "rel_pct", "ext_sll_prc")
    # amounts are summed per obligation before the join, so a busy obligation stays one row
    processed = actions.groupBy("pob_id").agg(F.sum(signed).alias("amt"))
    per_pob = priced.join(processed, "pob_id").groupBy("doc_num", "project", "pob_id", "rel_pct").agg(
        F.sum((F.col("amt").cast("double") / F.col("ext_sll_prc").cast("double")) * 100).alias("pct")
    )
    release = per_pob.groupBy(F.col("doc_num").alias("orig_doc"), "project").agg(
        F.round(
            F.greatest(F.coalesce(F.max("pct"), F.lit(0.0)), F.coalesce(F.max(F.col("rel_pct").cast("double")), F.lit(0.0))).cast("decimal(28,8)"), 0
        ).cast("int").alias("release_pct")
    )
    todo = lines.where(
        (F.col("type") == "SO")
        & (F.coalesce("released", F.lit("N")) == "N")
        & F.col("orig_doc").isNotNull()
        & (F.col("orig_doc") != F.col("doc_num"))
        & F.col("project").isNotNull()
        & (F.coalesce("rel_pct", F.lit(0)) == 0)
    )
    return attach(todo, release, ["orig_doc", "project"], "inner").where("release_pct > 0 AND release_pct <= 100").select(
        "line_id", "pob_id", "orig_doc", "project", "release_pct"
    )
