"""Contract-model views over the order, line and part tables.

Every view takes the columns a job needs and joins only the tables behind them: an inner
join is not removed by the optimizer just because its columns are unused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recogna.functions.scalars import period_of

OPEN_PRD = 199906
AS_OF = "1999-06-15"


#: What names a line of frames that are dealt by contract.
BY_LINE = ("rc_id", "line_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dec(c: Column, digits: int = 2, width: int = 18) -> Column:
    return c.cast(f"decimal({width},{digits})")


def _line_id(order: Column) -> Column:
    return F.concat_ws("-", order, "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int"))


def _line_columns() -> dict[str, tuple[set[str], Column]]:
    price = _dec(F.col("l_extendedprice"))
    factor = (F.lit(1) + _dec(F.col("l_tax"), 2, 3) - _dec(F.col("l_discount"), 2, 3)).cast("decimal(4,2)")
    alctd = F.round(price * factor, 2).cast("decimal(18,2)")
    billed = F.col("l_linestatus") == "F"
    order_day = F.to_date("o_orderdate")
    span = F.abs(F.datediff(F.to_date("l_shipdate"), order_day)) % 336 + 29
    even = F.col("p_size") % 2 == 0
    category = (
        F.when(F.col("p_type") == "ECONOMY", "License - Term")
        .when(F.col("p_type") == "STANDARD", "License - Perpetual")
        .when(F.col("p_type") == "SMALL", "Maintenance - New")
        .when(F.col("p_type") == "MEDIUM", "Professional Services")
        .when(F.col("p_type") == "LARGE", F.when(even, "Subscription").otherwise("Content Subscription"))
        .otherwise(F.when(even, "Marketing").otherwise("Training"))
    )
    action = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "UPGRADE")
        .when(F.col("o_orderpriority") == "2-HIGH", "DOWNGRADE")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "NEW")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "RENEWAL")
        .otherwise("ADD-ON")
    )
    none: set[str] = set()
    order, customer, nation, part = {"orders"}, {"orders", "customer"}, {"orders", "customer", "nation"}, {"part"}
    return {
        "rc_id": (none, F.col("l_orderkey") + 2),
        "line_id": (none, _line_id(F.col("l_orderkey"))),
        "line_num": (none, F.col("l_linenumber")),
        "part_key": (none, F.col("l_partkey")),
        "supp_key": (none, F.col("l_suppkey")),
        "item_num": (none, F.concat(F.lit("ITEM-"), F.col("l_partkey"))),
        "ord_qty": (none, _dec(F.col("l_quantity"))),
        "ext_sll_prc": (none, price),
        "alctbl_xt_prc": (none, price),
        "alctd_xt_prc": (none, alctd),
        "cv_amt": (none, (alctd - price).cast("decimal(18,2)")),
        "bld_def_amt": (none, F.when(billed, F.round(price * F.lit("0.4").cast("decimal(2,1)"), 2)).otherwise(0).cast("decimal(18,2)")),
        "bld_rec_amt": (none, F.when(billed, F.round(price * F.lit("0.5").cast("decimal(2,1)"), 2)).otherwise(0).cast("decimal(18,2)")),
        "eligible": (none, F.when(F.col("l_returnflag") == "R", "N").otherwise("Y")),
        "in_range": (none, F.when(_dec(F.col("l_discount"), 2, 3) <= F.lit("0.05").cast("decimal(3,2)"), "Y").otherwise("N")),
        "bill_pending": (none, F.when(F.col("l_returnflag") == "A", "Y").otherwise("N")),
        "line_status": (none, F.col("l_linestatus")),
        "return_flag": (none, F.col("l_returnflag")),
        "discount_pct": (none, F.round(F.col("l_discount") * 100).cast("int")),
        "is_parent": (none, F.col("l_linenumber") == 1),
        "ship_date": (none, F.to_date("l_shipdate")),
        "doc_date": (order, order_day),
        "start_date": (order, order_day),
        "end_date": (order, F.date_add(order_day, span)),
        "batch_id": (order, F.year("o_orderdate")),
        "contract_num": (order, F.col("o_custkey")),
        "mod_doc": (order, F.concat_ws("-", F.col("o_custkey"), F.year("o_orderdate"))),
        "sales_action": (order, action),
        "treatment": (order, F.when(F.col("o_orderstatus") == "F", "R").otherwise("P")),
        "order_status": (order, F.col("o_orderstatus")),
        "org": (nation, F.col("n_regionkey")),
        "nation_key": (customer, F.col("c_nationkey")),
        "curr": (customer, F.concat(F.lit("C"), F.col("c_nationkey"))),
        "f_ex_rate": (customer, (F.lit(1) + _dec(F.col("c_nationkey") / 100, 2, 4)).cast("decimal(6,2)")),
        "g_ex_rate": (nation, (F.lit(1) + _dec(F.col("n_regionkey") / 10, 1, 3)).cast("decimal(6,1)")),
        "prod_ctgry": (part, category),
        "prod_fmly": (part, F.col("p_brand")),
        "unit_ssp": (part, _dec(F.col("p_retailprice"))),
        "term": (part, F.col("p_size") % 12 + 1),
    }


def lines(spark: SparkSession, sf_dir: str, *columns: str, dealt: str | None = None) -> DataFrame:
    """Order lines as contract lines; one contract per order.

    Orders meet their customers before the lines, of which there are several times as many. Lines ``dealt`` by "line_id" lie
    together by it while they are narrow, and so does what is made of them, without another shuffle. Those dealt by "rc_id" stay
    where they met their order, without a shuffle of their own: a line is of one contract, so what is grouped or joined by ``BY_LINE`` needs none either.
    A hot contract's lines are split there by adaptive execution, which then deals them by line.
    """
    spec, none = _line_columns(), set()
    needed = set().union(*(spec[c][0] for c in columns))
    if dealt == "rc_id" and not ("rc_id" in columns and "orders" in needed):
        raise ValueError("lines are dealt by the contract where they meet their order")
    df = table(spark, sf_dir, "lineitem")
    if "orders" in needed:
        orders = table(spark, sf_dir, "orders")
        if "customer" in needed:
            orders = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        if "nation" in needed:
            orders = orders.join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
        if dealt == "rc_id":  # hinted, so that the shuffle comes while lines are narrow, however small the orders are
            orders = orders.withColumn("rc_id", F.col("o_orderkey") + 2).hint("merge")
            df = df.withColumn("rc_id", F.col("l_orderkey") + 2).join(orders, "rc_id")
            spec |= {"rc_id": (none, F.col("rc_id")), "line_id": (none, _line_id(F.col("rc_id") - 2))}  # one key is shuffled
        else:
            df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if "part" in needed:
        df = df.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    df = df.select(*[spec[c][1].alias(c) for c in columns])
    return df.repartition("line_id") if dealt == "line_id" else df


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract headers: one per order."""
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + 2).alias("rc_id"),
        F.lit(1).alias("book_id"),
        F.lit(1).alias("obj_version"),
        F.when(F.col("o_orderstatus") == "F", "R").otherwise("P").alias("treatment"),
        F.when(F.col("o_orderkey") % 2 == 0, "Y").otherwise("N").alias("posted"),
        F.year("o_orderdate").alias("batch_id"),
        period_of(day).alias("crtd_prd_id"),
        F.date_add(day, 30).alias("init_pob_exp_dt"),
        F.date_add(day, 365).alias("ct_mod_end_dt"),
        F.col("o_custkey").alias("contract_num"),
        day.alias("doc_date"),
    )


def bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices: one per order; four of five name an earlier invoice as their original."""
    day = F.to_date("o_orderdate")
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        (key + 2).alias("rc_id"),
        F.concat(F.lit("I"), key).alias("doc_num"),
        F.when((key % 5 != 0) & (key > 1), F.concat(F.lit("I"), F.expr("o_orderkey div 2"))).alias("orig_doc_num"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "UPGRADE")
        .when(F.col("o_orderpriority") == "2-HIGH", "DOWNGRADE")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "NEW")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "RENEWAL")
        .otherwise("ADD-ON").alias("sales_action"),
        F.when(key % 3 == 0, "N").otherwise("Y").alias("mod_flag"),
        F.lit("INV").alias("type"),
        day.alias("doc_date"),
        day.alias("start_date"),
        F.date_add(day, (key % 1500 + 300).cast("int")).alias("end_date"),
        F.year("o_orderdate").alias("batch_id"),
    )


def account_types(spark: SparkSession) -> DataFrame:
    # fixed values: account type id, name, group, class, profit/loss, variable, clearing, cost, netting, payables
    return spark.sql(
        """SELECT * FROM VALUES
        ('R','Revenue','REV','REC','Y','N','N','N','N','N'),
        ('X','Adjustment Revenue','EREV','EREC','Y','N','N','N','N','N'),
        ('L','Contract Liability','DREV','DEF','N','N','N','N','Y','N'),
        ('A','Adjustment Liability','EDREV','EDEF','N','Y','Y','N','Y','N'),
        ('U','Unbilled','UNBILL','UBL','N','N','N','N','N','N'),
        ('T','Contra','CONTRA','CTR','N','N','N','N','N','N'),
        ('B','Billing','AR','ARC','N','N','N','N','N','Y')
        AS t(acct_type_id, acct_name, acct_group, def_rec_flag, pl_flag, vc_flag, vc_clr_flag,
             cost_flag, incl_netting_flag, payables_acct_flag)"""
    )


def schedules(spark: SparkSession, sf_dir: str, *extra: str, dealt: str | None = None) -> DataFrame:
    """Accounting entries of a line: billing, revenue at start and adjustment at end.

    Adjustments of returned lines are posted a month after their period, the others in it.
    ``indicators`` positions: 1 interfaced, 2 debit type, 3 credit type, 4 unbilled,
    5 initial entry, 10 schedule type.
    """
    cols = ["rc_id", "line_id", "line_num", "ext_sll_prc", "alctd_xt_prc", "cv_amt", "line_status",
            "return_flag", "start_date", "end_date", *extra]
    src = lines(spark, sf_dir, *dict.fromkeys(cols), dealt=dealt)
    share = F.lit("0.6").cast("decimal(2,1)")
    interfaced = F.when(F.col("return_flag") == "N", "Y").otherwise("N")
    unbilled = F.when(F.col("line_status") == "O", "Y").otherwise("N")
    initial = F.when(F.col("line_num") == 1, "Y").otherwise("N")

    def entry(no, prd, amount, kind, dr, cr, unbilled_flag, initial_flag, post=None):
        return F.struct(
            F.lit(no).alias("seq"),
            prd.alias("prd_id"),
            (prd if post is None else post).alias("post_prd_id"),
            amount.cast("decimal(18,2)").alias("amount"),
            F.lit(dr).alias("dr_acct"),
            F.lit(cr).alias("cr_acct"),
            F.lit(kind).alias("schd_type"),
            F.concat(interfaced, F.lit(dr), F.lit(cr), unbilled_flag, initial_flag, F.lit("NNNN"), F.lit(kind), F.lit("N" * 30)).alias("indicators"),
        )

    first, last = period_of(F.col("start_date")), period_of(F.col("end_date"))
    entries = F.array(
        entry(1, first, F.when(F.col("line_status") == "F", F.col("ext_sll_prc")).otherwise(0), "B", "B", "L", F.lit("N"), F.lit("N")),
        entry(2, first, F.round(F.col("alctd_xt_prc") * share, 2), "R", "L", "R", unbilled, initial),
        entry(3, last, F.col("cv_amt"), "A", "A", "X", F.lit("N"), F.lit("N"), F.when(F.col("return_flag") == "R", period_of(F.add_months("end_date", 1))).otherwise(last)),
    )
    return src.withColumn("e", F.explode(entries)).select(
        "rc_id", "line_id", F.col("line_id").alias("root_line_id"), "e.*", *extra
    )


# base amounts of an account summary row; each exists per currency
SUMMARY_AMOUNTS = (
    "at", "ps", "un", "bb", "ad", "rl", "eb", "nt", "nt_rl", "rt_ar", "ca_im",
    "at_qt", "rt_ar_qt", "bb_qt", "ad_qt", "rl_qt", "ca_im_qt",
    "at_yt", "rt_ar_yt", "bb_yt", "ad_yt", "rl_yt", "ca_im_yt",
    "at_ut", "bb_ut", "ad_ut", "rl_ut", "ca_im_ut",
)


def summary_amounts() -> dict[str, Column]:
    """The amounts of an account summary row, from its line's price and rates."""
    price, f, g = F.col("ext_sll_prc"), F.col("f_ex_rate"), F.col("g_ex_rate")
    amounts = {}
    for i, name in enumerate(SUMMARY_AMOUNTS):
        t = F.round(price * F.lit(f"{i + 1}").cast("decimal(3,0)") * F.lit("0.01").cast("decimal(3,2)"), 2).cast("decimal(18,2)")
        amounts |= {f"t_{name}": t, f"f_{name}": F.round(t * f, 2).cast("decimal(18,2)"), f"r_{name}": F.round(t * f * g, 2).cast("decimal(18,2)")}
    return amounts


def account_summary_rows(spark: SparkSession, sf_dir: str, dealt: str | None = "rc_id", narrow: bool = False) -> DataFrame:
    """Account-period summary: one account type per line, valid for one to three periods. ``narrow`` rows have price and
    rates in place of the amounts, which ``summary_amounts`` makes of them later."""
    src = lines(spark, sf_dir, "rc_id", "line_id", "line_num", "supp_key", "start_date", "ext_sll_prc", "f_ex_rate", "g_ex_rate", "discount_pct", dealt=dealt)
    kinds = F.array(*[F.lit(k) for k in ("R", "X", "L", "A", "U", "T", "B")])
    amounts = ["ext_sll_prc", "f_ex_rate", "g_ex_rate"] if narrow else [c.alias(name) for name, c in summary_amounts().items()]
    start = F.col("start_date")
    return src.select(
        "rc_id", "line_id", F.col("line_id").alias("root_line_id"), F.lit(1).alias("book_id"),
        F.get(kinds, F.pmod(F.col("line_num") + F.col("supp_key"), F.lit(7)).cast("int")).alias("acct_type_id"),
        F.concat(F.lit("SEG-"), F.col("supp_key") % 3).alias("acct_segs"),
        F.when(F.col("discount_pct") == 9, "M").when(F.col("discount_pct") == 10, "D").otherwise("S").alias("schd_type"),
        period_of(start).alias("prd_id"),
        F.last_day(start).alias("valid_from"),
        F.last_day(F.add_months(start, F.pmod(F.col("line_num"), F.lit(3)).cast("int"))).alias("valid_until"),
        F.last_day(F.add_months(F.to_date(F.date_trunc("quarter", start)), 2)).alias("pd_qt_ed_dt"),
        F.make_date(F.year(start), F.lit(12), F.lit(31)).alias("pd_yr_ed_dt"),
        *amounts,
    )
