"""Shuffles stay narrow and partitions grow in number with the input."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from recogna.operators import waterfall as W
from recogna.plans import catalog
from recogna.session import LINES_PER_PARTITION, tune
from recogna.sources.fiscal import FiscalCalendar

SF_DIR = "/root/testdata/sf0.001"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def plan_of(spark, name: str) -> str:
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables beyond it
    try:
        return catalog.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partitions_grow_in_number(spark):
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tune(spark, 5 * own * LINES_PER_PARTITION)
    assert int(spark.conf.get(INITIAL)) == 5 * own
    tune(spark)
    assert spark.conf.get(INITIAL, None) in (None, str(own))


@pytest.mark.parametrize("name", ["order_on_hand", "waterfall_snapshot"])
def test_lines_are_dealt_before_they_become_several_rows(spark, name):
    shuffles = [x for x in plan_of(spark, name).split("\n") if re.search(r"Exchange hashpartitioning\((line_id|prd_id)", x)]
    assert shuffles and all("REPARTITION_BY_COL" in x for x in shuffles)


@pytest.mark.parametrize("name", ["line_account_summary", "line_account_measures"])
def test_wide_account_rows_are_not_shuffled(spark, name):
    assert "hashpartitioning(root_line_id" not in plan_of(spark, name)


def test_account_sums_meet_lines_that_have_their_headers(spark):
    joins = [x for x in plan_of(spark, "revenue_insight").split("\n") if "SortMergeJoin" in x or "ShuffledHashJoin" in x]
    assert "root_line_id" in joins[0]


def test_cells_without_a_shown_key_leave_a_row_of_zeros(spark):
    snap = spark.createDataFrame([("a", "NO", 202401, 5), ("a", "NO", 202402, 7), ("a", "NO", 202402, 1), ("b", "NO", 203001, 9), ("c", "REV", None, 3)], "line_id string, rev_type string, prd_id int, amount int")
    snap = snap.withColumn("amount", F.col("amount").cast("decimal(28,2)"))
    rates = spark.createDataFrame([(x, 1, 1) for x in "abc"], "line_id string, f_ex_rate int, g_ex_rate int")
    gate = spark.createDataFrame([(1, 202402, None)], "org int, prd_id int, reason string")
    got = W.monthly(snap, gate, rates, FiscalCalendar.months(202401, 203012), 202402, 202403)
    assert sorted((r["line_id"], int(r["prior_amt"]), int(r["p202402"]), int(r["p202403"])) for r in got.collect()) == [("a", 5, 8, 0), ("b", 0, 0, 0), ("c", 0, 0, 0)]
