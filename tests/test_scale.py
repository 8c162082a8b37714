"""Properties that keep the jobs usable on skewed and large data."""

import random

import pytest
from pyspark.sql import functions as F

from recogna.functions.skew import attach, bucket, running_before
from recogna.plans import catalog

SF_DIR = "/root/testdata/sf0.001"
WRITES_OR_LOOPS = {"error_log", "period_reload", "period_snapshot", "prior_period_table", "work_table_refill"}


def test_running_values_match_brute_force(spark):
    rnd = random.Random(7)
    # one group holds most rows and one day holds most of that group
    rows = [(0 if i % 3 else i % 5, 1 if i % 4 else rnd.randint(1, 9), rnd.randint(1, 3), f"r{i}", rnd.randint(1, 50)) for i in range(900)]
    df = spark.createDataFrame(rows, "g int, a int, b int, id string, q int")
    got = running_before(df, ["g"], ["a", "b"], "id", {"s": ("sum", F.col("q")), "m": ("max", F.col("q"))})
    buckets = {r["id"]: r["x"] for r in df.select("id", bucket("id").alias("x")).collect()}
    order = {r["id"]: (r["s"], r["m"]) for r in got.collect()}
    seen: dict[int, list[int]] = {}
    for g, _, _, id_, q in sorted(rows, key=lambda r: (r[0], r[1], r[2], buckets[r[3]], r[3])):
        before = seen.setdefault(g, [])
        assert order[id_] == (sum(before), max(before) if before else None)
        before.append(q)


def test_hot_key_is_split(spark):
    """A third of the rows under one key: the adaptive join splits that partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.shuffle.partitions": "40",
    }
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 300000, 1, 16).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000).alias("rc_id"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad")
        )
        totals = rows.groupBy("rc_id").agg(F.sum("v").alias("total"))
        out = attach(rows, totals, ["rc_id"])
        assert out.count() == 300000
        largest = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        executed = out._jdf.queryExecution().executedPlan()
        out.collect()
        assert "skew=true" in executed.toString()
        assert largest < 50000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - WRITES_OR_LOOPS))
def test_no_python_and_no_cartesian_plan(spark, name):
    """Jobs stay on JVM operators and never pair rows of two large inputs."""
    df = catalog.QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert python_node not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = catalog.QUERIES["pending_contracts"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "l_partkey" not in plan


def test_recognition_needs_no_shuffle_behind_the_scan(spark):
    plan = catalog.QUERIES["revenue_schedules"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "HashAggregate" not in plan and "hashpartitioning" not in plan
