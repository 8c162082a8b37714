"""Session settings used by the bench and the tests; a cluster brings its own session."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str, cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


#: Lines that a shuffle partition holds at most, on average, and its size: a row of a few bytes becomes hundreds of amounts.
LINES_PER_PARTITION, PARTITION_SIZE = 100_000, "4MB"


def tune(spark: SparkSession, lines: int = 0, line_joins: bool = False) -> None:
    """Runtime settings the jobs count on: adaptive plans that split hot join partitions, and partitions that grow in
    number, not in size, with the ``lines`` of the input, so that what a task sorts or sums fits its memory.

    With ``line_joins`` frames dealt by line join on line and more without another shuffle; otherwise totals get one, which
    the splitting of hot partitions needs (``skew.attach``).

    Joining totals back to lines is often followed by another grouping on the same key;
    ``forceOptimizeSkewedJoin`` lets Spark split the hot partition there as well.
    """
    first, initial = -(-lines // LINES_PER_PARTITION), "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if first > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(initial, str(first))
    else:
        spark.conf.unset(initial)
    for key, value in {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": PARTITION_SIZE,
        "spark.sql.requireAllClusterKeysForCoPartition": str(not line_joins).lower(),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # hash instead of sort where every partition of the build side is known to be small
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    }.items():
        spark.conf.set(key, value)


def cut(df: DataFrame) -> DataFrame:
    """Materialise a frame several branches read, in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def keep_dealt(df: DataFrame, key: str) -> DataFrame:
    """Keep distinct rows dealt and sorted by ``key``, so that the joins of many rounds neither shuffle nor sort them again.

    Planned without adaptive execution: what is kept of an adaptive plan doesn't tell how its rows are dealt. Lost parts
    are made again from the input; the caller unpersists the frame when its rounds are over.
    """
    spark = df.sparkSession
    own, adaptive = int(spark.conf.get("spark.sql.shuffle.partitions")), spark.conf.get("spark.sql.adaptive.enabled")
    first = int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or own)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # a contract has several lines, by whose number the first partitions are reckoned
        return df.repartition(max(own, first // 4), key).distinct().sortWithinPartitions(key).persist()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative jobs cut lineage with ``checkpoint()``.

    The cluster names a shared folder in ``spark.checkpoint.dir``; only a local
    session without that setting gets a temporary folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="recogna-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
