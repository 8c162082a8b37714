"""Writers: change sets, period snapshots and reloads."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def apply_changes(base: DataFrame, changes: DataFrame, keys: Sequence[str], marker: str = "change") -> DataFrame:
    """Base after a change set: I inserts, U replaces, D deletes, other markers leave a row alone."""
    touched = changes.where(F.col(marker).isin("U", "D")).select(*keys)
    # an update of a row that is not there changes nothing
    updated = changes.where(F.col(marker) == "U").join(base.select(*keys), list(keys), "left_semi")
    inserted = changes.where(F.col(marker) == "I")
    return (
        base.join(touched, list(keys), "left_anti")
        .unionByName(updated.select(*base.columns))
        .unionByName(inserted.select(*base.columns))
    )


def _stored(spark: SparkSession, folder: str) -> bool:
    """Whether something was stored there, rows or none; other read errors are not taken for an empty place."""
    try:
        spark.read.parquet(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def write_snapshot(df: DataFrame, path: str, run_prd: int, open_prd: int, org: str | None = None) -> bool:
    """Store a period snapshot; returns whether it was written.

    A closed period that has a snapshot stays frozen, also an empty one; the open period is rebuilt, to
    nothing if ``df`` has no rows; a future period is refused.
    """
    if run_prd > open_prd:
        raise ValueError("a snapshot cannot be taken for a future period")
    folder = f"{path}/snapshot_prd_id={run_prd}" + (f"/org={quote(org, safe='')}" if org is not None else "")
    if run_prd < open_prd and _stored(df.sparkSession, folder):
        return False
    df.write.mode("overwrite").parquet(folder)
    return True


def reload_period(df: DataFrame, path: str, period: str = "prd_id", periods: Sequence[int] | None = None) -> None:
    """Replace the named periods by what ``df`` has of them, which may be nothing; other periods stay.

    Without names the periods present in ``df`` are replaced.
    """
    if periods is None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period).parquet(path)
        return
    for one in periods:
        df.where(F.col(period) == one).drop(period).write.mode("overwrite").parquet(f"{path}/{period}={one}")


def materialise(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Store a query result as a table, replacing an earlier one; ``path`` keeps its files outside the warehouse."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def refill(df: DataFrame, path: str) -> None:
    """Empty a work table and fill it again."""
    df.write.mode("overwrite").parquet(path)


def append_errors(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
