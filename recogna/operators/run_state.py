"""What a recurring job remembers between its runs: a log of runs and the value each line had when last processed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recogna.sources.readers import stored_or_none

#: Runs whose values are merged into one table again.
MERGE_AFTER = 16

_LOG = "run long, base long, program string, requested_at timestamp, status string"
_VALUES = "line_id string, rc_id long, value decimal(18,2)"


class RunState:
    """State of one program below a folder that all executors reach.

    ``log/run=N`` has a row for each run that ended; ``values/run=N`` has only what that run processed, so a run
    writes in proportion to its work. A run counts once its log row is there, which is written last: what a failed run
    left behind is never read, and the next run replaces it. ``base`` is the run from which on values are read; a merge
    writes all current values and becomes the new base.
    """

    def __init__(self, spark: SparkSession, path: str, program: str) -> None:
        self.spark, self.path, self.program = spark, f"{path}/{program}", program

    def log(self) -> DataFrame:
        rows = stored_or_none(self.spark, f"{self.path}/log", _LOG)
        return self.spark.createDataFrame([], _LOG) if rows is None else rows.where(F.col("program") == self.program)

    def mark(self) -> DataFrame:
        """One row, ``mark``: when the last completed run was requested; null before the first."""
        return self.log().where("status = 'C'").agg(F.max("requested_at").alias("mark"))

    def processed(self) -> DataFrame:
        """Latest contract and value of every line processed so far."""
        rows = stored_or_none(self.spark, f"{self.path}/values", f"{_VALUES}, run long")
        if rows is None:
            return self.spark.createDataFrame([], _VALUES)
        done = self.log().where("status = 'C'")
        newest_base = done.agg(F.max("base").alias("base"))
        counted = done.select("run").join(F.broadcast(newest_base), F.col("run") >= F.col("base"))  # MERGE_AFTER rows at most
        latest = F.max_by(F.struct("rc_id", "value"), "run").alias("last")
        return rows.join(F.broadcast(counted.select("run")), "run", "left_semi").groupBy("line_id").agg(latest).select("line_id", "last.*")

    def due(self, lines: DataFrame) -> DataFrame:
        """The ``lines`` (line_id, rc_id, value, updated_at) that a run has to process, with the ``reason``.

        CHANGED: the value differs from the one last processed, an unset one counting as -999. MOVED: changed since the last
        completed run was requested, and in another contract than when processed; contract 0 doesn't count.
        A moved line counts as never processed, so without a value it stays out.
        """
        unset = F.lit(-999).cast("decimal(18,2)")
        if stored_or_none(self.spark, f"{self.path}/values", f"{_VALUES}, run long") is None:
            known = lines.select("*", F.lit(None).cast("long").alias("_rc"), F.lit(None).cast("decimal(18,2)").alias("_value"))  # the first run shuffles nothing
        else:
            last = self.processed().select("line_id", F.col("rc_id").alias("_rc"), F.col("value").alias("_value"))
            known = lines.join(last, "line_id", "left")
        rows = known.join(F.broadcast(self.mark()), F.lit(True))
        value, before = F.coalesce("value", unset), F.coalesce("_value", unset)
        moved = (F.to_date("updated_at") >= F.to_date("mark")) & (F.col("rc_id") != F.col("_rc")) & (F.col("rc_id") != 0) & (value != unset)
        reason = F.when(moved, "MOVED").when(value != before, "CHANGED")
        return rows.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(*lines.columns, "reason")

    def advance(self, done: DataFrame, requested_at: datetime, status: str = "C") -> int:
        """Remember the lines a run processed, and then that it ended; returns its number.

        ``done`` is what ``due`` gave, stored by the caller if it is dear: it is read once here. Any other status than C
        leaves values and mark as they are.
        """
        at = self.log().agg(F.max("run").alias("run"), F.max("base").alias("base")).first()
        run, base = (at["run"] or 0) + 1, at["base"] or 1
        if status == "C":
            self._put(done.select("line_id", F.col("rc_id").cast("long"), F.col("value").cast("decimal(18,2)")), "values", run)
        self._end(run, base, requested_at, status)
        if status == "C" and run - base >= MERGE_AFTER:
            merged = run + 1
            self._put(self.processed(), "values", merged)
            self._end(merged, merged, requested_at, "C")
            return merged
        return run

    def _put(self, rows: DataFrame, what: str, run: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{what}/run={run}")

    def _end(self, run: int, base: int, requested_at: datetime, status: str) -> None:
        row = self.spark.createDataFrame([(base, self.program, requested_at, status)], "base long, program string, requested_at timestamp, status string")
        self._put(row.coalesce(1), "log", run)
