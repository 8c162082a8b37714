"""Lines that many documents share, found with levelled sorted runs of line hashes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recogna.llm.common import ROW_KEY, WHITE, ascii_lower, clash_free, scratch, stored, with_row_key

MIN_DOCS = 10
BATCHES = 4
FANOUT = 2


def lines_of(text: Column) -> Column:
    """The lines of a whole text; null and empty have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(text: Column) -> Column:
    """For each line of a whole text, a 128-bit hash of the line without white space at its ends and with A-Z
    lower-cased; null for lines left empty. Letters are lower-cased before the text is split, which moves no line end."""

    def key(line: Column) -> Column:
        bare = F.btrim(line, F.lit(WHITE))
        return F.when(bare != "", F.unhex(F.md5(bare.cast("binary"))))

    return F.transform(lines_of(ascii_lower(text)), key)


class LineRuns:
    """Sorted runs of (key, n_docs) in levels below one shared folder.

    ``add`` counts a batch's keys with map-side partial counts, merge-anti-joins them with the keys that
    the runs have already settled (found in ``min_docs`` documents, so later counts change nothing)
    and writes the rest as a run of level 0. ``fanout`` runs of a level are merged into one of the next, so
    a key is rewritten once a level. The driver holds the paths of runs only.
    """

    def __init__(self, spark: SparkSession, folder: str, min_docs: int = MIN_DOCS, fanout: int = FANOUT) -> None:
        self.spark, self.folder, self.min_docs, self.fanout = spark, folder, min_docs, fanout
        self.levels: list[list[str]] = [[]]
        self.written = 0

    def _write(self, counts: DataFrame, level: int) -> None:
        path = f"{self.folder}/level{level}-run{self.written}"
        self.written += 1
        counts.sortWithinPartitions("key").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def _merged(self, paths: list[str]) -> DataFrame:
        runs = [self.spark.read.schema("key binary, n_docs long").parquet(p) for p in paths]
        return reduce(DataFrame.unionByName, runs).groupBy("key").agg(F.sum("n_docs").alias("n_docs"))

    def frequent(self) -> DataFrame:
        """(key) found in at least ``min_docs`` documents of all batches so far."""
        paths = [p for level in self.levels for p in level]
        if not paths:
            return self.spark.createDataFrame([], "key binary")
        return self._merged(paths).where(F.col("n_docs") >= self.min_docs).select("key")

    def add(self, docs: DataFrame) -> None:
        """Each row of ``docs`` is a document."""
        keys = F.array_distinct(line_keys(F.col("text")))
        counts = docs.select(F.explode(keys).alias("key")).where("key is not null").groupBy("key").agg(F.count("*").alias("n_docs"))
        if self.written:
            counts = counts.join(self.frequent(), "key", "left_anti")
        self._write(counts, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self._merged(self.levels[level]), []
            self._write(merged, level + 1)
            level += 1


@clash_free()
def drop_frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """All columns of ``docs``, the text without the lines whose key at least ``min_docs`` documents hold, and
    ``n_lines`` (before) and ``n_dropped``.

    Every document goes through one of ``batches`` batches; once all are in the runs, the lines of all documents
    meet the frequent keys. Only keys and line numbers are shuffled there; a key that a third of
    the documents holds is one row of the small side, and its rows can be split. A document's dropped line numbers
    then join its row.

    Null text becomes empty, one empty line; lines of white space are never dropped, and a document
    keeps its row when all its lines go. Repeated rows count as documents each. Columns of ``docs`` named
    ``n_lines`` or ``n_dropped`` are replaced; all others come back whatever they are called.
    """
    spark = docs.sparkSession
    rows = with_row_key(docs.drop("n_lines", "n_dropped"))
    runs = LineRuns(spark, scratch(spark, "line-runs"), min_docs, fanout)
    for batch in range(batches):
        runs.add(rows.where(F.pmod(F.xxhash64(*ROW_KEY), F.lit(batches)) == batch).select("text"))
    frequent = stored(runs.frequent(), "line-frequent")
    lines = rows.select(*ROW_KEY, F.posexplode(line_keys(F.col("text"))).alias("place", "key"))
    hits = lines.where("key is not null").join(frequent, "key", "left_semi")
    dropped = hits.groupBy(*ROW_KEY).agg(F.collect_set("place").alias("_places"))
    joined = rows.join(dropped, ROW_KEY, "left").withColumn("_lines", lines_of(F.col("text")))
    places = F.coalesce("_places", F.array().cast("array<int>"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), places)
    return joined.select(
        *[F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n").alias("text") if c == "text" else F.col(c) for c in rows.columns if c not in ROW_KEY],
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(places).cast("long").alias("n_dropped"),
    )
