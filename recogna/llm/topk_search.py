"""Exact top-k search: global score histograms locate each query's kth score, then a filter and definite ties."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recogna.llm.common import stored

K = 5
QUERY_STEP = 50
FACTOR = 256
#: A round of refinement cuts every interval into 2 ** this many bins.
BIN_BITS = 12
#: Numbers in the vectors of one tile's candidates, and of its queries, about.
TILE_VALUES = 1 << 19
#: Scores a task holds at once.
_SCORES = 1 << 21
_EXACT = float(1 << 53)
_ENDS = (-(1 << 63), (1 << 63) - 1)
_STATE = "query long, bin long, n long"


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def whole_vectors(rows: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(row, vec_id, size, part, vector): floor(factor * x) of every usable vector, as whole numbers in doubles.

    ``row`` names the row, whatever its id; ``part`` deals the rows of one length evenly into tiles.
    """
    vectors = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")).where(usable(F.col("vector")))
    # multiplication by a power of two and floor are exact in a double; floor() itself would cut at the ends of long
    whole = F.transform("vector", lambda x: F.when(F.abs(x) < 2.0**52 / factor, F.floor(x * factor).cast("double")).otherwise(x * factor))
    vectors = stored(vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.size("vector").alias("size"), whole.alias("vector")), "search-vectors")
    return stored(dealt(vectors, "part"), "search-dealt")


def dealt(vectors: DataFrame, part: str) -> DataFrame:
    """Add ``part``, one of so many that a tile's vectors of one length stay bounded, and their number ``<part>_n``."""
    sizes = vectors.groupBy("size").agg(F.count("*").alias("n"))  # one row a length
    tiles = F.greatest(F.lit(1), F.ceil(F.col("n") * F.greatest("size", F.lit(1)) / F.lit(TILE_VALUES))).cast("int")
    return vectors.join(sizes.select("size", tiles.alias(f"{part}_n")), "size").withColumn(part, F.pmod(F.xxhash64("row"), f"{part}_n").cast("int"))


def _scores(candidates: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products, one row a query, as longs. Doubles are exact below 2 ** 53; beyond, Python's numbers are."""
    if candidates.shape[1] == 0:
        return np.zeros((len(queries), len(candidates)), np.int64)
    bound = float(np.abs(candidates).max(initial=0)) * float(np.abs(queries).max(initial=0)) * candidates.shape[1]
    if bound < _EXACT:
        return (queries @ candidates.T).astype(np.int64)
    rows = [[int(x) for x in c] for c in candidates.tolist()]
    cut = [[min(max(sum(a * int(b) for a, b in zip(c, q, strict=True)), _ENDS[0]), _ENDS[1]) for c in rows] for q in queries.tolist()]
    return np.array(cut, np.int64)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    numbers = lists.flatten().to_numpy()
    return numbers.reshape(len(lists), len(numbers) // len(lists))


def _tiled(vectors: DataFrame, queries: DataFrame, state: DataFrame, run, schema: str) -> DataFrame:
    """Apply ``run(rows, ids, scores, query)`` in every tile of a part of the vectors and a part of the queries, once
    for each of its queries.

    Both sides are dealt by hash of the row, so no key, id or vector makes a tile larger. What is shuffled is each
    side once for every part of the other.
    """
    q_parts = queries.select("size", F.col("q_part_n").alias("times")).distinct()  # one row a length
    left = vectors.join(q_parts, "size").withColumn("q_part", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
    right = state.join(queries, "row").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("part_n") - 1))).drop("query_id", "part_n", "q_part_n")
    left = left.select("size", "part", "q_part", "row", "vec_id", "vector")
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # columns of its own beside those of the left side
    names = pa.schema([(f.split()[0], pa.int64()) for f in schema.split(", ")])

    def tile(some: pa.Table, asked: pa.Table) -> pa.Table:
        if not some.num_rows or not asked.num_rows:
            return names.empty_table()
        vectors, wanted = _matrix(some.column("vector")), _matrix(asked.column("vector"))
        rows, ids = some.column("row").to_numpy(), np.array(some.column("vec_id").to_pylist(), object)
        asking = asked.drop_columns(["vector"]).to_pylist()
        step = max(1, _SCORES // len(rows))
        out = [out for at in range(0, len(asking), step) for q, s in zip(asking[at : at + step], _scores(vectors, wanted[at : at + step]), strict=True) for out in run(rows, ids, s, q)]
        return pa.Table.from_pylist(out, names)

    keys = ["size", "part", "q_part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(tile, schema)


def kth_scores(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(row, kth): for every query row the score of its kth best candidate, or of its last if there are fewer.

    A score's leading bits name its bin. Each round counts, over all tiles, the scores of every bin inside the interval
    that holds the kth value, and goes on with the bin where the count from above reaches it, until bins hold
    one value. A tile leaves out the bins below its own kth score, which can't hold the global one.
    """
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    longest = vectors.agg(F.max(norm).alias("norm")).first()["norm"] or 1.0  # bounds every score, by Cauchy and Schwarz
    bits = min(63, max(1, math.ceil(math.log2(max(2.0, longest) * 1.001)) if math.isfinite(longest) else 63))
    shift, state = bits + 1, queries.select("row", F.lit(0).cast("long").alias("above"), F.lit(None).cast("long").alias("bin"))
    while shift > 0:
        before, shift = shift, max(0, shift - BIN_BITS)

        def count(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, q: dict, before: int = before, shift: int = shift) -> list[dict]:
            scores = scores[rows != q["row"]]
            if q["bin"] is not None:
                scores = scores[scores >> before == q["bin"]]
            bins, n = np.unique(scores >> shift, return_counts=True)
            bins, n = bins[::-1], n[::-1]
            enough = int(np.searchsorted(np.cumsum(n), k - q["above"])) + 1
            return [{"query": q["row"], "bin": int(b), "n": int(c)} for b, c in zip(bins[:enough], n[:enough], strict=True)]

        counted = _tiled(vectors, queries, state, count, _STATE).groupBy("query", "bin").agg(F.sum("n").alias("n"))
        higher = Window.partitionBy("query").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)  # 2 ** BIN_BITS rows at most
        counted = counted.join(state.select(F.col("row").alias("query"), "above"), "query")
        counted = counted.withColumn("above", F.col("above") + F.coalesce(F.sum("n").over(higher), F.lit(0))).where(F.col("above") < k)
        state = counted.groupBy(F.col("query").alias("row")).agg(F.min("bin").alias("bin"), F.max("above").alias("above"))
        state = stored(state.select("row", "above", "bin"), "search-state")
    return state.select("row", F.col("bin").alias("kth"))


def top_k(embeddings: DataFrame, k: int = K, step: int = QUERY_STEP, factor: int = FACTOR) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` candidates of highest integer inner product for each query row.

    Queries are the rows whose vec_id is divisible by ``step``, candidates all other rows; only vectors of one length
    are compared. Ties go to the smaller vec_id, null last, and then to the earlier row. A null id is a candidate
    and no query. Rows that repeat an id are queries and candidates of their own, so a repeated query gives its
    ranks once for each row. Null vectors and those with null or non-finite components take no part, and empty
    ones score 0. Scores beyond a long count as its end. Other columns are ignored; an empty table gives no rows.

    Every tile passes at most ``k`` of the candidates that reach the kth score, in the order of the result, so a
    group of copies that all tie is never sent on as a whole.
    """
    vectors = whole_vectors(embeddings, factor)
    queries = vectors.where(F.col("vec_id") % step == 0).select("row", F.col("vec_id").alias("query_id"), "size", "vector", "part_n")
    queries = stored(dealt(queries, "q_part"), "search-queries")
    limits = kth_scores(vectors, queries, k)

    def reached(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, q: dict) -> list[dict]:
        at = np.flatnonzero((scores >= q["kth"]) & (rows != q["row"]))
        if len(at) > k:
            tied = [(-int(scores[i]), ids[i] is None, ids[i] or 0, int(rows[i]), i) for i in at]
            at = [t[-1] for t in sorted(tied)[:k]]
        return [{"query": q["row"], "row": int(rows[i]), "vec_id": ids[i], "score": int(scores[i])} for i in at]

    found = _tiled(vectors, queries, limits, reached, "query long, row long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = queries.select(F.col("row").alias("query"), "query_id")
    return best.join(names, "query").select("query_id", "rank", "vec_id", "score")
