"""Building blocks that stay distributed when one key owns a large part of the rows.

Lines are never windowed by contract, customer or bundle: such a group has no size
bound.  Totals are aggregated (map-side partial sums) and joined back, and ordered
running values are built from blocks whose sizes are bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def bucket(row_id: str) -> Column:
    """Stable two-digit hash of a row id, used as a leading tie-break (256 values)."""
    return F.substring(F.md5(F.col(row_id).cast("string").cast("binary")), 1, 2)


def attach(rows: DataFrame, totals: DataFrame, keys: Sequence[str], how: str = "left", premarked: bool = False) -> DataFrame:
    """Join one total row per key onto ``rows``, whose keys may be very uneven.

    Adaptive execution splits an oversized partition of the row side, but only where both
    join inputs come straight out of a shuffle.  Totals are an aggregate already
    partitioned by the key, so a plain join would read them in place and leave the hot
    partition whole.  Joining on the key and a hash of it as well gives the totals - one
    row per key - a shuffle of their own.  Totals that pass Spark's size check are
    broadcast instead.

    ``premarked`` rows (``marked``) keep the hash, so one shuffle of theirs serves all the totals attached by the same keys.
    """
    keys = list(keys)
    mark, values = _mark(keys) if premarked else "_key_hash", [c for c in totals.columns if c not in keys]
    left = rows if premarked else rows.withColumn(mark, _hash(keys))
    return left.join(totals.withColumn(mark, _hash(keys)), [*keys, mark], how).select(*rows.columns, *values)


def _hash(keys: Sequence[str]) -> Column:
    return F.hash(*[F.col(k).cast("string") for k in keys])


def _mark(keys: Sequence[str]) -> str:
    return "_key_hash_" + "_".join(keys)


def marked(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a hash of their keys, to which several totals are to be attached."""
    return rows if _mark(keys) in rows.columns else rows.withColumn(_mark(keys), _hash(keys))


def running_before(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    row_id: str,
    measures: dict[str, tuple[str, Column]],
) -> DataFrame:
    """Add running values over the rows strictly before each row of its group.

    Row order is ``order`` (dates), then ``bucket(row_id)``, then ``row_id``.  ``measures``
    maps a new column to ("sum" | "max", expression).  The running value is built in three
    levels - per first order column, per full order and bucket, per row - so the largest
    window holds either the distinct days of a group or 1/256 of the rows that share all
    order columns, never a whole group.
    """
    keys, order = list(keys), list(order)
    fold = {"sum": F.sum, "max": F.max}
    day_key = [*keys, order[0]]
    block_order = [*order[1:], "_bucket"]
    block_key = [*day_key, *block_order]

    def combine(kind: str, a: Column, b: Column) -> Column:
        if kind == "sum":
            return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
        return F.greatest(a, b)

    base = rows.withColumn("_bucket", bucket(row_id))
    for name, (_, expr) in measures.items():
        base = base.withColumn(f"_in_{name}", expr)
    blocks = base.groupBy(*block_key).agg(*[fold[k](f"_in_{n}").alias(f"_blk_{n}") for n, (k, _) in measures.items()])
    days = blocks.groupBy(*day_key).agg(*[fold[k](f"_blk_{n}").alias(f"_day_{n}") for n, (k, _) in measures.items()])

    by_day = Window.partitionBy(*keys).orderBy(order[0]).rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(*day_key, *[fold[k](f"_day_{n}").over(by_day).alias(f"_before_day_{n}") for n, (k, _) in measures.items()])
    by_block = Window.partitionBy(*day_key).orderBy(*block_order).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.join(days, day_key).select(
        *block_key,
        *[
            combine(k, F.col(f"_before_day_{n}"), fold[k](f"_blk_{n}").over(by_block)).alias(f"_before_block_{n}")
            for n, (k, _) in measures.items()
        ],
    )
    # the hash of the block's keys changes nothing in the groups, but lets the rows stay where they met their blocks
    by_row = Window.partitionBy(*block_key, _mark(block_key)).orderBy(row_id).rowsBetween(Window.unboundedPreceding, -1)
    return attach(marked(base, block_key), blocks, block_key, "inner", premarked=True).select(
        *rows.columns,
        *[
            combine(k, F.col(f"_before_block_{n}"), fold[k](f"_in_{n}").over(by_row)).alias(n)
            for n, (k, _) in measures.items()
        ],
    )
