"""Best-fit packing of token sequences, certified and repaired with dual-feasible-function bounds."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recogna.llm.common import stored, text_batches
from recogna.llm.tokens import encoder

CAPACITY = 1024
END_ID = 2
#: Pieces packed together in one task.
PER_PART = 16_384
ROUNDS = 4


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): a document's ids and the end id, cut only if longer than
    ``capacity``; then the first piece takes what the full ones leave over."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer, "kept"), np.array([end_id], "<u4").tobytes()
        for batch, texts in text_batches(batches, "text"):
            rows, piece, start, length, crc = [], [], [], [], []
            for row, ids in enumerate(enc.encode(texts)):
                ids = memoryview(ids + end)
                n = len(ids) // 4
                cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append(row), piece.append(k), start.append(a), length.append(b - a), crc.append(zlib.crc32(ids[4 * a : 4 * b]))
            yield pa.record_batch(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The largest of the bin counts that dual feasible functions prove necessary.

    With sizes as shares of the capacity, ``u`` raises sizes above 1 - e to 1 and drops those below e;
    ``v`` rounds (k + 1) x down to whole k-ths unless it is whole. Sums of either over the sizes
    that fit one bin are at most 1, so their sum over all sizes is a lower bound.
    """
    size, count = np.unique(np.asarray(lengths, np.int64), return_counts=True)
    best = -(-int((size * count).sum()) // capacity)
    for e in range(1, capacity // 2 + 1):
        u = np.where(size > capacity - e, capacity, np.where(size >= e, size, 0))
        best = max(best, -(-int((u * count).sum()) // capacity))
    for k in range(1, 33):
        whole = (k + 1) * size % capacity == 0
        v = np.where(whole, size * k, (k + 1) * size // capacity * capacity)
        best = max(best, -(-int((v * count).sum()) // (capacity * k)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: each length's bin and offset, and the fill of every bin. ``open_`` has a bit for
    each free space that some bin offers, so the tightest fit is one bit search."""
    bins, offsets, fills = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    offering: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_ = 0
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        fits = open_ >> n
        if fits:
            space = n + (fits & -fits).bit_length() - 1
            at = offering[space].pop()
            if not offering[space]:
                open_ ^= 1 << space
        else:
            space, at = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = at, capacity - space
        fills[at] += n
        if space > n:
            offering[space - n].append(at)
            open_ |= 1 << (space - n)
    return bins, offsets, np.array(fills, np.int64)


def _deal(pieces: DataFrame, turn: int, per_part: int, capacity: int) -> DataFrame:
    """Pack evenly dealt parts; every row also has its bin's fill and its part's gap to the certified bound."""
    parts = max(1, -(-pieces.count() // per_part))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "uid"], ascending=[False, True], ignore_index=True)
        lengths = group["length"].to_numpy(np.int64)
        bins, offsets, fills = best_fit(lengths, capacity)
        group["bin"], group["offset"], group["fill"] = bins, offsets, fills[bins]
        group["gap"] = len(fills) - lower_bound(lengths, capacity)
        group["turn"] = turn
        return group[["uid", "length", "turn", "part", "bin", "offset", "fill", "gap"]]

    dealt = pieces.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(parts)).alias("part"))
    schema = "uid long, length long, turn int, part long, bin long, offset long, fill long, gap long"
    return stored(dealt.groupBy("part").applyInPandas(run, schema), "packing-round")


def _bins(packed: DataFrame) -> int:
    return packed.where("offset = 0").count()


def pack(pieces: DataFrame, capacity: int = CAPACITY, per_part: int = PER_PART, rounds: int = ROUNDS) -> DataFrame:
    """(uid, sequence_id, offset) for pieces (uid, length), uid unique and length 1 to ``capacity``.

    Pieces of full length are sequences of their own. The others are dealt by a hash of the uid into
    parts of about ``per_part`` pieces, which best-fit decreasing packs; a part whose bins equal its
    lower bound is certified. Parts with a gap keep their full bins and exchange the rest:
    the pieces of their open bins are pooled, dealt anew and packed again, for as long as
    that needs fewer bins, ``rounds`` times at most. Nothing is left out: what an exchange
    doesn't improve stays as it was. Every part is bounded, whatever keys or copies the pieces have.
    """
    whole = pieces.where(F.col("length") == capacity).select("uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    current = _deal(pieces.where(F.col("length") < capacity), 0, per_part, capacity)
    settled = []
    for turn in range(1, rounds + 1):
        loose = (F.col("gap") > 0) & (F.col("fill") < capacity)
        pool = current.where(loose)
        if pool.select("part").distinct().limit(2).count() < 2:
            break
        again = _deal(pool, turn, per_part, capacity)
        if _bins(again) >= _bins(pool):
            break
        settled.append(current.where(~loose))
        current = again
    packed = reduce(DataFrame.unionByName, [*settled, current])
    number = F.shiftleft(F.col("turn").cast("long"), 56) + F.shiftleft("part", 24) + F.col("bin")
    return packed.select("uid", number.alias("sequence_id"), "offset").unionByName(whole)


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every row.

    Null text is empty: a piece with the end id alone. Rows that repeat an id are packed each on its
    own; a null id stays null. Documents are tokenized once, and the pieces kept in the shared folder.
    An empty table gives an empty result. Other columns are ignored.
    """
    pieces = token_pieces(docs, tokenizer, capacity, end_id).withColumn("uid", F.monotonically_increasing_id())
    pieces = stored(pieces, "packing-pieces")
    return pieces.join(pack(pieces.select("uid", "length"), capacity), "uid").drop("uid")
