"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recogna.functions.skew import attach
from recogna.llm.common import shuffle_partitions, stored
from recogna.llm.components import components, mixed

SEED = 42
BITS = 64
RADIUS = 3
#: Variants that a task sorts at once, on average.
PER_TASK = 2_000_000


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, as a signed long; a text without words has 0."""
    import xxhash

    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    shingles = map(b" ".join, zip(*(islice(tokens, k, None) for k in range(words)), strict=False)) if len(tokens) > words else iter([b" ".join(tokens)])
    ones, count = np.zeros(BITS, np.int64), 0
    while True:
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in islice(shingles, 1 << 15)), "<u8")
        if not len(hashes):
            break
        count += len(hashes)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fingerprint long) for every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = [fingerprint(t.as_py(), words) for t in b.column("text")]
            yield pa.record_batch([b.column("doc_id"), pa.array(marks, pa.int64())], ["doc_id", "fingerprint"])

    return rows.mapInArrow(run, "doc_id long, fingerprint long")


def _flip(*bits: int) -> int:
    return int(np.array(sum(1 << b for b in bits), np.uint64).view(np.int64))


def _pairs(bits: range) -> list[int]:
    return [_flip(*p) for p in combinations(bits, 2)]


#: Flips of no bit, one bit, two bits, for each half of the word.
LOW_ONE, LOW_TWO = [_flip(b) for b in range(32)], _pairs(range(32))
HIGH_ONE, HIGH_TWO = [_flip(b) for b in range(32, 64)], _pairs(range(32, 64))
#: Variants of an even and of an odd fingerprint.
EVEN, ODD = 1 + BITS + len(LOW_TWO) + len(HIGH_TWO), BITS


def routed(marks: DataFrame) -> DataFrame:
    """(route, fingerprint): a row for each different low half among the variants of a fingerprint.

    Half the radius of 3 is 1 on one side and 2 on the other. Two fingerprints 1 or 3 bits apart
    differ in parity, so only even ones need flip two bits; of any three differing bits two lie in
    the same half of the word, so only pairs within a half are needed; two fingerprints 2 bits
    apart meet after one flip each. 1,057 and 64 variants instead of 2,081 each. Variants meet
    only if their low halves do, and those with flips in the high half have the fingerprint's own: they travel as
    one row and are told apart by the task that gets it. 529 and 33 rows remain.
    """
    flip = F.when(F.bit_count("fingerprint") % 2 == 0, F.lit([0, *LOW_ONE, *LOW_TWO])).otherwise(F.lit([0, *LOW_ONE]))
    return marks.select("fingerprint", F.explode(flip).alias("flip")).select(
        F.col("fingerprint").bitwiseXOR(F.col("flip")).bitwiseAND(F.lit(0xFFFFFFFF)).alias("route"), "fingerprint"
    )


def variants_of(route: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(variant, fingerprint) for rows of ``routed``."""
    half = np.int64(0xFFFFFFFF)
    low = (mark ^ route) & half
    own, even = low == 0, np.bitwise_count(mark.view(np.uint64)) % 2 == 0
    made = [(mark[~own] ^ low[~own], mark[~own])]
    for rows, flips in ((own & even, [0, *HIGH_ONE, *HIGH_TWO]), (own & ~even, HIGH_ONE)):
        made.append(((mark[rows][:, None] ^ np.array(flips, np.int64)).ravel(), np.repeat(mark[rows], len(flips))))
    return tuple(np.concatenate(x) for x in zip(*made, strict=True))


def meetings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) among the rows (route, fingerprint) of one partition, which has all rows of its routes.

    A fingerprint at most one bit from the variant is its hub; all others there are at most
    two bits from the variant, hence at most three from the hub, and every pair within the radius
    shares a variant of which one of the two is a hub. A star around one hub therefore joins all
    that meet there, with a link for each member. Distances are verified again.
    """
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if not parts:
        return
    variant, mark = variants_of(*(np.concatenate(x) for x in zip(*parts, strict=True)))
    order = np.argsort(variant, kind="stable")
    variant, mark = variant[order], mark[order]
    first = np.flatnonzero(np.r_[True, variant[1:] != variant[:-1]])
    size = np.diff(np.r_[first, len(variant)])
    shared = np.repeat(size > 1, size)
    variant, mark, size = variant[shared], mark[shared], size[size > 1]
    if not len(size):
        return
    none = np.iinfo(np.int64).max
    begin = np.r_[0, np.cumsum(size)[:-1]]
    near = np.bitwise_count((variant ^ mark).view(np.uint64)) <= 1
    hub = np.repeat(np.minimum.reduceat(np.where(near, mark, none), begin), size)
    has = np.repeat(np.add.reduceat(near.astype(np.int64), begin) > 0, size)
    real = has & (hub != mark) & (np.bitwise_count((hub ^ mark).view(np.uint64)) <= RADIUS)
    links = np.unique(np.stack([hub[real], mark[real]]), axis=1)
    yield pa.record_batch([pa.array(links[0]), pa.array(links[1])], ["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Fingerprints at most 3 bits apart are linked; ``component_id`` is the smallest id of the
    connected documents. Copies meet in one fingerprint before anything is emitted, so a
    group of copies costs one row. Distinct fingerprints emit their variants (``routed``), which are
    shuffled; tasks sort their share and emit links, whose components follow.

    Null text counts as empty; texts without words have fingerprint 0 and are linked like others.
    Null ids keep their row; they don't name a component, which is null if it has no other id. Rows
    that repeat an id are rows of their own. Other columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    marks = stored(fingerprints(docs, id_col, text_col, words), "simhash-marks")
    distinct = stored(marks.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    tasks = max(shuffle_partitions(spark), -(-distinct.count() * (EVEN + ODD) // 2 // PER_TASK))
    links = routed(distinct).repartition(tasks, "route").mapInArrow(meetings, "a long, b long")
    roots = components(links, "simhash")
    own = distinct.withColumn("node", mixed("fingerprint")).join(roots, "node", "left")
    own = own.withColumn("root", F.coalesce("root", "node"))
    lowest = own.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_mark = stored(own.join(lowest, "root").select("fingerprint", "component_id"), "simhash-groups")
    out = attach(marks, of_mark, ["fingerprint"])
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
