"""Near-duplicate vectors: codes by iterative quantisation, multi-index Hamming tables, exact reranking."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recogna.functions.skew import attach
from recogna.llm.common import stored
from recogna.llm.components import components, mixed

MIN_COSINE = 0.98
TABLES, TABLE_BITS = 5, 25
#: Vectors of one length on which its rotations are fitted, at most; all vectors are indexed.
FIT_ROWS = 4096
FIT_ROUNDS = 50
MOST_DIMS = 64


def fit_codes(sample: np.ndarray, bits: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(mean, directions): the signs of (x - mean) @ directions are a code of ``bits`` bits.

    Vectors are projected on their principal directions; a rotation of these is then improved in turns: the
    nearest code for each vector, the rotation that brings vectors nearest to their codes. As many
    rotations, from different random starts, are laid side by side as the bits need.
    """
    mean = sample.mean(axis=0)
    centred = sample - mean
    values, vectors = np.linalg.eigh(centred.T @ centred)
    principal = vectors[:, np.argsort(-values)][:, : min(MOST_DIMS, sample.shape[1])]
    reduced = centred @ principal
    width = principal.shape[1]
    sides = []
    for turn in range(-(-bits // width)):
        rotation = np.linalg.qr(np.random.default_rng([seed, turn]).normal(size=(width, width)))[0]
        for _ in range(FIT_ROUNDS):
            codes = np.where(reduced @ rotation > 0, 1.0, -1.0)
            u, _, vt = np.linalg.svd(codes.T @ reduced)
            rotation = (u @ vt).T
        sides.append(principal @ rotation)
    return mean, np.concatenate(sides, axis=1)[:, :bits]


def usable(embedding: Column) -> Column:
    """No null or non-finite component, and not zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return _unit(flat.reshape(len(column), -1))


def codes(vectors: DataFrame, models: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(rep, label, size, keys): ``TABLES`` numbers of ``TABLE_BITS`` bits for each vector."""
    weights = 1 << np.arange(TABLE_BITS, dtype=np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                mean, directions = models[int(size)]
                bits = (_matrix(part.column("embedding")) - mean) @ directions > 0
                keys = bits.reshape(len(bits), TABLES, TABLE_BITS) @ weights
                yield pa.record_batch([part.column("rep"), part.column("label"), part.column("size"), pa.array(keys.tolist(), pa.list_(pa.int64()))], ["rep", "label", "size", "keys"])

    schema = f"rep long, label {vectors.schema['label'].dataType.simpleString()}, size int, keys array<long>"
    return vectors.select("rep", "label", "size", "embedding").mapInArrow(run, schema)


def candidates(coded: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, that some table has at most one bit apart, each once.

    Every vector is entered under its key in each table and looks under its key and all keys one bit away. A pair
    that several tables find counts in the first of them, so pairs need no second shuffle. Spark sizes exploded rows like
    those they come from, here up to 130 times too low, so neither side may be broadcast on that estimate.
    """
    entered = coded.select("label", "size", F.posexplode("keys").alias("table", "key"), F.col("rep").alias("a"), F.col("keys").alias("keys_a"))
    probing = coded.select("label", "size", F.posexplode("keys").alias("table", "own"), F.col("rep").alias("b"), F.col("keys").alias("keys_b"))
    flips = F.lit([0, *(1 << b for b in range(TABLE_BITS))]).cast("array<long>")
    probing = probing.withColumn("flip", F.explode(flips)).withColumn("key", F.col("own").bitwiseXOR(F.col("flip"))).drop("own", "flip")
    met = entered.join(probing.hint("merge"), ["label", "size", "table", "key"]).where("a < b")
    earlier = F.exists(
        F.zip_with("keys_a", "keys_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        lambda d: d <= 1,
    )
    first = met.withColumn("keys_a", F.slice("keys_a", F.lit(1), F.col("table"))).withColumn("keys_b", F.slice("keys_b", F.lit(1), F.col("table")))
    return first.where(~earlier).select("a", "b")


def linked(pairs: DataFrame, vectors: DataFrame, min_cosine: float) -> DataFrame:
    """The pairs whose cosine, in double precision, is at least ``min_cosine``. Vectors are not broadcast: Spark counts an
    array as one component."""
    left = vectors.select(F.col("rep").alias("a"), F.col("embedding").alias("x")).hint("merge")
    right = vectors.select(F.col("rep").alias("b"), F.col("embedding").alias("y")).hint("merge")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            widths = np.diff(batch.column("x").offsets.to_numpy())
            for width in np.unique(widths):
                part = batch.filter(pa.array(widths == width))
                cosine = np.einsum("ij,ij->i", _matrix(part.column("x")), _matrix(part.column("y")))
                yield part.filter(pa.array(cosine >= min_cosine)).select(["a", "b"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near_vectors(embeddings: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``embeddings`` (vec_id, embedding, label).

    Vectors are compared if their labels are equal and not null and they are of one length. Equal vectors meet
    first: one stands for all and carries their number, so a group of copies costs one row and every copy still
    counts as a link. The others are coded, found in the Hamming tables and compared in full; a crowded key is
    a join partition that adaptive execution splits on both sides. Links are counted with partial sums.

    Null, zero and non-finite vectors and those without label link with nothing and are components of their own.
    Rows with a null id count as vectors but name no component. Rows that repeat an id are vectors
    of their own. Other columns are ignored. An empty table gives an empty result.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label")
    # -0.0 becomes 0.0: grouping does that to the results, and the rows' join keys must be the same
    rows = rows.withColumn("embedding", F.transform("embedding", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)))
    rows = rows.withColumn("_fit", F.col("label").isNotNull() & usable(F.col("embedding")))
    grouped = rows.where("_fit").groupBy("label", "embedding").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    grouped = grouped.withColumn("rep", F.monotonically_increasing_id()).withColumn("size", F.size("embedding"))
    vectors = stored(grouped, "vectors-distinct")
    models = {}
    for r in vectors.groupBy("size").count().collect():  # one row for each vector length
        some = vectors.where(F.col("size") == r["size"]).select("embedding", F.xxhash64("embedding").alias("h"))
        share, parts = min(1.0, FIT_ROWS / r["count"]), 1 << max(20, r["count"].bit_length())  # finer than one vector a part
        some = some.where(F.pmod("h", F.lit(parts)) < int(share * parts)).orderBy("h").limit(2 * FIT_ROWS).collect()
        fitted = np.array([s["embedding"] for s in some], np.float64) if some else np.eye(r["size"])
        models[r["size"]] = fit_codes(_unit(fitted), TABLES * TABLE_BITS)
    coded = stored(codes(vectors, models), "vectors-codes")
    links = stored(linked(candidates(coded), vectors, min_cosine), "vectors-links")
    copies = vectors.select("rep", "copies")
    ends = links.select(F.col("a").alias("rep"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("rep"), F.col("a").alias("other")))
    found = ends.join(copies.select(F.col("rep").alias("other"), "copies"), "other").groupBy("rep").agg(F.sum("copies").alias("found"))
    roots = components(links, "vectors")
    own = vectors.select("rep", "label", "embedding", "first_id", "copies", mixed("rep").alias("node")).join(roots, "node", "left")
    own = own.withColumn("root", F.coalesce("root", "node"))
    lowest = own.groupBy("root").agg(F.min("first_id").alias("component_id"))
    results = own.join(lowest, "root").join(found, "rep", "left").select(
        "label", F.xxhash64("embedding").alias("_hash"), "embedding", (F.coalesce("found", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    fit = attach(rows.where("_fit").withColumn("_hash", F.xxhash64("embedding")), stored(results, "vectors-results"), ["label", "_hash", "embedding"])
    alone = rows.where(~F.col("_fit")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = fit.select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
