"""The trie of conversation prefixes: adaptive radix trees over sorted ranges of turn-id keys, joined at their edges."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recogna.llm.common import stored
from recogna.llm.radix_tree import RadixTree

#: Bytes of a turn id in a key.
WIDTH = 8
#: Turns that one task's tree takes, about; a longer conversation is in a tree of its own or with few others.
TREE_TURNS = 200_000
#: Consecutive conversation ids whose decimals are joined before they are hashed.
_ID_BLOCK = 4096
_NODES = 50_000
_KEYS = "key binary, chars array<int>, n long, first long, ends string"
_TRIE = (
    "node binary, parent binary, conv_id long, parent_conv_id long, depth long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, chars long, ends string"
)


def rebuilt(turns: DataFrame, share: int, most_shared: int) -> DataFrame:
    """(conv_id, key, chars): each conversation's turns after rebuilding, as big-endian turn ids and code points.

    Turns of one number are ordered by role and text. A turn's id is the number of its role and text among the
    distinct ones; turns meet their ids in a join that adaptive execution splits where one turn is very common.
    """
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    in_order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    name = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(" "), "role", "text"), 256)
    rows = stored(rows.select("conv_id", F.row_number().over(in_order).alias("place"), name.alias("name"), F.length("text").alias("chars")), "trie-turns")
    names = stored(rows.groupBy("name").agg(F.count("*").alias("n")).select("name", F.monotonically_increasing_id().alias("id")), "trie-names")
    convs = rows.join(names, "name").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "id", "chars"))).alias("turns"))
    convs = stored(convs.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.chars").alias("chars")), "trie-conversations")

    heads = convs.where(F.col("conv_id") % share == 0)
    heads = heads.select(F.col("conv_id").alias("base"), F.slice("ids", 1, most_shared).alias("base_ids"), F.slice("chars", 1, most_shared).alias("base_chars"))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most_shared + 1)).cast("int")
    joined = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % share).withColumn("taken", taken).join(heads, "base", "left")

    def spliced(base: str, own: str):
        kind = "array<long>" if own == "ids" else "array<int>"
        head = F.coalesce(F.slice(base, F.lit(1), F.col("taken")), F.array().cast(kind))
        rest = F.slice(own, F.col("taken") + 1, F.greatest(F.size(own) - F.col("taken"), F.lit(0)))
        return F.concat(head, rest)

    joined = joined.select("conv_id", spliced("base_ids", "ids").alias("ids"), spliced("base_chars", "chars").alias("chars"))
    key = F.unhex(F.array_join(F.transform("ids", lambda i: F.lpad(F.hex(i), 2 * WIDTH, "0")), ""))
    return joined.select("conv_id", key.alias("key"), "chars")


def distinct_keys(convs: DataFrame) -> DataFrame:
    """(key, chars, n, first, ends): each distinct sequence with its conversations' number, smallest id and hash of ids.

    Ids are joined block by block first. The hash of a sequence's ids is sequential by definition; it runs over its
    sorted blocks as they stream by, so its memory doesn't follow the number of copies.
    """
    block = F.floor(F.col("conv_id") / _ID_BLOCK).alias("block")
    ids = F.sort_array(F.collect_list("conv_id"))  # _ID_BLOCK ids at most
    blocks = convs.groupBy("key", "chars", block).agg(F.count("*").alias("n"), F.min("conv_id").alias("first"), F.array_join(ids.cast("array<string>"), ",").alias("ids"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = digest = None
        out: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["key"] != key:
                    if key is not None:
                        out[-1]["ends"] = digest.hexdigest()
                    if len(out) >= _NODES // 10:
                        yield pa.RecordBatch.from_pylist(out, _schema(_KEYS))
                        out = []
                    key, digest = row["key"], hashlib.sha256(row["ids"].encode())
                    out.append({"key": key, "chars": row["chars"], "n": row["n"], "first": row["first"]})
                else:
                    digest.update(b"," + row["ids"].encode())
                    out[-1]["n"] += row["n"]
        if key is not None:
            out[-1]["ends"] = digest.hexdigest()
            yield pa.RecordBatch.from_pylist(out, _schema(_KEYS))

    return blocks.repartition("key").sortWithinPartitions("key", "block").mapInArrow(run, _KEYS)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


class _Below:
    """What a subtree passes up to the next turn-aligned byte depth."""

    __slots__ = ("n", "first", "chars", "rows", "leaves", "saved", "lowest", "highest")

    def __init__(self) -> None:
        self.n, self.first, self.chars, self.rows = 0, None, None, []  # rows: nodes whose parent is yet to come
        self.leaves = self.saved = 0
        self.lowest = self.highest = False  # whether the range's first or last key is in here

    def take(self, other: _Below) -> None:
        self.n += other.n
        self.first = other.first if self.first is None else min(self.first, other.first)
        self.chars = self.chars or other.chars
        self.rows += other.rows
        self.leaves, self.saved = self.leaves + other.leaves, self.saved + other.saved
        self.lowest, self.highest = self.lowest or other.lowest, self.highest or other.highest


class _Trie:
    """Trie nodes of one sorted range of keys. Nodes that hold the range's first or last key may go on in another
    range: they are open, and pass nothing but their own closed part."""

    def __init__(self, tree: RadixTree, low: bytes, high: bytes) -> None:
        self.low, self.high = low, high
        self.first, self.parent, self.depth, self.n, self.children, self.leaves = [], [], [], [], [], []
        self.saved, self.open, self.chars, self.ends = [], [], [], []
        self.at: dict[bytes, int] = {}  # the nodes where the two keys end
        todo = [(tree.root, 0, False)]
        results: list[_Below] = []
        while todo:  # children first
            node, begin, seen = todo.pop()
            end = begin + len(node.path)
            below = node.ordered()
            if not seen:
                todo.append((node, begin, True))
                todo += [(c, end, False) for c in below]
                continue
            here = _Below()
            for _ in below:
                here.take(results.pop())
            results.append(self.along(node.value, here, begin, end))

    def along(self, value: tuple | None, here: _Below, begin: int, end: int) -> _Below:
        """Trie nodes at the turn-aligned depths of a path, from its end up; the root has no path and depth 0."""
        ends = None
        if value is not None:
            own = _Below()
            own.n, own.first, own.chars, ends, key = value
            own.lowest, own.highest = key == self.low, key == self.high
            here.take(own)
            if own.lowest or own.highest:
                self.at[key] = len(self.first)
        least = 0 if end == 0 else begin + 1
        for at in range(end // WIDTH * WIDTH, least - 1, -WIDTH):
            here = self.node(here, at // WIDTH, ends if at == end else None)
        return here

    def node(self, below: _Below, depth: int, ends: str | None) -> _Below:
        me, is_open = len(self.first), below.lowest or below.highest
        saved = (below.n - 1) * below.chars[depth - 1] if depth else 0
        closed = [r for r in below.rows if not self.open[r]]
        if not is_open:
            below.leaves += not below.rows
            below.saved += saved
        self.first.append(below.first)
        self.depth.append(depth)
        self.n.append(below.n)
        self.children.append(len(closed))
        self.leaves.append(below.leaves)
        self.saved.append(below.saved)
        self.open.append(is_open)
        self.chars.append(below.chars[depth - 1] if depth else 0)
        self.ends.append(ends)
        self.parent.append(-1)
        for r in below.rows:
            self.parent[r] = me
        below.rows = [me]
        if is_open:  # counted at this node; what is above adds it when the ranges are joined
            below.leaves = below.saved = 0
        return below

    def names(self) -> dict[int, bytes]:
        """The name of every open node: the hash of its key."""
        out, known = {}, {}
        for key in (self.low, self.high):
            digest = hashlib.sha256()
            known[key] = [digest.digest()]
            for at in range(0, len(key), WIDTH):
                digest.update(key[at : at + WIDTH])
                known[key].append(digest.digest())
        for key, on_path in ((self.low, self.path(self.low)), (self.high, self.path(self.high))):
            for row in on_path:
                out[row] = known[key][self.depth[row]]
        return out

    def path(self, key: bytes) -> list[int]:
        row, out = self.at[key], []
        while row >= 0:
            out.append(row)
            row = self.parent[row]
        return out


def trie_parts(keys: DataFrame, trees: int) -> DataFrame:
    """One radix tree for each of ``trees`` sorted ranges of keys; its nodes, the open ones with names."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, low, high = RadixTree(), None, None
        for batch in batches:
            for row in batch.to_pylist():
                key = row["key"]
                tree.insert(key, (row["n"], row["first"], row["chars"], row["ends"], key))
                low = key if low is None or key < low else low
                high = key if high is None or key > high else high
        if low is None:
            return
        trie = _Trie(tree, low, high)
        names = trie.names()
        for begin in range(0, len(trie.first), _NODES):
            rows = range(begin, min(begin + _NODES, len(trie.first)))
            parents = [trie.parent[r] for r in rows]
            columns = [
                [names.get(r) for r in rows], [names.get(p) for p in parents], [trie.first[r] for r in rows],
                [trie.first[p] if p >= 0 else None for p in parents], [trie.depth[r] for r in rows], [trie.n[r] for r in rows],
                [trie.children[r] for r in rows], [trie.leaves[r] for r in rows], [trie.saved[r] for r in rows],
                [trie.chars[r] for r in rows], [trie.ends[r] for r in rows],
            ]
            schema = _schema(_TRIE)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return keys.repartitionByRange(trees, "key").mapInArrow(run, _TRIE)


def joined_edges(parts: DataFrame) -> DataFrame:
    """The open nodes of all ranges as one tree: their parts added up, then what hangs below them.

    Sums over subtrees by doubling: after round i every node has the sum over its descendants fewer than 2 ** i
    levels down, and sends it to its ancestor 2 ** i levels up. Only nodes at the edges of ranges take part.
    """
    opened = parts.where("node is not null").groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("closed"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.first("chars").alias("chars"),
        F.max("ends").alias("ends"),
    )
    opened = stored(opened, "trie-open")
    inner = opened.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("inner"))
    firsts = opened.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = opened.join(inner, "node", "left").join(firsts, "parent", "left").withColumn("n_children", F.col("closed") + F.coalesce("inner", F.lit(0)))
    nodes = nodes.withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
    nodes = stored(nodes.withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars")), "trie-edges")
    sums = nodes.select("node", F.col("parent").alias("up"), "n_leaves", "saved_tokens")
    levels = (nodes.agg(F.max("depth")).first()[0] or 0) + 1
    for _ in range((levels - 1).bit_length()):
        sent = sums.where("up is not null").groupBy(F.col("up").alias("node")).agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        further = sums.select(F.col("node").alias("up"), F.col("up").alias("next"))
        sums = sums.join(sent, "node", "left").join(further, "up", "left").select(
            "node", F.col("next").alias("up"), (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        )
        sums = stored(sums, "trie-sums")
    return nodes.drop("n_leaves", "saved_tokens").join(sums.drop("up"), "node")


def prefix_trie(turns: DataFrame, share: int = 100, most_shared: int = 5) -> DataFrame:
    """One row for each distinct prefix of the rebuilt conversations of ``turns`` (conv_id, turn, role, text).

    Conversation c takes its first h turns, h = crc32 of its decimal id modulo ``most_shared + 1``, from conversation
    c - c % ``share`` and the others from its own. Null roles and texts are empty; null turns come first; turns of
    one number are ordered by role and text, so repeated rows are turns one after the other. Rows
    without conv_id take no part. Other columns are ignored. An empty table has no node, not even a root.

    Identical sequences are one key before any tree is built, and keys are dealt by sorted ranges, so neither a
    group of copies nor a first turn that all share makes a task larger. A conversation must fit in a row.
    """
    keys = stored(distinct_keys(rebuilt(turns, share, most_shared)), "trie-keys")
    size = keys.agg(F.sum(F.size("chars") + 1).alias("n")).first()["n"] or 0
    parts = stored(trie_parts(keys, int(size) // TREE_TURNS + 1), "trie-parts")
    edges = stored(joined_edges(parts), "trie-joined")
    firsts = edges.select(F.col("node").alias("parent"), F.col("conv_id").alias("edge_conv_id"))
    closed = parts.where("node is null").join(firsts, "parent", "left").withColumn("parent_conv_id", F.coalesce("edge_conv_id", "parent_conv_id"))
    ends = F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", ends]
    return closed.select(*columns).unionByName(edges.select(*columns))
