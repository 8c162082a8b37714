"""How far the sources of a language differ in their words: chunk factorization and smoothed frequencies."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recogna.llm.common import ascii_lower, stored

#: What isn't an ASCII character, or is an ASCII letter.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 30
SMOOTH = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
#: A worker passes its counts on when it holds so many.
_HELD = 800_000
#: Bits of the map of open terms that every worker gets, 8 MB however many there are.
_BITS = 1 << 26
#: Cells (terms x sources) of the largest matrix a task makes, roughly.
_CELLS = 1 << 17
#: In UTF-8 every byte above 0x7F belongs to a character that is part of a term, so the same pattern cuts bytes.
_TERM = re.compile(TERM.encode("latin-1"))


def _rows(docs: DataFrame) -> DataFrame:
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    return docs.select(*names, F.col("text").cast("binary").alias("data"))


def chunk_counts(rows: DataFrame) -> DataFrame:
    """(chunk, lang, source, docs, times): white-space chunks counted by document, then added up.

    Each worker adds what it reads and passes its sums on whenever it holds ``_HELD`` of them, so a chunk of all
    documents is few rows before the shuffle. Rows are dealt by chunk alone: what follows by chunk stays in place.
    """

    def passed(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (docs, more) in held.items():
            n = len(docs)
            counts = np.fromiter(docs.values(), np.int64, n)
            times = counts + np.fromiter((more.get(c, 0) for c in docs), np.int64, n)
            columns = [pa.array(list(docs), pa.binary()), pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(counts), pa.array(times)]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "lang", "source", "docs", "times"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}  # documents of each chunk; its occurrences beyond one a document
        size = 0
        for batch in batches:
            for lang, source, value in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("data"), strict=True):
                words = Counter((value.as_py() or b"").split())  # of bytes: at [\x20\x09-\x0D] only
                if not words:
                    continue
                docs, more = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(docs)
                docs.update(words.keys())
                size += len(docs)
                for word, n in words.items():
                    if n > 1:
                        more[word] += n - 1
                if size > _HELD:
                    yield from passed(held)
                    held, size = {}, 0
        yield from passed(held)

    counted = rows.mapInArrow(run, "chunk binary, lang string, source string, docs long, times long")
    counted = counted.withColumn("chunk", F.col("chunk").cast("string")).repartition("chunk")
    return counted.groupBy("chunk", "lang", "source").agg(F.sum("docs").alias("docs"), F.sum("times").alias("times"))


def term_counts(rows: DataFrame) -> DataFrame:
    """(lang, source, term, times, least, most): occurrences, and bounds of the number of documents.

    Every distinct chunk is cut into its terms once, where all counts of the chunk are: its groups, of which there are
    as many as sources at most, gather in one row, and terms and groups join there. A document that has
    several chunks of a term makes their sum too large, and their largest number is too small: the two bounds.
    """
    groups = F.collect_list(F.struct("lang", "source", "docs", "times")).alias("groups")
    terms = F.regexp_extract_all(ascii_lower(F.col("chunk")), F.lit(TERM), F.lit(0))
    chunks = chunk_counts(rows).groupBy("chunk").agg(groups).select("groups", F.explode(terms).alias("term"))
    spread = chunks.select("term", F.explode("groups").alias("g")).select("term", "g.*")
    return spread.groupBy("lang", "source", "term").agg(F.sum("times").alias("times"), F.max("docs").alias("least"), F.sum("docs").alias("most"))


def _bit(lang: Column, term: Column) -> Column:
    return F.pmod(F.crc32(F.concat(F.encode(lang, "utf-8"), F.encode(F.lit("\n"), "utf-8"), F.encode(term, "utf-8"))), F.lit(_BITS))


def exact_docs(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(lang, term, docs): the documents that hold each of the ``wanted`` (lang, term), counted one by one.

    The exact check of the few terms that the bounds leave open. Workers get a bit map of the wanted terms, of a fixed size; what passes it by chance falls out in the join.
    """
    bits = wanted.select(_bit(F.col("lang"), F.col("term")).alias("bit")).select((F.col("bit") / 64).cast("long").alias("word"), F.expr("shiftleft(1L, cast(bit % 64 as int))").alias("one"))
    words = bits.groupBy("word").agg(F.bit_or("one").alias("set")).toArrow()  # _BITS / 64 rows at most
    dense = np.zeros(_BITS // 64, np.int64)
    dense[words.column("word").to_numpy()] = words.column("set").to_numpy()
    table = dense.tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[set, set]] = {}  # by language: the terms met, and those of them that the map has
        found: Counter = Counter()
        size = 0

        def passed() -> pa.RecordBatch:
            keys = list(found)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()), pa.array(list(found.values()), pa.int64())], ["lang", "term", "docs"])

        for batch in batches:
            for lang, value in zip(batch.column("lang").to_pylist(), batch.column("data"), strict=True):
                met, open_terms = known.setdefault(lang, (set(), set()))
                terms = set(_TERM.findall((value.as_py() or b"").lower()))
                fresh = terms - met
                head = zlib.crc32(lang.encode() + b"\n")
                for term in fresh:
                    at = zlib.crc32(term, head) % _BITS
                    if table[at >> 3] >> (at & 7) & 1:
                        open_terms.add(term)
                met |= fresh
                size += len(fresh)
                found.update([(lang, t) for t in terms & open_terms])
            if size > _HELD:
                known, size = {}, 0
            if len(found) > _HELD:
                yield passed()
                found.clear()
        yield passed()

    counted = rows.select("lang", "data").mapInArrow(run, "lang string, term binary, docs long").withColumn("term", F.col("term").cast("string"))
    return counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).join(wanted.select("lang", "term"), ["lang", "term"])


def _share(times: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (times + SMOOTH) / (total + SMOOTH * kept)), in whole numbers of 38 digits."""
    above = F.lit(SCALE).cast("decimal(12,0)") * (times + F.lit(SMOOTH)).cast("decimal(20,0)")
    below = (total + F.lit(SMOOTH) * kept).cast("decimal(20,0)")
    return F.call_function("div", above, below) + F.lit(1).cast("long")


def pair_sums(counts: DataFrame, groups: DataFrame, buckets: int) -> DataFrame:
    """(lang, source, item, value) for all ordered pairs of a language's sources: the sum over its terms of |p - q|.

    Terms are dealt into ``buckets`` by hash, and every bucket gets its language's sources; a task fills a matrix
    of the bucket's terms by sources and adds up the differences of its columns. No pair of rows is formed.
    """
    left = counts.select("lang", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket"), "term", "source", "p")
    right = groups.select("lang", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"), "source", "p_none")

    def run(terms: pa.Table, sources: pa.Table) -> pa.Table:
        names = sources.column("source").to_pylist()
        place = {s: i for i, s in enumerate(names)}
        codes = terms.column("term").combine_chunks().dictionary_encode()
        codes = codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
        matrix = np.tile(sources.column("p_none").to_numpy(), (len(codes.dictionary), 1))
        matrix[codes.indices.to_numpy(), [place[s] for s in terms.column("source").to_pylist()]] = terms.column("p").to_numpy()
        n, lang = len(names), sources.column("lang")[0].as_py()
        sums = np.stack([np.abs(matrix[:, i : i + 1] - matrix).sum(axis=0) for i in range(n)])
        one, other = np.nonzero(~np.eye(n, dtype=bool))
        columns = [pa.array([lang] * len(one), pa.string()), pa.array([names[i] for i in one], pa.string()), pa.array([names[i] for i in other], pa.string()), pa.array(sums[one, other])]
        return pa.Table.from_arrays(columns, ["lang", "source", "item", "value"])

    parts = left.groupBy("lang", "bucket").cogroup(right.groupBy("lang", "bucket")).applyInArrow(run, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audited(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) for ``docs`` (text, lang, source): see the module's query.

    ``pair`` rows hold a source's distance from every other source of its language, ``term`` rows its ``top_terms``
    terms that are most frequent beside the language as a whole. A language's terms are those of ``min_docs`` of its
    documents: the bounds of ``term_counts`` decide nearly all, the others are counted one by one.

    Null text, lang and source are empty; every row is a document, also one that repeats another. Groups without
    terms take part. Ties rank by item, in the order of UTF-8. Other columns are ignored. An empty table gives no rows.
    """
    rows = _rows(docs)
    counts = stored(term_counts(rows), "audit-terms")
    bounds = counts.groupBy("lang", "term").agg(F.sum("least").alias("least"), F.sum("most").alias("most"))
    bounds = stored(bounds.where(F.col("most") >= min_docs), "audit-bounds")
    exact = exact_docs(rows, bounds.where(F.col("least") < min_docs))
    kept = bounds.where(F.col("least") >= min_docs).select("lang", "term")
    kept = stored(kept.unionByName(exact.where(F.col("docs") >= min_docs).select("lang", "term")), "audit-kept")

    counts = stored(counts.select("lang", "source", "term", "times").join(kept, ["lang", "term"]), "audit-counts")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("times").alias("total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.fillna(0, ["total", "kept"])
    none = F.when(F.col("kept") > 0, _share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))).otherwise(F.lit(0).cast("long"))
    groups = stored(groups.withColumn("p_none", none), "audit-groups")

    of_group = counts.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("times"), F.col("total"), F.col("kept")))
    largest = groups.groupBy("lang").agg((F.max("kept") * F.count("*")).alias("cells")).agg(F.max("cells")).first()[0] or 0
    pairs = pair_sums(of_group, groups, int(largest) // _CELLS + 1).withColumn("part", F.lit("pair"))

    whole = counts.groupBy("lang", "term").agg(F.sum("times").alias("all_times"))
    lang_totals = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    terms = of_group.join(whole, ["lang", "term"]).join(lang_totals, "lang")
    value = F.col("p") - _share(F.col("all_times"), F.col("lang_total"), F.col("kept"))
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value")).where("value > 0")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(order).alias("rank")
    columns = ["lang", "source", "part", "item", "value"]
    return pairs.select(*columns, ranked).unionByName(terms.select(*columns, ranked).where(F.col("rank") <= top_terms))
