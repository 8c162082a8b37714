"""SentencePiece encoding over a relational lattice of words and pieces, and decoding."""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recogna.llm.common import stored, text_batches, widened

Batches = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]
BLANK = "▁"
#: Words of the lattice: the most frequent ones, at most so many and so long, so what is broadcast is bounded.
LATTICE_WORDS = 1 << 17
LATTICE_CHARS = 24
#: Words a task remembers besides.
KNOWN_WORDS = 200_000
#: A word starts with blanks or after a line feed; no piece reaches over either.
WORD = f"\n|{BLANK}*[^{BLANK}\n]+|{BLANK}+"


@dataclass(frozen=True)
class Pieces:
    """A piece table: text, score and id of ordinary pieces, the ids of byte pieces, and the id of the unknown one."""

    rows: tuple[tuple[str, float, int], ...]
    bytes_: tuple[int, ...]
    unknown: int

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.vocab_size())
        of_byte = {model.id_to_piece(i): i for i in every if model.is_byte(i)}
        rows = tuple((model.id_to_piece(i), model.get_score(i), i) for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)))
        if any(BLANK in p.lstrip(BLANK) or "\n" in p for p, _, _ in rows):
            raise ValueError("a piece reaches over a word's start")
        return cls(rows, tuple(of_byte[f"<0x{b:02X}>"] for b in range(256)) if of_byte else (), model.unk_id())

    def fallback(self, char: str) -> list[int]:
        """A character without a piece: its UTF-8 bytes, or the unknown piece."""
        return [self.bytes_[b] for b in char.encode("utf-8", "replace")] if self.bytes_ else [self.unknown]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), "piece string, score double, id int")


def marked(text: Column) -> Column:
    """Blanks as pieces write them, one more before a text that isn't empty."""
    return F.when(F.length(text) > 0, F.concat(F.lit(BLANK), F.replace(text, F.lit(" "), F.lit(BLANK)))).otherwise("")


def lattice(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """(word, edges): for every word the pieces on it, each with start, end, score and id.

    Substrings up to the longest piece meet the piece table in an equi-join and are grouped by their word, which
    has no more than (its length) x ``longest`` of them.
    """
    spans = words.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("start"))
    ends = F.sequence(F.col("start"), F.least(F.length("word"), F.col("start") + longest - 1))
    spans = spans.select("word", "start", F.explode(ends).alias("end"))
    spans = spans.withColumn("piece", F.substring(F.col("word"), F.col("start"), F.col("end") - F.col("start") + 1))
    met = spans.join(F.broadcast(pieces), "piece")  # the table of one model, whatever the data
    edges = met.groupBy("word").agg(F.collect_list(F.struct("start", "end", "piece", "score", "id")).alias("edges"))
    return words.join(edges, "word", "left").select("word", F.coalesce("edges", F.array().cast(edges.schema["edges"].dataType)).alias("edges"))


def best_paths(of: DataFrame) -> DataFrame:
    """Viterbi over each word's edges, for models whose scores add up (unigram): (word, path of edge structs).

    The state holds, for every place in the word, the best score and path to it. A character without a piece is an
    edge of its own with a null id and a score below all others; of equal scores the longer last piece wins.
    """
    kind = "struct<score:double,path:array<struct<piece:string,id:int>>>"
    begin = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<struct<piece:string,id:int>>").alias("path")).cast(kind))

    def reach(state: Column, end: Column) -> Column:
        known = F.transform(
            F.filter("edges", lambda e: e["end"] == end),
            lambda e: F.struct(
                (F.get(state, e["start"] - 1)["score"] + e["score"]).alias("score"),
                (e["end"] - e["start"]).alias("wide"),
                F.concat(F.get(state, e["start"] - 1)["path"], F.array(F.struct(e["piece"].alias("piece"), e["id"].alias("id")))).alias("path"),
            ),
        )
        before = F.get(state, end - 1)
        single = F.struct(F.substring(F.col("word"), end, F.lit(1)).alias("piece"), F.lit(None).cast("int").alias("id"))
        missing = F.struct((before["score"] - 1e6).alias("score"), F.lit(0).alias("wide"), F.concat(before["path"], F.array(single)).alias("path"))
        best = F.array_max(F.concat(known, F.array(missing)))
        return F.concat(state, F.array(F.struct(best["score"].alias("score"), best["path"].alias("path")).cast(kind)))

    states = F.aggregate(F.sequence(F.lit(1), F.length("word")), begin, reach)
    return of.select("word", F.element_at(states, -1)["path"].alias("path"))


def merged_paths(of: DataFrame) -> DataFrame:
    """Pair merging over each word's edges, for BPE models: (word, path of piece and id).

    The state holds the word's symbols. Each step joins the neighbours whose piece has the highest score, the
    leftmost of equal ones; a word of n characters is done after n - 1 steps.
    """
    scores = F.map_from_entries(F.array_distinct(F.transform("edges", lambda e: F.struct(e["piece"], (-e["score"]).alias("cost")))))
    ids = F.map_from_entries(F.array_distinct(F.transform("edges", lambda e: F.struct(e["piece"], e["id"]))))

    def join_best(symbols: Column, _: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.size(symbols) - 2), lambda i: F.struct(F.element_at(F.col("scores"), F.concat(F.get(symbols, i), F.get(symbols, i + 1))).alias("cost"), i.alias("i")))
        best = F.array_min(F.filter(pairs, lambda p: p["cost"].isNotNull()))["i"]
        both = F.array(F.concat(F.get(symbols, best), F.get(symbols, best + 1)))
        joined = F.concat(F.slice(symbols, F.lit(1), best), both, F.slice(symbols, best + 3, F.size(symbols)))
        return F.when(F.size(symbols) < 2, symbols).otherwise(F.coalesce(joined, symbols))

    symbols = F.aggregate(F.sequence(F.lit(1), F.length("word")), F.split("word", ""), join_best)
    frame = of.select("word", scores.alias("scores"), ids.alias("ids")).select("word", "ids", symbols.alias("symbols"))
    return frame.select("word", F.transform("symbols", lambda s: F.struct(s.alias("piece"), F.element_at("ids", s).alias("id"))).alias("path"))


def merge(word: str, costs: dict[str, float]) -> list[str]:
    """The same merging for one word in a task, with a heap of neighbours, for words of any length."""
    symbols: list[str | None] = list(word)
    after = list(range(1, len(symbols) + 1))
    before = list(range(-1, len(symbols) - 1))
    heap = [(costs[p], i, p) for i in range(len(symbols) - 1) if (p := word[i : i + 2]) in costs]
    heapq.heapify(heap)
    while heap:
        _, i, both = heapq.heappop(heap)
        left, j = symbols[i], after[i]
        if left is None or j >= len(symbols) or symbols[j] is None or left + symbols[j] != both:
            continue
        symbols[i], symbols[j], after[i] = both, None, after[j]
        if after[i] < len(symbols):
            before[after[i]] = i
            if (p := both + symbols[after[i]]) in costs:
                heapq.heappush(heap, (costs[p], i, p))
        if before[i] >= 0 and (p := symbols[before[i]] + both) in costs:
            heapq.heappush(heap, (costs[p], before[i], p))
    return [s for s in symbols if s is not None]


def frequent_words(docs: DataFrame, most: int = LATTICE_WORDS, longest: int = LATTICE_CHARS) -> DataFrame:
    """(word): those of at most ``longest`` characters found so often that no more than ``most`` are.

    All words of all documents are counted; the threshold comes from the counts of counts."""
    words = docs.select(F.explode(F.regexp_extract_all(marked(F.col("text")), F.lit(WORD), F.lit(0))).alias("word"))
    counts = stored(words.where(F.length("word") <= longest).groupBy("word").agg(F.count("*").alias("n")), "piece-words")
    by_count = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(most).collect()  # distinct counts: few
    total, least = 0, None
    for r in by_count:
        total += r["words"]
        if total > most:
            break
        least = r["n"]
    return counts.where(F.lit(False) if least is None else F.col("n") >= least).select("word")


def _encoding(rows: DataFrame, pieces: Pieces, most: int) -> Batches:
    """What encodes the batches of a task: the corpus's frequent words are encoded over the lattice and broadcast."""
    spark = rows.sparkSession
    longest = max(len(p) for p, _, _ in pieces.rows)
    paths = merged_paths(lattice(frequent_words(rows.select("text"), most), pieces.frame(spark), longest))
    costs = {p: -s for p, s, _ in pieces.rows}
    number = {p: i for p, _, i in pieces.rows}

    def packed(symbols: list[tuple[str, int | None]]) -> bytes:
        return np.array([x for s, i in symbols for x in ((i,) if i is not None else pieces.fallback(s))], "<i4").tobytes()

    few = paths.select("word", F.col("path.piece").alias("symbols"), F.col("path.id").alias("numbers")).toArrow()  # at most ``most`` short words
    frequent = {w: packed(list(zip(s, n, strict=True))) for b in few.to_batches() for w, s, n in zip(*(c.to_pylist() for c in b.columns), strict=True)}
    shared = spark.sparkContext.broadcast((frequent, costs, number))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, costs, number = shared.value
        word, known = re.compile(WORD), {}

        def ids_of(w: str) -> bytes:
            got = frequent.get(w) or known.get(w)
            if got is None:
                got = packed([(s, number.get(s)) for s in merge(w, costs)])
                if len(known) < KNOWN_WORDS and len(w) <= LATTICE_CHARS:
                    known[w] = got
            return got

        for batch, texts in text_batches(batches, "text"):
            every = [b"".join([ids_of(w) for w in word.findall(BLANK + t.replace(" ", BLANK))]) if t else b"" for t in texts]
            offsets = np.cumsum([0, *(len(x) // 4 for x in every)])
            ids = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(np.frombuffer(b"".join(every), "<i4"))).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, "ids"])

    return run


def encoded(docs: DataFrame, pieces: Pieces, most: int = LATTICE_WORDS) -> DataFrame:
    """All columns of ``docs`` and ``ids``, array of int, the ids of the whole text.

    The corpus's frequent words are encoded over the lattice and broadcast to the tasks, which encode the rarer
    words by the same merging and put texts together. Texts never leave their partition, so long texts,
    copies and hot sources only cost their own words. Null and empty texts have no ids. A column of
    ``docs`` named ``ids`` is replaced.
    """
    rows = docs.drop("ids")
    return rows.mapInArrow(_encoding(rows, pieces, most), widened(rows.schema, ids="array<int>"))


def decode_ids(ids: np.ndarray, table: list[bytes]) -> str:
    """The text of an id sequence: pieces and bytes in a row, blanks restored, the first one taken off."""
    return b"".join([table[i] for i in ids]).decode("utf-8", "replace").replace(BLANK, " ")[1:]


def byte_table(pieces: Pieces) -> list[bytes]:
    size = 1 + max([pieces.unknown, *pieces.bytes_, *(i for _, _, i in pieces.rows)])
    table = [b""] * size
    for p, _, i in pieces.rows:
        table[i] = p.encode()
    for b, i in enumerate(pieces.bytes_):
        table[i] = bytes([b])
    table[pieces.unknown] = " ⁇ ".encode()
    return table


def _decoding(pieces: Pieces) -> Batches:
    table = byte_table(pieces)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                ids = [x.values.to_numpy(zero_copy_only=False) if x.is_valid else np.zeros(0, np.int32) for x in part.column("ids")]
                texts = [decode_ids(x.tolist(), table) for x in ids]
                crcs = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string()), pa.array(crcs, pa.int64())], [*part.schema.names, "decoded", "ids_crc32"])

    return run


def decoded(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """All columns of ``docs`` with ``decoded``, the text of ``ids``, and ``ids_crc32`` of them as little-endian
    unsigned 32-bit numbers. No ids give an empty text; null ids count as none."""
    rows = docs.drop("decoded", "ids_crc32")
    return rows.mapInArrow(_decoding(pieces), widened(rows.schema, decoded="string", ids_crc32="long"))


def round_trip(docs: DataFrame, pieces: Pieces, most: int = LATTICE_WORDS) -> DataFrame:
    """What ``decoded`` gives of ``encoded``, in one pass: a task needs one Python worker, not two, and texts and ids
    don't go through the JVM between the two steps."""
    rows = docs.drop("ids", "decoded", "ids_crc32")
    encode, decode = _encoding(rows, pieces, most), _decoding(pieces)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return decode(encode(batches))

    return rows.mapInArrow(run, widened(rows.schema, ids="array<int>", decoded="string", ids_crc32="long"))
