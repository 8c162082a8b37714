"""Token ids in length-delimited binary records with masked checksums and an offset index.

A file is a run of records. A record is, little-endian:

    8 bytes   payload length
    4 bytes   masked checksum of those 8 bytes
    payload   8 bytes document id, 1 byte 1 if the id is null, 1 byte width of a token id (2 or 4), the ids
    4 bytes   masked checksum of the payload
    1 byte    line feed

A masked checksum is the CRC-32 turned right by 15 bits plus a constant, so that a checksum of data that
holds checksums stays sound. Files are written by Spark's committer and read by its ``binaryFile`` source,
so any store that Spark reaches will do, and a lost task or executor leaves no half file behind.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recogna.llm.common import scratch, stored, text_batches
from recogna.llm.tokens import encoder

END_ID = 2
#: So many records a file at most, so that one file fits a task's memory.
PER_FILE = 1 << 15
_FRAME = struct.Struct("<QI")
_HEAD = struct.Struct("<qBB")
_TAIL = struct.Struct("<I")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    """A record without its closing line feed, which the writer adds; an id that ``width`` can't hold is an error."""
    if len(ids) and int(ids.max()) >> 8 * width:
        raise ValueError(f"token id {ids.max()} takes more than {width} bytes")
    payload = _HEAD.pack(doc_id or 0, doc_id is None, width) + ids.astype(f"<u{width}").tobytes()
    size = struct.pack("<Q", len(payload))
    return size + _TAIL.pack(masked(size)) + payload + _TAIL.pack(masked(payload))


def unframe(data: memoryview, at: int) -> tuple[int | None, np.ndarray, int]:
    """Document id, token ids and the place of the next record; a wrong checksum is an error."""
    size, check = _FRAME.unpack_from(data, at)
    if masked(data[at : at + 8]) != check:
        raise ValueError(f"damaged record length at byte {at}")
    begin = at + _FRAME.size
    payload = data[begin : begin + size]
    if len(payload) < size or masked(payload) != _TAIL.unpack_from(data, begin + size)[0]:
        raise ValueError(f"damaged record at byte {at}")
    doc_id, missing, width = _HEAD.unpack_from(payload)
    ids = np.frombuffer(payload[_HEAD.size :], f"<u{width}").astype("<u4")
    return None if missing else doc_id, ids, begin + size + _TAIL.size + 1


def write_records(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID, width: int = 2) -> None:
    """Encode every text and write it to ``folder`` in ascending id order: by file number, then by place."""
    if width not in (2, 4):
        raise ValueError("a token id takes 2 or 4 bytes")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, "dropped")
        for batch, texts in text_batches(batches, "text"):
            known = zip(batch.column("doc_id").to_pylist(), enc.encode(texts), strict=True)
            frames = [frame(d, np.append(np.frombuffer(ids, "<u4"), np.uint32(end_id)), width) for d, ids in known]
            yield pa.record_batch([pa.array(frames, pa.binary())], ["frame"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    lines = ordered.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value"))
    lines.write.option("compression", "none").option("maxRecordsPerFile", PER_FILE).text(folder)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    name = F.regexp_extract("path", r"part-(\d+)-[^/]*-c(\d+)[^/]*$", 1).cast("long")
    turn = F.regexp_extract("path", r"part-(\d+)-[^/]*-c(\d+)[^/]*$", 2).cast("long")
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select(name.alias("part"), turn.alias("turn"), "content")


def _scan(spark: SparkSession, folder: str, digest: bool) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, turn = batch.column("part")[row].as_py(), batch.column("turn")[row].as_py()
                data = memoryview(batch.column("content")[row].as_buffer())
                at, begun, cols = 0, 0, [[] for _ in range(6)]
                while at < len(data):
                    doc_id, ids, after = unframe(data, at)
                    for c, x in zip(cols, (doc_id, at, after - at, begun, len(ids), zlib.crc32(ids.tobytes()) if digest else None), strict=True):
                        c.append(x)
                    at, begun = after, begun + len(ids)
                n = len(cols[0])
                yield pa.record_batch([pa.array([part] * n, pa.int64()), pa.array([turn] * n, pa.int64()), *(pa.array(c, pa.int64()) for c in cols)], ["part", "turn", "doc_id", "place", "size", "begun", "n_tokens", "ids_crc32"])

    return _files(spark, folder).mapInArrow(run, "part long, turn long, doc_id long, place long, size long, begun long, n_tokens long, ids_crc32 long")


def write_index(spark: SparkSession, folder: str, index: str) -> DataFrame:
    """One row for each record: file (part, turn), place and size in bytes, doc_id, n_tokens, and start, the
    tokens of all records before it. Only one row a file meets in the running sum over files."""
    rows = stored(_scan(spark, folder, digest=False).drop("ids_crc32"), "records-scan")
    files = rows.groupBy("part", "turn").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part", "turn").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", "turn", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    out = rows.join(files, ["part", "turn"]).select("part", "turn", "place", "size", "doc_id", "n_tokens", (F.col("base") + F.col("begun")).alias("start"))
    out.write.parquet(index)
    return spark.read.schema(out.schema).parquet(index)


def read_records(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files, with checksums verified; starts come from the index's
    first record of each file."""
    bases = index.where("place = 0").select("part", "turn", F.col("start").alias("base"))
    rows = _scan(spark, folder, digest=True).join(bases, ["part", "turn"])
    return rows.select("doc_id", (F.col("base") + F.col("begun")).alias("start"), "n_tokens", "ids_crc32")


def fetch(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of the index rows ``wanted``, in any order: each file is cut at their places only,
    without reading the records between. For shuffled reads, pass index rows by their random turn."""
    lists = wanted.groupBy("part", "turn").agg(F.collect_list(F.struct("place", "start")).alias("places"))  # bounded by PER_FILE

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, places in zip(batch.column("content"), batch.column("places").to_pylist(), strict=True):
                data = memoryview(content.as_buffer())
                got = [(*unframe(data, p["place"])[:2], p["start"]) for p in places]
                yield pa.record_batch([pa.array([g[0] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int64()), pa.array([g[1].tolist() for g in got], pa.list_(pa.int64()))], ["doc_id", "start", "ids"])

    found = _files(spark, folder).join(lists, ["part", "turn"]).select("content", "places")
    return found.mapInArrow(run, "doc_id long, start long, ids array<long>")


def encoded_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID, width: int = 2) -> DataFrame:
    """Write records and index to the shared folder and return what reading them back gives.

    Null text is empty: the end id alone. A null id sorts first and comes back null. Rows that repeat an
    id are records each, in the order of a hash of the text. An empty table gives no records.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "records")
    write_records(docs, tokenizer, f"{folder}/data", end_id, width)
    index = write_index(spark, f"{folder}/data", f"{folder}/index")
    return read_records(spark, f"{folder}/data", index)
