"""What several operators of this subpackage share: shared-folder storage, row salts and Arrow batches."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recogna.session import ensure_checkpoint_dir

#: ``[\x20\x09-\x0D]``, the white space of the word and line rules.
WHITE = " \t\n\x0b\f\r"
#: The same characters as a Java pattern.
WHITE_RUN = r"[\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. For a text of one byte a character ``lower`` does that, and faster."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def known_to_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if it isn't installed there."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder, which driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there, whatever executor is lost."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def widened(schema: StructType, **more: str) -> StructType:
    """A schema with further columns; the given one stays as it is."""
    return StructType([*schema.fields, *StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in more.items())).fields])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_batches(batches: Iterable[pa.RecordBatch], column: str, most_chars: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of Arrow batches whose texts (null: empty) hold about ``most_chars`` characters, so that what a
    tokenizer makes of one slice stays small; a longer text is a slice of its own."""
    for batch in batches:
        texts = ["" if t is None else t for t in batch.column(column).to_pylist()]
        begin = held = 0
        for at, text in enumerate(texts):
            if held and held + len(text) > most_chars:
                yield batch.slice(begin, at - begin), texts[begin:at]
                begin, held = at, 0
            held += len(text)
        if texts:
            yield batch.slice(begin), texts[begin:]


def with_row_key(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``_id`` and ``_mark``, by which results computed from a text find its row again. Rows with the same
    id and text share the key, and whatever follows from the text is the same for them; a null id has a stand-in."""
    return docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))).withColumn("_mark", F.xxhash64(text_col))


ROW_KEY = ["_id", "_mark"]


def aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with free names for its columns that are called like ``names`` (in any case), begin with ``_`` or are no
    plain words, and the map back to their own names. Without such columns ``docs`` comes back as it is."""
    reserved = {n.lower() for n in names}
    taken = {c.lower() for c in docs.columns} | reserved
    free = (name for k in count() if (name := f"aside{k}") not in taken)
    other = {c: next(free) for c in docs.columns if c.lower() in reserved or not re.fullmatch("[A-Za-z][A-Za-z0-9_]*", c)}
    return (docs.withColumnsRenamed(other) if other else docs), {new: old for old, new in other.items()}


def renamed_back(out: DataFrame, own: dict[str, str]) -> DataFrame:
    return out.withColumnsRenamed(own) if own else out


def clash_free(*names: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """For operators that return the columns of their table: those called like ``names``, which the operator uses
    for itself, or beginning with ``_`` have other names while it works and come back as they were."""

    def decorate(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(operator)
        def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
            rows, own = aside(docs, *names)
            return renamed_back(operator(rows, *args, **kwargs), own)

        return run

    return decorate
