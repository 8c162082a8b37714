"""Registered queries, the inventory ids they cover and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from recogna.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}


def line_count(spark: SparkSession, sf_dir: str) -> int:
    """Lines of the input, from the files' footers; 0 without such a table."""
    try:
        return spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise


def query(name: str, *covers: str, sql: str | None = None, line_joins: bool = False) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark, line_count(spark, sf_dir), line_joins)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        COVERS[name] = covers
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
