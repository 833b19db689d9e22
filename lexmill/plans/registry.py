"""All queries over the reference's operators, by name, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a function (spark, sf_dir) -> DataFrame under its name, with SQL that gives the same rows."""

    def put(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all() -> None:
    """Imports the modules that register queries."""
    from lexmill.plans import chunk_queries, eval_queries, gold_queries, io_queries, page_queries, retrieval_queries, synth_queries  # noqa: F401
