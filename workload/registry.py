"""Keeps each query together with the SQL that has to give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str


QUERIES: dict[str, Query] = {}


def query(sql: str):
    """Registers a function under its own name."""

    def register(run):
        if run.__name__ in QUERIES:
            raise ValueError(f"two queries named {run.__name__}")
        QUERIES[run.__name__] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
