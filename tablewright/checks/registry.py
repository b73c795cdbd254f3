"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    run: Query
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        if name in CHECKS:
            raise ValueError(f"{name} is registered twice")
        CHECKS[name] = Check(run, sql)
        return run

    return add


def no_gaps(df: DataFrame, *columns: str) -> DataFrame:
    """Missing numbers as -1, so that every reader of a result sees the same value."""
    return df.fillna(-1, subset=list(columns))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
