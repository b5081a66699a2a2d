"""Where queries and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cells, columns, groups

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def counts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return cells.value_counts(table(spark, sf_dir, name))


def profiled_columns(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return columns.profile_columns(groups.profile_groups(counts(spark, sf_dir, name)))


def shown(column: str, form: str = "yyyy-MM-dd HH:mm:ss"):
    return F.date_format(column, form).alias(column)
