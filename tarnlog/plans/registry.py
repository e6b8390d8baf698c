"""All core queries by name, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarnlog.plans import data_queries, log_queries

Query = Callable[[SparkSession, str], DataFrame]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_queries.pipeline_errors(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {**log_queries.QUERIES, **data_queries.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**log_queries.ORACLE, **data_queries.ORACLE}
