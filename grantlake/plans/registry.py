"""Registered queries over the given tables, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` its result is tested against a model instead."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(pin_utc(spark), sf_dir)

        run.__name__ = name
        run.__doc__ = function.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SPREAD_LIMIT = 64


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table about to go through costly row work, spread if its scan has fewer tasks than cores.

    A scan that already gives enough tasks, as any large table does, is left alone.
    """
    df = table(spark, sf_dir, name)
    wanted = min(spark.sparkContext.defaultParallelism, _SPREAD_LIMIT)
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def plain_time(column: str | Column) -> Column:
    """A UTC instant as a timestamp without zone, as the tables hold it."""
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


# Fixed mapping of the events table onto the feed's operations.
OPERATION_SQL = "case event_type when 'signup' then 'CREATE' when 'error' then 'DELETE' else 'UPDATE' end"


def feed(
    df: DataFrame,
    message_type: str,
    raw: Column,
    ts: str,
    seq: str,
    operation: Column | None = None,
    step: Column | None = None,
    version: str = "1.0",
    tenancy: Column | None = None,
) -> DataFrame:
    """View table rows as decoded events: ``raw`` is the JSON, ``seq`` the arrival column."""
    operation = F.lit("CREATE") if operation is None else operation
    return df.select(
        F.lit(message_type).alias("message_type"),
        operation.alias("operation"),
        operation.alias("operation_type"),
        F.lit(version).alias("event_type_version"),
        (F.lit("T") if tenancy is None else tenancy).alias("tenancy_id"),
        F.lit("S").alias("service_instance_id"),
        F.col(ts).cast("timestamp").alias("event_timestamp"),
        raw.alias("raw"),
        (F.lit(0).cast("long") if step is None else step).alias("_step"),
        F.col(seq).alias("_seq"),
    )


def json_of(**fields: Column | str) -> Column:
    """The fields as a JSON object; NULL fields are left out."""
    return F.to_json(F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()]))


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")
