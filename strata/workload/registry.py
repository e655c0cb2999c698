"""Registration of queries and small helpers that both sides of a check share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from strata.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query of (spark, folder) under a name, with its SQL where it has one."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return as_text(build(configure(spark), folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def as_text(df: DataFrame) -> DataFrame:
    """Dates, timestamps and decimals as text, so that no client library rounds or shifts them."""
    columns = []
    for f in df.schema:
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            columns.append(F.date_format(f.name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name))
        elif isinstance(f.dataType, (DateType, DecimalType)):
            columns.append(F.col(f.name).cast("string").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def sql_time(expression: str, name: str | None = None) -> str:
    """SQL twin of ``as_text`` for a timestamp."""
    text = f"strftime(CAST({expression} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')"
    return f"{text} AS {name or expression}"


def sql_text(expression: str, name: str | None = None) -> str:
    """SQL twin of ``as_text`` for a date or decimal."""
    return f"CAST({expression} AS VARCHAR) AS {name or expression}"


def sql_hash(*columns: str) -> str:
    """SQL twin of ``hash_expr``."""
    return "sha256(concat_ws('||', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in columns) + "))"
