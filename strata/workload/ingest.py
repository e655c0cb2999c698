"""Extracts, raw layer and watermark log."""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_folder, stage
from strata.sources.bronze import (
    add_lineage,
    extract_delta,
    extract_full,
    newer_than,
    read_bronze,
    source_high_water,
    write_bronze,
)
from strata.sources.metadata import latest_watermarks, reset_watermark
from strata.sources.tables import Tables
from strata.workload.inputs import FIRST_LOAD, table
from strata.workload.registry import query, sql_time

_BOUND = datetime(1998, 1, 1)
_SINCE = datetime(2024, 1, 20, 12)


@query(
    "extract_full",
    f"""SELECT c_custkey, c_name, c_mktsegment, 'WWI' AS source_id, {sql_time(f"TIMESTAMP '{FIRST_LOAD}'", "audit_ts")}
    FROM customer""",
)
def extract_all_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = extract_full(table(spark, folder, "customer"), ["c_custkey", "c_name", "c_mktsegment"])
    return add_lineage(rows, "WWI", FIRST_LOAD)


@query(
    "extract_delta",
    f"""WITH marked AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS o_orderdate FROM orders)
    SELECT o_orderkey, o_custkey, {sql_time("o_orderdate")} FROM marked
    WHERE o_orderdate IS NULL OR o_orderdate > TIMESTAMP '{_BOUND}' AND o_orderdate <= (SELECT max(o_orderdate) FROM marked)""",
)
def extract_between_marks(spark: SparkSession, folder: str) -> DataFrame:
    """Some orders have no mark; every extract takes them."""
    mark = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    orders = table(spark, folder, "orders").withColumn("o_orderdate", mark)
    high = source_high_water(orders, "o_orderdate").first()[0]
    return extract_delta(orders, ["o_orderkey", "o_custkey", "o_orderdate"], "o_orderdate", _BOUND, high)


@query(
    "append_evolve",
    """SELECT c_custkey, c_name, CAST(NULL AS DOUBLE) AS c_acctbal, NULL AS c_mktsegment FROM customer
    UNION ALL SELECT c_custkey, NULL, c_acctbal, c_mktsegment FROM customer""",
)
def appended_with_new_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer")
    tables = Tables.temporary(spark, scratch_folder(spark))
    tables.create(rows.select("c_custkey", "c_name"), "t")
    tables.append(rows.select("c_mktsegment", "c_custkey", "c_acctbal"), "t", evolve=True)
    result = stage(tables.read("t").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), "evolved")
    tables.drop_database()
    return result


@query(
    "high_water_default",
    f"""SELECT 'orders' AS source, {sql_time("max(o_orderdate)", "high_water")} FROM orders
    UNION ALL SELECT 'lineitem', {sql_time("max(l_shipdate)", "high_water")} FROM lineitem
    UNION ALL SELECT 'events', {sql_time("max(ts)", "high_water")} FROM events
    UNION ALL SELECT 'returned before the first order', {sql_time(
        "coalesce(max(l_shipdate), TIMESTAMP '1900-01-01')", "high_water")}
      FROM lineitem WHERE l_shipdate < TIMESTAMP '1990-01-01'""",
)
def high_water_of_sources(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    sources = {
        "orders": (table(spark, folder, "orders"), "o_orderdate"),
        "lineitem": (lines, "l_shipdate"),
        "events": (table(spark, folder, "events"), "ts"),
        "returned before the first order": (lines.filter(F.col("l_shipdate") < "1990-01-01"), "l_shipdate"),
    }
    result = None
    for name, (source, column) in sources.items():
        row = source_high_water(source, column).select(F.lit(name).alias("source"), "high_water")
        result = row if result is None else result.unionByName(row)
    return result


@query(
    "bronze_partition_range",
    f"""SELECT event_id, user_id, event_type, {sql_time("ts", "audit_ts")},
           CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
    FROM events WHERE ts > TIMESTAMP '{_SINCE}'""",
)
def bronze_since(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn("audit_ts", F.col("ts").cast("timestamp"))
    path = f"{scratch_folder(spark)}/bronze-{uuid4().hex}"
    write_bronze(events, path)
    rows = newer_than(read_bronze(spark, path, _SINCE), "audit_ts", _SINCE)
    return rows.select("event_id", "user_id", "event_type", "audit_ts", "year", "month", "day")


_LOG_SQL = """WITH log AS (
  SELECT ts AS "timestamp",
         CASE WHEN value < 20 THEN 'bronze' WHEN value < 60 THEN 'silver' ELSE 'gold' END AS layer,
         event_type AS object_name, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS key_1
  FROM events)"""


def _log(spark: SparkSession, folder: str) -> DataFrame:
    """Each event as the entry of a load of its type."""
    value = F.col("value")
    return table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(value < 20, "bronze").when(value < 60, "silver").otherwise("gold").alias("layer"),
        F.col("event_type").alias("object_name"),
        F.date_trunc("day", "ts").cast("timestamp").cast("string").alias("key_1"),
        F.lit("datetime").alias("key_1_desc"),
    )


@query(
    "latest_watermark",
    f"""{_LOG_SQL}
    SELECT layer, object_name, {sql_time('max("timestamp")', '"timestamp"')},
           {sql_time('CAST(arg_max(key_1, "timestamp") AS TIMESTAMP)', "watermark")}
    FROM log GROUP BY layer, object_name""",
)
def latest_marks(spark: SparkSession, folder: str) -> DataFrame:
    return latest_watermarks(_log(spark, folder))


@query(
    "reset_watermark",
    f"""{_LOG_SQL}
    SELECT {sql_time('"timestamp"')}, layer, object_name, key_1, 'datetime' AS key_1_desc
    FROM log WHERE layer <> 'bronze'""",
)
def marks_without_bronze(spark: SparkSession, folder: str) -> DataFrame:
    return reset_watermark(_log(spark, folder))


