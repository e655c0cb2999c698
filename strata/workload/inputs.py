"""The test tables in the shape of the six sources, and two states of each dimension source.

The states come from the data: customers with orders, and parts and suppliers with
shipments, in an early and in a late period. Members seen only late are new, only early
deleted, and an attribute taken from the period's rows makes the changed ones.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_LOAD, SECOND_LOAD = datetime(2024, 1, 1), datetime(2024, 2, 1)
CUT = date(1999, 1, 1)  # orders and lines edited before it belong to the first load

EARLY, LATE = "early", "late"
_PERIODS = {
    "customer": (date(1996, 10, 1), date(1999, 10, 1)),
    "part": (date(1995, 7, 1), date(2001, 7, 1)),
    "supplier": (date(1995, 1, 15), date(2001, 10, 1)),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def load_time(when: datetime) -> Column:
    return F.lit(when).cast("timestamp")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    day = F.to_date("o_orderdate")
    rank = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.substring("o_orderpriority", 1, 1).cast("long"))
    return o.select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("o_custkey").alias("CustomerID"),
        rank.alias("SalespersonPersonID"),
        day.alias("OrderDate"),
        F.date_add(day, 7).alias("ExpectedDeliveryDate"),
        F.col("o_orderstatus").alias("Comments"),
        F.col("o_orderdate").cast("timestamp").alias("LastEditedWhen"),
    )


def lines(spark: SparkSession, folder: str) -> DataFrame:
    line = table(spark, folder, "lineitem")
    quantity = F.col("l_quantity").cast("long")
    return line.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("OrderLineID"),
        F.col("l_orderkey").alias("OrderID"),
        F.col("l_partkey").alias("StockItemID"),
        F.concat(F.lit("  "), "l_returnflag", F.lit(" "), "l_linestatus", F.lit(" ")).alias("Description"),
        quantity.alias("Quantity"),
        money("l_extendedprice").alias("UnitPrice"),
        (F.col("l_tax") * 100).cast("decimal(18,3)").alias("TaxRate"),
        F.when(F.col("l_returnflag") != "N", quantity).alias("PickedQuantity"),
        F.col("l_shipdate").cast("timestamp").alias("LastEditedWhen"),
    )


def customers(spark: SparkSession, folder: str, period: str) -> DataFrame:
    seen = _seen(table(spark, folder, "orders"), "customer", period, "o_custkey", "o_orderdate", "o_orderpriority")
    return table(spark, folder, "customer").join(seen, F.col("c_custkey") == F.col("_member")).select(
        F.col("c_custkey").alias("CustomerID"),
        F.col("c_name").alias("CustomerName"),
        F.col("c_nationkey").cast("long").alias("CustomerCategoryID"),
        money("c_acctbal").alias("CreditLimit"),
        F.col("_trait").alias("DeliveryPostalCode"),
    )


def categories(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("long").alias("CustomerCategoryID"), F.col("n_name").alias("CustomerCategoryName")
    )


def stock_items(spark: SparkSession, folder: str, period: str) -> DataFrame:
    seen = _seen(table(spark, folder, "lineitem"), "part", period, "l_partkey", "l_shipdate", "l_returnflag")
    return table(spark, folder, "part").join(seen, F.col("p_partkey") == F.col("_member")).select(
        F.col("p_partkey").alias("StockItemID"),
        F.col("p_name").alias("StockItemName"),
        F.col("p_brand").alias("Brand"),
        F.col("p_size").cast("string").alias("Size"),
        money("p_retailprice").alias("UnitPrice"),
        F.col("_trait").alias("Tags"),
    )


def people(spark: SparkSession, folder: str, period: str) -> DataFrame:
    seen = _seen(table(spark, folder, "lineitem"), "supplier", period, "l_suppkey", "l_shipdate", "l_linestatus")
    return table(spark, folder, "supplier").join(seen, F.col("s_suppkey") == F.col("_member")).select(
        F.col("s_suppkey").alias("PersonID"),
        F.col("s_name").alias("FullName"),
        F.concat("s_name", F.lit("@"), "_trait").alias("EmailAddress"),
    )


def _seen(rows: DataFrame, member_table: str, period: str, member: str, day: str, trait: str) -> DataFrame:
    first_end, last_start = _PERIODS[member_table]
    in_period = F.col(day) < F.lit(first_end) if period == EARLY else F.col(day) >= F.lit(last_start)
    return rows.filter(in_period).groupBy(F.col(member).alias("_member")).agg(F.max(trait).alias("_trait"))


def with_load(df: DataFrame, when: datetime) -> DataFrame:
    return df.withColumns({"source_id": F.lit("WWI"), "audit_ts": load_time(when)})


# SQL twins of the frames above, as common table expressions without the leading WITH.


def _sql_seen(member_table: str, period: str, rows: str, member: str, day: str, trait: str) -> str:
    first_end, last_start = _PERIODS[member_table]
    test = f"< DATE '{first_end}'" if period == EARLY else f">= DATE '{last_start}'"
    return f"SELECT {member} AS member, max({trait}) AS trait FROM {rows} WHERE {day} {test} GROUP BY {member}"


ORDERS_SQL = """orders_src AS (
  SELECT o_orderkey AS OrderID, o_custkey AS CustomerID,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(substr(o_orderpriority, 1, 1) AS BIGINT) END
           AS SalespersonPersonID,
         CAST(o_orderdate AS DATE) AS OrderDate, CAST(o_orderdate AS DATE) + 7 AS ExpectedDeliveryDate,
         o_orderstatus AS Comments, CAST(o_orderdate AS TIMESTAMP) AS LastEditedWhen
  FROM orders)"""

LINES_SQL = """lines_src AS (
  SELECT l_orderkey * 10 + l_linenumber AS OrderLineID, l_orderkey AS OrderID, l_partkey AS StockItemID,
         '  ' || l_returnflag || ' ' || l_linestatus || ' ' AS Description,
         CAST(l_quantity AS BIGINT) AS Quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS UnitPrice,
         CAST(l_tax * 100 AS DECIMAL(18,3)) AS TaxRate,
         CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS BIGINT) END AS PickedQuantity,
         CAST(l_shipdate AS TIMESTAMP) AS LastEditedWhen
  FROM lineitem)"""


def customers_sql(period: str) -> str:
    seen = _sql_seen("customer", period, "orders", "o_custkey", "o_orderdate", "o_orderpriority")
    return f"""customers_{period} AS (
  SELECT c_custkey AS CustomerID, c_name AS CustomerName, CAST(c_nationkey AS BIGINT) AS CustomerCategoryID,
         CAST(c_acctbal AS DECIMAL(18,2)) AS CreditLimit, trait AS DeliveryPostalCode
  FROM customer JOIN ({seen}) ON c_custkey = member)"""


def stock_items_sql(period: str) -> str:
    seen = _sql_seen("part", period, "lineitem", "l_partkey", "l_shipdate", "l_returnflag")
    return f"""stock_items_{period} AS (
  SELECT p_partkey AS StockItemID, p_name AS StockItemName, p_brand AS Brand, CAST(p_size AS VARCHAR) AS Size,
         CAST(p_retailprice AS DECIMAL(18,2)) AS UnitPrice, trait AS Tags
  FROM part JOIN ({seen}) ON p_partkey = member)"""


def people_sql(period: str) -> str:
    seen = _sql_seen("supplier", period, "lineitem", "l_suppkey", "l_shipdate", "l_linestatus")
    return f"""people_{period} AS (
  SELECT s_suppkey AS PersonID, s_name AS FullName, s_name || '@' || trait AS EmailAddress
  FROM supplier JOIN ({seen}) ON s_suppkey = member)"""


CATEGORIES_SQL = """categories AS (
  SELECT CAST(n_nationkey AS BIGINT) AS CustomerCategoryID, n_name AS CustomerCategoryName FROM nation)"""

CUSTOMER_COLUMNS = ["CustomerID", "CustomerName", "CustomerCategoryID", "CreditLimit", "DeliveryPostalCode"]
STOCK_COLUMNS = ["StockItemID", "StockItemName", "Brand", "Size", "UnitPrice", "Tags"]
PEOPLE_COLUMNS = ["PersonID", "FullName", "EmailAddress"]
ORDER_COLUMNS = ["OrderID", "CustomerID", "SalespersonPersonID", "OrderDate", "ExpectedDeliveryDate", "LastEditedWhen"]
LINE_COLUMNS = [
    "OrderLineID", "OrderID", "StockItemID", "Description", "Quantity", "UnitPrice", "TaxRate", "PickedQuantity",
    "LastEditedWhen",
]
