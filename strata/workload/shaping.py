"""Cleaning, projections, hashes and surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions import hash_expr, with_sales_measures
from strata.operators import (
    add_surrogate_key,
    align_to,
    calendar_between,
    clean_strings,
    conform,
    dates_to_timestamp,
    drop_columns,
    max_skey,
    row_hash,
    select_configured,
    with_hash_key,
)
from strata.workload.inputs import LINES_SQL, lines, table
from strata.workload.registry import query, sql_hash, sql_text, sql_time

# A comment that is blank for some orders and padded for the others.
_COMMENT_SQL = "CASE WHEN o_orderstatus = 'P' THEN '   ' ELSE ' ' || o_orderpriority || '  ' END"


def _commented(spark: SparkSession, folder: str) -> DataFrame:
    padded = F.concat(F.lit(" "), "o_orderpriority", F.lit("  "))
    blank = F.when(F.col("o_orderstatus") == "P", F.lit("   ")).otherwise(padded)
    return table(spark, folder, "orders").withColumn("comment", blank)


@query(
    "clean_strings",
    f"""SELECT o_orderkey, nullif(trim(o_orderstatus), '') AS o_orderstatus,
           nullif(trim(o_orderpriority), '') AS o_orderpriority, nullif(trim({_COMMENT_SQL}), '') AS comment
    FROM orders""",
)
def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return clean_strings(_commented(spark, folder)).select("o_orderkey", "o_orderstatus", "o_orderpriority", "comment")


@query(
    "dates_to_timestamp",
    f"""SELECT o_orderkey, {sql_time("o_orderdate")}, {sql_time("CAST(o_orderdate AS DATE) + 30", "due")}
    FROM orders""",
)
def as_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    due = F.date_add(F.to_date("o_orderdate"), 30)
    return dates_to_timestamp(table(spark, folder, "orders").withColumn("due", due)).select(
        "o_orderkey", "o_orderdate", "due"
    )


@query("drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def without_unwanted(spark: SparkSession, folder: str) -> DataFrame:
    dated = _commented(spark, folder).withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    return drop_columns(dated, ["COMMENT", "O_OrderPriority", "o_orderdate"])


@query(
    "select_configured",
    f"SELECT c_custkey, c_name, c_acctbal, {sql_time("TIMESTAMP '2024-01-01'", 'audit_ts')} FROM customer",
)
def configured(spark: SparkSession, folder: str) -> DataFrame:
    stamped = table(spark, folder, "customer").withColumn("audit_ts", F.lit("2024-01-01").cast("timestamp"))
    return select_configured(stamped, ["c_custkey"], ["c_name", "c_custkey", "c_acctbal"])


@query(
    "align_to_target",
    f"""SELECT CAST(NULL AS BIGINT) AS skey, CAST(c_custkey AS VARCHAR) AS c_custkey,
           {sql_text("CAST(c_acctbal AS DECIMAL(18,4))", "c_acctbal")}, CAST(NULL AS VARCHAR) AS c_comment, c_name
    FROM customer""",
)
def aligned(spark: SparkSession, folder: str) -> DataFrame:
    target = StructType.fromDDL(
        "skey long, c_custkey string, c_acctbal decimal(18,4), c_comment string, c_name string"
    )
    return align_to(table(spark, folder, "customer"), target)


@query(
    "conform_types",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS o_totalprice,
           {sql_text("CAST(o_orderdate AS DATE)", "o_orderdate")},
           TRY_CAST(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS INTEGER) AS priority,
           CASE WHEN o_orderstatus = 'F' AND TRY_CAST(o_orderpriority AS INTEGER) IS NULL THEN o_orderpriority END AS rescued_priority,
           CASE WHEN o_orderstatus = 'F' AND TRY_CAST(o_orderpriority AS INTEGER) IS NULL THEN 1 ELSE 0 END AS n_rescued
    FROM orders""",
)
def conformed(spark: SparkSession, folder: str) -> DataFrame:
    # Text of which one part is a number and the other isn't.
    text = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise(F.col("o_custkey").cast("string"))
    orders = table(spark, folder, "orders").withColumn("priority", text)
    target = StructType.fromDDL("o_orderkey string, o_totalprice long, o_orderdate date, priority int")
    done = conform(orders, target, rescued="_rescued")
    return done.withColumns(
        {"rescued_priority": F.element_at("_rescued", "priority"), "n_rescued": F.size("_rescued")}
    ).drop("_rescued")


@query(
    "hash_key",
    f"""SELECT l_orderkey, l_linenumber, {sql_hash("l_orderkey", "l_linenumber")} AS hash_key,
           {sql_hash("nullif(l_returnflag, 'N')", "l_linestatus")} AS status_hash
    FROM lineitem""",
)
def key_hashes(spark: SparkSession, folder: str) -> DataFrame:
    hashed = with_hash_key(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])
    status = hash_expr([F.nullif("l_returnflag", F.lit("N")), "l_linestatus"])
    return hashed.select("l_orderkey", "l_linenumber", "hash_key", status.alias("status_hash"))


@query(
    "hash_key_safe",
    r"""WITH escaped AS (
      SELECT o_orderkey, coalesce(replace(replace(nullif(o_orderstatus, 'P') || '|\', '\', '\\'), '|', '\|'), '\N') AS a,
             replace(replace(o_orderpriority, '\', '\\'), '|', '\|') AS b
      FROM orders)
    SELECT o_orderkey, sha256(a || '||' || b) AS hash_key FROM escaped""",
)
def escaped_hashes(spark: SparkSession, folder: str) -> DataFrame:
    status = F.concat(F.nullif("o_orderstatus", F.lit("P")), F.lit("|\\"))
    orders = table(spark, folder, "orders").withColumn("status", status)
    return with_hash_key(orders, ["status", "o_orderpriority"], safe=True).select("o_orderkey", "hash_key")


_LISTED = ["StockItemID", "OrderLineID", "Description", "UnitPrice", "PickedQuantity", "audit_ts", "NotThere"]
_ROW_HASH_COLUMNS = ["OrderLineID", "StockItemID", "Quantity", "UnitPrice"]


@query(
    "row_hash_sorted",
    f"""WITH {LINES_SQL}
    SELECT {", ".join(_ROW_HASH_COLUMNS[:3])},
           {sql_hash("Description", "OrderLineID", "PickedQuantity", "StockItemID", "UnitPrice")} AS row_hash
    FROM lines_src""",
)
def sorted_row_hashes(spark: SparkSession, folder: str) -> DataFrame:
    rows = lines(spark, folder)
    return rows.select("OrderLineID", "StockItemID", "Quantity", row_hash(rows, _LISTED).alias("row_hash"))


@query(
    "row_hash_config",
    f"""WITH {LINES_SQL}
    SELECT {", ".join(_ROW_HASH_COLUMNS[:3])},
           {sql_hash("StockItemID", "Description", "UnitPrice", "PickedQuantity")} AS row_hash
    FROM lines_src""",
)
def ordered_row_hashes(spark: SparkSession, folder: str) -> DataFrame:
    rows = lines(spark, folder)
    version = row_hash(rows, _LISTED, order="given", exclude=["OrderLineID"])
    return rows.select("OrderLineID", "StockItemID", "Quantity", version.alias("row_hash"))


@query(
    "surrogate_keys",
    """SELECT (SELECT max(p_partkey) FROM part)
             + row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS line_skey,
           l_orderkey, l_linenumber, l_partkey, l_suppkey
    FROM lineitem""",
)
def numbered(spark: SparkSession, folder: str) -> DataFrame:
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    start = max_skey(table(spark, folder, "part"), "p_partkey")
    return add_surrogate_key(table(spark, folder, "lineitem").select(*order), "line_skey", order, start=start).drop(
        "l_shipdate"
    )


@query(
    "dim_date",
    f"""WITH days AS (
      SELECT CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT date_trunc('year', min(o_orderdate)) AS d0, max(o_orderdate) AS d1 FROM orders))
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, {sql_text("d", "full_date")},
           CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
           'Q' || quarter(d) AS quarter_name, CAST(month(d) AS INTEGER) AS month,
           strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_short, CAST(day(d) AS INTEGER) AS day,
           CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
           strftime(d, '%a') AS day_short, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
           dayofweek(d) IN (0, 6) AS is_weekend, day(d) = 1 AS is_month_start,
           last_day(d) = d AS is_month_end, CAST(strftime(d, '%Y%m') AS INTEGER) AS year_month_key,
           year(d) || '-Q' || quarter(d) AS year_quarter
    FROM days""",
)
def calendar_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    bounds = table(spark, folder, "orders").agg(
        F.to_date(F.date_trunc("year", F.min("o_orderdate"))).alias("start"), F.to_date(F.max("o_orderdate")).alias("end")
    )
    return calendar_between(bounds)


@query(
    "sales_measures",
    f"""WITH {LINES_SQL}, base AS (
      SELECT OrderLineID, LastEditedWhen, StockItemID,
             CAST(Quantity AS DECIMAL(18,4)) AS Quantity, CAST(UnitPrice AS DECIMAL(18,4)) AS UnitPrice,
             CAST(TaxRate AS DECIMAL(18,4)) AS TaxRate, CAST(coalesce(PickedQuantity, 0) AS DECIMAL(18,4)) AS PickedQuantity
      FROM lines_src), net AS (
      SELECT *, CAST(CAST(Quantity AS DECIMAL(28,4)) * UnitPrice AS DECIMAL(18,4)) AS sales_amount_net FROM base), taxed AS (
      SELECT *, CAST(CAST(sales_amount_net AS DECIMAL(28,4)) * TaxRate * 0.01 AS DECIMAL(18,4)) AS tax_amount FROM net)
    SELECT OrderLineID, StockItemID, {sql_time("LastEditedWhen")}, {sql_text("PickedQuantity")},
           {sql_text("sales_amount_net")}, {sql_text("tax_amount")},
           {sql_text("CAST(sales_amount_net + tax_amount AS DECIMAL(18,4))", "sales_amount_gross")}
    FROM taxed""",
)
def measured(spark: SparkSession, folder: str) -> DataFrame:
    return with_sales_measures(lines(spark, folder)).select(
        "OrderLineID", "StockItemID", "LastEditedWhen", "PickedQuantity",
        "sales_amount_net", "tax_amount", "sales_amount_gross",
    )

