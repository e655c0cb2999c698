"""The whole run, through stored layers, on the test tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from strata.operators import align_to
from strata.plans import Layers, ingest_all, load_silver, run_all, stream_silver
from strata.plans.silver import version_hashes
from strata.schemas import DIMENSIONS, FACT_SALES, ORDER_LINES, SOURCES, Source
from strata.session import remove, scratch_folder, stage
from strata.workload.dimensions import CUSTOMER_DIM_SQL, STOCK_DIM_SQL, T0, T1
from strata.workload.facts import FACT_SKEY_SQL, base_sql, versions_sql
from strata.workload.inputs import (
    CUT,
    EARLY,
    FIRST_LOAD,
    LATE,
    SECOND_LOAD,
    categories,
    customers,
    lines,
    orders,
    people,
    people_sql,
    stock_items,
)
from strata.workload.registry import query, sql_text, sql_time
from strata.workload.versions import CONFIGURED_LINE_VERSIONS_SQL


def reader(spark: SparkSession, folder: str, period: str):
    """The six sources as they stand at the first or the second load."""
    edited = F.col("LastEditedWhen")
    known = (lambda df: df.filter(edited < F.lit(CUT))) if period == EARLY else (lambda df: df)
    tables = {
        "Orders": lambda: known(orders(spark, folder)),
        "OrderLines": lambda: known(lines(spark, folder)),
        "Customers": lambda: customers(spark, folder, period),
        "CustomerCategories": lambda: categories(spark, folder),
        "StockItems": lambda: stock_items(spark, folder, period),
        "People": lambda: people(spark, folder, period),
    }
    schemas = {source.table: _widened(source) for source in SOURCES}
    return lambda schema, table: align_to(tables[table](), schemas[table])


def _widened(source: Source) -> StructType:
    """The declared columns with 64-bit keys: large data has more lines than an int can number."""
    return StructType(
        [StructField(f.name, LongType() if isinstance(f.dataType, IntegerType) else f.dataType) for f in source.schema]
    )


def _layers(spark: SparkSession) -> Layers:
    run = uuid4().hex
    return Layers(spark, f"{scratch_folder(spark)}/layers-{run}", f"run_{run}").set_up()


def _drop(layers: Layers) -> None:
    """All tables and the raw files."""
    layers.drop()
    remove(layers.spark, layers.root)


@query(
    "ingest_all",
    f"""SELECT 'Sales_Orders' AS source_object, 'WWI' AS source_id, count(*) AS n,
           {sql_time(f"TIMESTAMP '{FIRST_LOAD}'", "audit_ts")}, {sql_time("max(o_orderdate)", "marked")}
    FROM orders WHERE o_orderdate < DATE '{CUT}'
    UNION ALL SELECT 'Sales_Orders', 'WWI', count(*), {sql_time(f"TIMESTAMP '{SECOND_LOAD}'", "a")},
           {sql_time("max(o_orderdate)", "m")} FROM orders WHERE o_orderdate >= DATE '{CUT}'
    UNION ALL SELECT 'Sales_OrderLines', 'WWI', count(*), {sql_time(f"TIMESTAMP '{FIRST_LOAD}'", "a")},
           {sql_time("max(l_shipdate)", "m")} FROM lineitem WHERE l_shipdate < DATE '{CUT}'
    UNION ALL SELECT 'Sales_OrderLines', 'WWI', count(*), {sql_time(f"TIMESTAMP '{SECOND_LOAD}'", "a")},
           {sql_time("max(l_shipdate)", "m")} FROM lineitem WHERE l_shipdate >= DATE '{CUT}'""",
)
def ingested_increments(spark: SparkSession, folder: str) -> DataFrame:
    """Two config-driven ingest runs; what each put into the raw layer for the incremental sources."""
    layers = _layers(spark)
    for period, when in ((EARLY, FIRST_LOAD), (LATE, SECOND_LOAD)):
        ingest_all(layers, reader(spark, folder, period), when)
    configs = layers.config("Bronze", "Sales_Orders", "Sales_OrderLines").values()
    result = None
    for config in configs:
        landed = spark.read.parquet(layers.bronze(config)).groupBy("source_id", "audit_ts")
        counts = landed.agg(F.count(F.lit(1)).alias("n"), F.max(config.watermark_column).alias("marked"))
        counts = counts.withColumn("source_object", F.lit(config.source_object))
        result = counts if result is None else result.unionByName(counts)
    result = stage(result, "ingested")
    _drop(layers)
    return result


_LINES = ORDER_LINES.object


@query(
    "silver_stream",
    f"""WITH {CONFIGURED_LINE_VERSIONS_SQL}
    SELECT OrderLineID, OrderID, StockItemID, Description, Quantity, {sql_text("UnitPrice")}, hash_key, row_hash,
           {sql_time("audit_ts")}
    FROM lines_src_versions""",
)
def streamed_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned order lines after two copies, each loaded as a stream of the raw files that it added."""
    layers = _layers(spark)
    for period, when in ((EARLY, FIRST_LOAD), (LATE, SECOND_LOAD)):
        ingest_all(layers, reader(spark, folder, period), when, source_object=_LINES)
        stream_silver(layers, _LINES, f"{layers.root}/checkpoint", when)
    columns = (
        "OrderLineID", "OrderID", "StockItemID", "Description", "Quantity", "UnitPrice", "hash_key", "row_hash", "audit_ts",
    )
    rows, config = layers.silver.read(_LINES), layers.config("Silver", _LINES)[_LINES]
    result = stage(rows, "streamed", derived=version_hashes(rows, config.keys, config.columns)).select(*columns)
    _drop(layers)
    return result


@query(
    "load_metrics",
    f"""WITH {CONFIGURED_LINE_VERSIONS_SQL}, compared AS (
      SELECT CASE WHEN f.OrderLineID IS NULL THEN 'new' WHEN f.row_hash <> s.row_hash THEN 'changed' ELSE 'same' END AS kind
      FROM lines_src_second s LEFT JOIN lines_src_first f USING (OrderLineID))
    SELECT 1 AS load, 'ingest' AS step, 'copied' AS metric, count(*) AS n FROM lines_src WHERE LastEditedWhen < DATE '{CUT}'
    UNION ALL SELECT 2, 'ingest', 'copied', count(*) FROM lines_src WHERE LastEditedWhen >= DATE '{CUT}'
    UNION ALL SELECT load, 'ingest', 'unmarked', 0 FROM range(1, 3) t(load)
    UNION ALL SELECT 1, 'clean', 'new', count(*) FROM lines_src_first
    UNION ALL SELECT 2, 'clean', kind, (SELECT count(*) FROM compared c WHERE c.kind = k.kind)
      FROM (VALUES ('new'), ('changed'), ('same')) k(kind)""",
)
def metrics_of_two_loads(spark: SparkSession, folder: str) -> DataFrame:
    """What two loads of the order lines report, step by step."""
    layers, rows = _layers(spark), []
    for load, (period, when) in enumerate(((EARLY, FIRST_LOAD), (LATE, SECOND_LOAD)), 1):
        (copied,) = ingest_all(layers, reader(spark, folder, period), when, source_object=_LINES)
        for step, result in (("ingest", copied), ("clean", load_silver(layers, _LINES, when))):
            rows += [(load, step, metric, n) for metric, n in result.counts.items()]
    _drop(layers)
    return spark.createDataFrame(rows, "load int, step string, metric string, n long")


# Which version of a member a fact refers to. A member of the first copies was loaded before the first facts, one
# that they use but the copies lack was inferred with them, and others came with the second load. Facts
# that were not replaced by the second load still refer to the version that was active at the first.
def _referred_sql(name: str, key: str, changed: str | None) -> str:
    return f"""{name}_referred AS (
  SELECT k.{key}, e.{key} IS NULL AND l.{key} IS NULL AS unknown,
         CASE WHEN e.{key} IS NOT NULL OR u.{key} IS NOT NULL THEN {T0} ELSE {T1} END AS since,
         {"c." + key + " IS NOT NULL" if changed else "false"} AS changed
  FROM (SELECT DISTINCT {key} FROM facts) k
  LEFT JOIN (SELECT {_SOURCE_KEY[key]} AS {key} FROM {name}_early) e ON e.{key} = k.{key}
  LEFT JOIN (SELECT {_SOURCE_KEY[key]} AS {key} FROM {name}_late) l ON l.{key} = k.{key}
  LEFT JOIN (SELECT DISTINCT {key} FROM first_members) u ON u.{key} = k.{key}
  {f"LEFT JOIN {changed} c ON c.{key} = k.{key}" if changed else ""})"""


_SOURCE_KEY = {"CustomerID": "CustomerID", "StockItemID": "StockItemID", "SalespersonPersonID": "PersonID"}
_REFERRED_SQL = f"""first_members AS (
  SELECT l.StockItemID, o.CustomerID, o.SalespersonPersonID
  FROM lines_src_first l JOIN orders_src_first o ON l.OrderID = o.OrderID),
customers_changed AS (SELECT CustomerID FROM customers_arrived WHERE NOT is_new),
stock_items_changed AS (SELECT StockItemID FROM stock_items_arrived WHERE NOT is_new),
{_referred_sql("customers", "CustomerID", "customers_changed")},
{_referred_sql("stock_items", "StockItemID", "stock_items_changed")},
{_referred_sql("people", "SalespersonPersonID", None)}"""


def _version_sql(alias: str, name: str) -> str:
    new = f"{alias}.changed AND audit_ts = {T1}"
    since = sql_time(f"CASE WHEN {new} THEN {T1} ELSE {alias}.since END", f'"{name}_from"')
    return f"""CASE WHEN {new} THEN 2 ELSE 1 END AS "{name}_version",
           CASE WHEN {alias}.changed AND audit_ts = {T0} THEN 0 ELSE 1 END AS "{name}_active",
           {since}, CAST({alias}.unknown AS INTEGER) AS "{name}_inferred\""""


@query(
    "run_all",
    f"""WITH {versions_sql(CONFIGURED_LINE_VERSIONS_SQL)}, {base_sql("facts")}, {FACT_SKEY_SQL}, {CUSTOMER_DIM_SQL},
    {STOCK_DIM_SQL}, {people_sql(EARLY)}, {people_sql(LATE)}, {_REFERRED_SQL}
    SELECT fact_sales_skey, OrderLineID, OrderID, n.CustomerID, n.CustomerID AS "Dim_Customer",
           n.StockItemID, n.StockItemID AS "Dim_StockItems", n.SalespersonPersonID,
           n.SalespersonPersonID AS "Dim_People", {_version_sql("c", "Dim_Customer")},
           {_version_sql("s", "Dim_StockItems")}, CASE WHEN p.unknown THEN 1
             WHEN n.SalespersonPersonID IS NOT NULL THEN 0 END AS "Dim_People_inferred",
           {sql_text("OrderDate")}, Description, {sql_text("sales_amount_net")}, {sql_text("tax_amount")},
           {sql_text("sales_amount_gross")}, {sql_time("audit_ts")}
    FROM numbered n JOIN customers_referred c ON c.CustomerID = n.CustomerID
    JOIN stock_items_referred s ON s.StockItemID = n.StockItemID
    LEFT JOIN people_referred p ON p.SalespersonPersonID = n.SalespersonPersonID""",
)
def two_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Facts after two full runs, each surrogate key followed back to the key and version of its dimension row."""
    layers = _layers(spark)
    for period, when in ((EARLY, FIRST_LOAD), (LATE, SECOND_LOAD)):
        run_all(layers, reader(spark, folder, period), when)
    facts = layers.gold.read(FACT_SALES)
    versions = []
    for dim in DIMENSIONS:
        kept = ("scd_version", "scd_active", "scd_from", "inferred_flag") if dim.history else ("inferred_flag",)
        named = {c: f"{dim.name}_{c.removeprefix('scd_').removesuffix('_flag')}" for c in kept}
        keys = layers.gold.read(dim.name).select(
            dim.skey, F.col(dim.key).alias(dim.name), *[F.col(c).alias(name) for c, name in named.items()]
        )
        facts = facts.join(keys, dim.skey, "left")
        versions += named.values()
    result = stage(
        facts.select(
            "fact_sales_skey", "OrderLineID", "OrderID", "CustomerID", "Dim_Customer", "StockItemID", "Dim_StockItems",
            "SalespersonPersonID", "Dim_People", *versions, "OrderDate", "Description", "sales_amount_net",
            "tax_amount", "sales_amount_gross", "audit_ts",
        ),
        "run_all",
    )
    _drop(layers)
    return result
