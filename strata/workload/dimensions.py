"""Dimension loads, inferred members and lookups."""

from __future__ import annotations

from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import hash_expr
from strata.operators import (
    classify_members,
    dimension_schema,
    enrich,
    fill_inferred,
    infer_members,
    new_members,
    scd1_next,
    scd2_next,
    scd2_recalc,
)
from strata.operators.changes import SAME
from strata.operators.scd import SCD1_TECHNICAL, SCD2_TECHNICAL
from strata.plans.gold import stage_members
from strata.session import stage
from strata.workload.inputs import (
    CATEGORIES_SQL,
    CUSTOMER_COLUMNS,
    EARLY,
    FIRST_LOAD,
    LATE,
    PEOPLE_COLUMNS,
    SECOND_LOAD,
    STOCK_COLUMNS,
    categories,
    customers,
    customers_sql,
    load_time,
    orders,
    people,
    people_sql,
    stock_items,
    stock_items_sql,
    table,
    with_load,
)
from strata.workload.registry import query, sql_hash, sql_text, sql_time

T0, T1 = f"TIMESTAMP '{FIRST_LOAD}'", f"TIMESTAMP '{SECOND_LOAD}'"
OPEN_SQL = "TIMESTAMP '2999-12-31'"


def _load(dim: DataFrame, source: DataFrame, key: str, columns: list[str], skey: str, when: datetime) -> DataFrame:
    """One load as the job does it: members stored, first versions appended, else the next state."""
    staged = stage_members(with_load(source, when), [key], columns)
    members = stage(classify_members(staged, dim, skey).filter(F.col("change_type") != SAME), "members")
    if when == FIRST_LOAD:
        return new_members(members, dim, skey=skey, keys=[key], now=load_time(when))
    step = scd2_next if "scd_from" in dim.columns else scd1_next
    return step(dim, members, skey=skey, keys=[key], attributes=columns, now=load_time(when))


def _dimension(source, key: str, columns: list[str], skey: str, technical: str, periods: tuple[str, ...]) -> DataFrame:
    first = source(EARLY)
    dim = first.sparkSession.createDataFrame([], dimension_schema(first.schema, skey, columns, technical))
    for period, when in zip(periods, (FIRST_LOAD, SECOND_LOAD)):
        dim = _load(dim, source(period), key, columns, skey, when)
    return dim


def stock_dimension(spark: SparkSession, folder: str, *periods: str) -> DataFrame:
    source = partial(stock_items, spark, folder)
    return _dimension(source, "StockItemID", STOCK_COLUMNS, "stockitem_skey", SCD2_TECHNICAL, periods)


def customer_dimension(spark: SparkSession, folder: str, *periods: str) -> DataFrame:
    source = partial(customers, spark, folder)
    return _dimension(source, "CustomerID", CUSTOMER_COLUMNS, "customer_skey", SCD2_TECHNICAL, periods)


def people_dimension(spark: SparkSession, folder: str, *periods: str) -> DataFrame:
    source = partial(people, spark, folder)
    return _dimension(source, "PersonID", PEOPLE_COLUMNS, "person_skey", SCD1_TECHNICAL, periods)


def _scd2_sql(name: str, key: str, columns: list[str], skey: str) -> str:
    """Both loads of a dimension with history: <name>_dim."""
    attributes = [c for c in columns if c != key]

    def hashed(period: str) -> str:
        return f"""{name}_{period}_h AS (
  SELECT *, {sql_hash(key)} AS hash_key, {sql_hash(*attributes)} AS row_hash FROM {name}_{period})"""

    return f"""{hashed(EARLY)}, {hashed(LATE)}, {name}_arrived AS (
  SELECT l.*, e.hash_key IS NULL AS is_new FROM {name}_late_h l
  LEFT JOIN (SELECT hash_key, row_hash AS before FROM {name}_early_h) e USING (hash_key)
  WHERE before IS NULL OR before <> row_hash), {name}_dim AS (
  SELECT row_number() OVER (ORDER BY {key}) AS {skey}, e.*, {T0} AS audit_ts, {T0} AS scd_start, {T0} AS scd_from,
         CASE WHEN a.hash_key IS NULL THEN {OPEN_SQL} ELSE {T1} END AS scd_to,
         CASE WHEN a.hash_key IS NULL THEN 1 ELSE 0 END AS scd_active, 1 AS scd_version
  FROM {name}_early_h e LEFT JOIN (SELECT hash_key FROM {name}_arrived) a USING (hash_key)
  UNION ALL
  SELECT (SELECT count(*) FROM {name}_early_h) + row_number() OVER (ORDER BY {key}), * EXCLUDE (is_new), {T1},
         CASE WHEN is_new THEN {T1} ELSE {T0} END, {T1}, {OPEN_SQL}, 1, CASE WHEN is_new THEN 1 ELSE 2 END
  FROM {name}_arrived)"""


STOCK_DIM_SQL = f"""{stock_items_sql(EARLY)}, {stock_items_sql(LATE)},
{_scd2_sql("stock_items", "StockItemID", STOCK_COLUMNS, "stockitem_skey")}"""
CUSTOMER_DIM_SQL = f"""{customers_sql(EARLY)}, {customers_sql(LATE)},
{_scd2_sql("customers", "CustomerID", CUSTOMER_COLUMNS, "customer_skey")}"""


@query(
    "scd2_load",
    f"""WITH {STOCK_DIM_SQL}
    SELECT stockitem_skey, StockItemID, StockItemName, Brand, Tags, {sql_text("UnitPrice")}, hash_key, row_hash,
           {sql_time("audit_ts")}, {sql_time("scd_start")}, {sql_time("scd_from")}, {sql_time("scd_to")},
           scd_active, scd_version, 0 AS inferred_flag
    FROM stock_items_dim""",
)
def stock_history(spark: SparkSession, folder: str) -> DataFrame:
    return stock_dimension(spark, folder, EARLY, LATE).select(
        "stockitem_skey", "StockItemID", "StockItemName", "Brand", "Tags", "UnitPrice", "hash_key", "row_hash",
        "audit_ts", "scd_start", "scd_from", "scd_to", "scd_active", "scd_version", "inferred_flag",
    )


@query(
    "scd2_load_customers",
    f"""WITH {CUSTOMER_DIM_SQL}
    SELECT customer_skey, CustomerID, CustomerName, {sql_text("CreditLimit")}, DeliveryPostalCode, row_hash,
           {sql_time("scd_from")}, {sql_time("scd_to")}, scd_active, scd_version
    FROM customers_dim""",
)
def customer_history(spark: SparkSession, folder: str) -> DataFrame:
    return customer_dimension(spark, folder, EARLY, LATE).select(
        "customer_skey", "CustomerID", "CustomerName", "CreditLimit", "DeliveryPostalCode", "row_hash",
        "scd_from", "scd_to", "scd_active", "scd_version",
    )


@query(
    "scd1_load",
    f"""WITH {people_sql(EARLY)}, {people_sql(LATE)}
    SELECT CASE WHEN e.PersonID IS NOT NULL THEN dense_rank() OVER (ORDER BY e.PersonID NULLS LAST)
                ELSE (SELECT count(*) FROM people_early)
                     + row_number() OVER (PARTITION BY e.PersonID IS NULL ORDER BY l.PersonID) END AS person_skey,
           coalesce(l.PersonID, e.PersonID) AS PersonID, coalesce(l.FullName, e.FullName) AS FullName,
           coalesce(l.EmailAddress, e.EmailAddress) AS EmailAddress,
           {sql_time(f"CASE WHEN e.EmailAddress = coalesce(l.EmailAddress, e.EmailAddress) THEN {T0} ELSE {T1} END",
                     "audit_ts")},
           {sql_time(f"CASE WHEN e.EmailAddress <> l.EmailAddress THEN {T1} END", "updated_audit_ts")},
           1 AS scd_active, 1 AS scd_version
    FROM people_early e FULL JOIN people_late l ON e.PersonID = l.PersonID""",
)
def people_in_place(spark: SparkSession, folder: str) -> DataFrame:
    return people_dimension(spark, folder, EARLY, LATE).select(
        "person_skey", "PersonID", "FullName", "EmailAddress", "audit_ts", "updated_audit_ts", "scd_active", "scd_version"
    )


@query(
    "scd2_recalc",
    f"""WITH versions AS (SELECT user_id, event_id, ts, {sql_hash("user_id")} AS hash_key FROM events)
    SELECT event_id, user_id, {sql_time("min(ts) OVER (PARTITION BY user_id)", "scd_start")}, {sql_time("ts", "scd_from")},
           {sql_time(f"coalesce(lead(ts) OVER w, {OPEN_SQL})", "scd_to")},
           CASE WHEN lead(ts) OVER w IS NULL THEN 1 ELSE 0 END AS scd_active,
           CAST(row_number() OVER w AS INTEGER) AS scd_version
    FROM versions WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def event_chains(spark: SparkSession, folder: str) -> DataFrame:
    """Events of a user as an unlinked version history."""
    ts = F.col("ts").cast("timestamp")
    unlinked = table(spark, folder, "events").select(
        "event_id", "user_id", hash_expr(["user_id"]).alias("hash_key"), ts.alias("audit_ts"), ts.alias("scd_start"),
        ts.alias("scd_from"), F.lit(None).cast("timestamp").alias("scd_to"), F.lit(1).alias("scd_active"),
        F.lit(1).alias("scd_version"),
    )
    return scd2_recalc(unlinked, "event_id").drop("hash_key", "audit_ts")


@query(
    "enrich_lookup",
    f"""WITH {CATEGORIES_SQL}
    SELECT c_custkey AS CustomerID, c_name AS CustomerName, CAST(c_nationkey AS BIGINT) AS CustomerCategoryID,
           coalesce(CustomerCategoryName, 'UNKNOWN') AS CustomerCategoryName
    FROM customer c LEFT JOIN categories k ON k.CustomerCategoryID = c.c_nationkey
      AND CustomerCategoryName < 'NATION_2'""",
)
def with_category(spark: SparkSession, folder: str) -> DataFrame:
    known = categories(spark, folder).filter(F.col("CustomerCategoryName") < "NATION_2")
    key = {"CustomerCategoryID": "CustomerCategoryID"}
    rows = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("CustomerID"),
        F.col("c_name").alias("CustomerName"),
        F.col("c_nationkey").cast("long").alias("CustomerCategoryID"),
    )
    return enrich(rows, known, key, {"CustomerCategoryName": "UNKNOWN"})


def _order_keys(spark: SparkSession, folder: str) -> DataFrame:
    return orders(spark, folder).select(
        "CustomerID", F.col("LastEditedWhen").alias("audit_ts"), F.lit("WWI").alias("source_id")
    )


def dimension_with_placeholders(spark: SparkSession, folder: str) -> DataFrame:
    """Early customers, and placeholders for the others that have orders."""
    dim = customer_dimension(spark, folder, EARLY)
    missing = infer_members(
        _order_keys(spark, folder), dim, {"CustomerID": "CustomerID"}, skey="customer_skey", now=load_time(FIRST_LOAD)
    )
    return dim.unionByName(missing)


_INFERRED_SQL = f"""{customers_sql(EARLY)}, inferred AS (
  SELECT o_custkey AS CustomerID, min(o_orderdate) AS audit_ts,
         (SELECT count(*) FROM customers_early) + row_number() OVER (ORDER BY o_custkey) AS customer_skey
  FROM orders WHERE o_custkey NOT IN (SELECT CustomerID FROM customers_early) GROUP BY o_custkey)"""


@query(
    "infer_members",
    f"""WITH {_INFERRED_SQL}
    SELECT customer_skey, CustomerID, CAST(NULL AS VARCHAR) AS CustomerName, {sql_hash("CustomerID")} AS hash_key,
           '' AS row_hash, 'WWI' AS source_id, {sql_time("audit_ts")}, {sql_time("audit_ts", "scd_from")},
           {sql_time(OPEN_SQL, "scd_to")}, 1 AS scd_active, 1 AS scd_version, 1 AS inferred_flag
    FROM inferred""",
)
def placeholders(spark: SparkSession, folder: str) -> DataFrame:
    dim = dimension_with_placeholders(spark, folder).filter(F.col("inferred_flag") == 1)
    return dim.select(
        "customer_skey", "CustomerID", "CustomerName", "hash_key", "row_hash", "source_id", "audit_ts", "scd_from",
        "scd_to", "scd_active", "scd_version", "inferred_flag",
    )


@query(
    "fill_inferred",
    f"""WITH {_INFERRED_SQL}, {customers_sql(LATE)}
    SELECT i.customer_skey, i.CustomerID, l.CustomerName, l.DeliveryPostalCode,
           CASE WHEN l.CustomerID IS NULL THEN 1 ELSE 0 END AS inferred_flag,
           {sql_time(f"CASE WHEN l.CustomerID IS NULL THEN i.audit_ts ELSE {T1} END", "audit_ts")},
           {sql_time("i.audit_ts", "scd_from")},
           {sql_time(f"CASE WHEN l.CustomerID IS NOT NULL THEN {T1} END", "updated_audit_ts")}, 1 AS scd_version
    FROM inferred i LEFT JOIN customers_late l USING (CustomerID)
    UNION ALL
    SELECT row_number() OVER (ORDER BY CustomerID), CustomerID, CustomerName, DeliveryPostalCode, 0,
           {sql_time(T0, "audit_ts")}, {sql_time(T0, "scd_from")}, NULL, 1
    FROM customers_early""",
)
def filled_placeholders(spark: SparkSession, folder: str) -> DataFrame:
    dim = dimension_with_placeholders(spark, folder)
    staged = stage_members(with_load(customers(spark, folder, LATE), SECOND_LOAD), ["CustomerID"], CUSTOMER_COLUMNS)
    members = classify_members(staged, dim, "customer_skey")
    filled = fill_inferred(dim, members, attributes=CUSTOMER_COLUMNS, now=load_time(SECOND_LOAD))
    return filled.select(
        "customer_skey", "CustomerID", "CustomerName", "DeliveryPostalCode", "inferred_flag", "audit_ts", "scd_from",
        "updated_audit_ts", "scd_version",
    )
