"""Latest versions, change detection, merges and the cleaned layer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import (
    assert_unique,
    changed_rows,
    classify,
    current_versions,
    deleted_keys,
    keep_earliest,
    keep_latest,
    latest_snapshot,
    merge_delete,
    merge_update,
    new_keys,
    row_hash,
    soft_delete,
    with_hash_key,
)
from strata.operators.changes import SAME
from strata.plans.silver import incremental_versions, snapshot_next, snapshot_versions, stage_rows, version_hashes
from strata.schemas import ORDERS
from strata.session import stage
from strata.workload.inputs import (
    CUSTOMER_COLUMNS,
    CUT,
    EARLY,
    FIRST_LOAD,
    LATE,
    LINE_COLUMNS,
    LINES_SQL,
    ORDER_COLUMNS,
    ORDERS_SQL,
    SECOND_LOAD,
    customers,
    customers_sql,
    lines,
    load_time,
    orders,
    table,
    with_load,
)
from strata.workload.registry import query, sql_hash, sql_text, sql_time

T0, T1 = f"TIMESTAMP '{FIRST_LOAD}'", f"TIMESTAMP '{SECOND_LOAD}'"


# Latest and earliest rows

_LINE_OUT = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


@query(
    "keep_latest",
    f"""SELECT {", ".join(_LINE_OUT[:4])}, {sql_time("l_shipdate")}, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
)
def latest_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(*_LINE_OUT)
    return keep_latest(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


@query(
    "keep_earliest",
    f"""SELECT event_id, user_id, event_type, {sql_time("ts")} FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
)
def first_events(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_id", "user_id", "event_type", "ts")
    return keep_earliest(rows, ["user_id"], ["ts", "event_id"])


def _marked_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events of a user as versions, where an error closes the version."""
    mark = F.when(F.col("event_type") == "error", F.col("ts"))
    return table(spark, folder, "events").select("user_id", "event_id", "ts", mark.alias("deleted_audit_ts"))


_NEWEST = "row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"


@query(
    "latest_active_before",
    f"""SELECT user_id, event_id, {sql_time("ts")}, CAST(NULL AS VARCHAR) AS deleted_audit_ts
    FROM events WHERE event_type <> 'error' QUALIFY {_NEWEST}""",
)
def newest_open_version(spark: SparkSession, folder: str) -> DataFrame:
    return current_versions(_marked_events(spark, folder), ["user_id"], ["ts", "event_id"], active="before")


@query(
    "latest_active_after",
    f"""SELECT user_id, event_id, {sql_time("ts")}, CAST(NULL AS VARCHAR) AS deleted_audit_ts
    FROM (SELECT * FROM events QUALIFY {_NEWEST}) WHERE event_type <> 'error'""",
)
def newest_version_if_open(spark: SparkSession, folder: str) -> DataFrame:
    return current_versions(_marked_events(spark, folder), ["user_id"], ["ts", "event_id"], active="after")


@query(
    "latest_version",
    f"""SELECT user_id, event_id, {sql_time("ts")},
           {sql_time("CASE WHEN event_type = 'error' THEN ts END", "deleted_audit_ts")}
    FROM events QUALIFY {_NEWEST}""",
)
def newest_version(spark: SparkSession, folder: str) -> DataFrame:
    return current_versions(_marked_events(spark, folder), ["user_id"], ["ts", "event_id"], active=None)


@query(
    "latest_snapshot",
    f"""WITH {customers_sql(EARLY)}, {customers_sql(LATE)}, history AS (
      SELECT *, {T0} AS audit_ts FROM customers_early UNION ALL SELECT *, {T1} FROM customers_late)
    SELECT CustomerID, CustomerName, {sql_text("CreditLimit")}, {sql_time("audit_ts")}
    FROM history WHERE audit_ts = (SELECT max(audit_ts) FROM history)""",
)
def newest_copy(spark: SparkSession, folder: str) -> DataFrame:
    first = with_load(customers(spark, folder, EARLY), FIRST_LOAD)
    history = first.unionByName(with_load(customers(spark, folder, LATE), SECOND_LOAD))
    # Stored, as raw copies are: otherwise the optimizer sees one constant time per copy.
    return latest_snapshot(stage(history, "copies")).select("CustomerID", "CustomerName", "CreditLimit", "audit_ts")


# Change detection between two full copies


def _hashed(df: DataFrame) -> DataFrame:
    return with_hash_key(df, ["CustomerID"]).withColumn("row_hash", row_hash(df, CUSTOMER_COLUMNS))


def _copies(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return _hashed(customers(spark, folder, LATE)), _hashed(customers(spark, folder, EARLY))


_COPIES_SQL = f"""{customers_sql(EARLY)}, {customers_sql(LATE)}, current AS (
  SELECT *, {sql_hash("CustomerID")} AS hash_key, {sql_hash(*sorted(CUSTOMER_COLUMNS))} AS row_hash
  FROM customers_early), staged AS (
  SELECT *, {sql_hash("CustomerID")} AS hash_key, {sql_hash(*sorted(CUSTOMER_COLUMNS))} AS row_hash
  FROM customers_late)"""


@query(
    "new_keys",
    f"WITH {_COPIES_SQL} SELECT CustomerID, hash_key, row_hash FROM staged ANTI JOIN current USING (hash_key)",
)
def keys_only_staged(spark: SparkSession, folder: str) -> DataFrame:
    return new_keys(*_copies(spark, folder)).select("CustomerID", "hash_key", "row_hash")


@query(
    "changed_rows",
    f"""WITH {_COPIES_SQL} SELECT s.CustomerID, s.DeliveryPostalCode, s.row_hash
    FROM staged s JOIN current c USING (hash_key) WHERE s.row_hash <> c.row_hash""",
)
def rows_that_differ(spark: SparkSession, folder: str) -> DataFrame:
    return changed_rows(*_copies(spark, folder)).select("CustomerID", "DeliveryPostalCode", "row_hash")


@query("deleted_keys", f"WITH {_COPIES_SQL} SELECT hash_key FROM current ANTI JOIN staged USING (hash_key)")
def keys_only_current(spark: SparkSession, folder: str) -> DataFrame:
    return deleted_keys(*_copies(spark, folder))


@query(
    "classify",
    f"""WITH {_COPIES_SQL}
    SELECT coalesce(s.hash_key, c.hash_key) AS hash_key, s.CustomerID, s.row_hash,
           CASE WHEN s.hash_key IS NULL THEN 'deleted' WHEN c.hash_key IS NULL THEN 'new'
                WHEN s.row_hash <> c.row_hash THEN 'changed' ELSE 'same' END AS change_type
    FROM staged s FULL JOIN current c ON s.hash_key = c.hash_key""",
)
def all_changes(spark: SparkSession, folder: str) -> DataFrame:
    changes = classify(*_copies(spark, folder), detect_deletes=True)
    return changes.select("hash_key", "CustomerID", "row_hash", "change_type")


# Merges


@query(
    "merge_update",
    f"""WITH {_COPIES_SQL}
    SELECT t.CustomerID, t.CustomerName,
           CASE WHEN s.DeliveryPostalCode > t.DeliveryPostalCode THEN s.DeliveryPostalCode ELSE t.DeliveryPostalCode
             END AS DeliveryPostalCode,
           CASE WHEN s.DeliveryPostalCode > t.DeliveryPostalCode THEN s.row_hash ELSE t.row_hash END AS row_hash
    FROM current t LEFT JOIN staged s ON t.hash_key = s.hash_key""",
)
def updated_by_key(spark: SparkSession, folder: str) -> DataFrame:
    staged, current = _copies(spark, folder)
    higher = F.col("s.DeliveryPostalCode") > F.col("t.DeliveryPostalCode")
    set_ = {name: F.col(f"s.{name}") for name in ("DeliveryPostalCode", "row_hash")}
    merged = merge_update(current, assert_unique(staged, ["hash_key"]), ["hash_key"], set_, higher)
    return merged.select("CustomerID", "CustomerName", "DeliveryPostalCode", "row_hash")


@query(
    "merge_delete",
    f"""WITH {ORDERS_SQL} SELECT OrderID, CustomerID, {sql_text("OrderDate")} FROM orders_src
    WHERE OrderID NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def without_returned(spark: SparkSession, folder: str) -> DataFrame:
    returned = table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R")
    keys = returned.select(F.col("l_orderkey").alias("OrderID"))
    return merge_delete(orders(spark, folder).select("OrderID", "CustomerID", "OrderDate"), keys, ["OrderID"])


@query(
    "soft_delete",
    f"""WITH {_COPIES_SQL}
    SELECT CustomerID, {sql_time(f"CASE WHEN s.hash_key IS NULL THEN {T1} END", "deleted_audit_ts")}
    FROM current c LEFT JOIN (SELECT hash_key FROM staged) s USING (hash_key)""",
)
def closed_when_gone(spark: SparkSession, folder: str) -> DataFrame:
    staged, current = _copies(spark, folder)
    target = current.select("CustomerID", "hash_key", F.lit(None).cast("timestamp").alias("deleted_audit_ts"))
    return soft_delete(target, deleted_keys(staged, current), load_time(SECOND_LOAD)).drop("hash_key")


# Cleaned layer: what two loads leave


def line_versions(spark: SparkSession, folder: str) -> DataFrame:
    return _two_loads(lines(spark, folder), "OrderLineID", LINE_COLUMNS, ())


def order_versions(spark: SparkSession, folder: str) -> DataFrame:
    return _two_loads(orders(spark, folder), "OrderID", ORDER_COLUMNS, ORDERS.unwanted)


def _two_loads(source: DataFrame, key: str, columns: list[str], unwanted: tuple[str, ...]) -> DataFrame:
    """First load: rows edited before the cut. Second load: the others. Stored where a job stores them."""

    def staged(rows: DataFrame, when: datetime) -> DataFrame:
        raw = with_load(rows, when)
        return stage_rows(raw, [key], columns, when, unwanted=unwanted, watermark_column="LastEditedWhen")

    edited = F.col("LastEditedWhen")
    rows = staged(source.filter(edited < F.lit(CUT)), FIRST_LOAD)
    hashes = version_hashes(rows, [key], columns)
    first = stage(rows, key, derived=hashes)
    second = stage(staged(source.filter(edited >= F.lit(CUT)), SECOND_LOAD), key, derived=hashes)
    changes = incremental_versions(second, first, [key], derived=hashes)
    return first.unionByName(changes.filter(F.col("change_type") != SAME).select(*first.columns))


def _two_loads_sql(source: str, key: str, columns: list[str], expressions: dict[str, str], absent: tuple[str, ...] = ()) -> str:
    """SQL twin of the two loads. ``absent`` are configured columns without values; they are hashed as NULL."""
    versioned = [c if c in columns else "NULL" for c in sorted([*columns, *absent])]
    cleaned = ", ".join(f"{expressions.get(c, c)} AS {c}" for c in columns)

    def load(name: str, test: str, when: str) -> str:
        return f"""{name} AS (
  SELECT *, {when} AS audit_ts FROM {source}_clean WHERE LastEditedWhen {test} DATE '{CUT}'
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY LastEditedWhen DESC, row_hash DESC) = 1)"""

    return f"""{source}_clean AS (
  SELECT *, {sql_hash(key)} AS hash_key, {sql_hash(*versioned)} AS row_hash FROM (SELECT {cleaned} FROM {source})),
{load(source + "_first", "<", T0)}, {load(source + "_second", ">=", T1)}, {source}_versions AS (
  SELECT * FROM {source}_first
  UNION ALL SELECT s.* FROM {source}_second s LEFT JOIN {source}_first f ON s.{key} = f.{key}
    WHERE f.{key} IS NULL OR s.row_hash <> f.row_hash)"""


_TIMES = {c: f"CAST({c} AS TIMESTAMP)" for c in ("OrderDate", "ExpectedDeliveryDate", "LastEditedWhen")}
_CLEANED = {"Description": "nullif(trim(Description), '')"}
LINE_VERSIONS_SQL = f"{LINES_SQL}, {_two_loads_sql('lines_src', 'OrderLineID', LINE_COLUMNS, _CLEANED)}"
# The same with every configured column in the row hash, which decides between tied rows.
CONFIGURED_LINE_VERSIONS_SQL = f"""{LINES_SQL}, {_two_loads_sql(
    "lines_src", "OrderLineID", LINE_COLUMNS, _CLEANED, ("PackageTypeID", "PickingCompletedWhen", "LastEditedBy"))}"""
ORDER_VERSIONS_SQL = f"{ORDERS_SQL}, {_two_loads_sql('orders_src', 'OrderID', ORDER_COLUMNS, _TIMES)}"


@query(
    "silver_incremental",
    f"""WITH {LINE_VERSIONS_SQL}
    SELECT OrderLineID, OrderID, StockItemID, Description, Quantity, {sql_text("UnitPrice")}, PickedQuantity,
           hash_key, row_hash, {sql_time("audit_ts")}
    FROM lines_src_versions""",
)
def versions_of_lines(spark: SparkSession, folder: str) -> DataFrame:
    return line_versions(spark, folder).select(
        "OrderLineID", "OrderID", "StockItemID", "Description", "Quantity", "UnitPrice", "PickedQuantity",
        "hash_key", "row_hash", "audit_ts",
    )


@query(
    "silver_incremental_orders",
    f"""WITH {ORDER_VERSIONS_SQL}
    SELECT OrderID, CustomerID, SalespersonPersonID, {sql_time("OrderDate")}, row_hash, {sql_time("audit_ts")}
    FROM orders_src_versions""",
)
def versions_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    return order_versions(spark, folder).select(
        "OrderID", "CustomerID", "SalespersonPersonID", "OrderDate", "row_hash", "audit_ts"
    )


def customer_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned customer table after two full copies."""

    def staged(period: str, when: datetime) -> DataFrame:
        rows = stage_rows(with_load(customers(spark, folder, period), when), ["CustomerID"], CUSTOMER_COLUMNS, when)
        return rows.withColumn("deleted_audit_ts", F.lit(None).cast("timestamp"))

    first = stage(staged(EARLY, FIRST_LOAD), "customers")
    changes = snapshot_versions(staged(LATE, SECOND_LOAD), first).filter(F.col("change_type") != SAME)
    return snapshot_next(first, stage(changes, "customers"), SECOND_LOAD)


@query(
    "silver_snapshot",
    f"""WITH {_COPIES_SQL}, versions AS (
      SELECT c.*, {T0} AS audit_ts, CASE WHEN s.hash_key IS NULL THEN {T1} END AS deleted_audit_ts
      FROM current c LEFT JOIN (SELECT hash_key FROM staged) s USING (hash_key)
      UNION ALL
      SELECT s.*, {T1}, NULL FROM staged s LEFT JOIN (SELECT hash_key, row_hash AS before FROM current) c USING (hash_key)
      WHERE before IS NULL OR before <> row_hash)
    SELECT CustomerID, CustomerName, DeliveryPostalCode, {sql_text("CreditLimit")}, hash_key, row_hash,
           {sql_time("audit_ts")}, {sql_time("deleted_audit_ts")}
    FROM versions""",
)
def versions_of_customers(spark: SparkSession, folder: str) -> DataFrame:
    return customer_versions(spark, folder).select(
        "CustomerID", "CustomerName", "DeliveryPostalCode", "CreditLimit", "hash_key", "row_hash",
        "audit_ts", "deleted_audit_ts",
    )
