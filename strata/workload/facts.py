"""Fact base, key lookups and replace-by-key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import add_surrogate_key, changed_facts, lookup_skeys, replace_by_key, staged_facts
from strata.operators.facts import FACT_SKEY, ROW_HASH_COLUMNS, fact_hashes
from strata.plans.silver import version_hashes
from strata.schemas import DIM_CUSTOMER, DIM_PEOPLE, DIM_STOCK_ITEMS, Dimension
from strata.session import scratch_scope, stage
from strata.workload.dimensions import customer_dimension, people_dimension, stock_dimension
from strata.workload.inputs import (
    EARLY,
    FIRST_LOAD,
    LINE_COLUMNS,
    ORDER_COLUMNS,
    SECOND_LOAD,
    customers_sql,
    load_time,
    people_sql,
    stock_items_sql,
)
from strata.workload.registry import query, sql_hash, sql_text, sql_time
from strata.workload.versions import LINE_VERSIONS_SQL, ORDER_VERSIONS_SQL, line_versions, order_versions

T0 = f"TIMESTAMP '{FIRST_LOAD}'"


def versions_sql(line_versions: str) -> str:
    return f"""{line_versions}, {ORDER_VERSIONS_SQL}, lines_now AS (
  SELECT * FROM lines_src_versions QUALIFY row_number() OVER (PARTITION BY OrderLineID ORDER BY audit_ts DESC) = 1)"""


VERSIONS_SQL = versions_sql(LINE_VERSIONS_SQL)


def base_sql(name: str, lines: str = "lines_now", orders: str = "orders_src_versions", where: str = "true") -> str:
    return f"""{name}_joined AS (
  SELECT l.OrderLineID, l.OrderID, l.StockItemID, l.Description, o.CustomerID, o.SalespersonPersonID,
         CAST(o.OrderDate AS DATE) AS OrderDate, CAST(o.ExpectedDeliveryDate AS DATE) AS ExpectedDeliveryDate,
         greatest(l.audit_ts, o.audit_ts) AS audit_ts,
         CAST(coalesce(l.Quantity, 0) AS DECIMAL(18,4)) AS Quantity,
         CAST(coalesce(l.UnitPrice, 0) AS DECIMAL(18,4)) AS UnitPrice,
         CAST(coalesce(l.TaxRate, 0) AS DECIMAL(18,4)) AS TaxRate,
         CAST(coalesce(l.PickedQuantity, 0) AS DECIMAL(18,4)) AS PickedQuantity
  FROM {lines} l JOIN {orders} o ON l.OrderID = o.OrderID WHERE {where}), {name}_net AS (
  SELECT *, CAST(CAST(Quantity AS DECIMAL(28,4)) * UnitPrice AS DECIMAL(18,4)) AS sales_amount_net
  FROM {name}_joined), {name}_tax AS (
  SELECT *, CAST(CAST(sales_amount_net AS DECIMAL(28,4)) * TaxRate * 0.01 AS DECIMAL(18,4)) AS tax_amount
  FROM {name}_net), {name} AS (
  SELECT *, CAST(sales_amount_net + tax_amount AS DECIMAL(18,4)) AS sales_amount_gross FROM {name}_tax)"""


_BASE_OUT = (
    "OrderLineID", "OrderID", "StockItemID", "CustomerID", "SalespersonPersonID", "Description", "OrderDate",
    "ExpectedDeliveryDate", "audit_ts", "Quantity", "PickedQuantity", "sales_amount_net", "tax_amount",
    "sales_amount_gross",
)
_BASE_OUT_SQL = f"""OrderLineID, OrderID, StockItemID, CustomerID, SalespersonPersonID, Description,
    {sql_text("OrderDate")}, {sql_text("ExpectedDeliveryDate")}, {sql_time("audit_ts")}, {sql_text("Quantity")},
    {sql_text("PickedQuantity")}, {sql_text("sales_amount_net")}, {sql_text("tax_amount")},
    {sql_text("sales_amount_gross")}"""


def _versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The two cleaned tables, stored; what they are made from goes."""
    stored = []
    for versions, key, columns in ((line_versions, "OrderLineID", LINE_COLUMNS), (order_versions, "OrderID", ORDER_COLUMNS)):
        with scratch_scope(spark) as keep:
            rows = versions(spark, folder)
            stored.append(keep(rows, key, derived=version_hashes(rows, [key], columns)))
    return tuple(stored)


def _base(spark: SparkSession, folder: str, since: datetime | None, **options) -> DataFrame:
    """Base rows, stored without what leads to them."""
    with scratch_scope(spark) as keep:
        return keep(changed_facts(*_versions(spark, folder), since, **options), "base")


@query("fact_base", f"WITH {VERSIONS_SQL}, {base_sql('base')} SELECT {_BASE_OUT_SQL} FROM base")
def whole_base(spark: SparkSession, folder: str) -> DataFrame:
    return _base(spark, folder, None).select(*_BASE_OUT)


@query(
    "fact_changed_either",
    f"""WITH {VERSIONS_SQL}, {base_sql("base", where=f"greatest(l.audit_ts, o.audit_ts) > {T0}")}
    SELECT {_BASE_OUT_SQL} FROM base""",
)
def base_of_either_change(spark: SparkSession, folder: str) -> DataFrame:
    return _base(spark, folder, FIRST_LOAD, mode="either").select(*_BASE_OUT)


@query(
    "fact_changed_both",
    f"""WITH {VERSIONS_SQL}, {base_sql("base", where=f"l.audit_ts > {T0} AND o.audit_ts > {T0}")}
    SELECT {_BASE_OUT_SQL} FROM base""",
)
def base_of_both_changes(spark: SparkSession, folder: str) -> DataFrame:
    return _base(spark, folder, FIRST_LOAD, mode="both").select(*_BASE_OUT)


def _dimensions(spark: SparkSession, folder: str) -> dict[Dimension, DataFrame]:
    """Dimensions as the first load left them; members that came later are unknown."""
    return {
        DIM_CUSTOMER: customer_dimension(spark, folder, EARLY),
        DIM_STOCK_ITEMS: stock_dimension(spark, folder, EARLY),
        DIM_PEOPLE: people_dimension(spark, folder, EARLY),
    }


def _with_keys(base: DataFrame, dims: dict[Dimension, DataFrame]) -> DataFrame:
    base = lookup_skeys(base, [(dim, spec.fact_key, spec.key, spec.skey) for spec, dim in dims.items()])
    return base.withColumn("updated_audit_ts", load_time(SECOND_LOAD))




def _ranked_sql(name: str, key: str, skey: str) -> str:
    return f"{name}_dim AS (SELECT {key}, row_number() OVER (ORDER BY {key}) AS {skey} FROM {name}_early)"


_LOOKUP_SQL = f"""{customers_sql(EARLY)}, {_ranked_sql("customers", "CustomerID", "customer_skey")},
{stock_items_sql(EARLY)}, {_ranked_sql("stock_items", "StockItemID", "stockitem_skey")},
{people_sql(EARLY)}, {_ranked_sql("people", "PersonID", "person_skey")}, keyed AS (
  SELECT b.*, coalesce(c.customer_skey, -1) AS customer_skey, coalesce(s.stockitem_skey, -1) AS stockitem_skey,
         coalesce(p.person_skey, -1) AS person_skey
  FROM base b LEFT JOIN customers_dim c ON c.CustomerID = b.CustomerID
  LEFT JOIN stock_items_dim s ON s.StockItemID = b.StockItemID
  LEFT JOIN people_dim p ON p.PersonID = b.SalespersonPersonID), facts AS (
  SELECT *, {sql_hash("OrderLineID")} AS hash_key, {sql_hash(*ROW_HASH_COLUMNS)} AS row_hash FROM keyed)"""


@query(
    "fact_lookup",
    f"""WITH {VERSIONS_SQL}, {base_sql("base")}, {_LOOKUP_SQL}
    SELECT OrderLineID, CustomerID, StockItemID, SalespersonPersonID, customer_skey, stockitem_skey, person_skey,
           {sql_text("sales_amount_gross")}, hash_key, row_hash
    FROM facts""",
)
def facts_with_keys(spark: SparkSession, folder: str) -> DataFrame:
    base = _base(spark, folder, None)
    return staged_facts(_with_keys(base, _dimensions(spark, folder))).select(
        "OrderLineID", "CustomerID", "StockItemID", "SalespersonPersonID", "customer_skey", "stockitem_skey",
        "person_skey", "sales_amount_gross", "hash_key", "row_hash",
    )


FACT_SKEY_SQL = f"""first_facts AS (
  SELECT OrderLineID, row_number() OVER (ORDER BY OrderLineID) AS first_skey
  FROM lines_src_first l JOIN orders_src_first o ON l.OrderID = o.OrderID), numbered AS (
  SELECT f.*, CASE WHEN first_skey IS NOT NULL THEN first_skey ELSE (SELECT count(*) FROM first_facts)
           + row_number() OVER (PARTITION BY first_skey IS NULL ORDER BY OrderLineID) END AS fact_sales_skey
  FROM facts f LEFT JOIN first_facts USING (OrderLineID))"""


@query(
    "fact_load",
    f"""WITH {VERSIONS_SQL}, {base_sql("base")}, {_LOOKUP_SQL}, {FACT_SKEY_SQL}
    SELECT fact_sales_skey, hash_key, row_hash, OrderLineID, OrderID, customer_skey, stockitem_skey, person_skey,
           {sql_text("OrderDate")}, {sql_text("Quantity")}, {sql_text("sales_amount_net")}, {sql_text("tax_amount")},
           {sql_text("sales_amount_gross")}, {sql_time("audit_ts")}, {sql_time("audit_ts", "fact_effective_ts")}
    FROM numbered""",
)
def loaded_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Two fact loads: the second replaces rows whose line or order changed."""
    with scratch_scope(spark) as keep:
        lines, orders = _versions(spark, folder)
        first_time = F.col("audit_ts") == load_time(FIRST_LOAD)
        dims = {spec: stage(dim, spec.name) for spec, dim in _dimensions(spark, folder).items()}

        def keyed(lines: DataFrame, orders: DataFrame, since: datetime | None) -> DataFrame:
            with scratch_scope(spark) as keep_base:
                base = keep_base(changed_facts(lines, orders, since), "base")
            return staged_facts(_with_keys(base, dims))

        with scratch_scope(spark) as keep_first:
            first = keep_first(keyed(lines.filter(first_time), orders.filter(first_time), None), "first", derived=fact_hashes())
        with scratch_scope(spark) as keep_changed:
            changed = keep_changed(keyed(lines, orders, FIRST_LOAD), "changed", derived=fact_hashes())
        first, changed = keep(first, "first_facts", derived=fact_hashes()), keep(changed, "changed_facts", derived=fact_hashes())
    with scratch_scope(spark) as keep:
        numbered = add_surrogate_key(first, FACT_SKEY, ["OrderLineID", "hash_key"], derived=fact_hashes())
        fact = keep(numbered, "facts", derived=fact_hashes())
    return replace_by_key(fact, changed, derived=fact_hashes(), derived_held=fact_hashes()).select(
        "fact_sales_skey", "hash_key", "row_hash", "OrderLineID", "OrderID", "customer_skey", "stockitem_skey",
        "person_skey", "OrderDate", "Quantity", "sales_amount_net", "tax_amount", "sales_amount_gross", "audit_ts",
        "fact_effective_ts",
    )
