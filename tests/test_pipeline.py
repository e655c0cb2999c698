"""Three daily runs over the six sources: new, changed, deleted, returning and late keys."""

from datetime import date, datetime
from decimal import Decimal
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from strata.errors import EmptySnapshot
from strata.operators.facts import FACT_COLUMNS
from strata.plans import Layers, infer_ahead, load_dimension, load_fact, load_silver, run_all
from strata.plans.gold import FACT_PARTITION
from strata.schemas import DIM_CUSTOMER, DIM_PEOPLE, FACT_SALES, ORDERS, SOURCES

DAYS = [datetime(2024, 1, 1, 6), datetime(2024, 2, 1, 6), datetime(2024, 3, 1, 6), datetime(2024, 3, 2, 6)]


class Shop:
    """Mutable source tables; rows give only the columns a test cares about."""

    def __init__(self, spark):
        self.spark = spark
        self.tables = {s.table: {} for s in SOURCES}

    def put(self, table, key, **values):
        source = next(s for s in SOURCES if s.table == table)
        self.tables[table][key] = {source.business_key: key, **values}

    def drop(self, table, key):
        del self.tables[table][key]

    def reader(self, schema, table):
        source = next(s for s in SOURCES if s.table == table and s.schema_name == schema)
        names = source.schema.fieldNames()
        rows = [tuple(r.get(n) for n in names) for r in self.tables[table].values()]
        return self.spark.createDataFrame(rows, source.schema)


def order(shop, key, customer, person, edited, day=date(2024, 1, 5)):
    shop.put(
        "Orders", key, CustomerID=customer, SalespersonPersonID=person, OrderDate=day,
        ExpectedDeliveryDate=day, Comments="x", LastEditedWhen=edited,
    )


def line(shop, key, order_id, item, edited, qty=2, price="10.00", rate="15.000"):
    shop.put(
        "OrderLines", key, OrderID=order_id, StockItemID=item, Description=f" item {item} ", Quantity=qty,
        UnitPrice=price and Decimal(price), TaxRate=rate and Decimal(rate), PickedQuantity=None, LastEditedWhen=edited,
    )


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    shop = Shop(spark)
    layers = Layers(spark, str(tmp_path_factory.mktemp("lake")), f"t{uuid4().hex[:8]}").set_up()
    results = []

    shop.put("CustomerCategories", 1, CustomerCategoryName="Retail")
    for key in (1, 2, 3):
        shop.put("Customers", key, CustomerName=f" customer {key} ", CustomerCategoryID=min(key, 2), FaxNumber="  ")
        shop.put("StockItems", key, StockItemName=f"item {key}", Photo=b"p")
        shop.put("People", key, FullName=f"person {key}", HashedPassword=b"secret")
    edited = datetime(2024, 1, 1)
    order(shop, 10, 1, 1, edited)
    order(shop, 11, 9, None, edited, day=date(2024, 2, 5))  # customer 9 is not there yet
    line(shop, 100, 10, 1, edited)
    line(shop, 101, 10, 8, edited, qty=None)  # item 8 is not there yet
    line(shop, 102, 11, 2, edited, qty=1, price="99.99")
    results.append({r.table: r for r in run_all(layers, shop.reader, DAYS[0])})

    shop.put("Customers", 2, CustomerName="renamed", CustomerCategoryID=2)
    shop.drop("Customers", 3)
    shop.put("Customers", 9, CustomerName="late", CustomerCategoryID=1)
    shop.put("StockItems", 8, StockItemName="late item")
    shop.put("People", 1, FullName="person one")
    edited = datetime(2024, 1, 20)
    order(shop, 10, 2, 1, edited)  # only the order changes: its lines must follow
    line(shop, 103, 11, 3, edited)
    results.append({r.table: r for r in run_all(layers, shop.reader, DAYS[1])})

    shop.put("Customers", 3, CustomerName=" customer 3 ", CustomerCategoryID=2, FaxNumber="  ")  # is back, unchanged
    order(shop, 11, 9, None, datetime(2024, 2, 20), day=date(2024, 3, 7))  # leaves its month empty
    results.append({r.table: r for r in run_all(layers, shop.reader, DAYS[2])})
    results.append({r.table: r for r in run_all(layers, shop.reader, DAYS[3])})
    yield layers, results, shop
    layers.drop()


def test_counts_per_run(runs):
    _, (first, second, third, fourth), _ = runs
    assert first["Sales_Customers"].counts == {"new": 3}
    assert second["Sales_Customers"].counts == {"new": 1, "changed": 1, "deleted": 1, "same": 1}
    assert third["Sales_Customers"].counts == {"new": 1, "changed": 0, "deleted": 0, "same": 3}
    assert second["Sales_Orders"].counts == {"new": 0, "changed": 1, "same": 0}
    assert first["Fact_Sales"].counts == {
        "inferred Dim_Customer": 1, "inferred Dim_StockItems": 1, "inferred Dim_People": 0, "staged": 3, "replaced": 0,
    }
    assert second["Fact_Sales"].counts["staged"] == 3
    assert second["Fact_Sales"].counts["replaced"] == 2
    assert second["Dim_Customer"].counts == {"new": 0, "changed": 1, "fill": 1, "same": 1}
    # The last run ingests the same copies again and no changed orders.
    assert fourth["Sales_Customers"].counts == {"new": 0, "changed": 0, "deleted": 0, "same": 4}
    assert fourth["Fact_Sales"].status == fourth["Dim_People"].status == "no_new_data"


def test_cleaned_layer_keeps_versions(runs, rows_of):
    layers, _, _ = runs
    customers = layers.silver.read("Sales_Customers")
    assert "WebsiteURL" not in customers.columns and "year" not in customers.columns
    assert "HashedPassword" not in layers.silver.read("Application_People").columns
    three = customers.filter("CustomerID = 3")
    assert rows_of(three, "CustomerName", "FaxNumber", "audit_ts", "deleted_audit_ts") == [
        ("customer 3", None, DAYS[0], DAYS[1]),
        ("customer 3", None, DAYS[2], None),
    ]
    # A superseded version stays open; only a deletion closes versions.
    assert customers.filter("CustomerID = 2 AND deleted_audit_ts IS NULL").count() == 2
    assert layers.silver.read("Sales_Orders").filter("OrderID = 10").count() == 2


def test_scd2_history(runs, rows_of):
    layers, _, _ = runs
    dim = layers.gold.read("Dim_Customer")
    open_end = datetime(2999, 12, 31)
    columns = ("scd_version", "CustomerName", "scd_from", "scd_to", "scd_active", "scd_start", "inferred_flag")
    assert rows_of(dim.filter("CustomerID = 2"), *columns) == [
        (1, "customer 2", DAYS[0], DAYS[1], 0, DAYS[0], 0),
        (2, "renamed", DAYS[1], open_end, 1, DAYS[0], 0),
    ]
    # The placeholder was filled in place: same key, no second version, validity kept.
    assert rows_of(dim.filter("CustomerID = 9"), *columns) == [(1, "late", DAYS[0], open_end, 1, DAYS[0], 0)]
    assert rows_of(dim.filter("scd_active = 1"), "CustomerID", "CustomerCategoryName") == [
        (1, "Retail"), (2, "UNKNOWN"), (3, "UNKNOWN"), (9, "Retail"),
    ]
    assert dim.count() == dim.select("customer_skey").distinct().count()
    # A deletion in the source is not carried over, a returning key adds no version.
    assert rows_of(dim.filter("CustomerID = 3"), "scd_version", "scd_active") == [(1, 1)]


def test_scd1_updates_in_place(runs, rows_of):
    layers, _, _ = runs
    dim = layers.gold.read("Dim_People")
    assert rows_of(dim, "person_skey", "PersonID", "FullName", "scd_version", "updated_audit_ts") == [
        (1, 1, "person one", 1, DAYS[1]),
        (2, 2, "person 2", 1, None),
        (3, 3, "person 3", 1, None),
    ]


def test_facts(runs, rows_of):
    layers, _, _ = runs
    fact = layers.gold.read(FACT_SALES)
    assert set(FACT_COLUMNS) | {"fact_sales_skey", FACT_PARTITION} == set(fact.columns)
    dim = layers.gold.read("Dim_Customer").filter("scd_active = 1").select("customer_skey", F.col("CustomerID").alias("dim_id"))
    joined = fact.join(dim, "customer_skey", "left")
    assert rows_of(joined, "OrderLineID", "fact_sales_skey", "CustomerID", "dim_id", FACT_PARTITION) == [
        (100, 1, 2, 2, 202401),
        (101, 2, 2, 2, 202401),
        (102, 3, 9, 9, 202403),
        (103, 4, 9, 9, 202403),
    ]
    assert fact.filter("customer_skey = -1 OR stockitem_skey = -1").count() == 0
    assert rows_of(fact.filter("person_skey = -1"), "OrderLineID") == [(102,), (103,)]
    money = ("sales_amount_net", "tax_amount", "sales_amount_gross", "Quantity", "PickedQuantity")
    assert rows_of(fact.filter("OrderLineID IN (101, 102)"), *money) == [
        tuple(map(Decimal, ("0.0000", "0.0000", "0.0000", "0.0000", "0.0000"))),
        tuple(map(Decimal, ("99.9900", "14.9985", "114.9885", "1.0000", "0.0000"))),
    ]
    assert fact.filter("Description = 'item 1'").count() == 1


def test_watermarks_only_grow(runs):
    layers, _, _ = runs
    log = layers.watermarks
    for row in log.select("layer", "object_name").distinct().collect():
        mine = log.filter((F.col("layer") == row.layer) & (F.col("object_name") == row.object_name))
        values = [r.key_1 for r in mine.orderBy("timestamp").collect()]
        assert values == sorted(set(values))
    assert layers.watermark("gold", FACT_SALES) == DAYS[2]
    assert layers.watermark("bronze", ORDERS.object) == datetime(2024, 2, 20)


def test_calendar_table(runs):
    layers, _, _ = runs
    assert layers.gold.read("dim_date").count() == 11_688


def test_members_inferred_ahead_of_the_facts(spark, tmp_path, rows_of):
    shop = Shop(spark)
    layers = Layers(spark, str(tmp_path), f"t{uuid4().hex[:8]}").set_up()
    edited = datetime(2024, 1, 1)
    for table in ("Customers", "CustomerCategories", "StockItems", "People"):
        shop.put(table, 1)
    order(shop, 1, 1, 5, edited)
    order(shop, 2, 7, None, edited)
    order(shop, 3, 8, 6, edited)  # has no line
    line(shop, 1, 1, 1, edited)
    line(shop, 2, 2, 1, edited)
    from strata.plans.ingest import ingest_all
    from strata.plans.pipeline import run_silver

    ingest_all(layers, shop.reader, DAYS[0])
    run_silver(layers, DAYS[0])
    load_dimension(layers, DIM_CUSTOMER, DAYS[0])
    assert infer_ahead(layers, DIM_CUSTOMER, DAYS[1]).counts == {"inferred": 1}
    assert infer_ahead(layers, DIM_PEOPLE, DAYS[1]).counts == {"inferred": 1}  # table does not exist yet
    assert infer_ahead(layers, DIM_PEOPLE, DAYS[1]).status == "no_new_data"
    new = layers.gold.read("Dim_Customer").filter("inferred_flag = 1")
    assert rows_of(new, "customer_skey", "CustomerID", "row_hash", "audit_ts", "scd_from", "scd_start", "CustomerName") == [
        (2, 7, "", DAYS[0], DAYS[0], DAYS[1], None)
    ]
    layers.drop()


def test_empty_copy_changes_nothing(spark, tmp_path):
    shop = Shop(spark)
    layers = Layers(spark, str(tmp_path), f"t{uuid4().hex[:8]}").set_up()
    from strata.plans.ingest import ingest_all

    shop.put("Customers", 1)
    ingest_all(layers, shop.reader, DAYS[0], source_object="Sales_Customers")
    load_silver(layers, "Sales_Customers", DAYS[0])
    shop.drop("Customers", 1)
    ingest_all(layers, shop.reader, DAYS[1], source_object="Sales_Customers")
    # The empty copy has no load time of its own; the copy before it is read again.
    assert load_silver(layers, "Sales_Customers", DAYS[1]).counts["deleted"] == 0
    with pytest.raises(EmptySnapshot):
        from strata.operators import latest_snapshot_at

        latest_snapshot_at(layers.silver.read("Sales_Customers").filter("CustomerID = 99"))
    assert layers.silver.read("Sales_Customers").filter("deleted_audit_ts IS NULL").count() == 1
    layers.drop()
