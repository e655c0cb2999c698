"""Jobs whose configuration or source changes between runs, and the options of jobs."""

import re
from datetime import datetime
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from strata.errors import UnmarkedRows
from strata.plans import Layers, load_dimension, load_fact, run_all
from strata.plans.ingest import ingest_all
from strata.plans.pipeline import run_silver
from strata.schemas import DIM_CUSTOMER, FACT_SALES, ORDERS
from strata.sources.bronze import read_bronze
from strata.sources.metadata import seed_config
from test_pipeline import DAYS, Shop, line, order


@pytest.fixture
def lake(spark, tmp_path):
    layers = Layers(spark, str(tmp_path), f"t{uuid4().hex[:8]}")
    shop = Shop(spark)
    shop.put("CustomerCategories", 1, CustomerCategoryName="Retail")
    for table in ("Customers", "StockItems", "People"):
        shop.put(table, 1)
    shop.put("Customers", 1, CustomerName="one", CustomerCategoryID=1, FaxNumber="123")
    order(shop, 1, 1, 1, datetime(2024, 1, 1))
    line(shop, 1, 1, 1, datetime(2024, 1, 1))
    yield layers, shop
    layers.drop()


def test_a_column_that_the_configuration_gains_reaches_all_layers(spark, lake, rows_of):
    layers, shop = lake
    full = seed_config(spark)
    listed = F.regexp_replace("column_list", ", FaxNumber", "")
    narrow = full.withColumn("column_list", F.when(F.col("source_object") == "Sales_Customers", listed).otherwise(F.col("column_list")))
    narrow = spark.createDataFrame(narrow.collect(), full.schema)
    run_all(layers.set_up(narrow), shop.reader, DAYS[0])
    assert "FaxNumber" not in layers.silver.read("Sales_Customers").columns
    assert "FaxNumber" not in layers.gold.read("Dim_Customer").columns
    shop.put("Customers", 2, CustomerName="two", FaxNumber="456")
    run_all(layers.set_up(full), shop.reader, DAYS[1])
    assert "change_type" not in layers.silver.read("Sales_Customers").columns
    assert rows_of(layers.silver.read("Sales_Customers"), "CustomerID", "FaxNumber") == [(1, "123"), (1, None), (2, "456")]
    dim = layers.gold.read("Dim_Customer")
    assert rows_of(dim.filter("scd_active = 1"), "CustomerID", "FaxNumber", "scd_version") == [(1, "123", 2), (2, "456", 1)]
    assert rows_of(dim.filter("scd_active = 0"), "CustomerID", "FaxNumber") == [(1, None)]


def test_an_empty_source_leaves_the_mark(lake):
    layers, shop = lake
    layers.set_up()
    first = {r.table: r for r in ingest_all(layers, shop.reader, DAYS[0])}
    assert first[ORDERS.object].counts == {"copied": 1, "unmarked": 0} and first[ORDERS.object].seconds > 0
    mark = layers.watermark("bronze", ORDERS.object)
    kept, shop.tables["Orders"] = shop.tables["Orders"], {}
    (empty,) = ingest_all(layers, shop.reader, DAYS[1], source_object=ORDERS.object)
    assert (empty.status, empty.watermark) == ("no_new_data", mark)
    assert layers.watermark("bronze", ORDERS.object) == mark
    shop.tables["Orders"] = kept
    order(shop, 2, 1, 1, datetime(2024, 1, 9))
    (again,) = ingest_all(layers, shop.reader, DAYS[2], source_object=ORDERS.object)
    assert again.counts == {"copied": 1, "unmarked": 0}
    raw = read_bronze(layers.spark, layers.bronze(layers.config("Bronze", ORDERS.object)[ORDERS.object]))
    assert sorted(r.OrderID for r in raw.collect()) == [1, 2]
    log = layers.watermarks.filter(F.col("object_name") == ORDERS.object).orderBy("timestamp")
    assert [r.key_1 for r in log.collect()] == ["2024-01-01 00:00:00", "2024-01-09 00:00:00"]


def test_rows_without_a_mark_arrive(lake, rows_of):
    layers, shop = lake
    line(shop, 2, 1, 1, None)
    line(shop, 3, 1, 1, datetime(1800, 1, 1))  # before any default mark
    layers.set_up()
    with pytest.raises(UnmarkedRows):
        ingest_all(layers, shop.reader, DAYS[0], source_object="Sales_OrderLines", unmarked="refuse")
    results = {r.table: r for r in run_all(layers, shop.reader, DAYS[0])}
    assert results[FACT_SALES].counts["staged"] == 3
    shop.put("OrderLines", 2, OrderID=1, StockItemID=1, Quantity=99)  # changed, still without a mark
    again = {r.table: r for r in ingest_all(layers, shop.reader, DAYS[1])}
    assert again["Sales_OrderLines"].counts == {"copied": 1, "unmarked": 1}
    results = {r.table: r for r in run_all(layers, shop.reader, DAYS[2])}
    assert results["Sales_OrderLines"].counts["changed"] == 1
    raw = read_bronze(layers.spark, layers.bronze(layers.config("Bronze", "Sales_OrderLines")["Sales_OrderLines"]))
    assert raw.filter("LastEditedWhen IS NULL").count() == 2  # no row is copied twice
    assert rows_of(layers.silver.read("Sales_OrderLines"), "OrderLineID") == [(1,), (2,), (2,), (3,)]


def test_clock_of_the_load_misses_late_edits(lake):
    layers, shop = lake
    layers.set_up()
    ingest_all(layers, shop.reader, DAYS[0], source_object=ORDERS.object, clock="load")
    order(shop, 2, 1, 1, datetime(2024, 1, 1, 3))  # after the mark, before the load
    order(shop, 3, 1, 1, datetime(2024, 1, 2))
    (late,) = ingest_all(layers, shop.reader, DAYS[1], source_object=ORDERS.object, clock="load")
    assert late.counts["copied"] == 1
    order(shop, 4, 1, 1, datetime(2024, 1, 3))
    (source,) = ingest_all(layers, shop.reader, DAYS[2], source_object=ORDERS.object)
    assert source.counts["copied"] == 1
    with pytest.raises(ValueError):
        ingest_all(layers, shop.reader, DAYS[2], source_object=ORDERS.object, clock="wall")


def test_looked_up_values_count_as_changes_on_request(lake):
    layers, shop = lake
    layers.set_up()

    def silver(day):
        ingest_all(layers, shop.reader, day)
        run_silver(layers, day)

    silver(DAYS[0])
    assert load_dimension(layers, DIM_CUSTOMER, DAYS[0], hash_lookups=True).counts["new"] == 1
    shop.put("CustomerCategories", 1, CustomerCategoryName="Wholesale")
    silver(DAYS[1])
    assert load_dimension(layers, DIM_CUSTOMER, DAYS[1], hash_lookups=True).counts["changed"] == 1
    assert layers.gold.read("Dim_Customer").filter("scd_active = 1").first()["CustomerCategoryName"] == "Wholesale"


def test_fact_options(lake, rows_of):
    layers, shop = lake
    layers.set_up()
    line(shop, 2, 1, 1, datetime(2024, 1, 1))
    run_all(layers, shop.reader, DAYS[0])
    line(shop, 1, 1, 1, datetime(2024, 1, 20), qty=7)  # the line alone changes
    ingest_all(layers, shop.reader, DAYS[1])
    run_silver(layers, DAYS[1])
    assert load_fact(layers, DAYS[1], mode="both").counts["staged"] == 0
    line(shop, 1, 1, 1, datetime(2024, 2, 20), qty=8)
    order(shop, 1, 1, None, datetime(2024, 2, 20))
    ingest_all(layers, shop.reader, DAYS[2])
    run_silver(layers, DAYS[2])
    result = load_fact(layers, DAYS[2], mode="both", keep_skeys=False)
    assert (result.counts["staged"], result.counts["replaced"]) == (1, 1) and result.seconds > 0
    assert rows_of(layers.gold.read(FACT_SALES), "OrderLineID", "fact_sales_skey") == [(1, 3), (2, 2)]


def test_updates_leave_the_files_of_other_buckets(lake, rows_of):
    layers, shop = lake
    layers.set_up()
    for key in range(2, 40):
        shop.put("Customers", key, CustomerName=f"c{key}", CustomerCategoryID=1)
    run_all(layers, shop.reader, DAYS[0])

    def files(tables, table):
        held = {}
        for name in layers.spark.table(tables._stored(table)).inputFiles():
            held.setdefault(re.search(r"key_bucket=(\d+)", name)[1], set()).add(name)
        return held

    places = ((layers.silver, "Sales_Customers"), (layers.gold, "Dim_Customer"))
    before = [files(*p) for p in places]
    assert all(4 < len(x) <= 8 for x in before)
    shop.put("Customers", 5, CustomerName="changed", CustomerCategoryID=1)
    shop.drop("Customers", 7)
    run_all(layers, shop.reader, DAYS[1])
    after = [files(*p) for p in places]
    rewritten = [[k for k in b if b[k] != a.get(k)] for b, a in zip(before, after, strict=True)]
    assert 1 <= len(rewritten[0]) <= 2 and len(rewritten[1]) == 1  # changed and deleted key; changed member
    silver = layers.silver.read("Sales_Customers")
    assert silver.columns.count("key_bucket") == 0
    assert rows_of(silver.filter("CustomerID IN (5, 7)"), "CustomerID", "CustomerName", "deleted_audit_ts") == [
        (5, "c5", None), (5, "changed", None), (7, "c7", DAYS[1]),
    ]
    dim = layers.gold.read("Dim_Customer")
    assert dim.count() == dim.select("customer_skey").distinct().count() == 40
    assert rows_of(dim.filter("CustomerID = 5"), "scd_version", "scd_active") == [(1, 0), (2, 1)]
