"""What keeps loads cheap on large tables: registers, buckets, Bloom filters, compaction, and types that widen."""

import re
from datetime import date, datetime, timedelta
from uuid import uuid4

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from strata.errors import IncompatibleTypes
from strata.operators import classify, current_versions, near_stored, replace_by_key, restrict_to_stored
from strata.operators.facts import FACT_SKEY
from strata.operators.shape import merged_schema, widest_type
from strata.plans import Layers, gold, load_fact, load_silver, run_all
from strata.plans import layers as layers_module
from strata.plans.ingest import ingest_all
from strata.plans.pipeline import run_silver
from strata.plans.silver import snapshot_versions
from strata.schemas import DIM_CUSTOMER, FACT_SALES, SOURCES
from strata.session import stage
from strata.sources.bronze import read_bronze, recorded_schema, write_bronze
from strata.sources.tables import Register, Tables
from test_pipeline import DAYS, Shop, line, order


def lake_of(spark, tmp_path, **options):
    layers = Layers(spark, str(tmp_path), f"s{uuid4().hex[:8]}", **options).set_up()
    shop = Shop(spark)
    shop.put("CustomerCategories", 1, CustomerCategoryName="Retail")
    for table in ("Customers", "StockItems", "People"):
        shop.put(table, 1)
    return layers, shop


@pytest.fixture
def tables(spark, tmp_path):
    result = Tables.temporary(spark, str(tmp_path))
    yield result
    result.drop_database()


def fact_files(layers):
    held = {}
    for name in layers.gold.stored(FACT_SALES).inputFiles():
        place = re.search(r"order_month=(\d+)/key_bucket=(\d+)", name)
        held.setdefault((int(place[1]), int(place[2])), set()).add(name)
    return held


def test_one_changed_line_rewrites_one_month_and_bucket(spark, tmp_path, monkeypatch, rows_of):
    layers, shop = lake_of(spark, tmp_path, fact_buckets=4)
    for key in range(1, 61):
        order(shop, key, 1, 1, datetime(2024, 1, 1), day=date(2024, 1 + key % 3, 5))
        line(shop, key, key, 1, datetime(2024, 1, 1))
    run_all(layers, shop.reader, DAYS[0])
    before = fact_files(layers)
    assert len(before) > 6 and layers.gold._register(FACT_SALES) == Register(60, 60)
    seen = {}

    def spy(fact, staged, **options):
        seen.update(files=fact.inputFiles(), numbered=options["numbered"])
        return replace_by_key(fact, staged, **options)

    monkeypatch.setattr(gold, "replace_by_key", spy)
    line(shop, 7, 7, 1, datetime(2024, 1, 20), qty=9)
    results = {r.table: r for r in run_all(layers, shop.reader, DAYS[1])}
    assert results[FACT_SALES].counts["replaced"] == results[FACT_SALES].counts["staged"] == 1
    after = fact_files(layers)
    assert len([place for place in before if before[place] != after.get(place)]) == 1 and set(before) == set(after)
    # Surrogate keys are read in that folder only, and the largest one comes from the register.
    assert seen["numbered"] == 60 and len(seen["files"]) == 1
    line(shop, 61, 7, 1, datetime(2024, 2, 2))
    run_all(layers, shop.reader, DAYS[2])
    assert layers.gold._register(FACT_SALES) == Register(61, 61)
    keys = rows_of(layers.gold.read(FACT_SALES), FACT_SKEY, "OrderLineID")
    assert sorted(keys) == [(i, i) for i in range(1, 62)]
    # An order that moves to another month leaves its old folder.
    order(shop, 7, 1, 1, datetime(2024, 2, 25), day=date(2024, 6, 1))
    run_all(layers, shop.reader, DAYS[3])
    moved = layers.gold.read(FACT_SALES).filter("OrderID = 7")
    assert rows_of(moved, "OrderLineID", "order_month", FACT_SKEY) == [(61, 202406, 61), (7, 202406, 7)]
    assert layers.gold.read(FACT_SALES).count() == 61
    layers.drop()


def test_renumbering_reads_stored_keys_only_if_the_largest_is_replaced(spark, tmp_path, monkeypatch, rows_of):
    layers, shop = lake_of(spark, tmp_path, fact_buckets=2)
    order(shop, 1, 1, 1, datetime(2024, 1, 1))
    for key in (1, 2, 3):
        line(shop, key, 1, 1, datetime(2024, 1, 1))
    run_all(layers, shop.reader, DAYS[0])
    numbered = []

    def spy(fact, staged, **options):
        numbered.append(options["numbered"])
        return replace_by_key(fact, staged, **options)

    monkeypatch.setattr(gold, "replace_by_key", spy)
    for day, key in ((1, 1), (2, 1)):
        line(shop, key, 1, 1, DAYS[day] - timedelta(days=1), qty=day + 5)
        ingest_all(layers, shop.reader, DAYS[day])
        run_silver(layers, DAYS[day])
        load_fact(layers, DAYS[day], keep_skeys=False)
    assert numbered[0] == 3 and not isinstance(numbered[1], int)
    assert rows_of(layers.gold.read(FACT_SALES), "OrderLineID", FACT_SKEY) == [(1, 4), (2, 2), (3, 3)]
    assert layers.gold._register(FACT_SALES) == Register(4, 3)
    layers.drop()


def test_a_failed_load_leaves_the_register_open(tables):
    spark = tables.spark
    rows = spark.range(1, 6).select(F.col("id").alias("k"))
    with tables.registered("t", "k") as register:
        assert register == Register(0, 0)
        tables.create(rows, "t")
        register.high, register.rows = 5, 5
    with pytest.raises(RuntimeError), tables.registered("t", "k") as register:
        tables.append(spark.range(6, 9).select(F.col("id").alias("k")), "t")
        raise RuntimeError("lost")
    with tables.registered("t", "k") as register:
        assert register == Register(8, 8)  # counted anew
        register.high = 20  # numbers that were reserved but hold no row any more
    tables.replace(tables.read("t"), "t")
    with tables.registered("t", "k") as register:
        assert register == Register(20, 8)


def rows_read(spark, df):
    """Rows that the scans of a query hand on."""
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway

    def stages():
        quantiles, statuses = gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList()
        found = store.stageList(None, False, False, quantiles, statuses)
        return {found.apply(i).stageId(): found.apply(i) for i in range(found.size())}

    known = set(stages())
    df.write.format("noop").mode("overwrite").save()
    return sum(s.inputRecords() for i, s in stages().items() if i not in known)


@pytest.mark.parametrize("dictionary", ["true", "false"])
def test_scattered_edits_read_only_files_that_hold_their_keys(tables, dictionary):
    """Six loads whose keys lie in each other's ranges: statistics alone would skip nothing."""
    spark = tables.spark
    context = spark.sparkContext._jsc.hadoopConfiguration()
    context.set("parquet.enable.dictionary", dictionary)
    try:
        for part in range(6):
            rows = spark.range(part, 60_000, 6, numPartitions=1).select(F.col("id").alias("k"), F.col("id").alias("v"))
            if part:
                tables.append(rows, "t")
            else:
                tables.create(rows, "t", indexed=["k"])
    finally:
        context.unset("parquet.enable.dictionary")
    assert tables.layout("t").indexed == ("k",)
    oldest_and_newest = stage(spark.createDataFrame([(6,), (59_993,), (6,)], "k long"), "keys")
    found = restrict_to_stored(tables.read("t"), oldest_and_newest, "k")
    assert sorted(r.k for r in found.collect()) == [6, 59_993]
    assert rows_read(spark, found) <= 20_000
    many = stage(spark.range(10, 5_000).select(F.col("id").alias("k")), "keys")
    assert restrict_to_stored(tables.read("t"), many, "k").count() == 4_990


def test_the_stored_side_of_a_comparison_is_not_shuffled(spark, tmp_path):
    layers, shop = lake_of(spark, tmp_path)
    for key in range(2, 30):
        shop.put("Customers", key, CustomerName=f"c{key}")
    order(shop, 1, 1, 1, datetime(2024, 1, 1))
    line(shop, 1, 1, 1, datetime(2024, 1, 1))
    run_all(layers, shop.reader, DAYS[0])
    stored = layers.silver.read("Sales_Customers")
    staged = stored.filter("CustomerID > 5").withColumn("audit_ts", F.current_timestamp())
    staged = spark.createDataFrame(staged.collect(), stored.schema)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changes = snapshot_versions(staged, stored)
        plan = changes._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Joined and ranked by key: the only exchange brings the staged rows to the buckets.
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1 and "Window" in plan
    scan = plan[plan.index("SortMergeJoin") :].split("\n")
    stored_side = scan[max(i for i, text in enumerate(scan) if "Exchange" in text) + 1 :]
    assert any("FileScan" in text for text in stored_side)
    assert {r.change_type: r["count"] for r in changes.groupBy("change_type").count().collect()} == {"deleted": 5, "same": 24}
    layers.drop()


def test_the_log_keeps_a_bounded_number_of_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layers_module, "LOG_FILES", 4)
    layers = Layers(spark, str(tmp_path), "compacting").set_up()
    start = datetime(2024, 1, 1)
    for i in range(12):
        for object_name in ("a", "b"):
            now = start + timedelta(hours=i)
            previous = layers.watermark("bronze", object_name)
            layers.advance("bronze", object_name, start + timedelta(days=i), now, previous)
        assert len(layers.watermarks.inputFiles()) <= 5
        assert layers.watermark("bronze", "a") == start + timedelta(days=i)
    layers.advance("silver", "a", start, start, None)
    everything = layers.watermarks.unionByName(layers.control.read(layers.HISTORY))
    assert everything.count() == 25 == everything.distinct().count()
    assert layers.reset() >= 2
    assert layers.watermark("bronze", "a") is None and layers.watermark("silver", "a") == start
    layers.drop()


def test_types_that_widen_between_runs_reach_all_layers(spark, tmp_path, rows_of):
    layers, shop = lake_of(spark, tmp_path)
    order(shop, 1, 1, 1, datetime(2024, 1, 1))
    line(shop, 1, 1, 1, datetime(2024, 1, 1), qty=3)
    run_all(layers, shop.reader, DAYS[0])
    large = 5_000_000_000
    shop.put("Customers", large, CustomerName="far")
    shop.put("People", large, FullName="far")
    order(shop, large, large, large, datetime(2024, 1, 20))
    line(shop, large, large, 1, datetime(2024, 1, 20), qty=large, price="1.00", rate="0.000")

    def reader(schema, table):
        source = next(s for s in SOURCES if s.table == table)
        wide = StructType([StructField(f.name, LongType() if f.dataType == IntegerType() else f.dataType) for f in source.schema])
        rows = [tuple(r.get(n) for n in wide.names) for r in shop.tables[table].values()]
        return spark.createDataFrame(rows, wide)

    results = {r.table: r for r in run_all(layers, reader, DAYS[1])}
    # Values that have not changed are not new versions under their wider type.
    assert results["Sales_Customers"].counts == {"new": 1, "changed": 0, "deleted": 0, "same": 1}
    assert results["Dim_People"].counts["changed"] == 0
    for tables, name, column in (
        (layers.silver, "Sales_Orders", "OrderID"), (layers.silver, "Sales_Customers", "CustomerID"),
        (layers.gold, "Dim_Customer", "CustomerID"), (layers.gold, FACT_SALES, "OrderID"),
    ):
        stored = tables.read(name)
        assert stored.schema[column].dataType == LongType()
        assert rows_of(stored, column) == [(1,), (large,)]
    fact = layers.gold.read(FACT_SALES).filter(F.col("OrderID") == large).first()
    assert (int(fact["Quantity"]), fact["customer_skey"], fact[FACT_SKEY]) == (large, 2, 2)
    # A source that goes back to the narrow type is read as the wide one.
    order(shop, 2, 1, 1, datetime(2024, 2, 20))
    narrow = Shop(spark)
    narrow.tables = {t: {k: v for k, v in rows.items() if k != large} for t, rows in shop.tables.items()}
    run_all(layers, narrow.reader, DAYS[2])
    assert layers.silver.read("Sales_Orders").count() == 3
    layers.drop()


def test_types_of_copies(spark, tmp_path):
    path = str(tmp_path / "raw")
    audit = F.lit(DAYS[0]).cast("timestamp").alias("audit_ts")
    write_bronze(spark.sql("SELECT 1 AS a, CAST(1.5 AS decimal(5,2)) AS d, 'x' AS s").select("*", audit), path, DAYS[0])
    write_bronze(spark.sql("SELECT 3000000000 AS a, CAST(1.5 AS decimal(9,4)) AS d, 'y' AS s, 1 AS n").select("*", audit), path, DAYS[1])
    write_bronze(spark.sql("SELECT 2 AS a").select("*", audit), path, DAYS[2])
    rows = read_bronze(spark, path).select("a", F.col("d").cast("string"), "s", "n").orderBy("a")
    assert [tuple(r) for r in rows.collect()] == [(1, "1.5000", "x", None), (2, None, None, None), (3000000000, "1.5000", "y", 1)]
    with pytest.raises(IncompatibleTypes):
        write_bronze(spark.sql("SELECT 'text' AS a").select("*", audit), path, DAYS[3])
    assert read_bronze(spark, path).count() == 3
    assert recorded_schema(spark, path).names == ["a", "d", "s", "audit_ts", "n"]
    # Copies from before schemas were recorded are merged once.
    old = str(tmp_path / "old")
    spark.sql("SELECT 1 AS a").select("*", audit).write.parquet(f"{old}/year=2024/month=01/day=01")
    assert recorded_schema(spark, old) is None and read_bronze(spark, old).count() == 1
    write_bronze(spark.sql("SELECT 2L AS a, 'z' AS s").select("*", audit), old, DAYS[1])
    assert sorted((r.a, r.s) for r in read_bronze(spark, old).collect()) == [(1, None), (2, "z")]


def test_widest_types():
    types = StructType.fromDDL("b byte, i int, l long, f float, g double, d decimal(10,2), e decimal(38,0), s string")
    b, i, long, f, g, d, e, s = (field.dataType for field in types)
    assert widest_type(i, long) == widest_type(long, b) == long and widest_type(f, g) == g
    assert widest_type(i, d) == StructType.fromDDL("x decimal(12,2)")[0].dataType
    assert widest_type(d, e) is None and widest_type(i, s) is None and widest_type(i, f) is None and widest_type(s, s) == s
    with pytest.raises(IncompatibleTypes):
        merged_schema(StructType.fromDDL("a int"), StructType.fromDDL("a date"))


def test_a_grown_table_is_dealt_anew_once(spark, tmp_path, monkeypatch):
    layers, shop = lake_of(spark, tmp_path, buckets=2, bucket_rows=10, fact_buckets=1)
    dealt = []
    redeal = Tables.redeal
    monkeypatch.setattr(Tables, "redeal", lambda self, table, n: (dealt.append((table, n)), redeal(self, table, n))[1])
    for key in range(2, 12):
        shop.put("Customers", key, CustomerName=f"c{key}")
    order(shop, 1, 1, 1, datetime(2024, 1, 1))
    line(shop, 1, 1, 1, datetime(2024, 1, 1))
    run_all(layers, shop.reader, DAYS[0])
    assert dealt == []
    for key in range(12, 111):
        shop.put("Customers", key, CustomerName=f"c{key}")
    for key in range(2, 25):
        line(shop, key, 1, 1, datetime(2024, 1, 20))
    run_all(layers, shop.reader, DAYS[1])
    assert sorted(dealt) == [("Dim_Customer", 16), ("Fact_Sales", 4), ("Sales_Customers", 16)]
    assert layers.gold.layout("Dim_Customer").buckets == ("hash_key", 16)
    assert layers.gold.read("Dim_Customer").count() == 110 == layers.silver.read("Sales_Customers").count()
    assert layers.gold.read(FACT_SALES).count() == 24 and len(fact_files(layers)) == 4
    before = set(layers.gold.stored("Dim_Customer").inputFiles())
    shop.put("Customers", 50, CustomerName="changed")
    run_all(layers, shop.reader, DAYS[2])
    gone = before - set(layers.gold.stored("Dim_Customer").inputFiles())
    assert len({re.search(r"key_bucket=(\d+)", name)[1] for name in gone}) == 1 and len(dealt) == 3
    assert layers.gold._register(DIM_CUSTOMER.name) == Register(111, 111)
    layers.drop()


def test_an_incremental_load_reads_no_history(spark, tmp_path, monkeypatch, rows_of):
    layers, shop = lake_of(spark, tmp_path)
    name, side = "Sales_OrderLines", "Sales_OrderLines_current"
    read = []
    plain = Tables.read
    monkeypatch.setattr(Tables, "read", lambda self, table: (read.append(table), plain(self, table))[1])

    def load(day, lines):
        for key, qty in lines.items():
            line(shop, key, 1, 1, DAYS[day] - timedelta(days=1), qty=qty)
        ingest_all(layers, shop.reader, DAYS[day], source_object=name)
        read.clear()
        return load_silver(layers, name, DAYS[day]).counts

    assert load(0, {key: 1 for key in range(1, 21)}) == {"new": 20}
    assert load(1, {1: 2, 2: 1, 21: 1}) == {"new": 1, "changed": 2, "same": 0}  # edited is changed
    assert name not in read and side in read
    assert plain(layers.silver, side).count() == 23 and layers.silver._register(side).high == 2
    # Many superseded rows: compacted to one row per key.
    assert load(2, {key: 7 for key in range(5, 12)})["changed"] == 7
    assert plain(layers.silver, side).count() == 21 and layers.silver._register(side) == Register(0, 30)
    newest = current_versions(plain(layers.silver, name), active=None)
    assert rows_of(newest, "hash_key", "row_hash") == rows_of(plain(layers.silver, side), "hash_key", "row_hash")

    # A load that ends between the two tables leaves the register open; the next one builds the side table anew.
    append = Tables.append

    def lost(self, df, table, **options):
        if table == side:
            raise RuntimeError("lost")
        append(self, df, table, **options)

    monkeypatch.setattr(Tables, "append", lost)
    with pytest.raises(RuntimeError):
        load(3, {1: 9, 30: 1})
    monkeypatch.setattr(Tables, "append", append)
    assert load_silver(layers, name, DAYS[3]).counts == {"new": 0, "changed": 0, "same": 2}
    assert plain(layers.silver, name).filter("OrderLineID IN (1, 30)").count() == 4
    assert plain(layers.silver, side).count() == 22
    layers.drop()


def test_large_loads_do_not_shuffle_the_versions_in_force(tables):
    spark = tables.spark
    rows = spark.range(3_000).select(
        F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("hash_key"), F.lit("a").alias("row_hash"),
        F.lit(DAYS[0]).cast("timestamp").alias("audit_ts"),
    )
    tables.create(rows, "t", buckets=("hash_key", 4), indexed=["k"])
    staged = stage(rows.withColumn("row_hash", F.lit("b")).filter("k >= 1000"), "staged")
    known = current_versions(near_stored(tables.read("t"), staged, "k"), active=None)
    changes = classify(staged, known, detect_deletes=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = changes._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1 and "GreaterThanOrEqual(k,1000)" in plan
    assert changes.filter("change_type = 'changed'").count() == 2_000
