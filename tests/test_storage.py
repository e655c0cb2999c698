"""Configuration, watermark log, raw files and stored tables."""

import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata.errors import ConfigError, MissingTable, UnknownColumns
from strata.plans import Layers
from strata.schemas import CONFIG_SCHEMA
from strata.sources.bronze import (
    add_lineage,
    extract_delta,
    newer_than,
    read_bronze,
    source_high_water,
    write_bronze,
)
from strata.sources.metadata import (
    NO_WATERMARK,
    ingest_list,
    last_load,
    latest_watermark,
    legacy_config,
    load_config,
    reset_watermark,
    seed_config,
    watermark_rows,
)
from strata.sources.tables import Tables

T = [datetime(2023, 12, 31, 9), datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 18), datetime(2024, 2, 1, 9)]


@pytest.fixture
def tables(spark, tmp_path):
    result = Tables.temporary(spark, str(tmp_path))
    yield result
    result.drop_database()


def test_seeded_config(spark):
    config = seed_config(spark)
    assert config.count() == 18
    rows = {(r["layer"], r["source_object"]): r for r in config.collect()}
    assert sorted(r["config_id"] for r in rows.values()) == list(range(1, 19))
    gold = rows["Gold", "Sales_Customers"]
    assert gold["source_table"] is None and "DeliveryRun" not in gold["column_list"] and gold["load_type"] == "full"
    assert rows["Silver", "Sales_Customers"]["column_list"] == rows["Bronze", "Sales_Customers"]["column_list"]
    assert "HashedPassword" in rows["Silver", "Application_People"]["column_list"]
    assert legacy_config(config, "Gold").columns == [
        "config_id", "source_system", "source_object", "watermark_column", "business_key", "column_list", "is_active",
    ]
    assert [r["config_id"] for r in legacy_config(config, "Silver").orderBy("config_id").collect()] == [1, 2, 3, 4, 5, 6]
    assert ingest_list(config).count() == 6 and ingest_list(config, "Sales_Orders").count() == 1


def test_config_guards(spark):
    def row(**changes):
        base = dict(
            config_id=1, layer="Silver", source_system="s", source_schema="a", source_table="b", source_object="a_b",
            load_type="incremental", watermark_column="w", business_key="x, y ", column_list="x,y,z", is_active=True,
        )
        return spark.createDataFrame([tuple({**base, **changes}.values())], CONFIG_SCHEMA)

    found = load_config(row(), "Silver", ["a_b"])["a_b"]
    assert found.keys == ("x", "y") and found.columns == ("x", "y", "z") and found.incremental
    for broken in ({"is_active": False}, {"layer": "Gold"}, {"business_key": " "}, {"column_list": None}, {"watermark_column": None}):
        with pytest.raises(ConfigError):
            load_config(row(**broken), "Silver", ["a_b"])


def test_watermark_log(spark):
    log = watermark_rows(spark, "bronze", "a", T[1], T[0])
    log = log.union(watermark_rows(spark, "bronze", "a", T[0], T[2])).union(watermark_rows(spark, "silver", "a", T[3], T[3]))
    assert latest_watermark(log, "bronze", "a") == T[0]  # newest entry, not greatest value
    assert last_load(log, "bronze", "a") == T[2]
    assert latest_watermark(log, "bronze", "b") is None and last_load(log, "bronze", "b") is None
    assert [r["layer"] for r in reset_watermark(log).collect()] == ["silver"]


def test_layers_reset(spark, tmp_path):
    layers = Layers(spark, str(tmp_path), "resettable").set_up()
    layers.advance("bronze", "a", T[0], T[1], None)
    layers.advance("silver", "a", T[0], T[1], None)
    layers.advance("silver", "a", T[0], T[2], T[0])  # unchanged value
    layers.advance("silver", "a", T[0], T[2], T[1])  # going back
    assert layers.watermarks.count() == 2
    assert layers.reset() == 1 and layers.reset() == 0
    assert layers.watermark("bronze", "a") is None and layers.watermark("silver", "a") == T[0]
    assert layers.set_up().watermarks.count() == 1
    layers.drop()


def test_delta_bounds(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(T)] + [(9, None)], "id int, edited timestamp")
    assert [r["id"] for r in extract_delta(df, ["id"], "edited", T[0], T[2]).orderBy("id").collect()] == [1, 2, 9]
    assert [r["id"] for r in extract_delta(df, ["id"], "edited", None, T[2], unmarked=False).orderBy("id").collect()] == [0, 1, 2]
    assert [r["id"] for r in extract_delta(df, ["id"], "edited", None, None).collect()] == [9]
    assert source_high_water(df, "edited").first()[0] == T[3]
    assert source_high_water(df.limit(0), "edited").first()[0] == NO_WATERMARK


def test_marks_and_folders_do_not_depend_on_the_clients_time_zone(spark, tmp_path, monkeypatch):
    with monkeypatch.context() as zone:
        zone.setenv("TZ", "Asia/Bangkok")
        time.tzset()
        try:
            load = datetime(2024, 1, 2, 3)  # still January 1st in UTC
            log = watermark_rows(spark, "bronze", "a", load, load)
            assert latest_watermark(log, "bronze", "a") == load
            assert log.first()["key_1"] == "2024-01-01 20:00:00"
            path = str(tmp_path / "raw")
            write_bronze(add_lineage(spark.range(1), "WWI", load), path, load)
            write_bronze(read_bronze(spark, path).drop("year", "month", "day"), path)
            assert [p.name for p in (tmp_path / "raw" / "year=2024" / "month=01").glob("day=*")] == ["day=01"]
            assert read_bronze(spark, path, load).count() == 2
        finally:
            zone.undo()
            time.tzset()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_raw_files_by_day(spark, tmp_path):
    path = str(tmp_path / "raw")
    for i, when in enumerate(T):
        write_bronze(add_lineage(spark.range(i, i + 1), "WWI", when), path, when)
    assert (tmp_path / "raw" / "year=2024" / "month=01" / "day=01").exists()
    assert read_bronze(spark, path).count() == 4
    since = newer_than(read_bronze(spark, path, T[1]), "audit_ts", T[1])
    assert sorted(r["id"] for r in since.collect()) == [2, 3]
    text = plan(since)
    assert "PartitionFilters: [(" in text and "GreaterThan(audit_ts" in text
    history = str(tmp_path / "history")
    write_bronze(read_bronze(spark, path).drop("year", "month", "day"), history)
    assert read_bronze(spark, history, T[3]).count() == 1 and read_bronze(spark, history).count() == 4


def test_replace_while_reading(tables):
    spark = tables.spark
    tables.create(spark.range(3).toDF("v"), "t")
    for expected in ([1, 2, 3], [2, 3, 4], [3, 4, 5]):
        tables.replace(tables.read("t").withColumn("v", F.col("v") + 1), "t")
        assert sorted(r["v"] for r in tables.read("t").collect()) == expected
    with pytest.raises(UnknownColumns):
        tables.append(spark.createDataFrame([("9", "x")], "v string, extra string"), "t")
    tables.append(spark.createDataFrame([("9",)], "v string"), "t")
    assert tables.read("t").columns == ["v"] and tables.read("t").count() == 4
    tables.append(spark.createDataFrame([(10, "x")], "v long, extra string"), "t", evolve=True)
    assert {r["extra"] for r in tables.read("t").collect()} == {None, "x"}
    tables.drop("t")
    with pytest.raises(MissingTable):
        tables.read("t")


def test_failed_replacement_leaves_the_table(tables):
    spark = tables.spark
    tables.create(spark.range(3).toDF("v"), "t")
    with pytest.raises(Exception, match="stop here"):
        tables.replace(spark.range(5).select(F.raise_error(F.lit("stop here")).cast("long").alias("v")), "t")
    assert tables.read("t").count() == 3
    tables.replace(spark.range(5).toDF("v"), "t")
    assert tables.read("t").count() == 5


def test_only_touched_partitions_are_rewritten(tables):
    spark = tables.spark
    rows = spark.createDataFrame([(1, 202401), (2, 202402), (3, 202403)], "v long, m int")
    tables.create(rows, "t", ["m"])
    untouched = {f for f in tables.read("t").inputFiles() if "m=202401" in f}
    # Row 2 moves to another month and leaves its own empty.
    moved = tables.read("t").filter("m IN (202402, 202403)").withColumn("m", F.lit(202403))
    tables.replace_partitions(moved, "t", "m", [202402, 202403])
    assert sorted(map(tuple, tables.read("t").collect())) == [(1, 202401), (2, 202403), (3, 202403)]
    files = tables.read("t").inputFiles()
    assert untouched <= set(files) and not any("m=202402" in f for f in files)
