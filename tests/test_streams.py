"""The cleaned layer as a stream of raw files, and values that do not convert."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.errors import ConfigError
from strata.operators import conform
from strata.plans import load_silver, stream_silver
from strata.plans.ingest import ingest_all
from strata.schemas import ORDER_LINES
from strata.sources.bronze import RESCUED, read_bronze
from test_pipeline import DAYS, line, order
from test_scale import lake_of


def fill(layers, shop, day):
    edited = datetime(2024, 1, 1) if day == 0 else datetime(2024, day, 20)
    for key in range(day * 3, day * 3 + 6):
        line(shop, key, 1, 1, edited, qty=key + day % 2)
    ingest_all(layers, shop.reader, DAYS[day], source_object=ORDER_LINES.object)


def test_a_stream_of_batches_equals_the_loads(spark, tmp_path, rows_of):
    columns = ("OrderLineID", "Quantity", "row_hash", "audit_ts")
    name = ORDER_LINES.object
    streamed, shop = lake_of(spark, tmp_path / "s")
    loaded, same = lake_of(spark, tmp_path / "l")
    checkpoint = str(tmp_path / "checkpoint")
    counts = []
    for day in (0, 1, 2):
        fill(streamed, shop, day)
        fill(loaded, same, day)
        counts.append(stream_silver(streamed, name, checkpoint, DAYS[day]).counts)
        assert {k: v for k, v in counts[-1].items() if v} == {k: v for k, v in load_silver(loaded, name, DAYS[day]).counts.items() if v}
        assert rows_of(streamed.silver.read(name), *columns) == rows_of(loaded.silver.read(name), *columns)
    assert counts[0] == {"new": 6, "changed": 0, "same": 0} and counts[1]["changed"] == 3
    # Nothing new to read; then all files again, as after a checkpoint that was lost before its batch was confirmed.
    assert stream_silver(streamed, name, checkpoint, DAYS[3]).status == "no_new_data"
    before = rows_of(streamed.silver.read(name), *columns)
    again = stream_silver(streamed, name, str(tmp_path / "other"), DAYS[3])
    assert again.counts == {"new": 0, "changed": 0, "same": 12} and rows_of(streamed.silver.read(name), *columns) == before
    with pytest.raises(ConfigError):
        stream_silver(streamed, "Sales_Customers", checkpoint, DAYS[3])
    streamed.drop()
    loaded.drop()


def test_a_failed_batch_is_repeated(spark, tmp_path, monkeypatch):
    layers, shop = lake_of(spark, tmp_path)
    for day in (0, 1):
        fill(layers, shop, day)
    checkpoint, name = str(tmp_path / "checkpoint"), ORDER_LINES.object
    from strata.plans import silver

    add, calls = silver._add_versions, []

    def lost(*args):
        calls.append(add(*args))
        if len(calls) == 2:
            raise RuntimeError("lost after the rows were stored")
        return calls[-1]

    monkeypatch.setattr(silver, "_add_versions", lost)
    with pytest.raises(Exception, match="lost after"):
        stream_silver(layers, name, checkpoint, DAYS[1], files_per_batch=1)
    stored = layers.silver.read(name).count()
    stream_silver(layers, name, checkpoint, DAYS[2], files_per_batch=1)
    rows = layers.silver.read(name)
    assert len(calls) > 2 and calls[2]["new"] == 0 < calls[2]["same"]  # the batch whose rows were stored
    assert rows.count() == rows.select("OrderLineID", "row_hash").distinct().count() >= stored
    assert rows.select("OrderLineID").distinct().count() == 9
    layers.drop()


def test_values_that_do_not_convert_are_kept_and_counted(spark, tmp_path, rows_of):
    rows = spark.createDataFrame([("1", "2024-01-05", "x"), ("two", "soon", None), (None, None, "y")], "a string, d string, s string")
    done = conform(rows, StructType.fromDDL("a int, d date, s string"), rescued="lost")
    assert [r["lost"] for r in done.orderBy(F.col("s").desc_nulls_last()).collect()] == [{}, {}, {"a": "two", "d": "soon"}]
    assert rows_of(done, "a", "s") == [(1, "x"), (None, "y"), (None, None)]
    assert conform(rows, StructType.fromDDL("a string"), rescued="lost").schema["lost"].dataType.simpleString() == "map<string,string>"

    layers, shop = lake_of(spark, tmp_path)
    order(shop, 1, 1, 1, datetime(2024, 1, 1))
    line(shop, 1, 1, 1, datetime(2024, 1, 1))
    line(shop, 2, 1, 1, datetime(2024, 1, 1))

    def reader(schema, table):
        text = shop.reader(schema, table).withColumn("Quantity", F.col("Quantity").cast("string"))
        return text.withColumn("Quantity", F.when(F.col("OrderLineID") == 2, "a dozen").otherwise(F.col("Quantity")))

    name = ORDER_LINES.object
    (result,) = ingest_all(layers, reader, DAYS[0], source_object=name, types={name: ORDER_LINES.schema})
    assert result.counts == {"copied": 2, "rescued Quantity": 1, "unmarked": 0}
    raw = read_bronze(spark, layers.bronze(layers.config("Bronze", name)[name]))
    assert raw.schema["Quantity"].dataType.simpleString() == "int"
    assert [r[RESCUED] for r in raw.orderBy("OrderLineID").collect()] == [{}, {"Quantity": "a dozen"}]
    load_silver(layers, name, DAYS[0])
    stored = layers.silver.read(name)
    assert RESCUED not in stored.columns and rows_of(stored, "OrderLineID", "Quantity") == [(1, 2), (2, None)]
    layers.drop()
