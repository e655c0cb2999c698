"""Cleaning, projections, hashes and surrogate keys on literal rows."""

import hashlib
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.errors import MissingColumns
from strata.functions import hash_expr, split_list, with_sales_measures
from strata.operators import (
    add_surrogate_key,
    align_to,
    calendar,
    clean_strings,
    conform,
    dates_to_timestamp,
    drop_columns,
    empty_like,
    max_skey,
    move_first,
    row_hash,
    select_configured,
    with_hash_key,
)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_blank_strings(spark, rows_of):
    df = spark.createDataFrame([("a",), (" a ",), ("   ",), ("",), ("\ta",), (None,)], "s string")
    assert rows_of(clean_strings(df)) == [("\ta",), ("a",), ("a",), (None,), (None,), (None,)]


def test_all_temporal_types_become_timestamps(spark):
    df = spark.sql("SELECT DATE'2000-02-29' d, TIMESTAMP_NTZ'2000-02-29 01:02:03' n, TIMESTAMP'2000-02-29 01:02:03' t, 1 i")
    result = dates_to_timestamp(df)
    assert [f.dataType.typeName() for f in result.schema] == ["timestamp", "timestamp", "timestamp", "integer"]
    assert result.first()[:2] == (datetime(2000, 2, 29), datetime(2000, 2, 29, 1, 2, 3))


def test_columns_are_dropped_whatever_their_case(spark):
    df = spark.sql("SELECT 1 Photo, 2 websiteURL, 3 keep, 4 year, 5 month, 6 day")
    assert drop_columns(df, ["photo", "WebsiteURL"]).columns == ["keep"]
    assert drop_columns(df, [], partition_columns=[]).columns == df.columns


def test_configured_columns_once_each_and_present(spark):
    df = spark.sql("SELECT 1 a, 2 b, 3 audit_ts, 4 x")
    assert select_configured(df, ["b"], ["a", "b"]).columns == ["b", "a", "audit_ts"]
    with pytest.raises(MissingColumns):
        select_configured(df, ["b"], ["gone"])


def test_align_adds_drops_casts_and_orders(spark):
    df = spark.sql("SELECT 7 extra, '5' n, 1 k")
    target = StructType.fromDDL("k string, missing decimal(18,4), n long")
    aligned = align_to(df, target)
    assert aligned.schema.simpleString() == "struct<k:string,missing:decimal(18,4),n:bigint>"
    assert aligned.first() == ("1", None, 5)


def test_conform_truncates_and_keeps_booleans(spark):
    df = spark.sql("SELECT 9.87 amount, TIMESTAMP'2024-01-02 03:04:05' day, true flag, 'WWI' id")
    done = conform(df, StructType.fromDDL("amount int, day date, flag boolean, id string"))
    assert done.first() == (9, date(2024, 1, 2), True, "WWI")
    with pytest.raises(TypeError):
        conform(df, StructType.fromDDL("flag int"))
    assert conform(df, StructType.fromDDL("id int"), strict=False).first() == (None,)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, StructType.fromDDL("id int")).collect()


def test_small_helpers(spark):
    df = spark.sql("SELECT 1 a, 2 b")
    assert move_first(df, "b").columns == ["b", "a"]
    assert empty_like(df).count() == 0 and empty_like(df).schema == df.schema
    assert split_list("a, b ,,c") == ["a", "b", "c"] and split_list(None) == []


def test_hashes_are_byte_compatible(spark):
    df = spark.sql("SELECT 1 a, CAST(NULL AS STRING) b, 'x' c, DATE'2024-01-02' d, CAST(1.5 AS DECIMAL(18,2)) e")
    row = with_hash_key(df, ["b", "a", "e"]).first()
    assert row["hash_key"] == digest("NULL||1||1.50")
    assert df.select(row_hash(df, ["d", "c", "a", "hash_key", "zz"])).first()[0] == digest("1||x||2024-01-02")
    given = row_hash(df, ["d", "c", "a"], order="given", exclude=["c"])
    assert df.select(given).first()[0] == digest("2024-01-02||1")
    with pytest.raises(ValueError, match="no columns"):
        row_hash(df, ["audit_ts", "row_hash"])


def test_safe_hash_separates_what_the_plain_one_confuses(spark):
    pairs = [("a||b", "c"), ("a", "b||c"), ("NULL", "x"), (None, "x"), ("\\N", "x"), ("a\\", "|b"), ("a", "\\||b")]
    df = spark.createDataFrame(pairs, "l string, r string")
    plain = df.select(hash_expr(["l", "r"])).distinct().count()
    assert plain < len(pairs) == df.select(hash_expr(["l", "r"], safe=True)).distinct().count()


def test_surrogate_keys_equal_a_global_row_number(spark, rows_of):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("hot"), F.hash("id").alias("h"))
    expected = df.withColumn("skey", F.row_number().over(W.orderBy("hot", "k")) + 41)
    numbered = add_surrogate_key(df, "skey", ["hot", "k"], start=41)
    assert numbered.columns[0] == "skey"
    assert numbered.exceptAll(expected.select(*numbered.columns)).count() == 0
    assert numbered.count() == 5000
    used = spark.createDataFrame([(3,), (100,)], "skey long")
    assert add_surrogate_key(df, "skey", ["k"], after=used).agg(F.min("skey"), F.max("skey")).first() == (101, 5100)
    nothing_used = used.limit(0)
    assert add_surrogate_key(df, "skey", ["k"], after=nothing_used).agg(F.max("skey")).first()[0] == 5000
    assert add_surrogate_key(df.limit(0), "skey", ["k"], after=used).count() == 0


def test_largest_key_of_nothing_is_zero(spark):
    df = spark.sql("SELECT 5 skey")
    assert max_skey(df, "skey") == 5
    assert max_skey(df, "other") == max_skey(None, "skey") == max_skey(df.limit(0), "skey") == 0


def test_measures(spark):
    rows = [(3, Decimal("99.99"), Decimal("15.000"), None), (None, Decimal("1.00"), None, 2), (2, None, Decimal("5.000"), 2)]
    df = spark.createDataFrame(rows, "Quantity int, UnitPrice decimal(18,2), TaxRate decimal(18,3), PickedQuantity int")
    got = [tuple(r) for r in with_sales_measures(df).select("sales_amount_net", "tax_amount", "sales_amount_gross").collect()]
    zero = Decimal("0.0000")
    assert got == [(Decimal("299.9700"), Decimal("44.9955"), Decimal("344.9655")), (zero, zero, zero), (zero, zero, zero)]
    half = spark.createDataFrame([(1, Decimal("0.01"), Decimal("0.500"), 0)], df.schema)
    assert with_sales_measures(half).first()["tax_amount"] == Decimal("0.0001")  # 0.00005 rounds up


def test_calendar(spark):
    days = calendar(spark)
    assert days.count() == 11_688 and len(days.columns) == 18
    row = days.filter("date_key = 20270101").first().asDict()
    assert (row["week_of_year"], row["day_of_week"], row["day_name"], row["is_weekend"]) == (53, 6, "Friday", False)
    assert (row["year_quarter"], row["month_short"], row["is_month_start"]) == ("2027-Q1", "Jan", True)
    leap = days.filter("date_key = 20000229").first()
    assert leap["is_month_end"] and leap["year_month_key"] == 200002
    weekend = days.filter("date_key IN (20240106, 20240107)").select("is_weekend", "day_of_week").collect()
    assert sorted(map(tuple, weekend)) == [(True, 1), (True, 7)]
