"""Latest versions, change detection, merges, dimensions and facts on literal rows."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.errors import DuplicateKeys, EmptySnapshot, MissingColumns
from strata.operators import (
    assert_unique,
    changed_facts,
    changed_rows,
    classify,
    classify_members,
    current_versions,
    deleted_keys,
    enrich,
    infer_members,
    keep_earliest,
    keep_latest,
    latest_snapshot,
    latest_snapshot_at,
    lookup_skey,
    merge_delete,
    merge_update,
    new_keys,
    replace_by_key,
    restrict_to,
    restrict_to_stored,
    scd1_next,
    scd2_next,
    scd2_recalc,
)
from strata.plans.silver import incremental_versions, snapshot_next, snapshot_versions, stage_rows
from strata.session import stage

T = [datetime(2024, m, 1) for m in range(1, 8)]
LOADED_AT = datetime(2024, 12, 1)
OPEN = datetime(2999, 12, 31)


def test_ties_are_broken_the_same_way_each_time(spark, rows_of):
    rows = [(1, T[0], "a"), (1, T[0], "b"), (1, None, "z"), (2, T[1], "c")]
    df = spark.createDataFrame(rows, "k int, audit_ts timestamp, row_hash string").repartition(3)
    assert rows_of(keep_latest(df, ["k"], ["audit_ts", "row_hash"]), "k", "row_hash") == [(1, "b"), (2, "c")]
    assert rows_of(keep_earliest(df.dropna(), ["k"], ["audit_ts", "row_hash"]), "k", "row_hash") == [(1, "a"), (2, "c")]


def test_composite_key_and_null_key(spark):
    df = spark.createDataFrame([(1, None, 5), (1, None, 6), (1, 2, 1)], "a int, b int, v int")
    assert sorted(r["v"] for r in keep_latest(df, ["a", "b"], ["v"]).collect()) == [1, 6]


def test_open_versions_before_or_after_ranking(spark, rows_of):
    # The newest version is deleted while an older one was left open.
    df = spark.createDataFrame(
        [("k", T[0], "1", None), ("k", T[1], "2", T[2]), ("l", T[0], "3", None)],
        "hash_key string, audit_ts timestamp, row_hash string, deleted_audit_ts timestamp",
    )
    assert rows_of(current_versions(df, active="before"), "row_hash") == [("1",), ("3",)]
    assert rows_of(current_versions(df, active="after"), "row_hash") == [("3",)]
    assert rows_of(current_versions(df, active=None), "row_hash") == [("2",), ("3",)]
    assert rows_of(current_versions(df.drop("deleted_audit_ts")), "row_hash") == [("2",), ("3",)]


def test_snapshot_isolation(spark):
    df = spark.createDataFrame([(1, T[0]), (2, T[1]), (3, T[1]), (4, None)], "k int, audit_ts timestamp")
    assert sorted(r["k"] for r in latest_snapshot(df).collect()) == [2, 3]
    rows, newest = latest_snapshot_at(df)
    assert newest == T[1] and rows.count() == 2
    for empty in (df.limit(0), df.filter("k = 4")):
        with pytest.raises(EmptySnapshot):
            latest_snapshot_at(empty)


def change_set(spark):
    current = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "hash_key string, row_hash string")
    staged = spark.createDataFrame([("1", "a", 1), ("2", "B", 2), ("4", "d", 4)], "hash_key string, row_hash string, v int")
    return staged, current


def test_classification_equals_three_separate_joins(spark, rows_of):
    staged, current = change_set(spark)
    changes = classify(staged, current, detect_deletes=True)
    assert rows_of(changes, "hash_key", "change_type", "v") == [
        ("1", "same", 1), ("2", "changed", 2), ("3", "deleted", None), ("4", "new", 4),
    ]
    for kind, apart in (("new", new_keys), ("changed", changed_rows), ("deleted", deleted_keys)):
        together = changes.filter(F.col("change_type") == kind).select("hash_key")
        assert rows_of(together) == rows_of(apart(staged, current).select("hash_key"))
    assert classify(staged, current, detect_deletes=False).filter("change_type = 'deleted'").count() == 0


def test_merge_update_touches_every_matching_row_once(spark, rows_of):
    target = spark.createDataFrame([("k", 1, 5), ("k", 2, None), ("l", 3, None)], "hash_key string, id int, v int")
    source = spark.createDataFrame([("k", 9)], "hash_key string, v int")
    merged = merge_update(target, source, ["hash_key"], {"v": F.col("s.v")}, F.col("t.v").isNull())
    assert rows_of(merged, "id", "v") == [(1, 5), (2, 9), (3, None)]
    with pytest.raises(DuplicateKeys):
        assert_unique(source.union(source), ["hash_key"])
    with pytest.raises(MissingColumns):
        merge_update(target, source, ["hash_key"], {"nope": F.lit(1)})
    assert rows_of(merge_delete(target, source.union(source), ["hash_key"]), "id") == [(3,)]


def test_lookup_defaults(spark, rows_of):
    dim = spark.createDataFrame([(1, 10, 0), (1, 11, 1), (2, 12, 1)], "PersonID int, person_skey long, scd_active int")
    df = spark.createDataFrame([(1,), (3,), (None,)], "SalespersonPersonID int")
    assert rows_of(lookup_skey(df, dim, "SalespersonPersonID", "PersonID", "person_skey")) == [(1, 11), (3, -1), (None, -1)]
    names = spark.createDataFrame([(1, "one"), (2, None)], "id int, name string")
    got = enrich(df.withColumn("name", F.lit("old")), names, {"SalespersonPersonID": "id"}, {"name": "UNKNOWN"})
    assert rows_of(got) == [(1, "one"), (3, "UNKNOWN"), (None, "UNKNOWN")]


def silver(spark, rows, when):
    df = spark.createDataFrame(rows, "id int, name string").withColumns(
        {"source_id": F.lit("WWI"), "audit_ts": F.lit(when)}
    )
    staged = stage_rows(df, ["id"], ["id", "name"], when)
    return staged.withColumn("deleted_audit_ts", F.lit(None).cast("timestamp"))


def test_key_that_disappears_and_returns(spark, rows_of):
    table = silver(spark, [(1, "a"), (2, "b")], T[0])
    loads = [([(1, "A")], T[1]), ([(1, "A"), (2, "b")], T[2]), ([(2, "b"), (1, "A")], T[3])]
    for rows, when in loads:
        changes = stage(snapshot_versions(silver(spark, rows, when), table), "changes")
        table = stage(snapshot_next(table, changes, when), "customers")
    assert rows_of(table, "id", "name", "audit_ts", "deleted_audit_ts") == [
        (1, "A", T[1], None), (1, "a", T[0], None), (2, "b", T[0], T[1]), (2, "b", T[2], None),
    ]


def test_restriction_by_range_keeps_every_row_of_the_keys(spark, rows_of):
    history = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (5, "d"), (None, "e")], "k int, v string")
    for keys, expected in (
        ([2, 5], [("b",), ("c",), ("d",)]),
        ([3], []),
        ([None, 1], [("a",), ("e",)]),
        ([], []),
    ):
        wanted = spark.createDataFrame([(k,) for k in keys], "k int")
        assert rows_of(restrict_to_stored(history, wanted, "k"), "v") == expected
        assert rows_of(restrict_to(history, wanted, "k"), "v") == [row for row in expected if row != ("e",)]


def test_incremental_rerun_adds_nothing(spark):
    table = silver(spark, [(1, " a "), (1, "a"), (2, " "), (None, "n")], T[0]).drop("deleted_audit_ts")
    assert table.count() == 3
    again = incremental_versions(silver(spark, [(1, "a"), (2, None), (None, "n")], T[1]).drop("deleted_audit_ts"), table, ["id"])
    assert {r["change_type"] for r in again.collect()} == {"same"}


DIM = (
    "skey long, id int, name string, hash_key string, row_hash string, source_id string, audit_ts timestamp, "
    "updated_audit_ts timestamp, scd_start timestamp, scd_from timestamp, scd_to timestamp, scd_active int, "
    "scd_version int, inferred_flag int"
)


def members(spark, dim, rows, when):
    staged = spark.createDataFrame(rows, "id int, name string").select(
        "id", "name", F.lit("WWI").alias("source_id"), F.lit(when).alias("audit_ts"),
        F.sha2(F.col("id").cast("string"), 256).alias("hash_key"), F.col("name").alias("row_hash"),
    )
    return classify_members(staged, dim, "skey")


def load(spark, dim, rows, when, step=scd2_next):
    now = F.lit(when).cast("timestamp")
    stored = stage(members(spark, dim, rows, when), "members")
    return stage(step(dim, stored, skey="skey", keys=["id"], attributes=["id", "name"], now=now), "dim")


def test_scd2_over_three_loads_and_a_late_version(spark, rows_of):
    dim = spark.createDataFrame([], DIM)
    dim = load(spark, dim, [(1, "a"), (2, "b")], T[0])
    dim = load(spark, dim, [(1, "A"), (3, "c")], T[3])
    dim = load(spark, dim, [(1, "late")], T[1])  # arrives last, valid in between
    assert rows_of(dim, "id", "scd_version", "name", "scd_from", "scd_to", "scd_active", "scd_start", "skey") == [
        (1, 1, "a", T[0], T[1], 0, T[0], 1),
        (1, 2, "late", T[1], T[3], 0, T[0], 5),
        (1, 3, "A", T[3], OPEN, 1, T[0], 3),
        (2, 1, "b", T[0], OPEN, 1, T[0], 2),
        (3, 1, "c", T[3], OPEN, 1, T[3], 4),
    ]


def test_recalculation_of_some_keys_and_of_a_key_with_many_versions_a_day(spark):
    unlinked = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("hash_key"),
        F.col("id").alias("skey"),
        F.timestamp_seconds(F.lit(1700000000) + F.col("id") * 97 % 4001 * 600).alias("scd_from"),
        F.timestamp_seconds(F.lit(1700000000) + F.col("id")).alias("scd_start"),
        F.lit(None).cast("timestamp").alias("scd_to"), F.lit(9).alias("scd_active"), F.lit(9).alias("scd_version"),
    ).withColumn("audit_ts", F.col("scd_from"))
    rows = [r.asDict() for r in scd2_recalc(unlinked, "skey").collect()]
    by_key = {}
    for row in rows:
        by_key.setdefault(row["hash_key"], []).append(row)
    for chain in by_key.values():
        chain.sort(key=lambda r: (r["scd_from"], r["skey"]))
        assert [r["scd_version"] for r in chain] == list(range(1, len(chain) + 1))
        assert [r["scd_to"] for r in chain] == [r["scd_from"] for r in chain[1:]] + [OPEN]
        assert [r["scd_active"] for r in chain] == [0] * (len(chain) - 1) + [1]
        assert len({r["scd_start"] for r in chain}) == 1
    only = scd2_recalc(unlinked, "skey", keys=spark.createDataFrame([("hot",), ("hot",)], "hash_key string"))
    assert only.filter("hash_key <> 'hot' AND scd_version <> 9").count() == 0
    assert only.filter("hash_key = 'hot' AND scd_active = 1").count() == 1 and only.count() == 4000


def test_placeholder_is_filled_in_place(spark, rows_of):
    dim = load(spark, spark.createDataFrame([], DIM), [(1, "a")], T[1])
    facts = spark.createDataFrame(
        [(7, T[2], "WWI"), (7, T[0], "WWI"), (1, T[0], "WWI"), (None, T[0], "WWI")],
        "CustomerID int, audit_ts timestamp, source_id string",
    )
    found = infer_members(facts, dim, {"id": "CustomerID"}, skey="skey", now=F.lit(LOADED_AT))
    assert rows_of(found, "skey", "id", "name", "row_hash", "scd_from", "inferred_flag") == [(2, 7, None, "", T[0], 1)]
    assert infer_members(facts, dim.union(found), {"id": "CustomerID"}, skey="skey", now=F.lit(LOADED_AT)).count() == 0
    for step in (scd2_next, scd1_next):
        filled = load(spark, dim.union(found), [(7, "g"), (1, "a")], T[3], step)
        assert rows_of(filled.filter("id = 7"), "skey", "name", "inferred_flag", "scd_version", "scd_from", "updated_audit_ts") == [
            (2, "g", 0, 1, T[0], T[3])
        ]
        assert filled.count() == 2


def test_blank_text_keys_are_not_inferred(spark, rows_of):
    dim = spark.createDataFrame([], DIM.replace("id int", "id string"))
    facts = spark.createDataFrame([(" x ", T[0], "a"), ("", T[0], "a"), ("  ", T[0], "a")], "k string, audit_ts timestamp, source_id string")
    assert rows_of(infer_members(facts, dim, {"id": "k"}, skey="skey", now=F.lit(LOADED_AT)), "id") == [("x",)]


def test_scd1_keeps_keys_and_rows(spark, rows_of):
    dim = load(spark, spark.createDataFrame([], DIM), [(1, "a"), (2, "b")], T[0], scd1_next)
    dim = load(spark, dim, [(1, "A"), (3, "c")], T[1], scd1_next)
    assert rows_of(dim, "skey", "id", "name", "updated_audit_ts", "scd_version") == [
        (1, 1, "A", T[1], 1), (2, 2, "b", None, 1), (3, 3, "c", None, 1),
    ]


def fact_tables(spark):
    lines = spark.createDataFrame(
        [
            (100, 1, T[0], "a"), (100, 2, T[1], "b"),  # has moved to another order
            (101, 1, T[0], "c"), (102, 2, T[0], "d"), (103, 3, T[2], "e"), (104, 9, T[2], "f"),
        ],
        "OrderLineID int, OrderID int, audit_ts timestamp, row_hash string",
    )
    lines = lines.withColumns(
        {c: F.lit(v) for c, v in {"Quantity": 1, "UnitPrice": Decimal("2.00"), "TaxRate": Decimal("10.000")}.items()}
    ).withColumns({"PickedQuantity": F.lit(0), "source_id": F.lit(None).cast("string")})
    orders = spark.createDataFrame(
        [(1, T[0], "x"), (1, T[2], "y"), (2, T[0], "z"), (3, T[2], "w")],
        "OrderID int, audit_ts timestamp, row_hash string",
    )
    day = F.lit("2024-05-06 07:08:09").cast("timestamp")
    return lines, orders.withColumns(
        {"CustomerID": F.lit(5), "SalespersonPersonID": F.lit(6), "OrderDate": day, "ExpectedDeliveryDate": day,
         "source_id": F.lit(None).cast("string")}
    )


def test_which_facts_change(spark, rows_of):
    lines, orders = fact_tables(spark)
    everything = changed_facts(lines, orders, None, now=F.lit(LOADED_AT))
    assert rows_of(everything, "OrderLineID", "OrderID", "audit_ts") == [
        (100, 2, T[1]), (101, 1, T[2]), (102, 2, T[0]), (103, 3, T[2]),
    ]
    assert rows_of(changed_facts(lines, orders, T[1]), "OrderLineID") == [(101,), (103,)]
    assert rows_of(changed_facts(lines, orders, T[0]), "OrderLineID") == [(100,), (101,), (103,)]
    assert rows_of(changed_facts(lines, orders, T[0], mode="both"), "OrderLineID") == [(103,)]
    row = everything.first()
    assert row["source_id"] == "-1" and str(row["OrderDate"]) == "2024-05-06"


def test_replace_by_key_keeps_or_renews_surrogate_keys(spark, rows_of):
    fact = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], "fact_sales_skey long, hash_key string, v int")
    staged = spark.createDataFrame([("c", 31), ("d", 40)], "hash_key string, v int")
    assert rows_of(replace_by_key(fact, staged, order=["hash_key"])) == [(1, "a", 10), (2, "b", 20), (3, "c", 31), (4, "d", 40)]
    renewed = replace_by_key(fact, staged, order=["hash_key"], keep_skeys=False)
    assert rows_of(renewed) == [(1, "a", 10), (2, "b", 20), (3, "c", 31), (4, "d", 40)]
    middle = staged.filter("hash_key = 'd'").union(spark.createDataFrame([("b", 21)], staged.schema))
    assert rows_of(replace_by_key(fact, middle, order=["hash_key"], keep_skeys=False), "fact_sales_skey", "hash_key") == [
        (1, "a"), (3, "c"), (4, "b"), (5, "d"),
    ]
