"""Physical plans that decide how the operators behave on large data."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strata.operators import (
    add_surrogate_key,
    enrich,
    keep_latest,
    latest_snapshot_at,
    lookup_skey,
    missing_members,
    restrict_to_stored,
    scd2_recalc,
)
from strata.session import scratch_folder, scratch_scope, stage
from strata.sources.bronze import extract_delta

T = datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    """Stored rows of which a third share one key."""
    path = str(tmp_path_factory.mktemp("history") / "rows")
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    when = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))
    rows = spark.range(30_000, numPartitions=6).select(
        key.alias("k"), F.col("id").alias("v"), when.alias("audit_ts"), F.sha2(key.cast("string"), 256).alias("hash_key")
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_a_hot_key_is_reduced_before_the_shuffle(history):
    latest = keep_latest(history, ["k"], ["audit_ts", "v"])
    text = plan(latest)
    before_shuffle = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert latest.filter("k = -1").first()["v"] == 29_997


def shuffled_rows(spark, df):
    """Rows of the largest shuffle task of the query: what one key can send to one place."""
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway

    def stages():
        quantiles, statuses = gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList()
        return {s.stageId(): s for s in items(store.stageList(None, False, False, quantiles, statuses))}

    known = set(stages())
    df.write.format("noop").mode("overwrite").save()
    ran = [s for id_, s in stages().items() if id_ not in known]
    tasks = [t for s in ran for t in items(store.taskList(s.stageId(), s.attemptId(), 1000))]
    return max(t.taskMetrics().get().shuffleReadMetrics().recordsRead() for t in tasks if t.taskMetrics().isDefined())


def items(seq):
    return [seq.apply(i) for i in range(seq.size())]


def test_no_task_receives_the_hot_key(spark, history):
    without_aqe = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in without_aqe}
    for k, v in without_aqe.items():
        spark.conf.set(k, v)
    try:
        assert shuffled_rows(spark, keep_latest(history, ["k"], ["audit_ts", "v"])) < 3_000
        facts = history.withColumn("source_id", F.lit("x"))
        dim = spark.createDataFrame([], "k long, hash_key string")
        assert shuffled_rows(spark, missing_members(facts, dim, {"k": "k"})) < 3_000
        days = history.withColumn("scd_from", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("v") * 8640))
        chained = {"scd_start": "scd_from", "scd_to": "scd_from"}
        unlinked = days.withColumns({a: F.col(b) for a, b in chained.items()}).withColumns(
            {"scd_active": F.lit(0), "scd_version": F.lit(0)}
        )
        assert shuffled_rows(spark, scd2_recalc(unlinked, "v")) < 6_000
        one_day = unlinked.withColumn("scd_from", F.lit(T).cast("timestamp"))
        assert shuffled_rows(spark, scd2_recalc(one_day, "v")) < 6_000
        assert shuffled_rows(spark, add_surrogate_key(history, "n", ["k", "v"])) < 6_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_numbering_has_no_single_task_over_the_rows(history):
    text = plan(add_surrogate_key(history, "n", ["k", "v"]))
    single = text.index("Exchange SinglePartition")
    assert "HashAggregate" in text[single:], "only the row counts of the partitions may meet in one task"
    assert text.count("Exchange SinglePartition") == 1


def test_filters_reach_the_scan(history):
    delta = plan(extract_delta(history, ["k", "v"], "audit_ts", T, datetime(2024, 2, 1)))
    pushed = delta[delta.index("PushedFilters") :]
    bounds = "And(GreaterThan(audit_ts,2024-01-01 00:00:00.0),LessThanOrEqual(audit_ts,202"
    assert f"PushedFilters: [Or(IsNull(audit_ts),{bounds}" in pushed, delta
    only_marked = plan(extract_delta(history, ["k", "v"], "audit_ts", T, datetime(2024, 2, 1), unmarked=False))
    assert "GreaterThan(audit_ts,2024-01-01" in only_marked[only_marked.index("PushedFilters") :]
    assert "ReadSchema: struct<k:bigint,v:bigint,audit_ts:timestamp>" in delta
    newest = plan(latest_snapshot_at(history)[0])
    assert "EqualTo(audit_ts," in newest


def test_a_small_load_reads_only_its_range(spark, history):
    keys = stage(spark.createDataFrame([(20_001,), (20_003,)], "k long"), "keys")
    found = restrict_to_stored(history, keys, "k")
    assert "In(k, [20001,20003])" in plan(found)
    # Keys divisible by three share the hot key, so these two are not in the history.
    assert found.count() == history.filter("k IN (20001, 20003)").count()


def test_lookups_broadcast_by_size_only(spark, history):
    dim = history.select("k", F.col("hash_key").alias("name"))
    small = plan(enrich(history.select("k"), dim, {"k": "k"}, {"name": "UNKNOWN"}))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        large = plan(enrich(history.select("k"), dim, {"k": "k"}, {"name": "UNKNOWN"}))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in small
    assert "SortMergeJoin" in large and "Broadcast" not in large


@pytest.mark.parametrize("hot", [7, None])
def test_key_lookups_split_a_hot_key(spark, tmp_path, hot):
    """A third of the facts share one key, or have none, and nothing is broadcast."""
    key = F.when(F.col("id") % 3 == 0, F.lit(hot).cast("long")).otherwise(F.col("id") % 5_000)
    spark.range(60_000, numPartitions=8).select(key.alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("h")).write.parquet(str(tmp_path / "f"))
    facts = spark.read.parquet(str(tmp_path / "f"))
    dim = spark.range(5_000).select(F.col("id").alias("dim_key"), F.col("id").alias("dim_skey"), F.lit(1).alias("scd_active"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        assert shuffled_rows(spark, lookup_skey(facts, dim, "k", "dim_key", "dim_skey")) < 15_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_scratch_files_are_removed_with_their_scope(spark):
    def files(df):
        return [Path(name.removeprefix("file://")) for name in df.inputFiles()]

    kept = stage(spark.range(3).toDF("v"), "kept")
    with scratch_scope(spark):
        gone = stage(spark.range(3).toDF("v"), "gone")
        names = files(gone)
        assert gone.count() == 3 and all(name.exists() for name in names)
        assert all(name.is_relative_to(scratch_folder(spark)) for name in names)
    assert not any(name.exists() for name in names)
    assert kept.count() == 3
