"""What queries put on disk: scratch files without hashes, none but the result's at the end, and slim shuffles."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strata.functions import hash_expr, hash_order, packed, unpacked
from strata.operators import restrict_to_stored
from strata.session import scratch_folder, scratch_scope, stage
from strata.workload import QUERIES

ORDERS = 3_000
LINES = 4 * ORDERS


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Orders of four lines each, edited on days before and after the cut; every tenth line comes again in the second load."""
    path = tmp_path_factory.mktemp("tables")
    def day(n):
        return F.expr(f"cast(date_add(DATE '1994-01-01', cast({n} as int)) as timestamp_ntz)")

    def write(df, name):
        df.coalesce(2).write.parquet(str(path / f"{name}.parquet"))

    write(spark.range(200).select(F.col("id").alias("c_custkey"), F.format_string("c%d", "id").alias("c_name"), (F.col("id") % 25).cast("int").alias("c_nationkey"), F.col("id").cast("double").alias("c_acctbal")), "customer")
    write(spark.range(25).select(F.col("id").cast("int").alias("n_nationkey"), F.format_string("n%d", "id").alias("n_name")), "nation")
    write(spark.range(300).select(F.col("id").alias("p_partkey"), F.format_string("p%d", "id").alias("p_name"), F.lit("b").alias("p_brand"), F.lit(3).alias("p_size"), F.col("id").cast("double").alias("p_retailprice")), "part")
    write(spark.range(50).select(F.col("id").alias("s_suppkey"), F.format_string("s%d", "id").alias("s_name")), "supplier")
    orders = spark.range(ORDERS).select(
        F.col("id").alias("o_orderkey"), (F.xxhash64("id") % 97 + 98).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.concat((F.col("id") % 5 + 1).cast("string"), F.lit("-URGENT")).alias("o_orderpriority"),
        day("id * 7 % 2900").alias("o_orderdate"),
    )
    write(orders, "orders")
    rows = spark.range(LINES + LINES // 10)
    rows = rows.withColumn("line", F.when(F.col("id") < LINES, F.col("id")).otherwise((F.col("id") - LINES) * 10))
    write(
        rows.select(
            F.floor(F.col("line") / 4).alias("l_orderkey"), (F.col("line") % 4 + 1).cast("int").alias("l_linenumber"),
            (F.xxhash64("id") % 149 + 150).alias("l_partkey"), (F.col("id") % 50).alias("l_suppkey"),
            F.substring(F.lit("RAN"), (F.col("id") % 3 + 1).cast("int"), F.lit(1)).alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
            (F.col("id") % 50 + 1).cast("double").alias("l_quantity"), (F.xxhash64("id") % 100_000 / 100 + 1_000).alias("l_extendedprice"),
            F.lit(0.05).alias("l_tax"), day(f"case when id < {LINES} then id * 11 % 2900 else 2850 end").alias("l_shipdate"),
        ),
        "lineitem",
    )
    return str(path)


def held(spark):
    """Bytes in the scratch folder, and of the shuffle files in all local folders."""
    scratch = sum(f.stat().st_size for f in Path(scratch_folder(spark)).rglob("*") if f.is_file())
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return scratch, [files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")]


def shuffled_bytes(spark, action):
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway

    def stages():
        quantiles, statuses = gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList()
        found = store.stageList(None, False, False, quantiles, statuses)
        return {found.apply(i).stageId(): found.apply(i) for i in range(found.size())}

    known = set(stages())
    action()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return max(s.shuffleWriteBytes() for i, s in stages().items() if i not in known)


# Bytes a line that may be left in the scratch folder, and that the largest shuffle may write.
LIMITS = {
    "load_metrics": (5, 60),
    "silver_stream": (40, 60),
    "fact_lookup": (90, 80),
    "fact_changed_both": (10, 60),
    "fact_base": (40, 80),
    "fact_changed_either": (30, 60),
    "run_all": (40, 170),
    "fact_load": (120, 60),
    "silver_incremental": (20, 60),
}


@pytest.mark.parametrize("name", LIMITS)
def test_disk_of_a_query(spark, folder, tmp_path, name):
    before = held(spark)[0]
    largest = shuffled_bytes(spark, lambda: QUERIES[name](spark, folder).write.parquet(str(tmp_path / "out")))
    left, shuffles = held(spark)
    assert shuffles == [], "shuffle files outlive the writes that made them"
    assert (left - before) / LINES < LIMITS[name][0] and largest / LINES < LIMITS[name][1]


def test_packed_hashes(spark):
    texts = ["", "a", "b" * 31, "0" * 64, "F" * 64, "g" * 64, None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").union(spark.range(50).select(F.sha2(F.col("id").cast("string"), 256)))
    packs = rows.select("t", packed("t").alias("p"), unpacked(packed("t")).alias("u"), *[c.alias(f"o{i}") for i, c in enumerate(hash_order("t"))])
    found = packs.collect()
    assert all(r.t == r.u for r in found) and len({r.p for r in found}) == len(found)
    digests = [r for r in found if r.p is not None and len(r.p) == 32]
    assert len(digests) == 51
    by_text = sorted(r.t for r in digests)
    assert by_text == [r.t for r in sorted(digests, key=lambda r: bytes(r.p))] == [r.t for r in sorted(digests, key=lambda r: (r.o0, r.o1))]
    assert all(r.o0 is None and r.o2 == r.t for r in found if r not in digests)


def test_derived_columns_are_not_stored_and_results_outlive_their_scope(spark):
    rows = spark.range(5).select(hash_expr(["id"]).alias("hash_key"), F.col("id").alias("a b"), "id")
    with scratch_scope(spark) as outer:
        with scratch_scope(spark) as keep:
            gone = stage(rows, "gone")
            kept = keep(gone, "kept", derived={"hash_key": hash_expr(["id"])})
        assert kept.columns == rows.columns and sorted(kept.collect()) == sorted(rows.collect())
        assert spark.read.parquet(*kept.inputFiles()).columns == ["a b", "id"]
        assert not any(Path(name.removeprefix("file://")).exists() for name in gone.inputFiles())
        names = [Path(name.removeprefix("file://")) for name in kept.inputFiles()]
        last = outer(kept, "last")
    assert not any(name.exists() for name in names) and last.count() == 5


def test_rows_of_stored_keys_stay_dealt_by_the_key(spark):
    history = stage(spark.range(3_000).select((F.col("id") % 1_500).alias("k"), F.col("id").alias("v")), "history")
    keys = stage(spark.range(2, 1_400).select(F.col("id").alias("k")), "keys")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = restrict_to_stored(history, keys, "k").groupBy("k").agg(F.max("v"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 and found.count() == 1_398
        with_null = restrict_to_stored(history.union(spark.sql("SELECT NULL, 1L")), keys.union(spark.sql("SELECT NULL")), "k")
        assert with_null.count() == 2 * 1_398 + 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
