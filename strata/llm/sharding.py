"""Operator 10: a uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Documents are spread over logical partitions by a hash. The matrix that says how many rows each
partition sends to each shard is drawn without replacement, so that its column sums are the shard
sizes: the numbers of all rows are permuted and dealt round to the shards, each partition's numbers where the
others of that partition are, and counted there. Rows are permuted inside
their partition, the first of them go to the first shard and so on as the matrix says, and inside
the shard they are permuted again. No rank is computed over a whole shard or the whole table:
offsets come from counts of about ``sqrt(rows)`` partitions.
"""

from __future__ import annotations

from math import ceil, sqrt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import permute, text_of

#: Row numbers that one task draws.
TASK_NUMBERS = 250_000


def communication_matrix(parts: DataFrame, shards: int, rows: int, seed: int) -> DataFrame:
    """(_part, _lo, _to): in each partition, from which local rank on rows go to which shard.

    ``parts`` has _part and _n, the rows of each logical partition. Only these, one row per partition, meet in
    one task; the numbers are drawn in as many tasks as their count asks for.
    """
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    numbered = parts.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    tasks = max(parts.sparkSession.sparkContext.defaultParallelism, ceil(rows / TASK_NUMBERS))
    numbered = numbered.repartition(tasks, "_part")
    numbers = numbered.select("_part", F.explode(F.sequence("_first", F.col("_first") + F.col("_n") - 1)).alias("_g"))
    dealt = numbers.withColumn("_to", F.pmod(permute(F.col("_g"), F.lit(rows), seed), F.lit(shards)).cast("int"))
    cells = dealt.groupBy("_part", "_to").agg(F.count("*").alias("_c"))
    left = Window.partitionBy("_part").orderBy("_to").rowsBetween(Window.unboundedPreceding, -1)
    return cells.select("_part", "_to", F.coalesce(F.sum("_c").over(left), F.lit(0)).alias("_lo"))


def shuffle_into_shards(docs: DataFrame, shards: int = 24, seed: int = 1610) -> DataFrame:
    """All rows and columns of ``docs`` with ``shard`` (from 0) and ``slot`` (gapless from 0 in its shard).

    Shard sizes differ by one row at most. The result depends on the rows and the seed alone, not on
    how they are stored. Null texts count as empty ones, a null doc_id is a value like any other, and
    repeated rows are placed one by one; an empty table gives an empty result. Columns named
    ``shard`` or ``slot`` in the input are replaced; names that start with ``_`` and clash with the
    working columns are kept because work columns are taken from a struct.
    """
    rows = docs.count()
    spread = max(1, ceil(sqrt(rows)))
    inner = max(1, ceil(sqrt(rows / shards)))
    key = [F.col("doc_id"), text_of()]
    carried = [c for c in docs.columns if c not in ("shard", "slot")]
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("_row") if carried else F.lit(None).alias("_row"),
        F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(spread)).alias("_part"),
        F.xxhash64(F.lit(seed + 1), *key).alias("_h"),
        F.pmod(F.xxhash64(F.lit(seed + 2), *key), F.lit(inner)).alias("_cell"),
        F.xxhash64(F.lit(seed + 3), *key).alias("_h2"),
    )
    parts = base.groupBy("_part").agg(F.count("*").alias("_n"))
    matrix = communication_matrix(parts, shards, max(rows, 1), seed + 4)
    rules = matrix.groupBy("_part").agg(F.sort_array(F.collect_list(F.struct("_lo", "_to"))).alias("_rule"))
    local = base.withColumn("_rank", F.row_number().over(Window.partitionBy("_part").orderBy("_h")) - 1)
    sent = local.join(rules, "_part").withColumn(
        "shard", F.element_at(F.filter("_rule", lambda x: x["_lo"] <= F.col("_rank")), -1)["_to"]
    )
    cells = sent.groupBy("shard", "_cell").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("shard", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    again = Window.partitionBy("shard", "_cell").orderBy("_h2")
    placed = sent.drop("_rule").withColumn("_rank", F.row_number().over(again) - 1)
    return placed.join(offsets, ["shard", "_cell"]).select(
        *[F.col("_row").getField(c).alias(c) for c in carried], "shard", (F.col("_off") + F.col("_rank")).alias("slot")
    )


def op10(spark, sf_dir: str) -> DataFrame:
    """The query: sizes and checksums of all documents with their place."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text_of()) + 8).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
        "text",
    )
    return shuffle_into_shards(narrow).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
