"""Operator 11: exact top-k search by inner product with a three-phase uniform threshold.

The components of a vector are cut into ``LISTS`` slices. For a query, each slice is a list that scores every
vector by its partial inner product; the score is the sum over the lists.

1. Every task gathers the heads of its local lists and sends the best whole scores among them. The k-th best of
   all, tau, is a safe cutoff: at least k vectors reach it.
2. tau is broadcast. A vector that reaches tau has a partial score of ``tau / LISTS`` or more in some list, so tasks
   collect exactly these entries, with bounds of the whole score. The k-th best lower bound raises
   the cutoff, and entries whose upper bound is below it are dropped.
3. What is left, about the square root of all vectors for a query, gets its remaining scores exactly.

Equal vectors are one class with its k + 1 smallest rows, so a vector that a third of all rows share is scored
once. Queries go through in blocks of bounded size; the vectors are scanned for each block
and never shuffled by query. Scores are integers and exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import table
from strata.session import scratch_folder, scratch_scope, stage

LISTS = 2
#: Entries that a list's head holds in one batch, beyond the k that are looked for.
HEAD = 12
#: Query vectors of a block on average, and vectors of a task: both fit in memory many times over.
QUERY_BLOCK, TASK_VECTORS = 8192, 32768
#: Queries that are scored against a batch at once.
TILE = 256


@dataclass(frozen=True)
class Block:
    """Query vectors of one block as a matrix, and what all partial scores keep below."""

    vectors: np.ndarray
    bound: int

    @property
    def dimension(self) -> int:
        return self.vectors.shape[1]

    def slices(self) -> list[slice]:
        edges = [self.dimension * j // LISTS for j in range(LISTS + 1)]
        return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]

    def exact(self) -> type:
        """The narrowest type whose sums of products are exact."""
        if self.bound < 1 << 24:
            return np.float32
        return np.float64 if self.bound < 1 << 53 else np.int64


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    made = np.zeros((len(column), dimension), np.int64)
    sizes = np.asarray(column.value_lengths())
    row = np.repeat(np.arange(len(column)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    made[row, place] = np.asarray(column.flatten())
    return made


def integer_vector(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of all components; null if the vector or a component is null or not finite."""
    values = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(sound, F.transform(values, lambda x: F.floor(F.lit(float(scale)) * x).cast("bigint")))


def heads(block: Block, keep: int):
    """Phase 1 in a task: the ``keep`` best whole scores among the heads of the local lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, low = block.exact(), np.iinfo(np.int64).min
        best = np.full((len(block.vectors), keep), low, np.int64)
        for batch in batches:
            found = matrix(batch.column("_v"), block.dimension)
            if not len(found):
                continue
            size = min(keep + HEAD, len(found))
            for start in range(0, len(best), TILE):
                queries = block.vectors[start : start + TILE]
                tops = []
                for part in block.slices():
                    scores = queries[:, part].astype(kind) @ found[:, part].astype(kind).T
                    tops.append(np.argpartition(scores, len(found) - size, axis=1)[:, len(found) - size :])
                listed = np.sort(np.concatenate(tops, axis=1), axis=1)
                whole = np.einsum("qd,qnd->qn", queries, found[listed])
                # An entry that heads two lists counts once.
                whole[:, 1:][listed[:, 1:] == listed[:, :-1]] = low
                merged = np.concatenate([best[start : start + TILE], whole], axis=1)
                best[start : start + TILE] = np.partition(merged, merged.shape[1] - keep, axis=1)[:, -keep:]
        query, _ = np.nonzero(best > low)
        yield pa.RecordBatch.from_pydict({"_q": query.astype(np.int64), "_score": best[best > low]})

    return run


def sufficient(block: Block, cutoff: np.ndarray):
    """Phase 2 in a task: entries that reach their share of the cutoff in some list, with bounds of the score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = block.exact()
        share = -(-cutoff // LISTS)  # a partial score is sufficient from here on
        for batch in batches:
            found = matrix(batch.column("_v"), block.dimension)
            names = np.asarray(batch.column("_c"))
            if not len(found):
                continue
            for start in range(0, len(cutoff), TILE):
                here = share[start : start + TILE]
                queries = block.vectors[start : start + TILE]
                parts = [
                    (queries[:, part].astype(kind) @ found[:, part].astype(kind).T) for part in block.slices()
                ]
                enough = [part >= here[:, None].astype(kind) for part in parts]
                query, row = np.nonzero(np.logical_or.reduce(enough))
                low = np.zeros(len(query), np.int64)
                high = np.zeros(len(query), np.int64)
                for part, seen in zip(parts, enough, strict=True):
                    known = part[query, row].astype(np.int64)
                    seen = seen[query, row]
                    low += np.where(seen, known, part.min(axis=1).astype(np.int64)[query])
                    high += np.where(seen, known, here[query] - 1)
                yield pa.RecordBatch.from_pydict(
                    {"_q": query + start, "_c": names[row], "_low": low, "_high": high}
                )

    return run


def resolved(block: Block):
    """Phase 3 in a task: whole scores of the entries that are left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = matrix(batch.column("_v"), block.dimension)
            query = np.asarray(batch.column("_q"))
            score = np.einsum("nd,nd->n", block.vectors[query], found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_q"), batch.column("_members"), pa.array(score)], ["_q", "_members", "_score"]
            )

    return run


def kth_best(scores: DataFrame, column: str, k: int) -> DataFrame:
    """(_q, _cut): the k-th largest value of each query that has so many. Tasks send their k largest only."""
    order = Window.partitionBy("_q").orderBy(F.desc(column))
    ranked = scores.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k)
    return ranked.filter(F.col("_rank") == k).select("_q", F.col(column).alias("_cut"))


def top_k(vectors: DataFrame, queries: Column, k: int = 5, *, id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``queries`` holds, the k other rows of highest score.

    The score is the inner product of ``floor(scale * x)``; of vectors of different lengths the shorter
    one goes on with zeros. Ties go to the smaller id, a null id last, then to whichever row. Vectors that
    are null or hold null or non-finite components take no part; empty ones score 0. Repeated rows are
    rows of their own, as queries and as results. With fewer than k other rows all are returned;
    an empty table gives no rows. Only the two named columns are read. Scores beyond 62 bits raise an error.
    """
    spark = vectors.sparkSession
    keep = k + 1  # the query itself is among the best
    asked = F.coalesce(queries, F.lit(False)).alias("_asked")
    rows = vectors.select(F.col(id).alias("_id"), integer_vector(F.col(vector), scale).alias("_v"), asked)
    rows = stage(rows.filter(F.col("_v").isNotNull()).withColumn("_row", F.monotonically_increasing_id()), "vectors")
    member = F.struct(F.col("_id").isNull().alias("_blank"), "_id", "_row")
    order = Window.partitionBy("_v").orderBy("_member")
    smallest = rows.select("_v", member.alias("_member")).withColumn("_rank", F.row_number().over(order))
    classes = smallest.filter(F.col("_rank") <= keep).groupBy("_v")
    classes = classes.agg(F.sort_array(F.collect_list("_member")).alias("_members"))
    count = rows.count()
    tasks = max(spark.sparkContext.defaultParallelism, -(-count // TASK_VECTORS))
    classes = stage(classes.repartition(tasks).withColumn("_c", F.monotonically_increasing_id()), "classes")
    dimension, largest = classes.agg(
        F.max(F.size("_v")), F.max(F.array_max(F.transform("_v", lambda x: F.abs(x))))
    ).first()
    dimension, largest = dimension or 0, largest or 0
    bound = dimension * largest**2
    if bound >= 1 << 62:
        raise ArithmeticError("scores of vectors with such components do not fit in 64 bits")
    wanted = stage(rows.filter("_asked").select("_id", "_row", "_v").join(classes.select("_v", "_c"), "_v").drop("_v"), "queries")
    distinct = classes.select("_c", "_v").join(wanted.select("_c").distinct(), "_c", "left_semi")
    blocks = max(1, -(-wanted.select("_c").distinct().count() // QUERY_BLOCK))
    folder = f"{scratch_folder(spark)}/search-{uuid4().hex}"
    dealt = distinct.withColumn("_block", F.pmod(F.xxhash64("_c"), F.lit(blocks)).cast("int"))
    dealt.repartition("_block").write.partitionBy("_block").parquet(f"{folder}/queries")
    dealt = spark.read.schema(dealt.schema).parquet(f"{folder}/queries")
    schema = f"_c bigint, _best array<struct<_score:bigint,_members:{classes.schema['_members'].dataType.simpleString()}>>"
    spark.createDataFrame([], schema).write.parquet(f"{folder}/best")
    for number in range(blocks):
        held = dealt.filter(F.col("_block") == number).select("_c", "_v").toArrow().combine_chunks()
        if held.num_rows:
            with scratch_scope(spark):
                block = Block(matrix(held.column("_v").chunk(0), dimension), bound)
                best = search(classes, block, keep)
                names = spark.createDataFrame(held.select(["_c"]).append_column("_q", pa.array(range(held.num_rows))))
                best.join(F.broadcast(names), "_q").select("_c", "_best").write.mode("append").parquet(f"{folder}/best")
    best = spark.read.schema(schema).parquet(f"{folder}/best")
    listed = F.flatten(
        F.transform(
            "_best",
            lambda b: F.transform(
                b["_members"],
                lambda m: F.struct((-b["_score"]).alias("_less"), m["_blank"].alias("_blank"), m["_id"].alias("_id"), m["_row"].alias("_row")),
            ),
        )
    )
    others = F.slice(F.array_sort(F.filter(listed, lambda m: m["_row"] != F.col("_row"))), 1, k)
    found = wanted.join(best, "_c").select(F.col("_id").alias("query_id"), F.posexplode(others).alias("_place", "_found"))
    return found.select(
        "query_id",
        (F.col("_place") + 1).cast("int").alias("rank"),
        F.col("_found._id").alias("vec_id"),
        (-F.col("_found._less")).alias("score"),
    )


def search(classes: DataFrame, block: Block, keep: int) -> DataFrame:
    """(_q, _best): the ``keep`` best classes of each query of a block, by score and then smallest member."""
    spark = classes.sparkSession
    narrow = classes.select("_c", "_v")
    cuts = kth_best(narrow.mapInArrow(heads(block, keep), "_q bigint, _score bigint"), "_score", keep).toArrow()
    # Where fewer vectors than that exist, all are sufficient.
    cutoff = np.full(len(block.vectors), -(block.bound + 1) * LISTS)
    cutoff[np.asarray(cuts.column("_q").combine_chunks(), np.int64)] = np.asarray(cuts.column("_cut").combine_chunks())
    entries = narrow.mapInArrow(sufficient(block, cutoff), "_q bigint, _c bigint, _low bigint, _high bigint")
    entries = stage(entries, "entries")
    raised = kth_best(entries, "_low", keep)  # at most one row per query of the block
    left = entries.join(F.broadcast(raised), "_q", "left").filter(
        F.col("_cut").isNull() | (F.col("_high") >= F.col("_cut"))
    )
    members = classes.schema["_members"].dataType.simpleString()
    whole = left.select("_q", "_c").join(classes, "_c").select("_q", "_v", "_members")
    whole = whole.mapInArrow(resolved(block), f"_q bigint, _members {members}, _score bigint")
    order = Window.partitionBy("_q").orderBy(F.desc("_score"), F.col("_members")[0])
    ranked = whole.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= keep)
    return ranked.groupBy("_q").agg(F.collect_list(F.struct("_score", "_members")).alias("_best"))


def op11(spark, sf_dir: str) -> DataFrame:
    """The query: the five best other vectors of every vector whose id is divisible by 50."""
    found = top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)
    return found.select(*[F.col(c).cast("bigint") if c != "rank" else F.col(c) for c in found.columns])


ORACLE = """
WITH vectors AS (
  SELECT vec_id, row_number() OVER () AS r,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, q.r, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.r <> c.r)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""
