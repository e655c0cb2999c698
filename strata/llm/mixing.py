"""Operator 7: mixing sources to target weights in fixed-length blocks.

The words of a source form one stream, cut into blocks of fixed length. Every output shard draws
how many of its slots each source gets: the whole part of the expectation and a multinomial draw of
the rest. The slots of a source are numbered through all shards and mapped to its blocks by a
pseudorandom permutation, a new one for each pass over the source. Slots and blocks meet in a join
by index.

Offsets in the stream come from about ``sqrt(rows)`` chunks of a source, so that no task ranks a
whole source.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import BROADCAST_ROWS, WORDS, bounded_broadcast, permute, text_of, whole_row
from strata.session import stage

GRID_BITS = 16  # the multinomial draw joins slots and sources by 2 ** GRID_BITS cells, or more if there are more sources


@dataclass(frozen=True)
class Mix:
    """``sources``: one row each with target; ``pieces``: runs of a document's words by block;
    ``slots``: shard, slot, source number, block and pass; ``docs``: the rows with their place."""

    sources: DataFrame
    docs: DataFrame
    pieces: DataFrame
    slots: DataFrame

    def taken(self) -> DataFrame:
        """The pieces that the mix takes, one row per piece and pass."""
        return self.pieces.join(self.slots, ["_src", "_block"])


def word_count() -> F.Column:
    return F.regexp_count(text_of(), F.lit(WORDS)).cast("long")


def targets(sizes: DataFrame, epochs: float, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """Sources with number, weight and target. ``sizes``: _source, _words, _rows.

    Sources share ``epochs`` times all words by weight; none gets more than ``repeats`` times its
    own, and what is cut goes to the others by weight. In order of (limit / weight), the level that
    the rest would get is largest exactly where no further source is cut, so one pass finds it.
    """
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    index = F.row_number().over(by_name) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    named = sizes.select(
        "_source", "_words", "_rows", index.cast("long").alias("_src"),
        F.element_at(cycle, (index % len(weights) + 1).cast("int")).alias("_w"),
    ).withColumn("_cap", F.col("_words") * float(repeats))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "_src")
    upto, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = (F.sum("_words").over(every) * float(epochs) - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0))) / F.sum("_w").over(after)
    return named.withColumn("_level", level).withColumn(
        "target", F.least(F.col("_cap"), F.max("_level").over(every) * F.col("_w"))
    )


def mix(
    docs: DataFrame, block: int = 64, shard_slots: int = 512, epochs: float = 1.5,
    weights: tuple[int, ...] = (3, 1, 2), repeats: int = 2, seed: int = 717,
) -> Mix:
    """Plan the mix of all ``docs`` (doc_id, text, source).

    Null texts have no words and are taken nowhere, null sources form the last source, repeated rows
    are separate documents, a table without rows or words gives an empty plan. Any number of
    sources is accepted; one narrow row of each is ranked in one task. No block is taken more than
    ``repeats`` times: draws beyond that are left out.
    """
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), text_of())
    sized = stage(
        docs.select("doc_id", F.col("source").alias("_source"), word_count().alias("size"), key.alias("_key")), "mix-sizes"
    )
    sizes = sized.groupBy("_source").agg(F.sum("size").alias("_words"), F.count("*").alias("_rows"))
    blocks = F.greatest(F.ceil(F.col("_words") / block), F.lit(1)).cast("long")
    sources = targets(sizes, epochs, weights, repeats).withColumn("_blocks", blocks)
    # A slot is worth the mean length of the source's blocks, whose last one may be short.
    need = F.when(F.col("_words") > 0, F.col("target") * F.col("_blocks") / F.col("_words")).otherwise(0.0)
    sources = stage(sources.withColumn("_need", need).withColumn("_chunks", F.ceil(F.sqrt("_rows")).cast("long")), "mix-sources")
    wanted = sources.agg(F.coalesce(F.sum("_need"), F.lit(0.0))).first()[0]
    placed = place(sized, sources)
    return Mix(sources, placed, cut(placed, block), draw(sources, wanted, shard_slots, repeats, seed))


def place(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Each row with its source's number and the offset of its first word in the source's stream."""
    known = bounded_broadcast(sources.select(F.col("_source").alias("_named"), "_src", "_chunks"), BROADCAST_ROWS)
    rows = sized.join(known, F.col("_source").eqNullSafe(F.col("_named"))).drop("_named")
    rows = rows.withColumn("_chunk", F.pmod(F.col("_key"), F.col("_chunks"))).drop("_chunks")
    in_order = Window.partitionBy("_src", "_chunk").orderBy("_key", "doc_id")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {"_pos": F.row_number().over(in_order), "_in_chunk": F.coalesce(F.sum("size").over(before), F.lit(0))}
    )
    chunks = rows.groupBy("_src", "_chunk").agg(F.sum("size").alias("_n"))
    earlier = Window.partitionBy("_src").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = chunks.select("_src", "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    return rows.join(starts, ["_src", "_chunk"]).withColumn("_offset", F.col("_start") + F.col("_in_chunk"))


def cut(placed: DataFrame, block: int) -> DataFrame:
    """One row for each block that a document's words lie in: _from and _len count the document's words."""
    first, last = F.floor(F.col("_offset") / block), F.floor((F.col("_offset") + F.col("size") - 1) / block)
    pieces = placed.filter("size > 0").select(
        "doc_id", "_src", "_chunk", "_pos", "_offset", "size", F.explode(F.sequence(first, last)).alias("_block")
    )
    start = F.greatest(F.lit(0), F.col("_block") * block - F.col("_offset"))
    end = F.least(F.col("size"), (F.col("_block") + 1) * block - F.col("_offset"))
    return pieces.select("doc_id", "_src", "_chunk", "_pos", "_block", start.alias("_from"), (end - start).alias("_len"))


def draw(sources: DataFrame, wanted: float, per_shard: int, repeats: int, seed: int) -> DataFrame:
    """All slots of all shards: shard, slot, _src, _block, _pass."""
    spark = sources.sparkSession
    total = ceil(wanted)
    share = F.col("_need") / F.lit(max(wanted, 1e-300)) * per_shard
    parts = sources.select("_src", F.floor(share).alias("_whole"), (share - F.floor(share)).alias("_rest"))
    upto = Window.orderBy("_src").rowsBetween(Window.unboundedPreceding, 0)
    sums = parts.select(
        "*", F.sum("_whole").over(upto).alias("_w1"), F.sum("_rest").over(upto).alias("_r1"), F.sum("_whole").over(Window.partitionBy()).alias("_all")
    )
    # Each source starts exactly where the one before it ends, and the last one ends with the last cell.
    ends = sums.withColumns(
        {"_r0": F.coalesce(F.lag("_r1").over(Window.orderBy("_src")), F.lit(0.0)), "_left": F.max("_r1").over(Window.partitionBy())}
    )
    sure = ends.filter("_whole > 0").select(
        "_src", F.explode(F.sequence(F.col("_w1") - F.col("_whole"), F.col("_w1") - 1)).alias("_cell"),
        F.lit(0.0).alias("_lo"), F.lit(1.0).alias("_hi"),
    )
    whole, found = sums.agg(F.coalesce(F.max("_all"), F.lit(0)), F.count("*")).first()
    bits = max(GRID_BITS, found.bit_length())
    grid = float(2**bits)
    low, high = grid * F.col("_r0") / F.col("_left"), grid * F.col("_r1") / F.col("_left")
    drawn = ends.filter("_left > 1e-9").select("_src", "_all", low.alias("_low"), high.alias("_high")).filter("_high > _low")
    drawn = drawn.select("*", F.explode(F.sequence(F.floor("_low"), F.ceil("_high") - 1)).alias("_at")).select(
        "_src", (F.col("_all") + F.col("_at")).alias("_cell"),
        F.greatest(F.col("_low") - F.col("_at"), F.lit(0.0)).alias("_lo"), F.least(F.col("_high") - F.col("_at"), F.lit(1.0)).alias("_hi"),
    )
    # At most per_shard + 2 ** bits rows and one per source.
    cells = bounded_broadcast(sure.union(drawn), BROADCAST_ROWS)
    slots = spark.range(total).select(
        F.floor(F.col("id") / per_shard).alias("shard"), (F.col("id") % per_shard).alias("slot"), "id"
    )
    turn = permute(F.col("slot"), F.lit(per_shard), seed + 2, F.col("shard"), rounds=12)
    # One hash gives the cell and, by the bits below, the place within it.
    drop = F.xxhash64(F.lit(seed + 3), F.col("id"))
    chance = F.shiftrightunsigned(drop, 64 - bits) + whole
    inside = F.shiftrightunsigned(F.shiftleft(drop, bits), bits) / F.lit(float(2 ** (64 - bits)))
    slots = slots.withColumn("_turn", turn).select(
        "shard", "slot", F.when(F.col("_turn") < whole, F.col("_turn")).otherwise(chance).alias("_cell"), inside.alias("_inside")
    )
    found = slots.join(cells, "_cell").filter("_lo <= _inside and _inside < _hi").select("shard", "slot", "_src")
    # Counted and numbered: stored, as drawing costs more than reading.
    named = stage(found, "mix-slots")
    counts = named.groupBy("shard", "_src").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_src").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_src", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    nth = F.row_number().over(Window.partitionBy("shard", "_src").orderBy("slot")) - 1
    numbered = named.withColumn("_nth", nth).join(starts, ["shard", "_src"]).withColumn("_nth", F.col("_start") + F.col("_nth"))
    numbered = numbered.join(bounded_broadcast(sources.select("_src", "_blocks"), BROADCAST_ROWS), "_src")
    numbered = numbered.withColumn("_pass", F.floor(F.col("_nth") / F.col("_blocks"))).filter(F.col("_pass") < repeats)
    index = permute(F.col("_nth") % F.col("_blocks"), F.col("_blocks"), seed + 5, F.col("_src"), F.col("_pass"), rounds=16)
    return numbered.select("shard", "slot", "_src", "_pass", index.alias("_block"))


def mixed_documents(docs: DataFrame, block: int = 1024, **options) -> DataFrame:
    """The mix as rows of ``docs``: for each pass, the document's words that it takes.

    A document taken whole keeps its text as it is; otherwise the taken runs of words are joined by
    one blank. Rows of which nothing is taken are left out, those taken twice come twice; ``n_chars``,
    if there is one, is counted anew. Rows without words are in no block and leave the mix.
    """
    seed = options.get("seed", 717)
    plan = mix(docs, block=block, **options)
    runs = plan.taken().groupBy("_src", "_chunk", "_pos", "_pass").agg(
        F.sort_array(F.collect_list(F.struct("_from", "_len"))).alias("_runs")
    )
    sources = bounded_broadcast(plan.sources.select(F.col("_source").alias("_named"), "_src", "_chunks"), BROADCAST_ROWS)
    rows = docs.select(whole_row(docs), F.col("source").alias("_source"),
                       F.col("doc_id").alias("_doc"), F.xxhash64(F.lit(seed), F.col("doc_id"), text_of()).alias("_key"))
    rows = rows.join(sources, F.col("_source").eqNullSafe(F.col("_named"))).withColumn("_chunk", F.pmod(F.col("_key"), F.col("_chunks")))
    rows = rows.withColumn("_pos", F.row_number().over(Window.partitionBy("_src", "_chunk").orderBy("_key", "_doc")))
    found = rows.join(runs, ["_src", "_chunk", "_pos"]).withColumn(
        "_words", F.regexp_extract_all(F.col("_row.text"), F.lit(WORDS), F.lit(0))
    )
    part = F.array_join(
        F.transform("_runs", lambda x: F.array_join(F.slice("_words", x["_from"].cast("int") + 1, x["_len"].cast("int")), " ")), " "
    )
    length = F.aggregate("_runs", F.lit(0).cast("long"), lambda n, x: n + x["_len"])
    text = F.when(length == F.size("_words"), F.col("_row.text")).otherwise(part)
    found = found.withColumn("_text", text)
    kept = {"text": F.col("_text"), "n_chars": F.char_length("_text").cast("long")}
    return found.select(*[(kept.get(c, F.col("_row").getField(c))).alias(c) for c in docs.columns])


def op7(spark, sf_dir: str) -> DataFrame:
    """The query: words that the mix takes of every document."""
    plan = mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    place = ["_src", "_chunk", "_pos"]
    taken = plan.taken().groupBy(*place).agg(F.sum("_len").alias("taken"))
    sources = bounded_broadcast(plan.sources.select("_src", F.col("_words").alias("source_size"), "target"), BROADCAST_ROWS)
    return plan.docs.join(taken, place, "left").join(sources, "_src").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
