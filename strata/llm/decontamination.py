"""Operator 1: benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of consecutive words; a window is the set of its shingles (runs
of three words). A document that contains the window contains all of its shingles, so its rarest
one, the necessary prefix for full containment, is enough to find every candidate. Rarity is
counted over the whole corpus. A match at a position fixes where the window would have to begin;
windows that would stick out of the document are dropped by position and length, the others are
compared word by word.

Documents are cut into words and scanned in generated code, twice: to count the benchmark's
shingles and to join the prefixes. Where the benchmark is small enough to be broadcast, no text and
no word of the corpus is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (
    ALNUM_WORDS,
    BROADCAST_ROWS,
    bounded_broadcast,
    columns_of,
    lower_ascii,
    text_of,
    whole_row,
)
from strata.session import stage

SHINGLE = 3


def words_of(text: Column) -> Column:
    """Words in lower case (``A-Z`` only)."""
    return F.regexp_extract_all(lower_ascii(text), F.lit(ALNUM_WORDS), F.lit(0))


def shingle_at(words: Column, position: Column, size: int) -> Column:
    """Hash of the ``size`` words from ``position`` (from 0) on."""
    return F.xxhash64(F.lit(size), *[F.get(words, position + j) for j in range(size)])


def windows(items: DataFrame, width: int) -> DataFrame:
    """Distinct windows: _words, _len, _items (sorted distinct item ids as text), _window.

    Items without words have none; an item without an id counts as the item with the empty id.
    """
    cut = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("_item"), words_of(text_of()).alias("_all"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("_all") - width, F.lit(0)))
    each = cut.filter(F.size("_all") > 0).select("_item", "_all", F.explode(starts).alias("_at"))
    each = each.select("_item", F.slice("_all", F.col("_at") + 1, width).alias("_words"))
    same = each.groupBy("_words").agg(F.sort_array(F.collect_set("_item")).alias("_items"))
    return same.select("_words", "_items", F.size("_words").alias("_len"), F.xxhash64("_words").alias("_window"))


def tokens(cut: DataFrame, size: int) -> DataFrame:
    """The shingles of all documents with their position; ``cut`` has _words among its columns."""
    each = cut.select("*", F.posexplode("_words").alias("_at", "_word"))
    return each.filter(F.col("_at") <= F.size("_words") - size).withColumn(
        "_token", shingle_at(F.col("_words"), F.col("_at"), size)
    )


def prefixes(found: DataFrame, cut: DataFrame, size: int) -> DataFrame:
    """Each window of ``found`` with its rarest shingle: _token and _shift, its place in the window."""
    places = F.sequence(F.lit(0), F.col("_len") - size)
    listed = found.select("*", F.explode(places).alias("_shift"))
    listed = listed.withColumn("_token", shingle_at(F.col("_words"), F.col("_shift"), size))
    known = bounded_broadcast(listed.select("_token").distinct())
    counts = tokens(cut.select("_words"), size).select("_token").join(known, "_token").groupBy("_token").agg(F.count("*").alias("_n"))
    ranked = listed.join(counts, "_token", "left").groupBy("_window", "_words").agg(
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("_n"), "_token", "_shift")).alias("_rarest"),
        F.first("_items").alias("_items"), F.first("_len").alias("_len"),
    )
    # A window of which a shingle occurs nowhere can't occur itself.
    return ranked.filter("_rarest._n > 0").select(
        "_window", "_items", "_len", F.col("_words").alias("_wanted"), F.col("_rarest._token").alias("_token"), F.col("_rarest._shift").alias("_shift")
    )


def occurrences(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """Where windows of benchmark items occur: _doc, _digest, _start, _len, _items.

    A document is named by its id and the hash of its text, so that rows that share an id don't mix.
    """
    cut = docs.select(F.col("doc_id").alias("_doc"), F.xxhash64(text_of()).alias("_digest"), words_of(text_of()).alias("_words"))
    found = stage(windows(items, width), "decontamination-windows")
    sizes = [r[0] for r in found.select(F.least("_len", F.lit(SHINGLE)).alias("_size")).distinct().collect()]
    hits = None
    for size in sorted(sizes):  # three at most; below SHINGLE only where items are as short
        own = found.filter(F.least("_len", F.lit(SHINGLE)) == size)
        prefix = stage(prefixes(own, cut, size), "decontamination-prefixes")
        start = F.col("_at") - F.col("_shift")
        if prefix.count() <= BROADCAST_ROWS:
            near = tokens(cut, size).join(F.broadcast(prefix), "_token")
        else:  # too large to broadcast: narrow candidates meet their documents again
            lean = tokens(cut, size).select("_doc", "_digest", "_at", "_token").join(prefix, "_token")
            whole = cut.dropDuplicates(["_doc", "_digest"]).withColumnsRenamed({"_doc": "_d", "_digest": "_g"})
            near = lean.join(whole, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_digest") == F.col("_g")))
        near = near.filter((start >= 0) & (start + F.col("_len") <= F.size("_words")))
        near = near.filter(F.slice("_words", start + 1, F.col("_len")) == F.col("_wanted"))
        near = near.select("_doc", "_digest", start.alias("_start"), "_len", "_items")
        hits = near if hits is None else hits.union(near)
    if hits is None:
        nothing = [F.lit(0).alias("_start"), F.lit(0).alias("_len"), F.array().cast("array<string>").alias("_items")]
        hits = cut.filter(F.lit(False)).select("_doc", "_digest", *nothing)
    return hits


def contamination(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """One row per row of ``docs``: doc_id, _digest, n_words, n_hit, items (sorted texts).

    ``docs``: doc_id, text; ``items``: item_id, text. Null and empty texts have no words; tied,
    repeated and long texts need no care, as every row is judged by its own words; without items
    nothing is hit. Other columns are ignored.
    """
    hits = occurrences(docs, items, width).groupBy("_doc", "_digest").agg(
        F.sort_array(F.collect_set(F.struct("_start", "_len"))).alias("_spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("_items")))).alias("_items"),
    )
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def cover(done: Column, span: Column) -> Column:
        end = span["_start"] + span["_len"]
        fresh = F.greatest(end - F.greatest(span["_start"], done["end"]), F.lit(0))
        return F.struct((done["n"] + fresh).alias("n"), F.greatest(end, done["end"]).alias("end"))

    hits = hits.select("_doc", "_digest", F.aggregate("_spans", zero, cover)["n"].alias("_hit"), "_items")
    counted = docs.select(
        "doc_id", F.xxhash64(text_of()).alias("_key"), F.regexp_count(text_of(), F.lit(ALNUM_WORDS)).cast("long").alias("n_words")
    )
    same = counted["doc_id"].eqNullSafe(hits["_doc"]) & (counted["_key"] == hits["_digest"])
    return counted.join(hits, same, "left").select(
        "doc_id", F.col("_key").alias("_digest"), "n_words", F.coalesce("_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("_items", F.array().cast("array<string>")).alias("items"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, width: int = 10, share: float = 0.0) -> DataFrame:
    """The rows of ``docs``, all columns, of whose words no more than ``share`` are hit."""
    found = contamination(docs.select("doc_id", "text"), items, width)
    bad = found.filter((F.col("n_hit") > 0) & (F.col("n_hit") > F.col("n_words") * share))
    bad = bad.select(F.col("doc_id").alias("_bad"), F.col("_digest").alias("_bad_text")).distinct()
    rows = docs.select(whole_row(docs), F.col("doc_id").alias("_id"), F.xxhash64(text_of()).alias("_key"))
    same = F.col("_bad").eqNullSafe(F.col("_id")) & (F.col("_bad_text") == F.col("_key"))
    return rows.join(bad, same, "left_anti").select(*columns_of(docs))


def op1(spark, sf_dir: str) -> DataFrame:
    """The query: how much of each document the benchmark holds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
  SELECT item, least(len(w), 10) AS l, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS t
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT l FROM wins),
starts AS (
  SELECT doc_id, l, i, array_to_string(list_slice(w, i, i + l - 1), ' ') AS t
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM lowered, sizes WHERE len(w) >= l)),
hits AS (SELECT s.doc_id, s.i, s.l, x.item FROM starts s JOIN wins x ON s.l = x.l AND s.t = x.t),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM lowered LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
