"""Operator 3: removal of lines that spread over many sites.

Every line hash gets a HyperLogLog sketch of the sites that it occurs on; sketches of parts of the corpus
merge in the aggregation, so a line that is everywhere sends one sketch per task. Lines whose
estimate is clearly over or under the threshold are decided by it; those near it are counted exactly.
Then boilerplate lines are taken out of the documents.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_broadcast, text_of
from strata.session import stage

MIN_SITES = 10
SKETCH_BITS = 12


def lines_of(docs: DataFrame) -> DataFrame:
    """The lines that hold a word: all columns but ``text``, with _line, a hash."""
    each = docs.select(*[c for c in docs.columns if c != "text"], F.explode(F.split(text_of(), "\n")).alias("_l"))
    return each.filter(F.col("_l").rlike(r"[^\x20\x09-\x0D]")).withColumn("_line", F.xxhash64("_l")).drop("_l")


def spread_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, bits: int = SKETCH_BITS) -> DataFrame:
    """Hashes (_line) of lines that occur on ``min_sites`` different sites or more.

    The band in which lines are counted exactly is four standard errors of the sketch wide on either side,
    and one site at least. Rows without a site don't add to the spread. A line on one site is not spread, so
    ``min_sites`` is 2 or more.
    """
    if min_sites < 2:
        raise ValueError("lines are compared across sites: min_sites must be 2 or more")
    lines = lines_of(docs.select(F.col(site).cast("string").alias("_site"), "text"))
    sketches = lines.filter("_site is not null").groupBy("_line").agg(F.hll_sketch_agg("_site", bits).alias("_sketch"))
    estimates = stage(sketches.select("_line", F.hll_sketch_estimate("_sketch").alias("_sites")).filter(F.col("_sites") > 1), "line-spread")
    band = max(1.0, 4 * 1.04 / sqrt(2**bits) * min_sites)
    sure = estimates.filter(F.col("_sites") > min_sites + band).select("_line")
    near = estimates.filter(F.col("_sites").between(min_sites - band, min_sites + band)).select("_line")
    exact = lines.join(bounded_broadcast(near), "_line").groupBy("_line").agg(F.count_distinct("_site").alias("_sites"))
    return sure.union(exact.filter(F.col("_sites") >= min_sites).select("_line"))


def without_spread_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text and the site): doc_id, n_lines, n_removed, kept (the text that is left).

    Null texts are empty ones; empty and blank lines always stay; repeated rows get equal results
    and count as one site; texts without such lines stay as they are; other columns are ignored.
    """
    bad = bounded_broadcast(stage(spread_lines(docs, site, min_sites), "line-boilerplate"))
    keyed = docs.select("doc_id", F.xxhash64(text_of()).alias("_key"), text_of().alias("text"))
    found = lines_of(keyed).join(bad, "_line").groupBy("doc_id", "_key").agg(F.collect_set("_line").alias("_bad"))
    found = found.withColumnsRenamed({"doc_id": "_d", "_key": "_k"})
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_key") == F.col("_k"))
    rows = keyed.join(found, same, "left").withColumn("_lines", F.split("text", "\n"))
    # The hash of a blank line is in the list only if another line has the same hash.
    left = F.filter("_lines", lambda x: ~F.array_contains("_bad", F.xxhash64(x)) | ~x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("_left", F.when(F.col("_bad").isNull(), F.col("_lines")).otherwise(left))
    return rows.select(
        "doc_id", F.size("_lines").cast("long").alias("n_lines"), (F.size("_lines") - F.size("_left")).cast("long").alias("n_removed"),
        F.array_join("_left", "\n").alias("kept"),
    )


def op3(spark, sf_dir: str) -> DataFrame:
    """The query: what is left of all documents without lines of ten sources or more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return without_spread_lines(docs).select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
each AS (SELECT doc_id, source, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p FROM d),
bad AS (SELECT line FROM each WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line HAVING count(DISTINCT source) >= 10),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS kept, count(*) AS n FROM each ANTI JOIN bad USING (line) GROUP BY doc_id)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
