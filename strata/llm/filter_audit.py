"""Operator 13: what each filter of a chain removes, for every order in which the chain can be applied.

A document is reduced to its mask: which filters it fails, each judged on the input alone. Documents are
counted by part and mask, so a part has at most ``2 ** filters`` cells whatever its size. Every cell is
then folded by higher-order functions across the constant array of all orders: ``transform`` walks the
orders, ``aggregate`` walks the steps of one order and carries whether the cell is still alive. That
gives one weighted struct per order and step (600 for five filters); the structs of the cells of a part
are merged by elementwise sums. No row per document and order is ever made.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_broadcast, table, text_of
from strata.session import stage

BLANKS = r"[\x20\x09-\x0D]+"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
MAX_FILTERS = 6


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that look at one text: too short, repetitive, shouting, and odd signs."""
    words = F.array_remove(F.split(text, BLANKS), "")
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]", ""))
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * capitals > 5 * F.char_length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def failure_masks(docs: DataFrame, filters: Mapping[str, Column], repeats: str | None = None) -> DataFrame:
    """(_id, _part, _mask) of every row of ``docs`` (doc_id, text, source), one bit per filter in their order.

    ``repeats`` names one more filter, the last bit: the text is that of a smaller doc_id anywhere in
    the table. A null text is an empty one and a null source the part ``''``. A null doc_id is smaller
    than none, and no id is smaller than it; rows that share id and text don't fail for each other.
    """
    bits = [F.when(failed, F.lit(1 << i)).otherwise(0) for i, failed in enumerate(filters.values())]
    narrow = docs.select(
        F.col("doc_id").alias("_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_part"),
        sum(bits, F.lit(0)).alias("_mask"),
        *([F.unhex(F.sha2(text_of().cast("binary"), 256)).alias("_text")] if repeats else []),
    )
    if not repeats:
        return narrow
    narrow = stage(narrow, "masks")
    # Only texts that occur under several ids; stored, so that AQE can split a text with very many rows.
    firsts = narrow.groupBy("_text").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
    firsts = stage(firsts.filter("_first < _last").select("_text", "_first"), "repeated_texts")
    bit = F.when(F.col("_id") > F.col("_first"), F.lit(1 << len(bits))).otherwise(0)
    joined = narrow.join(bounded_broadcast(firsts), "_text", "left")
    return joined.select("_id", "_part", (F.col("_mask") + bit).alias("_mask"))


def with_labels(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``masks`` with _good and _toxic: whether a row of ``labels`` says so for the id; repeated rows count once."""
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("_toxic"),
    )
    marks = stage(marks.filter("_good OR _toxic"), "marks")
    joined = masks.join(marks, "_id", "left")
    return joined.select("_part", "_mask", *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("_good", "_toxic")])


def audit_orders(masks: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per part, order of the filters and step, with the counts of ``COUNTS``.

    ``masks`` has (_part, _mask, _good, _toxic), bit i of the mask for ``names[i]``. ``kept`` is what is
    left after the step, ``removed`` what it takes; ``redundant`` rows fail its filter but are gone
    already; ``unique_fails`` fail this filter only; ``shapley`` is what the filter removes, summed over all
    orders, the same at every step. An empty table gives no rows, since it has no parts.
    """
    if not 0 < len(names) <= MAX_FILTERS:
        raise ValueError(f"between 1 and {MAX_FILTERS} filters can be audited")
    cells = masks.groupBy("_part", "_mask").agg(
        F.count("*").alias("n"), F.count_if("_good").alias("good"), F.count_if("_toxic").alias("toxic")
    )
    # At most 2 ** filters cells a part.
    parts = cells.groupBy("_part").agg(F.collect_list(F.struct("_mask", "n", "good", "toxic")).alias("_cells"))
    labels = ["".join(order) for order in permutations(names)]
    bit = {name: 1 << i for i, name in enumerate(names)}
    orders = F.array(*[F.array(*[F.lit(bit[name]) for name in order]) for order in permutations(names)])
    row = f"struct<{','.join(f'{c}:bigint' for c in COUNTS)}>"
    none = F.array().cast(f"array<{row}>")

    def folded(cell: Column) -> Column:
        """The structs of one cell, order by order and step by step."""

        def step(state: Column, failing: Column) -> Column:
            fails = cell["_mask"].bitwiseAND(failing) != 0
            alive, taken = state["alive"], state["alive"] & fails
            share = F.lit(factorial(len(names))) / F.bit_count(cell["_mask"])
            counts = {
                "kept": F.when(alive & ~fails, cell["n"]),
                "removed": F.when(taken, cell["n"]),
                "redundant": F.when(~alive & fails, cell["n"]),
                "unique_fails": F.when(cell["_mask"] == failing, cell["n"]),
                "good_lost": F.when(taken, cell["good"]),
                "toxic_lost": F.when(taken, cell["toxic"]),
                # Each of the filters that a row fails is the first of them in an equal share of all orders.
                "shapley": F.when(fails, cell["n"] * share.cast("long")),
            }
            made = F.struct(*[F.coalesce(value, F.lit(0)).cast("long").alias(c) for c, value in counts.items()])
            return F.struct((alive & ~fails).alias("alive"), F.concat(state["rows"], F.array(made)).alias("rows"))

        start = F.struct(F.lit(True).alias("alive"), none.alias("rows"))
        return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, step, lambda s: s["rows"])))

    def added(a: Column, b: Column) -> Column:
        return F.struct(*[(a[c] + b[c]).alias(c) for c in COUNTS])

    zeros = F.array_repeat(F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS]), len(names) * len(labels))
    sums = F.aggregate("_cells", zeros, lambda total, cell: F.zip_with(total, folded(cell), added))
    rows = parts.select("_part", F.posexplode(sums).alias("_place", "_row"))
    which = F.floor(F.col("_place") / len(names)).cast("int")
    return rows.select(
        F.col("_part").alias("part"),
        F.element_at(F.array(*[F.lit(x) for x in labels]), which + 1).alias("filter_order"),
        (F.col("_place") % len(names) + 1).cast("int").alias("step"),
        *[F.col("_row")[c].alias(c) for c in COUNTS],
    )


def op13(spark, sf_dir: str) -> DataFrame:
    """The query: all 120 orders of five filters over all documents, by source."""
    docs = table(spark, sf_dir, "documents")
    filters = text_filters(text_of())
    masks = failure_masks(docs, filters, repeats="E")
    return audit_orders(with_labels(masks, table(spark, sf_dir, "labels")), [*filters, "E"])


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM texts GROUP BY t),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
fails AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         {'A': len(w) < 50, 'B': 100 * len(list_distinct(w)) < 65 * len(w),
          'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
          'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(x.doc_id > first_id, false)} AS f
  FROM texts x JOIN firsts USING (t) LEFT JOIN marks m ON m.doc_id = x.doc_id),
cells AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM fails GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
  SELECT a.c || b.c || d.c || e.c || g.c AS filter_order FROM letters a, letters b, letters d, letters e, letters g
  WHERE len(list_distinct([a.c, b.c, d.c, e.c, g.c])) = 5),
steps AS (SELECT filter_order, step FROM orders, range(1, 6) r(step)),
judged AS (
  SELECT part, filter_order, step, n, good, toxic, CAST(f.A AS INT) + f.B::INT + f.C::INT + f.D::INT + f.E::INT AS fs,
         map_from_entries([('A', f.A), ('B', f.B), ('C', f.C), ('D', f.D), ('E', f.E)]) AS m,
         substr(filter_order, step, 1) AS letter FROM cells, steps),
walked AS (
  SELECT *, m[letter] AS bad, list_bool_or([m[substr(filter_order, k, 1)] FOR k IN range(1, step)]) AS gone FROM judged),
counted AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (NOT bad AND NOT coalesce(gone, false)), 0) AS kept,
         coalesce(sum(n) FILTER (bad AND NOT coalesce(gone, false)), 0) AS removed,
         coalesce(sum(n) FILTER (bad AND gone), 0) AS redundant,
         coalesce(sum(n) FILTER (bad AND fs = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (bad AND NOT coalesce(gone, false)), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (bad AND NOT coalesce(gone, false)), 0) AS toxic_lost
  FROM walked GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""
