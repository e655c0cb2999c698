"""Operator 13 against a document-by-document walk through all orders."""

from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from strata.llm.common import text_of
from strata.llm.filter_audit import audit_orders, failure_masks, text_filters, with_labels

PROSE = " ".join(f"word{i}" for i in range(60))
DOCS = "doc_id long, text string, source string, part string, _mask string"
LABELS = "doc_id long, quality int, toxic int, text string"


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*row, "x", "y") for row in rows], DOCS)
    marks = spark.createDataFrame([(*row, "z") for row in labels], LABELS)
    filters = text_filters(text_of())
    return audit_orders(with_labels(failure_masks(docs, filters, repeats="E"), marks), [*filters, "E"])


def failed(rows, at):
    doc_id, text, _ = rows[at]
    text = text or ""
    words = [w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]
    fails = set()
    if len(words) < 50:
        fails.add("A")
    if 100 * len(set(words)) < 65 * len(words):
        fails.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text):
        fails.add("C")
    if set(text) & set("#$%&*|"):
        fails.add("D")
    if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows):
        fails.add("E")
    return fails


def walked(rows, labels):
    good = {i for i, quality, _ in labels if quality == 1}
    toxic = {i for i, _, bad in labels if bad == 1}
    counts = {(s or "", "".join(o), k): Counter() for _, _, s in rows for o in permutations("ABCDE") for k in range(1, 6)}
    shapley = Counter()
    for at, (doc_id, _, source) in enumerate(rows):
        fails, part = failed(rows, at), source or ""
        for order in permutations("ABCDE"):
            gone = False
            for k, name in enumerate(order, 1):
                c = counts[part, "".join(order), k]
                c["unique_fails"] += fails == {name}
                if name in fails:
                    c["redundant" if gone else "removed"] += 1
                    if not gone:
                        shapley[part, name] += 1
                        c["good_lost"] += doc_id in good
                        c["toxic_lost"] += doc_id in toxic
                    gone = True
                c["kept"] += not gone
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return {(*key, *(c[n] for n in names), shapley[key[0], key[1][key[2] - 1]]) for key, c in counts.items()}


def test_all_orders_against_a_walk_of_every_document(spark):
    rows = [
        (1, PROSE, "a"), (2, PROSE, "b"), (2, PROSE, "b"), (3, PROSE + " #", None), (4, None, "a"), (5, "", ""),
        (6, "SHOUT " * 70, "a"), (7, "same word " * 40, "b"), (8, " \t\n ", "a"), (9, "é" * 20 + " A|", "b"),
        (None, PROSE, "a"), (None, PROSE, "a"), (10, (PROSE + "\n") * 400, "b"), (1, "short", "a"), (11, "short", None),
    ]
    labels = [(1, 1, 0), (1, 1, 0), (2, 0, 1), (6, 1, None), (7, None, 1), (None, 1, 1), (99, 1, 1), (11, 1, 1)]
    got = audited(spark, rows, labels).collect()
    assert len(got) == 3 * 600
    assert {tuple(row) for row in got} == walked(rows, labels)


def test_an_empty_table_has_no_parts_and_empty_labels_lose_nothing(spark):
    assert audited(spark, [], [(1, 1, 1)]).count() == 0
    rows = audited(spark, [(1, "x", "a")], []).agg(F.sum("removed"), F.sum("good_lost"), F.sum("kept")).first()
    assert tuple(rows) == (120, 0, sum((k - 1) * 24 for k in range(1, 6)))


def test_the_merge_never_makes_a_row_per_document_and_order(spark):
    rows = [(i, PROSE if i % 3 else "hot text", "a" if i % 3 else "b") for i in range(3000)]
    got = audited(spark, rows, [])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" in plan and plan.count("Generate") == 1
    total = got.filter("step = 5").groupBy("part", "filter_order").agg(F.sum(F.col("kept")).alias("k")).collect()
    assert {row.k for row in total if row.part == "a"} == {1} and {row.k for row in total if row.part == "b"} == {0}


def test_the_number_of_filters_is_bounded(spark):
    masks = spark.createDataFrame([("a", 1, False, False)], "_part string, _mask int, _good boolean, _toxic boolean")
    assert audit_orders(masks, "XY").count() == 4
    with pytest.raises(ValueError):
        audit_orders(masks, "ABCDEFG")
