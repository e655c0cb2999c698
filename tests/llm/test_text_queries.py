"""The registered text queries: against SQL where there is one, and the pipeline stage by stage."""

import os
from pathlib import Path

import pytest

import corpus_pipeline
from strata.llm.queries import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")
FOLDER = os.environ.get("STRATA_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")
CONTRACT = {
    "op1_decontamination": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    "op4_jaccard_join": {"doc_id", "n_shingles", "component_id"},
    "op5_quality_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op6_secret_ledger": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op7_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op8_substrings": {"doc_id", "n_words", "n_removed", "kept_sha256"},
    "op9_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op10_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op11_top_k_search": {"query_id", "rank", "vec_id", "score"},
    "op12_periodic_runs": {
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    },
    "op13_filter_audit": {
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
    },
}
NOT_BY_DOCUMENT = {"op11_top_k_search", "op13_filter_audit"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_text_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert CONTRACT.get(name, set()) <= set(df.columns)
    got = [tuple(r) for r in df.collect()]
    if name not in NOT_BY_DOCUMENT:
        assert len(got) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    if name in ORACLES:
        with duckdb.connect() as db:
            for file in Path(FOLDER).glob("*.parquet"):
                db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
            want = db.execute(ORACLES[name])
            place = [df.columns.index(d[0]) for d in want.description]
            assert sorted(tuple(r[i] for i in place) for r in got) == sorted(want.fetchall())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, rows = docs.columns, []
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).toPandas())
        rows.append(docs.count())
    assert rows[2] <= rows[1] < rows[0] and rows[3] == rows[4] > rows[2] > 0
    assert set(columns) < set(docs.columns)
    assert corpus_pipeline.run(spark, FOLDER).count() == rows[-1]
