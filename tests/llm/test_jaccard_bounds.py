"""What tasks of the Jaccard join hold and write at a time."""

import numpy as np
import pyarrow as pa

from strata.llm import jaccard


def test_subsets_of_many_sets_go_out_in_bounded_batches():
    sets = np.random.default_rng(1).integers(0, 2**62, (8, 24))
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(list(sets), pa.list_(pa.int64()))], ["key", "small"])
    one = [b for i in range(8) for b in jaccard.subsets(24)(iter([batch.slice(i, 1)]))]
    many = list(jaccard.subsets(24)(iter([batch])))
    most = max(len(jaccard.left_out(24, jaccard.least_overlap(24, m))) for m in jaccard.partners(24))
    assert max(b.num_rows for b in many) < jaccard.SUBSET_ROWS + most
    assert pa.Table.from_batches(many).equals(pa.Table.from_batches(one))


def test_few_edges_are_written_in_few_files(spark):
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = jaccard.components(spark.range(600).selectExpr("id as u", "id div 3 * 3 as v"))
        assert len(found.inputFiles()) <= spark.sparkContext.defaultParallelism
        assert {tuple(r) for r in found.collect()} == {(i, i // 3 * 3) for i in range(600) if i % 3}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
