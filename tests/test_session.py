"""Where a cluster's scratch files go."""

from types import SimpleNamespace

import pytest
from pyspark.sql import DataFrameReader

from strata import session
from strata.errors import ConfigError
from strata.session import scratch_folder, stage
from strata.workload import QUERIES

CLUSTER = "spark://host:7077"


def test_shared_folder_of_a_file_system_serves_a_cluster(spark, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir")
    monkeypatch.setattr(spark.sparkContext, "master", CLUSTER)
    assert scratch_folder(spark) == named
    assert stage(spark.range(5).toDF("v"), "five").count() == 5


@pytest.mark.parametrize("name", ["append_evolve", "bronze_partition_range", "latest_snapshot", "surrogate_keys"])
def test_queries_with_scratch_files_run_on_a_cluster(spark, monkeypatch, name):
    monkeypatch.setattr(spark.sparkContext, "master", CLUSTER)
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


def test_folder_that_executors_and_driver_do_not_share_is_an_error(spark, monkeypatch, tmp_path):
    with pytest.raises(ConfigError):
        session._try_out(spark, "file:/proc/nowhere")
    with monkeypatch.context() as lost:
        lost.setattr(DataFrameReader, "parquet", lambda self, path: spark.range(1).toDF("id"))
        with pytest.raises(ConfigError):
            session._try_out(spark, str(tmp_path))
    assert list(tmp_path.iterdir()) == []
    session._try_out(spark, str(tmp_path))


def test_cluster_without_a_named_folder_uses_the_warehouse(monkeypatch):
    def cluster(master, checkpoints=None, **conf):
        context = SimpleNamespace(master=master, applicationId="a", getCheckpointDir=lambda: checkpoints)
        return SimpleNamespace(conf=conf, sparkContext=context)

    monkeypatch.setattr(session, "_scheme", lambda spark, folder: "s3a")
    warehouse = {"spark.sql.warehouse.dir": "s3a://store/warehouse/"}
    for master in (CLUSTER, "yarn", "local-cluster[2,1,1024]"):
        assert scratch_folder(cluster(master, **warehouse)) == "s3a://store/warehouse/strata-scratch"
        assert scratch_folder(cluster(master, "s3a://store/checkpoints/1", **warehouse)) == "s3a://store/checkpoints/1"
