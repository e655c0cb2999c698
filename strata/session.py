"""Session settings and the scratch folder used to cut lineage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import threading
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.errors import ConfigError

SQL_SETTINGS = {
    # One clock for all layers, so that text watermarks read back as they were written.
    "spark.sql.session.timeZone": "UTC",
    # The default (INT96) has no row-group statistics, so audit_ts filters could not skip data.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keys in a filter that parquet looks up in statistics and Bloom filters one by one (twice LISTED_KEYS).
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # Partial fact rewrites replace only the partitions they write.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Hashes are most of a stored row; their hex digits take half the bytes this way.
    "spark.sql.parquet.compression.codec": "zstd",
    # Shuffle files go with the write or action that made them, not when the driver happens to collect garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

_own_scratch: dict[str, str] = {}
_tried_out: set[tuple[str, str]] = set()
_scopes = threading.local()  # loads of independent tables may run in parallel threads


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library relies on to an existing session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "strata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with those settings; cluster size and shuffle partitions stay with the caller."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir`` or by ``setCheckpointDir``.

    Where neither names one, a temporary folder in local mode; on a cluster, where other machines
    could not see one, a folder in the warehouse. A folder of a file system that a machine may have to itself
    is tried out first on a cluster, unless ``strata.scratch.mounted=true`` says that all machines mount it.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    on_cluster = not re.fullmatch(r"local(\[.*\])?", context.master)  # local-cluster has executors of its own
    if on_cluster and not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/strata-scratch"
    if shared:
        mounted = spark.conf.get("strata.scratch.mounted", "false") == "true"
        if on_cluster and not mounted and _scheme(spark, shared) == "file":
            _try_out(spark, shared.rstrip("/"))
        return shared.rstrip("/")
    if context.applicationId not in _own_scratch:
        folder = _own_scratch[context.applicationId] = tempfile.mkdtemp(prefix="strata-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return _own_scratch[context.applicationId]


def _try_out(spark: SparkSession, folder: str) -> None:
    """An error unless all that executors write to the folder is found there; tried once in an application.

    Rows that went to disks of other machines would be missing without an error wherever ``stage`` reads them back.
    """
    tried = (spark.sparkContext.applicationId, folder)
    if tried in _tried_out:
        return
    tasks = 2 * spark.sparkContext.defaultParallelism
    path = f"{folder}/trial-{uuid4().hex}"
    cause = None
    try:
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        found = spark.read.schema("id long").parquet(path).count()
    except (PySparkException, Py4JJavaError) as failed:
        found, cause = 0, failed
    remove(spark, path)
    if found != tasks:
        raise ConfigError(f"executors and driver don't share {folder}: set spark.checkpoint.dir to a folder that they do") from cause
    _tried_out.add(tried)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _scheme(spark: SparkSession, folder: str) -> str:
    """The file system that a path without one resolves to as well."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme()


def stage(df: DataFrame, label: str, session: SparkSession | None = None, *, derived: Mapping[str, Column] | None = None) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back: lineage ends, later passes prune columns.

    The files outlive lost executors. Inside ``scratch_scope`` they are removed at its end. ``session`` reads
    them back, where ``df`` belongs to another one, as the batches of a stream do. Columns that are ``derived``
    from the others, such as hashes, are not written but computed again when they are read.
    """
    spark = session or df.sparkSession
    path = f"{scratch_folder(spark)}/{label}-{uuid4().hex}"
    written = df.drop(*derived) if derived else df
    written.write.parquet(path)
    for paths in _open_scopes()[-1:]:
        paths.append(path)
    stored = spark.read.schema(written.schema).parquet(path)
    return with_derived(stored, df.columns, derived) if derived else stored


def with_derived(df: DataFrame, columns: Sequence[str], derived: Mapping[str, Column]) -> DataFrame:
    """The columns in their order, with the derived ones computed from those that ``df`` has."""
    return df.select(*[derived[c].alias(c) if c in derived else F.col(f"`{c}`") for c in columns])


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """Remove what ``stage`` wrote inside the block once its results are in a table.

    The block gets a function like ``stage`` for results that outlive it, up to the end of the scope around it.
    """
    own: list[str] = []
    results: list[str] = []

    def keep(df: DataFrame, label: str, **options) -> DataFrame:
        staged = stage(df, label, **options)
        results.append(own.pop())
        return staged

    _open_scopes().append(own)
    try:
        yield keep
    finally:
        _open_scopes().pop()
        for paths in _open_scopes()[-1:]:
            paths += results
        for path in own:
            remove(spark, path)


def _open_scopes() -> list[list[str]]:
    if not hasattr(_scopes, "stack"):
        _scopes.stack = []
    return _scopes.stack
