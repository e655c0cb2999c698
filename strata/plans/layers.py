"""Where a deployment keeps its layers, and what a load reports."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime
from functools import wraps
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.schemas import WATERMARK_SCHEMA
from strata.session import configure
from strata.sources.bronze import bronze_path
from strata.sources.metadata import (
    CONFIG_REQUIRED,
    WATERMARK_REQUIRED,
    ObjectConfig,
    compacted_log,
    latest_watermark,
    load_config,
    require_values,
    reset_watermark,
    seed_config,
    superseded_log,
    watermark_rows,
)
from strata.sources.tables import Tables

LOADED, NO_NEW_DATA = "loaded", "no_new_data"
MAX_LOADS = 8  # that run side by side
LOG_FILES = 64  # of the watermark log, then it is compacted
BUCKET_ROWS = 4_000_000  # that a bucket is meant for


@dataclass(frozen=True)
class LoadResult:
    """Outcome of one load: row counts by kind, the watermark it reached and how long it took."""

    table: str
    status: str
    counts: dict[str, int] = field(default_factory=dict)
    watermark: datetime | None = None
    seconds: float = 0.0


def timed(load: Callable[..., LoadResult]) -> Callable[..., LoadResult]:
    """Adds the duration of the load to its result."""

    @wraps(load)
    def run(*args, **options) -> LoadResult:
        started = time.perf_counter()
        return replace(load(*args, **options), seconds=time.perf_counter() - started)

    return run


class Layers:
    """Raw files under ``root``; control, cleaned and dimensional tables in three databases."""

    CONFIG, WATERMARK, HISTORY = "config_tables", "watermark", "watermark_history"

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        prefix: str = "strata",
        buckets: int = 8,
        fact_buckets: int = 1,
        bucket_rows: int = BUCKET_ROWS,
    ):
        """An update rewrites the buckets that it touches. ``buckets`` is the least number for dimensions and snapshot
        tables, ``fact_buckets`` for a month of facts; a table that outgrows ``bucket_rows`` a bucket
        twofold is dealt anew to more of them.
        """
        self.spark = configure(spark)
        self.least_buckets, self.fact_buckets, self.bucket_rows = buckets, fact_buckets, bucket_rows
        self.root = root.rstrip("/")
        self._log_lock = Lock()  # parallel loads append to one log
        self.control, self.silver, self.gold = (
            Tables(spark, f"{prefix}_{name}", f"{self.root}/{name}") for name in ("etl", "silver", "gold")
        )

    def set_up(self, config: DataFrame | None = None) -> Layers:
        """(Re)write the configuration; create the watermark log where it is missing."""
        config = seed_config(self.spark) if config is None else config
        self.control.replace(require_values(config, CONFIG_REQUIRED), self.CONFIG)
        if not self.control.exists(self.WATERMARK):
            self.control.create(self.spark.createDataFrame([], WATERMARK_SCHEMA), self.WATERMARK)
        return self

    def drop(self) -> None:
        for tables in (self.control, self.silver, self.gold):
            tables.drop_database()

    def config(self, layer: str, *objects: str) -> dict[str, ObjectConfig]:
        return load_config(self.control.read(self.CONFIG), layer, objects)

    def bronze(self, config: ObjectConfig) -> str:
        return bronze_path(self.root, config.source_system, config.source_object)

    @property
    def watermarks(self) -> DataFrame:
        return self.control.read(self.WATERMARK)

    def watermark(self, layer: str, object_name: str) -> datetime | None:
        return latest_watermark(self.watermarks, layer, object_name)

    def advance(self, layer: str, object_name: str, value: datetime, now: datetime, previous: datetime | None) -> None:
        """Log a new watermark; called last in a load. A mark never goes back and is not logged twice."""
        if previous is not None and value <= previous:
            return
        with self._log_lock:
            rows = require_values(watermark_rows(self.spark, layer, object_name, value, now), WATERMARK_REQUIRED)
            self.control.append(rows, self.WATERMARK)
            if len(self.watermarks.inputFiles()) > LOG_FILES:
                self._compact()

    def _compact(self) -> None:
        """Keep the newest entries in the log; the older ones go to a table that no load reads."""
        older = superseded_log(self.watermarks).coalesce(1)
        if self.control.exists(self.HISTORY):
            # Entries that an interrupted compaction has moved already are not moved again.
            self.control.append(older.exceptAll(self.control.read(self.HISTORY)), self.HISTORY)
        else:
            self.control.create(older, self.HISTORY)
        self.control.replace(compacted_log(self.watermarks).coalesce(1), self.WATERMARK)

    def buckets(self, rows: int, least: int | None = None) -> tuple[str, int]:
        """The bucket key and the number of buckets for so many rows: the least number, doubled as often as needed."""
        number = self.least_buckets if least is None else least
        while rows > number * self.bucket_rows:
            number *= 2
        return "hash_key", number

    def settle(self, tables: Tables, table: str, rows: int, least: int | None = None) -> bool:
        """Deal a table anew whose buckets hold twice the rows that they are meant for."""
        held = tables.layout(table).buckets
        if held is None or rows <= 2 * held[1] * self.bucket_rows:
            return False
        tables.redeal(table, self.buckets(rows, least)[1])
        return True

    def reset(self, layer: str = "bronze") -> int:
        """Forget the watermarks of a layer, to load it anew; returns the number removed."""
        removed = self.watermarks.filter(F.col("layer") == layer).count()
        if removed:
            self.control.replace(reset_watermark(self.watermarks, layer), self.WATERMARK)
        return removed


def side_by_side(load: Callable, items: Iterable) -> list:
    """Run loads that do not depend on each other from parallel threads; Spark gets their jobs together."""
    items = list(items)
    with ThreadPoolExecutor(max_workers=min(MAX_LOADS, max(1, len(items)))) as pool:
        return list(pool.map(load, items))


def count_by(column: str, *values: str) -> dict[str, Column]:
    return {value: F.count_if(F.col(column) == value) for value in values}


def observed(df: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """Metrics that the write of ``df`` collects on the way, without a second pass."""
    observation = Observation()
    return df.observe(observation, *[c.alias(name) for name, c in metrics.items()]), observation
