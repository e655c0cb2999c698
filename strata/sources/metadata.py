"""Load configuration and the watermark log."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.errors import ConfigError
from strata.functions import split_list
from strata.schemas import CONFIG_SCHEMA, SOURCE_SYSTEM, SOURCES

LAYERS = ("Bronze", "Silver", "Gold")
CONFIG_REQUIRED = ("config_id", "layer")
WATERMARK_REQUIRED = ("timestamp", "layer", "object_name", "key_1")
NO_WATERMARK = datetime(1900, 1, 1)  # fixed value: lower bound before the first load


@dataclass(frozen=True)
class ObjectConfig:
    """One active config row with its comma lists split."""

    source_object: str
    source_system: str
    source_schema: str | None
    source_table: str | None
    load_type: str
    watermark_column: str | None
    keys: tuple[str, ...]
    columns: tuple[str, ...]

    @property
    def incremental(self) -> bool:
        return self.load_type == "incremental"


def seed_config(spark: SparkSession) -> DataFrame:
    """One row per layer and source. The Gold lists leave out what the Silver layer drops."""
    rows = []
    for layer in LAYERS:
        gold = layer == "Gold"
        for source in SOURCES:
            unwanted = source.unwanted if gold else ()
            columns = ", ".join(c for c in source.schema.fieldNames() if c not in unwanted)
            place = (None, None) if gold else (source.schema_name, source.table)
            rows.append(
                (len(rows) + 1, layer, SOURCE_SYSTEM, *place, source.object)
                + (source.load_type, source.watermark, source.business_key, columns, True)
            )
    return spark.createDataFrame(rows, CONFIG_SCHEMA)


def legacy_config(config: DataFrame, layer: str) -> DataFrame:
    """The older one-table-per-layer shape, without ``layer`` and numbered from 1."""
    dropped = ["layer"] if layer == "Silver" else ["layer", "source_schema", "source_table", "load_type"]
    rows = config.filter(F.col("layer") == layer)
    # One row per configured table: a handful, whatever the data size.
    return rows.withColumn("config_id", F.row_number().over(W.orderBy("config_id"))).drop(*dropped)


def load_config(config: DataFrame, layer: str, objects: Iterable[str]) -> dict[str, ObjectConfig]:
    """Active config of the named objects; raises when one is missing or has empty lists."""
    wanted = list(objects)
    active = config.filter((F.col("layer") == layer) & F.col("source_object").isin(wanted) & F.col("is_active"))
    found = {row["source_object"]: _parsed(row) for row in active.collect()}
    missing = [name for name in wanted if name not in found]
    if missing:
        raise ConfigError(f"no active {layer} config for {missing}")
    for item in found.values():
        if not item.keys or not item.columns:
            raise ConfigError(f"{item.source_object}: business key or column list is empty")
        if item.incremental and not item.watermark_column:
            raise ConfigError(f"{item.source_object}: incremental load without a watermark column")
    return {name: found[name] for name in wanted}


def ingest_list(config: DataFrame, source_object: str = "ALL") -> DataFrame:
    """Active Bronze rows: all of them, or those of one object."""
    rows = config.filter((F.col("layer") == "Bronze") & F.col("is_active"))
    return rows if source_object == "ALL" else rows.filter(F.col("source_object") == source_object)


def require_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df``; writing it fails if a required column is NULL anywhere. Stored tables don't keep NOT NULL, so writes check it."""

    def checked(name: str) -> Column:
        missing = F.raise_error(F.lit(f"control column {name} must have a value")).cast(df.schema[name].dataType)
        return F.when(F.col(name).isNull(), missing).otherwise(F.col(name))

    return df.withColumns({name: checked(name) for name in columns})


def watermark_rows(spark: SparkSession, layer: str, object_name: str, value: datetime, now: datetime) -> DataFrame:
    """A log entry. Spark writes the value as text and reads it back, both in the session's time zone."""
    entry = {
        "timestamp": F.lit(now).cast("timestamp"),
        "layer": F.lit(layer),
        "object_name": F.lit(object_name),
        "key_1": F.lit(value).cast("timestamp").cast("string"),
        "key_1_desc": F.lit("datetime"),
    }
    return spark.range(1).select(*[column.alias(name) for name, column in entry.items()])


def latest_watermarks(log: DataFrame) -> DataFrame:
    """Newest entry of every (layer, object), its value read back as a timestamp."""
    newest = F.max(F.struct("timestamp", "key_1")).alias("_newest")
    return log.groupBy("layer", "object_name").agg(newest).select(
        "layer",
        "object_name",
        F.col("_newest.timestamp").alias("timestamp"),
        F.to_timestamp("_newest.key_1").alias("watermark"),
    )


def _newest_first(log: DataFrame) -> DataFrame:
    order = W.partitionBy("layer", "object_name").orderBy(F.desc("timestamp"), F.desc("key_1"))
    return log.withColumn("_rank", F.row_number().over(order))


def compacted_log(log: DataFrame) -> DataFrame:
    """One row per (layer, object), the newest, from which all marks and load times are read as before."""
    return _newest_first(log).filter(F.col("_rank") == 1).drop("_rank")


def superseded_log(log: DataFrame) -> DataFrame:
    """The entries that ``compacted_log`` leaves out."""
    return _newest_first(log).filter(F.col("_rank") > 1).drop("_rank")


def latest_watermark(log: DataFrame, layer: str, object_name: str) -> datetime | None:
    """Value of the newest entry of one object, None before its first load."""
    mine = log.filter((F.col("layer") == layer) & (F.col("object_name") == object_name))
    row = mine.orderBy(F.desc("timestamp"), F.desc("key_1")).select(F.to_timestamp("key_1")).first()
    return row[0] if row else None


def last_load(log: DataFrame, layer: str, object_name: str) -> datetime | None:
    """Time of the newest entry. As a lower bound it misses rows edited before it but after the mark."""
    mine = log.filter((F.col("layer") == layer) & (F.col("object_name") == object_name))
    return mine.agg(F.max("timestamp")).first()[0]


def reset_watermark(log: DataFrame, layer: str = "bronze") -> DataFrame:
    """The log without the entries of one layer."""
    return log.filter(F.col("layer") != layer)


def _parsed(row) -> ObjectConfig:
    plain = ("source_object", "source_system", "source_schema", "source_table", "load_type", "watermark_column")
    keys, columns = split_list(row["business_key"]), split_list(row["column_list"])
    return ObjectConfig(**{name: row[name] for name in plain}, keys=tuple(keys), columns=tuple(columns))
