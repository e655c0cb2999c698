"""Config-driven ingestion from source tables into the raw layer."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.errors import UnmarkedRows
from strata.operators import conform, rescued_counts
from strata.plans.layers import LOADED, NO_NEW_DATA, LoadResult, Layers, observed, side_by_side, timed
from strata.sources.bronze import (
    RESCUED,
    add_lineage,
    extract_delta,
    extract_full,
    not_copied,
    read_bronze,
    recorded_schema,
    write_bronze,
)
from strata.sources.metadata import ObjectConfig, ingest_list, last_load

# Gives the source table for a schema and table name: spark.table, a JDBC read, files, ...
Reader = Callable[[str, str], DataFrame]


@timed
def ingest_object(
    layers: Layers,
    config: ObjectConfig,
    source: DataFrame,
    now: datetime,
    *,
    clock: str = "source",
    unmarked: str = "take",
    types: StructType | None = None,
) -> LoadResult:
    """Copy one source table, or what changed in it, to the raw layer.

    A delta starts at the stored source watermark; the first one takes everything. ``clock="load"``
    starts at the time of the last load instead, which misses rows edited before it but after the
    watermark. Rows without a watermark are taken once, as far as the raw layer can tell, and counted, or with
    ``unmarked="refuse"`` are an error before anything is written. A source without marks, such as
    an empty one, leaves the stored mark as it is.

    With ``types`` the copy is converted to declared types. Values that do not convert are NULL, kept as text
    in the column ``RESCUED`` of the raw layer, and counted by column.
    """
    if clock not in ("source", "load"):
        raise ValueError(f"unknown clock {clock!r}")
    if unmarked not in ("take", "refuse"):
        raise ValueError(f"unknown choice for unmarked rows {unmarked!r}")
    high = marked = None
    metrics = {"copied": F.count(F.lit(1))}
    if config.incremental:
        mark = config.watermark_column
        marked = layers.watermark("bronze", config.source_object)
        low = marked if clock == "source" else last_load(layers.watermarks, "bronze", config.source_object)
        high, without = source.agg(F.max(mark).cast("timestamp"), F.count_if(F.col(mark).isNull())).first()
        if without and unmarked == "refuse":
            raise UnmarkedRows(f"{config.source_object}: {without} rows have no {mark}")
        # The configured columns need not hold the mark, so rows without one are counted above.
        rows = extract_delta(source, config.columns, mark, low, high)
        path = layers.bronze(config)
        held = recorded_schema(layers.spark, path) if without and mark in config.columns else None
        if held and set(config.columns) <= set(held.names):
            unknown = extract_full(source.filter(F.col(mark).isNull()), config.columns)
            rows = extract_delta(source, config.columns, mark, low, high, unmarked=False).unionByName(
                not_copied(unknown, read_bronze(layers.spark, path), mark)
            )
    else:
        rows = extract_full(source, config.columns)
    if types is not None:
        declared = StructType([types[c] for c in rows.columns])
        rows = conform(rows, declared, rescued=RESCUED)
        metrics |= rescued_counts(declared, RESCUED)
    rows, seen = observed(add_lineage(rows, config.source_system, now), metrics)
    write_bronze(rows, layers.bronze(config), now)
    # Of the columns, only those that lost a value are reported.
    counts = {name: n for name, n in seen.get.items() if n or name == "copied"}
    if config.incremental:
        counts["unmarked"] = without
    if high is not None:
        layers.advance("bronze", config.source_object, high, now, marked)
        high = high if marked is None else max(high, marked)
    return LoadResult(config.source_object, LOADED if counts["copied"] else NO_NEW_DATA, counts, high or marked)


def ingest_all(
    layers: Layers,
    reader: Reader,
    now: datetime,
    *,
    source_object: str = "ALL",
    clock: str = "source",
    unmarked: str = "take",
    types: Mapping[str, StructType] | None = None,
) -> list[LoadResult]:
    """All active objects of the Bronze config, or one of them. Each is one Spark write.

    ``types`` names the declared schema of objects whose copies are to be converted.
    """
    listing = ingest_list(layers.control.read(layers.CONFIG), source_object).orderBy("config_id")
    listed = [row["source_object"] for row in listing.collect()]
    configs = layers.config("Bronze", *(listed or [source_object])).values()

    def ingest(config: ObjectConfig) -> LoadResult:
        source = reader(config.source_schema, config.source_table)
        declared = (types or {}).get(config.source_object)
        return ingest_object(layers, config, source, now, clock=clock, unmarked=unmarked, types=declared)

    return side_by_side(ingest, configs)
