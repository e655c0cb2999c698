"""Loads of the cleaned, versioned layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.errors import ConfigError, EmptySnapshot, LoadError
from strata.functions import hash_expr, hash_text
from strata.operators import (
    classify,
    clean_strings,
    current_versions,
    dates_to_timestamp,
    drop_columns,
    keep_latest,
    latest_snapshot_at,
    near_stored,
    restrict_to,
    restrict_to_stored,
    row_hash,
    soft_delete,
    with_hash_key,
)
from strata.operators.changes import CHANGED, DELETED, NEW, SAME
from strata.plans.layers import LOADED, NO_NEW_DATA, LoadResult, Layers, count_by, observed, timed
from strata.schemas import SOURCES
from strata.session import scratch_scope, stage
from strata.sources.bronze import RESCUED, newer_than, read_bronze, recorded_schema
from strata.sources.metadata import ObjectConfig

DELETION_MARK = "deleted_audit_ts"
CURRENT = "_current"  # ending of the side table of versions in force
COMPACT_SHARE = 4  # compacted when more than one row in so many is superseded


def stage_rows(bronze: DataFrame, keys: Sequence[str], columns: Sequence[str], now: datetime, *, unwanted: Sequence[str] = (), watermark_column: str | None = None) -> DataFrame:
    """Raw rows cleaned, hashed and reduced to the newest per business key, stamped with the load time.

    Rows of one copy share their raw load time; ties go to the greater source watermark and
    then to the greater row hash, so that a rerun picks the same row.
    """
    cleaned = drop_columns(dates_to_timestamp(clean_strings(bronze)), [*unwanted, RESCUED])
    # One hash goes through the shuffle, as bytes.
    versioned = cleaned.withColumn("_version", F.unhex(row_hash(cleaned, columns)))
    order = ["audit_ts", *([watermark_column] if watermark_column else []), "_version"]
    newest = with_hash_key(keep_latest(versioned, keys, order), keys)
    hashed = newest.withColumn("row_hash", F.lower(F.hex("_version"))).drop("_version")
    return hashed.withColumn("audit_ts", F.lit(now).cast("timestamp"))


def version_hashes(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> dict[str, Column]:
    """The hashes of ``stage_rows`` as expressions over its other columns, for scratch files without them."""
    return {"hash_key": hash_expr(keys), "row_hash": row_hash(df, columns)}


def incremental_versions(
    staged: DataFrame, silver: DataFrame, keys: Sequence[str], *, derived: Mapping[str, Column] | None = None
) -> DataFrame:
    """Stored staged rows with ``change_type``, compared with the current versions of their own keys.

    The history is cut down by the first business key column: its range skips row groups, its
    values leave only histories that are needed. Further key columns only make that set larger
    than necessary, never smaller. ``derived`` are the hashes, where those of both frames follow from
    the other columns (``version_hashes``): then both are dealt by the text of the key, once, and hashed after that.
    """
    if not derived:
        current = current_versions(restrict_to_stored(silver, staged, keys[0]), active=None)
        return classify(staged, current, detect_deletes=False)
    text = hash_text(keys)
    held = near_stored(silver, staged, keys[0]).select(text.alias("_text"), "row_hash", "audit_ts")
    current = current_versions(restrict_to(held, staged.select(text.alias("_text")), "_text"), ["_text"], active=None)
    return classify(staged, current, detect_deletes=False, key="_text", derived={**derived, "_text": text})


def snapshot_versions(staged: DataFrame, silver: DataFrame) -> DataFrame:
    """Staged full copy with ``change_type``, deletions included; a deleted key that is back is new."""
    return classify(staged, current_versions(silver, active="after"), detect_deletes=True)


def snapshot_next(silver: DataFrame, changes: DataFrame, now: datetime) -> DataFrame:
    """Table after a full copy: deleted keys closed, new and changed rows added."""
    upserts = changes.filter(F.col("change_type").isin(NEW, CHANGED)).drop("change_type")
    gone = changes.filter(F.col("change_type") == DELETED)
    closed = soft_delete(silver, gone, F.lit(now).cast("timestamp"), mark=DELETION_MARK)
    # Newly configured columns are NULL in older versions.
    return closed.unionByName(upserts, allowMissingColumns=True)


@timed
def load_silver(layers: Layers, source_object: str, now: datetime) -> LoadResult:
    """Load one object as its configuration says."""
    config = layers.config("Silver", source_object)[source_object]
    load = load_incremental if config.incremental else load_snapshot
    with scratch_scope(layers.spark):
        return load(layers, config, now)


def load_incremental(layers: Layers, config: ObjectConfig, now: datetime) -> LoadResult:
    """Append new and changed versions of the rows ingested since the last load."""
    name = config.source_object
    since = layers.watermark("silver", name)
    bronze = newer_than(read_bronze(layers.spark, layers.bronze(config), since), "audit_ts", since)
    newest, rows = bronze.agg(F.max("audit_ts"), F.count(F.lit(1))).first()
    if not rows:
        return LoadResult(name, NO_NEW_DATA, watermark=since)
    if newest is None:
        raise LoadError(f"{name}: raw rows have no audit_ts")
    counts = _add_versions(layers, config, bronze, now)
    layers.advance("silver", name, newest, now, since)
    return LoadResult(name, LOADED, counts, newest)


@timed
def stream_silver(layers: Layers, source_object: str, checkpoint: str, now: datetime, *, files_per_batch: int | None = None) -> LoadResult:
    """Load an incremental object as a stream of its raw files, until all that are there have been read.

    The checkpoint folder knows which files have been loaded, so neither day folders nor marks are compared.
    A batch that is repeated after a failure finds its rows stored and adds nothing. All rows of a call carry
    the load time ``now``. Run the object either this way or by ``load_silver``, not by turns. The columns are
    those that the raw layer has when the stream starts.
    """
    config = layers.config("Silver", source_object)[source_object]
    if not config.incremental:
        raise ConfigError(f"{source_object} is loaded by full copies, which a stream can't compare")
    counts = dict.fromkeys((NEW, CHANGED, SAME), 0)

    def load(batch: DataFrame, _: int) -> None:
        with scratch_scope(layers.spark):
            # Streams have a session of their own, which other readers' file listings don't follow.
            rows = stage(batch, source_object, layers.spark)
            for kind, number in _add_versions(layers, config, rows, now).items():
                counts[kind] += number

    path = layers.bronze(config)
    files = layers.spark.readStream.schema(recorded_schema(layers.spark, path))
    if files_per_batch:
        files = files.option("maxFilesPerTrigger", files_per_batch)
    query = files.parquet(path).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()
    return LoadResult(source_object, LOADED if sum(counts.values()) else NO_NEW_DATA, counts)


def _add_versions(layers: Layers, config: ObjectConfig, bronze: DataFrame, now: datetime) -> dict[str, int]:
    """Append the new and changed versions among raw rows; how many there are of each kind.

    Rows are compared with a side table of the versions in force, so that the history is neither read nor
    ranked. While the register of the history is open the two may differ; the side table is then built anew.
    """
    name, silver, side = config.source_object, layers.silver, config.source_object + CURRENT
    staged = _staged(bronze, config, now)
    narrow = [config.keys[0], "hash_key", "row_hash", "audit_ts"]
    with silver.registered(name) as register:
        if not silver.exists(name):
            staged, seen = observed(staged, {NEW: F.count(F.lit(1))})
            silver.create(staged, name, indexed=[*config.keys, *_lookup_keys(config)])
            register.rows = seen.get[NEW]
            _store_current(layers, side, silver.read(name).select(*narrow), register.rows, config)
            return seen.get
        if register.counted or not silver.exists(side):
            _store_current(layers, side, current_versions(silver.read(name).select(*narrow), active=None), register.rows, config)
        # Used twice: to cut the side table down to its keys and to be compared with it.
        hashes = version_hashes(staged, config.keys, config.columns)
        staged = stage(staged, name, derived=hashes)
        known = current_versions(near_stored(silver.read(side), staged, config.keys[0]), active=None)
        versions = classify(staged, known, detect_deletes=False, derived=hashes)
        versions, seen = observed(versions, count_by("change_type", NEW, CHANGED, SAME))
        changes = stage(versions.filter(F.col("change_type") != SAME).drop("change_type"), name, derived=hashes)
        added = seen.get[NEW] + seen.get[CHANGED]
        if added:
            silver.append(changes, name, evolve=True)
            silver.append(changes.select(*narrow), side, evolve=True)
            register.rows += added
            _compact_current(layers, side, seen.get[CHANGED], register.rows, config)
    return seen.get


def _store_current(layers: Layers, side: str, rows: DataFrame, count: int, config: ObjectConfig) -> None:
    """(Re)build the side table: one narrow row per key, in buckets of the key that the planner knows."""
    if layers.silver.exists(side):
        layers.silver.replace(rows, side)
    else:
        layers.silver.create(rows, side, buckets=layers.buckets(count), indexed=config.keys[:1])


def _compact_current(layers: Layers, side: str, superseded: int, rows: int, config: ObjectConfig) -> None:
    """Drop superseded rows from the side table once they may be a share of it; its register counts them as keys."""
    silver = layers.silver
    with silver.registered(side) as register:
        # ``high`` counts the superseded rows since the last compaction.
        register.high += superseded
        register.rows = rows
        if register.high * COMPACT_SHARE > rows:
            silver.replace(current_versions(silver.read(side), active=None), side)
            register.high = 0
        layers.settle(silver, side, rows)


def load_snapshot(layers: Layers, config: ObjectConfig, now: datetime) -> LoadResult:
    """Compare the newest full copy with the table: append new and changed rows, close deleted keys."""
    name, silver = config.source_object, layers.silver
    since = layers.watermark("silver", name)
    snapshot, newest = latest_snapshot_at(read_bronze(layers.spark, layers.bronze(config), since))
    staged = _staged(snapshot, config, now).withColumn(DELETION_MARK, F.lit(None).cast("timestamp"))
    with silver.registered(name) as register:
        if silver.exists(name):
            versions = snapshot_versions(staged, silver.read(name))
            versions, seen = observed(versions, count_by("change_type", NEW, CHANGED, DELETED, SAME))
            changes = stage(versions.filter(F.col("change_type") != SAME), name)
            counts = seen.get
            if not counts[NEW] + counts[CHANGED] + counts[SAME]:
                raise EmptySnapshot(f"{name}: the newest copy has no rows")
            if counts[DELETED]:
                silver.update_keys(name, changes, lambda held: snapshot_next(held, changes, now))
            elif counts[NEW] + counts[CHANGED]:
                silver.append(changes.drop("change_type"), name, evolve=True)
        else:
            staged, seen = observed(staged, {NEW: F.count(F.lit(1))})
            silver.create(staged, name, buckets=layers.buckets(0))
            counts = seen.get
        register.rows += counts[NEW] + counts.get(CHANGED, 0)
        layers.settle(silver, name, register.rows)
    layers.advance("silver", name, newest, now, since)
    return LoadResult(name, LOADED, counts, newest)


def _lookup_keys(config: ObjectConfig) -> tuple[str, ...]:
    """Keys of other objects by which loads look up rows of this one."""
    return next((s.lookup_keys for s in SOURCES if s.object == config.source_object), ())


def _staged(bronze: DataFrame, config: ObjectConfig, now: datetime) -> DataFrame:
    unwanted = next((s.unwanted for s in SOURCES if s.object == config.source_object), ())
    return stage_rows(
        bronze, config.keys, config.columns, now, unwanted=unwanted, watermark_column=config.watermark_column
    )
