"""Slowly changing dimensions: next state of a dimension from its staged current rows.

``staged`` holds one row per key: business columns, ``audit_ts``, ``source_id``,
``hash_key`` and ``row_hash``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions import blank_to_null
from strata.operators.changes import CHANGED, NEW, SAME, restrict_to
from strata.operators.keys import add_surrogate_key, with_hash_key
from strata.operators.merge import merge_delete, merge_update
from strata.operators.shape import align_to, require_columns
from strata.session import stage

OPEN_END = "2999-12-31 00:00:00"  # fixed value: end of the version that is still valid
FILL = "fill"  # change type of a real row that arrives for a placeholder

_LINEAGE = "hash_key string, row_hash string, source_id string, audit_ts timestamp, updated_audit_ts timestamp"
SCD2_TECHNICAL = (
    f"{_LINEAGE}, scd_start timestamp, scd_from timestamp, scd_to timestamp, "
    "scd_active int, scd_version int, inferred_flag int"
)
SCD1_TECHNICAL = f"{_LINEAGE}, scd_start timestamp, scd_active int, scd_version int, inferred_flag int"


def dimension_schema(source: StructType, skey: str, columns: Sequence[str], technical: str, extra: Mapping[str, str] | None = None) -> StructType:
    """Surrogate key, business columns typed as in the source, extra columns, technical columns."""
    schema = StructType().add(skey, "long")
    for name in columns:
        schema = schema.add(name, source[name].dataType)
    for name, type_ in (extra or {}).items():
        schema = schema.add(name, type_)
    return StructType(schema.fields + StructType.fromDDL(technical).fields)


def with_scd2_defaults(df: DataFrame, now: Column) -> DataFrame:
    """Technical columns of a version that has just arrived."""
    return df.withColumns(
        {
            "updated_audit_ts": F.lit(None).cast("timestamp"),
            "scd_start": now,
            "scd_from": F.to_timestamp("audit_ts"),
            "scd_to": F.lit(OPEN_END).cast("timestamp"),
            "scd_active": F.lit(1),
            "scd_version": F.lit(1),
            "inferred_flag": F.lit(0),
        }
    )


def with_scd1_defaults(df: DataFrame, now: Column) -> DataFrame:
    """Technical columns of a new row in a dimension without history."""
    return with_scd2_defaults(df, now).drop("scd_from", "scd_to")


def classify_members(staged: DataFrame, dim: DataFrame, skey: str) -> DataFrame:
    """Staged rows plus the active row's surrogate key and ``change_type``.

    ``fill`` when the active row is a placeholder, else new, changed or same. Deletions in
    the source are not carried into dimensions.
    """
    require_columns(dim, ["hash_key", skey, "row_hash", "scd_active", "inferred_flag"], "dimension")
    active = dim.filter(F.col("scd_active") == 1).select(
        "hash_key", skey, F.col("row_hash").alias("_before"), F.col("inferred_flag").alias("_inferred")
    )
    change = (
        F.when(F.col(skey).isNull(), NEW)
        .when(F.col("_inferred") == 1, FILL)
        .when(F.col("row_hash") != F.col("_before"), CHANGED)
        .otherwise(SAME)
    )
    return staged.drop(skey).join(active, "hash_key", "left").select(*staged.columns, skey, change.alias("change_type"))


def new_members(
    members: DataFrame, dim: DataFrame, *, skey: str, keys: Sequence[str], now: Column, numbered: DataFrame | int | None = None
) -> DataFrame:
    """New and changed members as numbered first versions, shaped like ``dim``.

    While nothing stored has changed, appending these rows is the whole load. When ``dim`` is only a
    part of the dimension, ``numbered`` is all of it or the largest surrogate key in use.
    """
    arrived = members.filter(F.col("change_type").isin(NEW, CHANGED)).drop(skey, "change_type")
    complete = with_scd2_defaults(arrived, now)
    return align_to(add_surrogate_key(complete, skey, [*keys, "audit_ts", "hash_key"], after=dim if numbered is None else numbered), dim.schema)


def scd2_next(
    dim: DataFrame, members: DataFrame, *, skey: str, keys: Sequence[str], attributes: Sequence[str], now: Column,
    refresh_source: bool = True, numbered: DataFrame | int | None = None,
) -> DataFrame:
    """Next state of a dimension with history, from ``classify_members``.

    Placeholders take the real attributes in place and keep their surrogate key; new and
    changed members become versions, whose keys' chains are recalculated. All joins are on
    ``hash_key``. ``members`` is read several times and should be stored. ``dim`` may be the part of
    the dimension in which the members are or belong; ``numbered`` is all of it then, or its largest key.
    """
    arrived = members.filter(F.col("change_type").isin(NEW, CHANGED)).select("hash_key")
    versions = new_members(members, dim, skey=skey, keys=keys, now=now, numbered=numbered)
    settled = fill_inferred(
        merge_delete(dim, arrived, ["hash_key"]), members, attributes=attributes, now=now, refresh_source=refresh_source
    )
    affected = restrict_to(dim, arrived, "hash_key").unionByName(versions)
    return settled.unionByName(_chains(affected, skey))


def scd1_next(
    dim: DataFrame, members: DataFrame, *, skey: str, keys: Sequence[str], attributes: Sequence[str], now: Column,
    numbered: DataFrame | int | None = None,
) -> DataFrame:
    """Next state of a dimension without history: new rows added, changed and inferred ones updated in place."""
    arrived = members.filter(F.col("change_type") == NEW)
    rows = new_members(arrived, dim, skey=skey, keys=keys, now=now, numbered=numbered)
    replaced = members.filter(F.col("change_type").isin(CHANGED, FILL)).drop(skey)
    new_values = {
        **_attributes(dim, members, attributes),
        **_refreshed(dim, now, refresh_source=True),
        "scd_active": F.lit(1),
        "scd_version": F.lit(1),
    }
    updated = merge_update(dim, replaced, ["hash_key"], new_values)
    return updated.unionByName(rows)


def fill_inferred(dim: DataFrame, members: DataFrame, *, attributes: Sequence[str], now: Column, refresh_source: bool = True) -> DataFrame:
    """Give active placeholders the attributes of the real row; validity and version stay as they are."""
    real = members.filter(F.col("change_type") == FILL)
    new_values = {**_attributes(dim, members, attributes), **_refreshed(dim, now, refresh_source)}
    placeholder = (F.col("t.scd_active") == 1) & (F.col("t.inferred_flag") == 1)
    return merge_update(dim, real, ["hash_key"], new_values, placeholder)


def scd2_recalc(dim: DataFrame, skey: str, keys: DataFrame | None = None) -> DataFrame:
    """Recalculate version chains: all of them, or those of the given ``hash_key`` values.

    Within a key, ordered by ``scd_from``, ``audit_ts`` and surrogate key: ``scd_to`` is the
    next ``scd_from`` or the open end, only the last version is active, versions count from
    1, and ``scd_start`` is the earliest of the key. Rows of other keys pass through.
    """
    if keys is None:
        return _chains(dim, skey)
    affected = keys.select("hash_key").distinct()
    return merge_delete(dim, affected, ["hash_key"]).unionByName(_chains(restrict_to(dim, affected, "hash_key"), skey))


def _chains(dim: DataFrame, skey: str) -> DataFrame:
    # Two levels, so that no key has to fit in one task, not even its versions of one day: the
    # rows are cut into ranges of (key, time) and written with their range, neighbours are found
    # within a range, and ranges of a key are linked through one summary row each.
    order = ("scd_from", "audit_ts", skey)
    ranges = dim.repartitionByRange("hash_key", *order).withColumn("_range", F.spark_partition_id())
    in_range = W.partitionBy("_range", "hash_key").orderBy(*order)
    rows = stage(ranges, "chains").withColumns(
        {"_position": F.row_number().over(in_range), "_next": F.lead("scd_from").over(in_range)}
    )
    by_range = W.partitionBy("hash_key").orderBy("_range")
    every = W.partitionBy("hash_key")
    summaries = (
        rows.groupBy("_range", "hash_key")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("scd_from").alias("_first"), F.min("scd_start").alias("_start"))
        .select(
            "_range",
            "hash_key",
            F.coalesce(F.sum("_n").over(by_range.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
            F.lead("_first").over(by_range).alias("_next_range"),
            F.min("_first").over(every).alias("_key_first"),
            F.min("_start").over(every).alias("_key_start"),
        )
    )
    # Versions without a start come first; what follows them is the earliest start of the key.
    after_unknown = F.when(F.col("scd_from").isNull(), F.col("_key_first"))
    successor = F.coalesce("_next", after_unknown, "_next_range")
    chained = {
        "scd_start": F.col("_key_start"),
        "scd_to": F.coalesce(successor, F.lit(OPEN_END).cast("timestamp")),
        "scd_active": F.when(successor.isNull(), 1).otherwise(0),
        "scd_version": (F.col("_before") + F.col("_position")).cast("int"),
    }
    return rows.join(summaries, ["_range", "hash_key"]).select(
        *[chained[c].alias(c) if c in chained else F.col(c) for c in dim.columns]
    )


def missing_members(facts: DataFrame, dim: DataFrame, key_map: Mapping[str, str]) -> DataFrame:
    """Keys that facts use and the dimension lacks, with the earliest ``audit_ts`` each was seen with.

    ``key_map`` maps dimension keys to fact columns. NULL and blank keys are left out. Finding
    keys is a pre-aggregated grouping, so a key used by a third of the facts costs one row
    per task.
    """
    keys = list(key_map)
    typed = [
        blank_to_null(F.col(source).cast("string")).cast(dim.schema[key].dataType).alias(key)
        for key, source in key_map.items()
    ]
    seen = facts.select(*typed, "audit_ts", "source_id").dropna(subset=keys)
    first = (
        seen.groupBy(*keys)
        .agg(F.min(F.struct("audit_ts", "source_id")).alias("_first"))
        .select(*keys, "_first.audit_ts", "_first.source_id")
    )
    return merge_delete(with_hash_key(first, keys), dim, ["hash_key"])


def placeholder_rows(
    missing: DataFrame, dim: DataFrame, *, skey: str, keys: Sequence[str], now: Column, numbered: int | None = None
) -> DataFrame:
    """Numbered rows for missing members, shaped like ``dim``: no attributes, marked as inferred."""
    rows = with_scd2_defaults(missing, now).withColumns({"row_hash": F.lit(""), "inferred_flag": F.lit(1)})
    after = dim if numbered is None else numbered
    return align_to(add_surrogate_key(rows, skey, [*keys, "audit_ts", "hash_key"], after=after), dim.schema)


def infer_members(facts: DataFrame, dim: DataFrame, key_map: Mapping[str, str], *, skey: str, now: Column) -> DataFrame:
    """Placeholder rows for the keys that facts use and the dimension lacks, one per key."""
    return placeholder_rows(missing_members(facts, dim, key_map), dim, skey=skey, keys=list(key_map), now=now)


def _attributes(dim: DataFrame, members: DataFrame, attributes: Sequence[str]) -> dict[str, Column]:
    return {c: F.col(f"s.{c}") for c in attributes if c in dim.columns and c in members.columns}


def _refreshed(dim: DataFrame, now: Column, refresh_source: bool) -> dict[str, Column]:
    values = {
        "audit_ts": F.col("s.audit_ts"),
        "row_hash": F.col("s.row_hash"),
        "updated_audit_ts": now,
        "inferred_flag": F.lit(0),
    }
    if refresh_source:
        values["source_id"] = F.col("s.source_id")
        if "deleted_audit_ts" in dim.columns:
            values["deleted_audit_ts"] = F.lit(None)
    return values
