"""Loads of the dimensional layer."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import (
    add_surrogate_key,
    calendar,
    changed_facts,
    classify_members,
    current_versions,
    dimension_schema,
    enrich,
    lookup_skeys,
    missing_members,
    new_members,
    placeholder_rows,
    replace_by_key,
    restrict_to,
    restrict_to_stored,
    row_hash,
    scd1_next,
    scd2_next,
    select_configured,
    staged_facts,
    wider_types,
    with_hash_key,
    with_types,
)
from strata.operators.calendar import FIRST_DAY, LAST_DAY
from strata.operators.changes import CHANGED, NEW, SAME
from strata.operators.facts import FACT_KEYS, FACT_SKEY, fact_hashes
from strata.operators.lookup import UNKNOWN_TEXT
from strata.operators.scd import FILL, SCD1_TECHNICAL, SCD2_TECHNICAL
from strata.plans.layers import LOADED, NO_NEW_DATA, LoadResult, Layers, count_by, observed, side_by_side, timed
from strata.schemas import DIM_DATE, DIMENSIONS, FACT_SALES, ORDER_LINES, ORDERS, Dimension
from strata.session import scratch_scope, stage
from strata.sources.bronze import newer_than
from strata.sources.metadata import ObjectConfig
from strata.sources.tables import BUCKET, Register, bucket_of, in_places

FACT_PARTITION = "order_month"
FACT_PLACES = (FACT_PARTITION, BUCKET)
_FACT_ORDER = (*FACT_KEYS, "hash_key")
# What facts use of the two histories, and what tells their versions apart.
LINE_COLUMNS = (
    "OrderLineID", "OrderID", "StockItemID", "Description", "Quantity", "UnitPrice", "TaxRate", "PickedQuantity",
    "audit_ts", "source_id", "row_hash",
)
ORDER_COLUMNS = (
    "OrderID", "CustomerID", "SalespersonPersonID", "OrderDate", "ExpectedDeliveryDate",
    "audit_ts", "source_id", "row_hash",
)


def stage_members(current: DataFrame, keys: Sequence[str], columns: Sequence[str], *, lookups: Sequence[str] = (), hash_lookups: bool = False) -> DataFrame:
    """Current source rows in the dimension's columns, with key and row hash.

    Looked-up attributes are carried along; they take part in change detection only with
    ``hash_lookups=True``.
    """
    rows = select_configured(current, keys, columns, [*lookups, "audit_ts", "source_id"])
    hashed = [*columns, *(lookups if hash_lookups else ())]
    version = row_hash(rows, hashed, order="given", exclude=[*keys, "source_id"])
    return with_hash_key(rows, keys).withColumn("row_hash", version)


@timed
def load_dimension(layers: Layers, dim: Dimension, now: datetime, *, hash_lookups: bool = False) -> LoadResult:
    """Bring a dimension up to the current rows of its source; deletions are not carried over.

    With ``hash_lookups=True`` a new value of a looked-up attribute is a change of the member.
    """
    config = layers.config("Gold", dim.source.object)[dim.source.object]
    source = layers.silver.read(dim.source.object)
    current = current_versions(source, active="before")
    if dim.lookup:
        current = _with_lookup(layers, dim, current)
    with scratch_scope(layers.spark), layers.gold.registered(dim.name, dim.skey) as register:
        staged = stage_members(current, config.keys, config.columns, lookups=dim.lookup_columns, hash_lookups=hash_lookups)
        target = _target(layers, dim, config)
        members, seen = observed(
            classify_members(staged, target, dim.skey), count_by("change_type", NEW, CHANGED, FILL, SAME)
        )
        members = stage(members.filter(F.col("change_type") != SAME), dim.name)
        counts = seen.get
        if counts[NEW] + counts[CHANGED] + counts[FILL] == 0:
            return LoadResult(dim.name, NO_NEW_DATA, counts)
        _write_members(layers, dim, config, target, members, counts, F.lit(now).cast("timestamp"), register)
    return LoadResult(dim.name, LOADED, counts)


@timed
def load_inferred(layers: Layers, dim: Dimension, facts: DataFrame, now: datetime) -> LoadResult:
    """Append placeholder rows for dimension keys that the facts use and the dimension lacks."""
    config = layers.config("Gold", dim.source.object)[dim.source.object]
    with scratch_scope(layers.spark), layers.gold.registered(dim.name, dim.skey) as register:
        target = _target(layers, dim, config)
        missing, seen = observed(
            missing_members(facts, target, {dim.key: dim.fact_key}), {"inferred": F.count(F.lit(1))}
        )
        missing = stage(missing, dim.name)
        if not seen.get["inferred"]:
            return LoadResult(dim.name, NO_NEW_DATA, seen.get)
        load_time = F.lit(now).cast("timestamp")
        rows = placeholder_rows(missing, target, skey=dim.skey, keys=[dim.key], now=load_time, numbered=register.high)
        _add(layers, dim.name, rows, register, seen.get["inferred"])
    return LoadResult(dim.name, LOADED, seen.get)


def infer_ahead(layers: Layers, dim: Dimension, now: datetime) -> LoadResult:
    """Infer members from the whole order history, ahead of and apart from a fact load.

    Only rows whose order and line both exist count, each with the load time of the side
    that holds the key.
    """
    lines, orders = layers.silver.read(ORDER_LINES.object), layers.silver.read(ORDERS.object)
    side, other = (lines, orders) if dim.fact_key in lines.columns else (orders, lines)
    return load_inferred(layers, dim, restrict_to(side, other, "OrderID"), now)


@timed
def load_calendar(layers: Layers, start: date = FIRST_DAY, end: date = LAST_DAY) -> LoadResult:
    """Rebuild the calendar dimension."""
    days, seen = observed(calendar(layers.spark, start, end), {"days": F.count(F.lit(1))})
    layers.gold.replace(days, DIM_DATE)
    return LoadResult(DIM_DATE, LOADED, seen.get)


@timed
def load_fact(layers: Layers, now: datetime, *, mode: str = "either", keep_skeys: bool = True) -> LoadResult:
    """Replace the fact rows of order lines that changed since the last load.

    The table is partitioned by order month and bucket of the key, and only pairs that lose or gain a row
    are rewritten. Missing dimension members are inferred before their keys are looked up.
    """
    lines = layers.silver.read(ORDER_LINES.object).select(*LINE_COLUMNS)
    orders = layers.silver.read(ORDERS.object).select(*ORDER_COLUMNS)
    since = layers.watermark("gold", FACT_SALES)
    marks = [newer_than(df, "audit_ts", since).agg(F.max("audit_ts")).first()[0] for df in (lines, orders)]
    if not any(marks):
        return LoadResult(FACT_SALES, NO_NEW_DATA, watermark=since)
    reached = max(mark for mark in marks if mark)
    # Of what each step stores, only its result outlives it.
    with scratch_scope(layers.spark):
        load_time = F.lit(now).cast("timestamp")
        with scratch_scope(layers.spark) as keep_facts:
            with scratch_scope(layers.spark) as keep:
                base = keep(changed_facts(lines, orders, since, mode=mode, now=load_time), "fact_base")
            inferred = side_by_side(lambda dim: load_inferred(layers, dim, base, now), DIMENSIONS)
            counts = {f"inferred {result.table}": result.counts["inferred"] for result in inferred}
            dims = [(layers.gold.read(dim.name), dim.fact_key, dim.key, dim.skey) for dim in DIMENSIONS]
            facts = _with_month(staged_facts(lookup_skeys(base, dims)))
            facts, seen = observed(facts, {"staged": F.count(F.lit(1))})
            facts = keep_facts(facts, "fact_staged", derived=fact_hashes())
        counts.update(_write_facts(layers, facts, seen.get["staged"], keep_skeys))
    layers.advance("gold", FACT_SALES, reached, now, since)
    return LoadResult(FACT_SALES, LOADED, counts, reached)


def _write_facts(layers: Layers, staged: DataFrame, count: int, keep_skeys: bool) -> dict[str, int]:
    gold, replaced = layers.gold, 0
    with gold.registered(FACT_SALES, FACT_SKEY) as register:
        if gold.exists(FACT_SALES):
            replaced = _replace_facts(layers, staged, count, register, keep_skeys)
        else:
            months = max(1, staged.select(FACT_PARTITION).distinct().count())
            buckets = layers.buckets(count // months, layers.fact_buckets)
            facts = add_surrogate_key(staged, FACT_SKEY, _FACT_ORDER, derived=fact_hashes())
            gold.create(facts, FACT_SALES, [FACT_PARTITION], buckets=buckets, indexed=FACT_KEYS)
            register.high = count
        register.rows += count - replaced
        if count > replaced:
            months = max(1, gold.partition_count(FACT_SALES) // gold.layout(FACT_SALES).buckets[1])
            layers.settle(gold, FACT_SALES, register.rows // months, layers.fact_buckets)
    return {"staged": count, "replaced": replaced}


def _replace_facts(layers: Layers, staged: DataFrame, count: int, register: Register, keep_skeys: bool) -> int:
    """Rewrite the (month, bucket) folders that lose or gain a row; the number of rows replaced."""
    gold, key = layers.gold, FACT_KEYS[0]
    fact = gold.stored(FACT_SALES)
    staged = staged.withColumn(BUCKET, bucket_of(gold.layout(FACT_SALES).buckets))
    # On the driver one row per folder, never one per fact.
    touched = {tuple(row) for row in staged.select(*FACT_PLACES).distinct().collect()}
    if not touched:
        return 0
    # Where the rows lie now is read from the business key alone: it is narrower than the hash, and its
    # ranges and Bloom filters skip row groups.
    buckets = sorted({bucket for _, bucket in touched})
    held = fact.select(key, *FACT_PLACES).filter(F.col(BUCKET).isin(*buckets))
    held = restrict_to_stored(held, staged, key).groupBy(*FACT_PLACES).count().collect()
    touched |= {tuple(row[:2]) for row in held}
    in_scope = fact.filter(in_places(FACT_PLACES, touched))
    numbered = register.high
    if not keep_skeys:
        # Numbering goes on from the rows that stay, which are read only if the largest key is not among them.
        gone = restrict_to_stored(in_scope.select(key, FACT_SKEY), staged, key).agg(F.max(FACT_SKEY)).first()[0]
        numbered = fact if gone == register.high else numbered
    options = {"keep_skeys": keep_skeys, "order": _FACT_ORDER, "numbered": numbered, "derived": fact_hashes()}
    rows = replace_by_key(in_scope, staged, **options)
    rows, written = observed(rows, {"high": F.max(FACT_SKEY)})
    gold.replace_partitions(rows, FACT_SALES, FACT_PLACES, touched, evolve=True)
    high = written.get["high"]
    register.high = max(register.high, high) if keep_skeys else high
    return sum(row["count"] for row in held)


def _with_month(facts: DataFrame) -> DataFrame:
    month = F.year("OrderDate") * 100 + F.month("OrderDate")
    return facts.withColumn(FACT_PARTITION, F.coalesce(month, F.lit(0)))


def _with_lookup(layers: Layers, dim: Dimension, current: DataFrame) -> DataFrame:
    newest = current_versions(layers.silver.read(dim.lookup.object), active=None)
    key = dim.lookup.business_key
    return enrich(current, newest, {key: key}, dict.fromkeys(dim.lookup_columns, UNKNOWN_TEXT))


def _target(layers: Layers, dim: Dimension, config: ObjectConfig) -> DataFrame:
    source = layers.silver.read(dim.source.object).schema
    columns = list(dict.fromkeys([*config.keys, *config.columns]))
    extra = dict.fromkeys(dim.lookup_columns, "string")
    technical = SCD2_TECHNICAL if dim.history else SCD1_TECHNICAL
    wanted = dimension_schema(source, dim.skey, columns, technical, extra)
    if not layers.gold.exists(dim.name):
        return layers.spark.createDataFrame([], wanted)
    # Columns that the configuration has gained are NULL in stored rows; types that have widened hold for all.
    return _with_columns_of(layers.gold.read(dim.name), wanted)


def _with_columns_of(stored: DataFrame, wanted: DataFrame | StructType) -> DataFrame:
    schema = wanted.schema if isinstance(wanted, DataFrame) else wanted
    stored = with_types(stored, wider_types(stored.schema, schema))
    gained = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in stored.columns}
    return stored.withColumns(gained) if gained else stored


def _write_members(layers: Layers, dim: Dimension, config: ObjectConfig, target: DataFrame, members: DataFrame, counts: dict[str, int], now: Column, register: Register) -> None:
    common = {"skey": dim.skey, "keys": config.keys, "now": now, "numbered": register.high}
    added = counts[NEW] + (counts[CHANGED] if dim.history else 0)
    attributes = [*config.columns, *dim.lookup_columns]
    if counts[CHANGED] + counts[FILL] == 0:
        # Only first versions: nothing stored changes, so the rows are added as they are.
        _add(layers, dim.name, new_members(members, target, **common), register, added)
        return
    if dim.history:
        step = partial(scd2_next, attributes=attributes, refresh_source=dim.refresh_source_on_fill, **common)
    else:
        step = partial(scd1_next, attributes=attributes, **common)
    # Only the buckets of these members are read and rewritten.
    layers.gold.update_keys(dim.name, members, lambda held: step(_with_columns_of(held, target), members))
    _count(layers, dim.name, register, added)


def _add(layers: Layers, table: str, rows: DataFrame, register: Register, added: int) -> None:
    if layers.gold.exists(table):
        layers.gold.append(rows, table, evolve=True)
    else:
        layers.gold.create(rows, table, buckets=layers.buckets(added))
    _count(layers, table, register, added)


def _count(layers: Layers, table: str, register: Register, added: int) -> None:
    register.high += added
    register.rows += added
    layers.settle(layers.gold, table, register.rows)
