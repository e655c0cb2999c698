"""Sales facts: base rows, staged rows and replace-by-key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import hash_expr, hash_order, packed, unpacked, with_sales_measures
from strata.operators.changes import restrict_to_stored
from strata.operators.keys import add_surrogate_key
from strata.operators.latest import keep_latest
from strata.operators.merge import merge_delete
from strata.session import stage, with_derived

FACT_KEYS = ("OrderLineID",)
FACT_SKEY = "fact_sales_skey"
UNKNOWN_SOURCE = "-1"

# Fixed value: the columns behind the stored row hash, in hashing order.
ROW_HASH_COLUMNS = (
    "OrderID", "OrderLineID", "CustomerID", "StockItemID", "SalespersonPersonID",
    "OrderDate", "ExpectedDeliveryDate", "Quantity", "UnitPrice", "TaxRate",
    "PickedQuantity", "customer_skey", "stockitem_skey", "person_skey",
    "sales_amount_net", "tax_amount", "sales_amount_gross",
)

# Fixed value: the stored columns in their order, behind the surrogate key.
FACT_COLUMNS = (
    "hash_key", "row_hash", "audit_ts", "updated_audit_ts", "source_id",
    "OrderID", "OrderLineID", "CustomerID", "StockItemID", "SalespersonPersonID",
    "customer_skey", "stockitem_skey", "person_skey",
    "OrderDate", "ExpectedDeliveryDate", "Description",
    "Quantity", "UnitPrice", "TaxRate", "PickedQuantity",
    "sales_amount_net", "tax_amount", "sales_amount_gross", "fact_effective_ts",
)

_HASHES = ("hash_key", "row_hash")


def changed_facts(lines: DataFrame, orders: DataFrame, since: object, *, mode: str = "either", now: Column | None = None) -> DataFrame:
    """Base rows of what changed after ``since`` (everything when it is None).

    ``mode="either"``: lines that changed or whose order changed, from current versions.
    ``mode="both"``: changed lines joined with changed orders only, so a change on one side
    alone is not seen.

    For "either", only the histories of touched keys are ranked. The key sets of a small load
    are small, so the semi joins that cut the histories down can be broadcast by size. Keys
    and lines found are stored once: their ranges limit what is read of the histories, and the files of
    one large shuffle are gone before the next.
    """
    if mode not in ("either", "both"):
        raise ValueError(f"unknown mode {mode!r}")
    if since is None:
        current_lines = stage(_current(lines, "OrderLineID").drop(*_HASHES), "current_lines")
        return fact_base(current_lines, _current(orders, "OrderID"), now)
    newer = F.col("audit_ts") > F.lit(since)
    changed_lines, changed_orders = lines.filter(newer), orders.filter(newer)
    if mode == "both":
        current_lines = stage(_current(changed_lines, "OrderLineID").drop(*_HASHES), "current_lines")
        return fact_base(current_lines, _current(changed_orders, "OrderID"), now)
    of_changed_orders = restrict_to_stored(lines, changed_orders, "OrderID").select("OrderLineID")
    touched = changed_lines.select("OrderLineID").unionByName(of_changed_orders).distinct()
    histories = restrict_to_stored(lines, stage(touched, "touched_keys"), "OrderLineID")
    current_lines = stage(_current(histories, "OrderLineID").drop(*_HASHES), "touched_lines")
    current_orders = _current(restrict_to_stored(orders, current_lines, "OrderID"), "OrderID")
    # The later of both load times; a line that has left a changed order drops out here.
    return fact_base(current_lines, current_orders, now).filter(newer)


def _current(versions: DataFrame, key: str) -> DataFrame:
    return keep_latest(versions, [key], ["audit_ts", *hash_order("row_hash")])


def fact_base(lines: DataFrame, orders: DataFrame, now: Column | None = None) -> DataFrame:
    """Order lines with their order's keys and dates, load times combined, and all measures.

    ``lines`` and ``orders`` hold one version per key. Their hashes end here: those of a fact are its own.
    """
    order_part = orders.select(
        "OrderID",
        "CustomerID",
        "SalespersonPersonID",
        F.to_date("OrderDate").alias("OrderDate"),
        F.to_date("ExpectedDeliveryDate").alias("ExpectedDeliveryDate"),
        F.col("audit_ts").alias("_order_ts"),
        F.col("source_id").alias("_order_source"),
    )
    joined = lines.drop(*_HASHES).join(order_part, "OrderID")
    audit = F.greatest(F.to_timestamp("audit_ts"), F.to_timestamp("_order_ts"))
    source = F.coalesce(F.col("source_id").cast("string"), F.col("_order_source").cast("string"), F.lit(UNKNOWN_SOURCE))
    base = joined.withColumns({"audit_ts": audit, "source_id": source, "fact_effective_ts": audit})
    if now is not None:
        base = base.withColumn("updated_audit_ts", now)
    return with_sales_measures(base).drop("_order_ts", "_order_source")


def _without(fact: DataFrame, staged: DataFrame, derived: Mapping[str, Column]) -> DataFrame:
    """``merge_delete`` by the hash of the key, with hashes as bytes or after the join."""
    hashes = {"hash_key": "_key", "row_hash": "_version"}
    names = {c: name for c, name in hashes.items() if c in fact.columns}
    narrow = fact.withColumns({name: packed(derived.get(c, c)) for c, name in names.items()}).drop(*names)
    kept = merge_delete(narrow, staged.select(packed("hash_key").alias("_key")), ["_key"])
    return with_derived(kept, fact.columns, {c: derived.get(c, unpacked(name)) for c, name in names.items()})


def staged_facts(base: DataFrame, keys: Sequence[str] = FACT_KEYS) -> DataFrame:
    """Base rows with dimension keys, hashed and in the fact table's columns."""
    return base.withColumns(fact_hashes(keys)).select(*FACT_COLUMNS)


def fact_hashes(keys: Sequence[str] = FACT_KEYS) -> dict[str, Column]:
    """The hashes of a fact, which follow from its other columns, so that scratch files go without them."""
    return {"hash_key": hash_expr(keys), "row_hash": hash_expr(ROW_HASH_COLUMNS)}


def replace_by_key(
    fact: DataFrame,
    staged: DataFrame,
    *,
    skey: str = FACT_SKEY,
    order: Sequence[str] = (*FACT_KEYS, "hash_key"),
    keep_skeys: bool = True,
    numbered: DataFrame | int | None = None,
    derived: Mapping[str, Column] | None = None,
    derived_held: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Fact rows with those of the staged keys replaced.

    A replaced row keeps its surrogate key and only new rows are numbered, from the largest
    key in use. ``keep_skeys=False`` numbers every staged row, from the largest key of the
    rows that stay. When ``fact`` is only a part of the table, ``numbered`` is all of it, or the largest
    key of all rows (of those that stay). Staged columns that are ``derived`` from the others, such as
    ``fact_hashes()``, and those of ``fact`` in ``derived_held`` are computed after each shuffle instead of shuffled.
    """
    everything = fact if numbered is None else numbered
    derived = dict(derived or {})
    # Each part is stored, so that one shuffle at a time is on disk.
    kept = stage(_without(fact, staged, dict(derived_held or {})), "kept", derived=derived_held)
    if not keep_skeys:
        stays = kept if numbered is None else numbered
        if isinstance(numbered, DataFrame):
            stays = merge_delete(numbered, staged, ["hash_key"])
        return kept.unionByName(add_surrogate_key(staged, skey, order, after=stays, derived=derived).select(*fact.columns))
    held = fact.select(packed("hash_key").alias("_key"), skey)
    known = staged.drop(*derived).join(held, packed(derived.get("hash_key", "hash_key")) == F.col("_key"), "left")
    known = stage(with_derived(known, [*staged.columns, skey], derived), "known", derived=derived)
    replaced = known.filter(F.col(skey).isNotNull()).select(*fact.columns)
    new = add_surrogate_key(known.filter(F.col(skey).isNull()), skey, order, after=everything, derived=derived)
    return kept.unionByName(replaced).unionByName(new.select(*fact.columns))
