"""Business-key hashes, row hashes and surrogate keys."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.functions import hash_expr
from strata.operators.shape import move_first, require_columns
from strata.session import stage, with_derived

# Columns that describe the load, not the row.
TECHNICAL_COLUMNS = ("hash_key", "row_hash", "audit_ts", "year", "month", "day")

# monotonically_increasing_id() holds the partition above bit 33 and the row below it.
_ROW_BITS = 33


def with_hash_key(df: DataFrame, keys: Sequence[str], *, name: str = "hash_key", safe: bool = False) -> DataFrame:
    """Add the hash of the business key, its parts in the order given."""
    require_columns(df, keys)
    return df.withColumn(name, hash_expr(keys, safe=safe))


def row_hash(
    df: DataFrame,
    columns: Iterable[str],
    *,
    order: str = "sorted",
    exclude: Iterable[str] = (),
    safe: bool = False,
) -> Column:
    """Hash over the columns that ``df`` has, without technical and excluded ones.

    ``order="sorted"`` hashes in name order (cleaned layer, business key included);
    ``order="given"`` keeps the listed order (dimensions, which exclude the key). The two
    give different digests and are never compared with each other.
    """
    if order not in ("sorted", "given"):
        raise ValueError(f"unknown order {order!r}")
    present, skip = set(df.columns), {*TECHNICAL_COLUMNS, *exclude}
    chosen = [c for c in columns if c in present and c not in skip]
    return hash_expr(sorted(chosen) if order == "sorted" else chosen, safe=safe)


def max_skey(df: DataFrame | None, column: str) -> int:
    """Largest surrogate key in use; 0 for a missing table, a missing column or no rows."""
    if df is None or column not in df.columns:
        return 0
    return df.agg(F.coalesce(F.max(column), F.lit(0)).cast("long")).first()[0]


def add_surrogate_key(
    df: DataFrame,
    skey: str,
    order: Sequence[str],
    *,
    start: int = 0,
    after: DataFrame | int | None = None,
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Number the rows ``start+1, start+2, ...`` in the given order, without one global task.

    The rows are range-partitioned and sorted by ``order`` and written out once with their
    partition and position; the number is then the position plus the row count of all
    earlier partitions. What is broadcast is one row per partition, whatever the data size.
    Writing first keeps numbers stable: a retried task would otherwise sample new ranges.
    ``order`` must be a total order for the numbering to be repeatable. With ``after``,
    numbering goes on from the largest ``skey`` of that frame, or from that number. Finding the ranges reads ``df``
    once more, so costly input should be stored first. Columns that are ``derived`` from the others are neither
    shuffled nor written.
    """
    require_columns(df, order)
    derived = dict(derived or {})
    by = [derived.get(c, F.col(c)).asc() for c in order]
    placed = stage(
        df.drop(*derived).repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id()),
        label="numbered",
    )
    part = F.shiftright("_place", _ROW_BITS).cast("int")
    position = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    if isinstance(after, int):
        start += after
    elif after is not None:
        # The numbers in use count like a partition before the first one.
        used = F.coalesce(F.max(skey), F.lit(0)).cast("long")
        sizes = sizes.unionByName(after.agg(used.alias("_rows")).select(F.lit(-1).alias("_part"), "_rows"))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    number = F.lit(start).cast("long") + F.col("_offset") + position + 1
    columns = [c for c in df.columns if c != skey]
    return move_first(with_derived(numbered, [*columns, skey], {**derived, skey: number}), skey)
