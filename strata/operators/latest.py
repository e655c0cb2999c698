"""Pick one version per key.

``row_number() = 1`` over a key is planned by Spark as a partial ``WindowGroupLimit`` before
the shuffle: each task first drops all but its best row per key, so a key that holds a third
of the table sends one row per task, not a third of the table, to one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.errors import EmptySnapshot
from strata.operators.shape import require_columns


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row with the greatest ``order`` per key.

    Several order columns are needed when the first can tie: all rows of one copy share their
    load time, so give a source timestamp and a row hash after it to get a repeatable result.
    """
    return _first(df, keys, [_column(c).desc() for c in order])


def keep_earliest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row with the smallest ``order`` per key."""
    return _first(df, keys, [_column(c).asc() for c in order])


def current_versions(
    df: DataFrame,
    keys: Sequence[str] = ("hash_key",),
    order: Sequence[str | Column] = ("audit_ts", "row_hash"),
    *,
    active: str | None = "after",
    deleted: str = "deleted_audit_ts",
) -> DataFrame:
    """Current version per key of a versioned table.

    ``active="before"`` ranks open versions only; ``"after"`` ranks all versions and then
    drops keys whose newest is deleted; ``None`` keeps deleted keys. Tables without a
    deletion mark only have the last meaning.
    """
    if active not in ("before", "after", None):
        raise ValueError(f"unknown rule {active!r}")
    if active is None or deleted not in df.columns:
        return keep_latest(df, keys, order)
    is_open = F.col(deleted).isNull()
    if active == "before":
        return keep_latest(df.filter(is_open), keys, order)
    return keep_latest(df, keys, order).filter(is_open)


def latest_snapshot(df: DataFrame, ts: str = "audit_ts") -> DataFrame:
    """Rows of the newest copy in a history of full copies.

    The newest time is one row, so the semi join is a broadcast of one row at any scale.
    """
    newest = df.agg(F.max(ts).alias(ts))
    return df.join(F.broadcast(newest), ts, "left_semi")


def latest_snapshot_at(df: DataFrame, ts: str = "audit_ts") -> tuple[DataFrame, object]:
    """Same, with the newest time as a literal that reaches the parquet scan, for jobs.

    Refuses a history without a usable time: an empty snapshot would look like "everything
    was deleted".
    """
    newest = df.agg(F.max(ts)).first()[0]
    if newest is None:
        raise EmptySnapshot(f"no usable {ts} in the snapshot history")
    return df.filter(F.col(ts) == F.lit(newest)), newest


def _first(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    require_columns(df, keys)
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
