"""Merge as a plan: the next state of a table from the table and a set of changes.

Plain parquet tables have no MERGE statement. These functions build the table's next state
as one DataFrame, to be written once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.errors import DuplicateKeys
from strata.operators.shape import require_columns


def merge_update(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    set_: Mapping[str, Column],
    condition: Column | None = None,
) -> DataFrame:
    """Target rows, with ``set_`` applied where a source row has the same key.

    In ``set_`` and ``condition`` the target is ``t`` and the source is ``s``, as in
    ``{"deleted_audit_ts": F.col("s.deleted_audit_ts")}``. Every target row of a matching
    key is updated. Source keys must be unique (``assert_unique``), else rows would double.
    """
    require_columns(target, [*on, *set_], "merge target")
    require_columns(source, on, "merge source")
    t = target.alias("t")
    s = source.withColumn("_matched", F.lit(True)).alias("s")
    same_key = [F.col(f"t.{c}") == F.col(f"s.{c}") for c in on]
    hit = F.col("s._matched").isNotNull()
    if condition is not None:
        hit = hit & condition
    return t.join(s, same_key, "left").select(
        *[
            F.when(hit, set_[f.name]).otherwise(F.col(f"t.{f.name}")).cast(f.dataType).alias(f.name)
            if f.name in set_
            else F.col(f"t.{f.name}")
            for f in target.schema
        ]
    )


def merge_delete(target: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in ``keys``; duplicate source keys do no harm."""
    return target.join(keys.select(*on), list(on), "left_anti").select(*target.columns)


def soft_delete(target: DataFrame, deleted: DataFrame, now: Column, *, key: str = "hash_key", mark: str = "deleted_audit_ts") -> DataFrame:
    """Mark every open version of the deleted keys."""
    return merge_update(target, deleted.select(key), [key], {mark: now}, F.col(f"t.{mark}").isNull())


def assert_unique(source: DataFrame, on: Sequence[str]) -> DataFrame:
    """Return ``source`` if each key has at most one row, else raise. Counting is pre-aggregated."""
    twice = source.groupBy(*on).count().filter("count > 1").limit(1).collect()
    if twice:
        raise DuplicateKeys(f"merge source holds several rows for {twice[0].asDict()}")
    return source
