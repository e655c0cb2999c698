"""Change detection between a staged set of rows and the current versions of a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.shape import empty_like
from strata.session import with_derived

# Keys that are listed in a filter; see the session setting of the same number.
LISTED_KEYS = 500
NEW, CHANGED, DELETED, SAME = "new", "changed", "deleted", "same"


def classify(
    staged: DataFrame,
    current: DataFrame,
    *,
    detect_deletes: bool,
    key: str = "hash_key",
    version: str = "row_hash",
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Staged rows plus ``change_type``: new, changed, same and, for full copies, deleted.

    One join on the key answers all four questions. A deleted key appears as a row whose
    other columns are NULL. Both inputs must hold one row per key. Staged columns that are ``derived`` from the others
    (the key may be one that ``staged`` lacks) are computed after the join instead of shuffled; not for full copies.
    """
    if derived:
        if detect_deletes:
            raise ValueError("deleted keys have no columns to derive others from")
        return _classified(staged, current, key, version, derived)
    before = current.select(key, F.col(version).alias("_before"), F.lit(True).alias("_known"))
    after = staged.withColumn("_staged", F.lit(True))
    how = "full" if detect_deletes else "left"
    change = (
        F.when(F.col("_staged").isNull(), DELETED)
        .when(F.col("_known").isNull(), NEW)
        .when(F.col(version) != F.col("_before"), CHANGED)
        .otherwise(SAME)
    )
    return after.join(before, key, how).select(*staged.columns, change.alias("change_type"))


def _classified(staged: DataFrame, current: DataFrame, key: str, version: str, derived: Mapping[str, Column]) -> DataFrame:
    before = current.select(F.col(key).alias("_key"), F.col(version).alias("_before"))
    joined = staged.drop(*derived).join(before, derived.get(key, F.col(key)) == F.col("_key"), "left")
    change = F.when(F.col("_key").isNull(), NEW).when(F.col(version) != F.col("_before"), CHANGED).otherwise(SAME)
    rows = with_derived(joined, [*staged.columns, "_key", "_before"], derived)
    return rows.select(*staged.columns, change.alias("change_type"))


def new_keys(staged: DataFrame, current: DataFrame, key: str = "hash_key") -> DataFrame:
    """Staged rows whose key the table does not have."""
    return staged.join(current.select(key), key, "left_anti").select(*staged.columns)


def changed_rows(staged: DataFrame, current: DataFrame, key: str = "hash_key", version: str = "row_hash") -> DataFrame:
    """Staged rows of known keys whose version hash differs."""
    before = current.select(key, F.col(version).alias("_before"))
    return staged.join(before, key).filter(F.col(version) != F.col("_before")).select(*staged.columns)


def deleted_keys(staged: DataFrame, current: DataFrame, key: str = "hash_key") -> DataFrame:
    """Keys the table has and the staged full copy does not."""
    return current.select(key).join(staged.select(key), key, "left_anti").distinct()


def restrict_to(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` for the keys of another frame.

    Used before ranking a long history: a small load then touches only its own keys. No
    broadcast hint, Spark decides by the measured size and can filter by a Bloom filter.
    """
    return df.join(keys.select(on), on, "left_semi").select(*df.columns)


def restrict_to_stored(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """``restrict_to`` for stored keys, where NULL is a key like any other."""
    found, exact, blanks = _near_stored(df, keys, on)
    if exact:
        return found
    rows = restrict_to(found.filter(F.col(on).isNotNull()), keys, on)
    # Without this union, rows stay dealt by the key, and ranking them by it needs no second shuffle.
    return rows.unionByName(found.filter(F.col(on).isNull())) if blanks else rows


def near_stored(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` that may have one of the keys, by filters alone: for joins that drop the others anyway."""
    return _near_stored(df, keys, on)[0]


def _near_stored(df: DataFrame, keys: DataFrame, on: str) -> tuple[DataFrame, bool, bool]:
    """Rows filtered by what can be told of the keys, whether these are just the rows that have one, and whether a key is NULL.

    Few keys reach the scan as a list: the parquet reader skips row groups by their statistics and Bloom
    filters for each of them, so keys that lie scattered over a long history cost a row group each.
    Of more keys, the smallest and largest reach it: keys are mostly given out in order and
    loads bring recent ones. Neither loses a row.
    """
    column = F.col(on)
    low, high, blanks, kinds = keys.agg(
        F.min(on), F.max(on), F.count_if(column.isNull()), F.approx_count_distinct(on)
    ).first()
    if low is None:
        return (df.filter(column.isNull()) if blanks else empty_like(df)), True, bool(blanks)
    test, exact = column.between(F.lit(low), F.lit(high)), False
    if kinds <= LISTED_KEYS:
        listed = keys.select(on).filter(column.isNotNull()).distinct().limit(2 * LISTED_KEYS + 1).collect()
        if len(listed) <= 2 * LISTED_KEYS:  # the estimate is a few percent off
            test, exact = column.isin(*[row[0] for row in listed]), True
    return df.filter(test | column.isNull() if blanks else test), exact, bool(blanks)
