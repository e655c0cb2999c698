"""Left lookups with a default.

No join carries a broadcast hint: dimensions grow with the data, so Spark chooses a
broadcast only under ``spark.sql.autoBroadcastJoinThreshold`` and a shuffled join beyond it,
where AQE splits a key that holds a large share of the rows, NULL included. It can do so only if the
lookup side comes straight from a shuffle, so an aggregated one is stored first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.shape import require_columns
from strata.session import scratch_scope, stage

UNKNOWN_TEXT = "UNKNOWN"
UNKNOWN_SKEY = -1


def enrich(df: DataFrame, lookup: DataFrame, on: Mapping[str, str], defaults: Mapping[str, object]) -> DataFrame:
    """Add the columns named in ``defaults``; rows without a match get the default.

    ``on`` maps columns of ``df`` to columns of ``lookup``, which has one row per key.
    """
    require_columns(df, on, "lookup input")
    require_columns(lookup, [*on.values(), *defaults], "lookup table")
    left = df.drop(*defaults)
    right = lookup.select(
        *[F.col(r).alias(f"_on_{r}") for r in on.values()],
        *[F.col(c).alias(f"_got_{c}") for c in defaults],
    )
    match = [left[c] == F.col(f"_on_{r}") for c, r in on.items()]
    added = [
        F.coalesce(F.col(f"_got_{c}"), F.lit(value).cast(lookup.schema[c].dataType)).alias(c)
        for c, value in defaults.items()
    ]
    return left.join(right, match, "left").select(*[left[c] for c in left.columns], *added)


def lookup_skey(df: DataFrame, dim: DataFrame, source_key: str, dim_key: str, skey: str) -> DataFrame:
    """Surrogate key of the active dimension row; -1 for a missing or NULL key.

    The narrow side, one row per active key, is written to the scratch folder.
    """
    active = dim.filter(F.col("scd_active") == 1).groupBy(dim_key).agg(F.min(skey).alias(skey))
    return enrich(df, stage(active, "active_members"), {source_key: dim_key}, {skey: UNKNOWN_SKEY})


def lookup_skeys(df: DataFrame, lookups: Sequence[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """``lookup_skey`` for several dimensions, given by its other arguments.

    Each result but the last is stored and the one before it removed: one shuffle of the rows is on disk at a time.
    """
    if not lookups:
        return df
    *before, (dim, source_key, dim_key, skey) = lookups
    if before:
        with scratch_scope(df.sparkSession) as keep:
            df = keep(lookup_skeys(df, before), "keyed")
    return lookup_skey(df, dim, source_key, dim_key, skey)
