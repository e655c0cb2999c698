"""Table-maintenance operators: functions from DataFrames to DataFrames."""

from strata.operators.calendar import calendar, calendar_between
from strata.operators.changes import (
    changed_rows,
    classify,
    deleted_keys,
    near_stored,
    new_keys,
    restrict_to,
    restrict_to_stored,
)
from strata.operators.facts import changed_facts, fact_base, replace_by_key, staged_facts
from strata.operators.keys import add_surrogate_key, max_skey, row_hash, with_hash_key
from strata.operators.latest import (
    current_versions,
    keep_earliest,
    keep_latest,
    latest_snapshot,
    latest_snapshot_at,
)
from strata.operators.lookup import enrich, lookup_skey, lookup_skeys
from strata.operators.merge import assert_unique, merge_delete, merge_update, soft_delete
from strata.operators.scd import (
    classify_members,
    dimension_schema,
    fill_inferred,
    infer_members,
    missing_members,
    new_members,
    placeholder_rows,
    scd1_next,
    scd2_next,
    scd2_recalc,
    with_scd1_defaults,
    with_scd2_defaults,
)
from strata.operators.shape import (
    align_to,
    clean_strings,
    conform,
    dates_to_timestamp,
    drop_columns,
    empty_like,
    merged_schema,
    move_first,
    require_columns,
    rescued_counts,
    select_configured,
    wider_types,
    with_types,
)

__all__ = [name for name in dir() if not name.startswith("_")]
