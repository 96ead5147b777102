from slotwise.operators.baseline import Profiles, entity_profiles, hourly_baseline, measured_profiles
from slotwise.operators.quality import (
    Audit,
    IncompleteReadings,
    RepeatedKeys,
    audit,
    incomplete_rows,
    measure,
    repeated_keys,
    require_complete,
    require_unique,
)
from slotwise.operators.repair import expand_gaps, fill_gaps, mask_outliers, missing_slots, with_zscores
from slotwise.operators.spine import (
    distinct_entities,
    expected_grid,
    expected_slots,
    observed_period,
    slot_spine,
)
from slotwise.operators.state import daily_state, moving_windows, read_state, state_profiles, update_state
from slotwise.operators.summary import anomalies, daily_summary
from slotwise.operators.upsert import merge_staged, read_target, upsert, upsert_table

__all__ = [
    "Audit",
    "IncompleteReadings",
    "Profiles",
    "RepeatedKeys",
    "anomalies",
    "audit",
    "daily_state",
    "daily_summary",
    "distinct_entities",
    "entity_profiles",
    "expand_gaps",
    "expected_grid",
    "expected_slots",
    "fill_gaps",
    "hourly_baseline",
    "incomplete_rows",
    "mask_outliers",
    "measure",
    "measured_profiles",
    "merge_staged",
    "missing_slots",
    "moving_windows",
    "observed_period",
    "read_state",
    "read_target",
    "repeated_keys",
    "require_complete",
    "require_unique",
    "slot_spine",
    "state_profiles",
    "update_state",
    "upsert",
    "upsert_table",
    "with_zscores",
]
