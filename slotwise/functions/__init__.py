from slotwise.functions.time import (
    day_of,
    day_parts,
    hours_with_slots,
    ntz,
    number_at_position,
    quoted,
    slot_floor,
    slot_hour,
    slot_number,
    slot_of,
    slot_position,
    slot_time,
    with_days,
    with_slot_places,
    with_slots_of_days,
)
from slotwise.functions.stats import number_or_null, zscore

__all__ = [
    "day_of",
    "day_parts",
    "hours_with_slots",
    "ntz",
    "number_at_position",
    "number_or_null",
    "quoted",
    "slot_floor",
    "slot_hour",
    "slot_number",
    "slot_of",
    "slot_position",
    "slot_time",
    "with_days",
    "with_slot_places",
    "with_slots_of_days",
    "zscore",
]
