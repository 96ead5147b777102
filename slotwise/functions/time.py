"""Zone-free time arithmetic on TIMESTAMP_NTZ columns.

Nothing here depends on the session zone or on the zone of the Python process.
Hours and positions come from the slot index by integer arithmetic, which is
much cheaper per row than the calendar functions.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from slotwise.spec import Period, SeriesSpec


def quoted(name: str) -> str:
    """A column name for use in an SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def ntz(value: datetime) -> Column:
    """A wall-clock literal."""
    return F.expr(_literal(value))


def slot_number(ts: str, spec: SeriesSpec, period: Period) -> Column:
    """Index of the slot at ``ts``, NULL unless ts lies exactly on a slot of
    the period."""
    t, elapsed = quoted(ts), _elapsed(ts, period)
    inside = f"{t} >= {_literal(period.start)} and {t} < {_literal(period.slots_end)}"
    on_slot = f"{elapsed} % {_seconds(spec)} = 0 and extract(second from {t}) = second({t})"
    return F.expr(f"if({inside} and {on_slot}, cast({elapsed} div {_seconds(spec)} as int), null)")


def slot_floor(ts: str, spec: SeriesSpec, period: Period) -> Column:
    """Timestamp of the slot that ``ts`` falls into, for ts >= period.start."""
    number = f"({_elapsed(ts, period)} div {_seconds(spec)})"
    return F.expr(f"{_literal(period.start)} + interval '{_seconds(spec)}' second * {number}")


def slot_time(number: str, spec: SeriesSpec, period: Period) -> Column:
    """Timestamp of a slot from its index."""
    return F.expr(f"{_literal(period.start)} + interval '{_seconds(spec)}' second * {quoted(number)}")


def with_days(df: DataFrame, period: Period) -> DataFrame:
    """Each row with every day of the period: adds its number ``_day`` and its
    start ``_first``."""
    if period.days == 0:
        days = "cast(array() as array<timestamp_ntz>)"
    else:
        last = period.slots_end - timedelta(days=1)
        days = f"sequence({_literal(period.start)}, {_literal(last)}, interval '1' day)"
    return df.select(*df.columns, F.posexplode(F.expr(days)).alias("_day", "_first"))


def with_slots_of_days(days: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Each row of ``with_days`` with every slot of its day: the timestamp and
    the place ``_slot`` in the day instead of ``_first``."""
    rest = 86400 - _seconds(spec)
    slots = f"sequence(_first, _first + interval '{rest}' second, interval '{_seconds(spec)}' second)"
    kept = [c for c in days.columns if c != "_first"]
    return days.select(*kept, F.posexplode(F.expr(slots)).alias("_slot", spec.ts))


def day_of(number: str, spec: SeriesSpec) -> Column:
    return F.expr(f"cast({quoted(number)} div {spec.slots_per_day} as int)")


def slot_of(number: str, spec: SeriesSpec) -> Column:
    return F.expr(f"{quoted(number)} % {spec.slots_per_day}")


def slot_hour(slot: str, spec: SeriesSpec, period: Period) -> Column:
    """Hour of day of a slot from its place in the day."""
    return F.expr(f"cast({_second_of_day(slot, spec, period)} div 3600 as int)")


def slot_position(day: str, slot: str, spec: SeriesSpec, period: Period) -> Column:
    """Place of a slot among all slots of its hour of day in the period."""
    if spec.slots_per_hour == 1:
        return F.col(day)
    place = f"({_second_of_day(slot, spec, period)} % 3600) div {_seconds(spec)}"
    return F.expr(f"cast({quoted(day)} * {spec.slots_per_hour} + {place} as int)")


def with_slot_places(rows: DataFrame, spec: SeriesSpec, period: Period) -> DataFrame:
    """Add ``_number``, ``_hour`` and ``_position`` (among the slots of that hour) of
    the slot at the time column, NULL off the slots."""
    return (
        rows.withColumn("_number", slot_number(spec.ts, spec, period))
        .withColumns({"_day": day_of("_number", spec), "_slot": slot_of("_number", spec)})
        .withColumns(
            {
                "_hour": slot_hour("_slot", spec, period),
                "_position": slot_position("_day", "_slot", spec, period),
            }
        )
        .drop("_day", "_slot")
    )


def number_at_position(hour: str, position: str, spec: SeriesSpec, period: Period) -> Column:
    """Index of the slot at a place of ``slot_position``, NULL where there is none."""
    step, first, h, at = _seconds(spec), _second_of_day("0", spec, period), quoted(hour), quoted(position)
    day = f"({at} div {spec.slots_per_hour})"
    begin = f"({h} * 3600 + {at} % {spec.slots_per_hour} * {step})" if spec.slots_per_hour > 1 else f"({h} * 3600)"
    second = f"({begin} + pmod({first} - {begin}, {step}))"
    number = f"({day} * {spec.slots_per_day} + pmod({second} - {first}, 86400) div {step})"
    inside = f"{second} < ({h} + 1) * 3600 and {number} < {period.days * spec.slots_per_day}"
    return F.expr(f"if({inside}, cast({number} as int), null)")


def hours_with_slots(spec: SeriesSpec, period: Period) -> list[int]:
    """The hours of day in which slots of the period begin."""
    return sorted({(period.start + i * spec.slot).hour for i in range(spec.slots_per_day)}) if period.days else []


def day_parts(value: str) -> dict[str, Column]:
    """Partition columns year, month and day."""
    return {"year": F.year(value), "month": F.month(value), "day": F.dayofmonth(value)}


def _literal(value: datetime) -> str:
    return f"timestamp_ntz'{value.isoformat(sep=' ')}'"


def _seconds(spec: SeriesSpec) -> int:
    return int(spec.slot.total_seconds())


def _elapsed(ts: str, period: Period) -> str:
    """Whole seconds since the start of the period. The function reads a
    wall-clock time as if it were UTC, whatever the session zone."""
    start = int((period.start - datetime(1970, 1, 1)).total_seconds())
    return f"(to_unix_timestamp({quoted(ts)}) - {start})"


def _second_of_day(slot: str, spec: SeriesSpec, period: Period) -> str:
    start = (period.start.hour * 60 + period.start.minute) * 60 + period.start.second
    return f"(({start} + {slot if slot == '0' else quoted(slot)} * {_seconds(spec)}) % 86400)"
