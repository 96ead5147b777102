"""Readings as the other operators expect them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import TimestampNTZType

from slotwise.functions import number_or_null, quoted, slot_number
from slotwise.sources.files import CORRUPT
from slotwise.spec import Period, SeriesSpec


def typed_readings(readings: DataFrame, spec: SeriesSpec, complete_keys: bool = True) -> DataFrame:
    """Only the series' columns (and that of corrupt lines), with wall-clock times
    and double metrics; without rows that lack a part of their key, unless told otherwise.

    A time that needs no cast is passed on as it is: an alias for the same
    column would keep Spark from seeing that two uses of a frame are equal.
    """
    ts = F.col(spec.ts)
    if not isinstance(readings.schema[spec.ts].dataType, TimestampNTZType):
        ts = ts.cast("timestamp_ntz").alias(spec.ts)
    corrupt = [CORRUPT] if not complete_keys and CORRUPT in readings.columns else []
    rows = readings.select(
        *spec.entity,
        ts,
        *[number_or_null(m).alias(m) for m in spec.metrics],
        *corrupt,
    )
    return rows.where(f"not ({lacks_entity(spec)})") if complete_keys else rows


def with_silent(rows: DataFrame, spec: SeriesSpec, entities: DataFrame | None) -> DataFrame:
    """Add a row without time and metrics for each listed entity."""
    if entities is None:
        return rows
    silent = entities.select(*spec.entity).where(f"not ({lacks_entity(spec)})")
    return rows.unionByName(silent, allowMissingColumns=True)


def slot_of_time(spec: SeriesSpec, period: Period) -> Column:
    """Place in its day of the slot at the time column, NULL off the slots."""
    return slot_number(spec.ts, spec, period) % spec.slots_per_day


def lacks_entity(spec: SeriesSpec) -> str:
    return " or ".join(f"{quoted(c)} is null" for c in spec.entity)
