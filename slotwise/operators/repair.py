"""Completing the grid, filling gaps with the seasonal mean, masking outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slotwise.functions import quoted, slot_hour, zscore
from slotwise.operators.baseline import (
    JoinLimits,
    Profiles,
    baseline_columns,
    measured_profiles,
    unseen_slots,
    with_broadcast_stats,
    with_shuffled_stats,
)
from slotwise.operators.presence import slots_seen, unseen
from slotwise.operators.readings import slot_of_time, typed_readings
from slotwise.sources.staging import run_folder
from slotwise.spec import Period, SeriesSpec


def missing_slots(
    readings: DataFrame, spec: SeriesSpec, period: Period, entities: DataFrame | None = None
) -> DataFrame:
    """``(entity..., ts, hour)`` for each expected slot without a reading."""
    seen = slots_seen(typed_readings(readings, spec), spec, period, entities)
    return unseen(seen, spec, period, "_seen", "_season").drop("_season")


def expand_gaps(
    readings: DataFrame, spec: SeriesSpec, period: Period, entities: DataFrame | None = None
) -> DataFrame:
    """The full grid: the readings on it, plus a row of NULL metrics for each
    slot without one. Repeated readings are all kept."""
    observed = (
        typed_readings(readings, spec)
        .withColumn("_slot", slot_of_time(spec, period))
        .where("_slot is not null")
        .select(*spec.entity, spec.ts, slot_hour("_slot", spec, period).alias("hour"), *spec.metrics)
    )
    gaps = missing_slots(readings, spec, period, entities)
    return observed.unionByName(gaps, allowMissingColumns=True)


def fill_gaps(
    readings: DataFrame,
    spec: SeriesSpec,
    period: Period,
    entities: DataFrame | None = None,
    profiles: Profiles | None = None,
    limits: JoinLimits = JoinLimits(),
    work: str | None = None,
) -> DataFrame:
    """The full grid with each missing cell set to the mean of its entity and
    hour of day, and with those means and deviations as columns.

    A cell stays NULL where its entity never reported at that hour.
    ``profiles`` are those of the same readings; without them they are staged at
    once, in ``work`` or the folder that the session names, where they stay as
    long as the result is used.

    With few entities the readings are not shuffled at all; with many they are
    shuffled once. Which it is follows from the staged profiles.
    """
    profiles = profiles or measured_profiles(readings, spec, period, run_folder(readings.sparkSession, work), entities)
    if profiles.bytes <= limits.broadcast_bytes:
        matched = with_broadcast_stats(readings, profiles, spec, period)
    else:
        matched = with_shuffled_stats(readings, profiles, spec, period, limits)
    observed = matched.select(
        *spec.entity,
        "hour",
        spec.ts,
        *[F.coalesce(m, _mean(m)).alias(m) for m in spec.metrics],
        *baseline_columns(spec),
    )
    gaps = unseen_slots(profiles, spec, period)
    filled = gaps.select(
        *spec.entity,
        "hour",
        spec.ts,
        *[F.col(_mean(m)).alias(m) for m in spec.metrics],
        *baseline_columns(spec),
    )
    return observed.unionByName(filled)


def with_zscores(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Add ``zscore_<metric>`` against the carried baseline."""
    return df.withColumns({f"zscore_{m}": zscore(m) for m in spec.metrics})


def mask_outliers(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Replace each metric beyond ``mask_sigma`` by its mean, the other metrics
    of the row staying as they are."""
    return df.withColumns(
        {
            m: F.when(zscore(m) > spec.mask_sigma, F.col(f"{m}_mean")).otherwise(F.col(m))
            for m in spec.metrics
        }
    )


def _mean(metric: str) -> str:
    return "_stats." + quoted(f"{metric}_mean")
