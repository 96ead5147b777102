"""Check, complete, fill and mask: the cleaning of one period."""

from __future__ import annotations

from pyspark.sql import DataFrame

from slotwise.operators.baseline import JoinLimits, Profiles, measured_profiles
from slotwise.operators.repair import fill_gaps, mask_outliers
from slotwise.sources.staging import run_folder
from slotwise.spec import Period, SeriesSpec


def clean(
    readings: DataFrame,
    spec: SeriesSpec,
    period: Period,
    entities: DataFrame | None = None,
    profiles: Profiles | None = None,
    limits: JoinLimits = JoinLimits(),
    work: str | None = None,
) -> DataFrame:
    """Cleaned readings on the full grid of the period.

    The profiles are staged at once, in ``work`` or the folder that the session
    names, and the audit made with them raises on missing cells. The rest is
    lazy and reads the readings once more. Pass ``profiles`` if they have been made already; they
    are held to the same gate.
    """
    if profiles is None:
        profiles = measured_profiles(readings, spec, period, run_folder(readings.sparkSession, work), entities)
    profiles.audit.require_complete()
    return mask_outliers(fill_gaps(readings, spec, period, entities, profiles, limits), spec)
