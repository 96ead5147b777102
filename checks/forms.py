"""Three ways to compute the cleaned frame, to measure against each other.

``profile_form`` is the one in use. ``join_form`` expands the grid with a cross
join, aggregates it and joins the aggregate back. ``window_form`` replaces the
second join by window aggregates. Both of these shuffle the expanded grid, and a
window or a join key gathers all rows of one entity and hour in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from checks.queries import PERIOD, events, rolled_up, series, work_folder
from slotwise import SeriesSpec, clean
from slotwise import operators as op


def profile_form(readings: DataFrame, spec: SeriesSpec) -> DataFrame:
    return clean(readings, spec, PERIOD, work=work_folder(readings.sparkSession))


def join_form(readings: DataFrame, spec: SeriesSpec) -> DataFrame:
    op.require_complete(readings, spec, PERIOD)
    grid = _grid(readings, spec)
    stats = [fn(m).alias(f"{m}_{name}") for m in spec.metrics for name, fn in (("mean", F.avg), ("stddev", F.stddev))]
    key = [*spec.entity, "hour"]
    return _finish(grid.join(grid.groupBy(*key).agg(*stats), key, "left"), spec)


def window_form(readings: DataFrame, spec: SeriesSpec) -> DataFrame:
    op.require_complete(readings, spec, PERIOD)
    same_hour = Window.partitionBy(*spec.entity, "hour")
    stats = {f"{m}_mean": F.avg(m).over(same_hour) for m in spec.metrics}
    stats |= {f"{m}_stddev": F.stddev(m).over(same_hour) for m in spec.metrics}
    return _finish(_grid(readings, spec).withColumns(stats), spec)


def user_readings(spark: SparkSession, sf_dir: str, copies: int = 1) -> tuple[DataFrame, SeriesSpec]:
    """Hourly readings per user, with each user's events repeated for
    ``copies`` users."""
    raw = events(spark, sf_dir)
    if copies > 1:
        raw = raw.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
        raw = raw.withColumn("user_id", F.col("user_id") * copies + F.col("copy")).drop("copy")
    return rolled_up(raw, "user_id"), series("user_id")


def _grid(readings: DataFrame, spec: SeriesSpec) -> DataFrame:
    slots = op.expected_slots(readings.sparkSession, spec, PERIOD)
    return slots.crossJoin(op.distinct_entities(readings, spec)).join(readings, [*spec.entity, spec.ts], "left")


def _finish(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    filled = df.withColumns({m: F.coalesce(m, f"{m}_mean") for m in spec.metrics})
    return op.mask_outliers(filled.select(spec.cleaned_columns), spec)
