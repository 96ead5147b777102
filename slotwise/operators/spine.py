"""The expected slots and the full entity-by-slot grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slotwise.functions import ntz, slot_hour, with_days, with_slots_of_days
from slotwise.spec import Period, SeriesSpec

# Slots that one task is given to make.
TASK_SLOTS = 4_000_000


def period_frame(spark: SparkSession, period: Period) -> DataFrame:
    """The period as a one-row frame ``(start, end)``."""
    return spark.range(1).select(ntz(period.start).alias("start"), ntz(period.end).alias("end"))


def observed_period(readings: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The whole days that the readings span, as a frame ``(start, end)``."""
    day = F.col(spec.ts).cast("timestamp_ntz").cast("date")
    return readings.agg(
        F.min(day).cast("timestamp_ntz").alias("start"),
        F.date_add(F.max(day), 1).cast("timestamp_ntz").alias("end"),
    )


def slot_spine(periods: DataFrame, spec: SeriesSpec) -> DataFrame:
    """``(ts, hour)`` for every slot in the whole days of each ``[start, end)``.

    Days are listed first and dealt to tasks, which list their slots.
    """
    days = F.floor((F.col("end") - F.col("start")).cast("interval second").cast("bigint") / 86400).cast("int")
    numbers = F.when(days > 0, F.sequence(F.lit(0), days - 1))
    dealt = spread(periods.select("start", F.explode(numbers).alias("_day")), "start", "_day")
    slots = F.sequence(F.lit(0), F.lit(spec.slots_per_day - 1))
    return (
        dealt.select("start", "_day", F.explode(slots).alias("_slot"))
        .withColumn("_number", F.col("_day").cast("bigint") * spec.slots_per_day + F.col("_slot"))
        .select((F.col("start") + F.lit(spec.slot) * F.col("_number")).alias(spec.ts))
        .withColumn("hour", F.hour(spec.ts))
    )


def expected_slots(spark: SparkSession, spec: SeriesSpec, period: Period) -> DataFrame:
    """``(ts, hour)`` for every slot of the period."""
    return slot_spine(period_frame(spark, period), spec)


def distinct_entities(readings: DataFrame, spec: SeriesSpec) -> DataFrame:
    return readings.select(*spec.entity).distinct()


def spread(df: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """Hash by the keys into the session's full number of shuffle partitions, or
    as many more as the ``rows`` that they will grow into ask for.

    A few bytes per row grow into a row per slot in the steps that follow. The
    adaptive planner would merge partitions by the small size before that
    growth; an explicit number keeps all tasks busy.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(partitions, -(-(rows or 0) // TASK_SLOTS)), *keys)


def expected_grid(entities: DataFrame, spec: SeriesSpec, period: Period) -> DataFrame:
    """Every entity with every slot; generated row by row, so no join. The days
    of an entity are dealt to several tasks, as many as the slots ask for; the
    entities are counted for that at once."""
    days = with_days(entities.select(*spec.entity), period)
    slots = entities.count() * period.days * spec.slots_per_day
    return with_slots_of_days(spread(days, *spec.entity, "_day", rows=slots), spec).select(
        *spec.entity, spec.ts, slot_hour("_slot", spec, period).alias("hour")
    )
