"""A baseline that is kept day by day and put together for any span of days.

The state of a day holds, per entity and hour of day, the count, sum and squared
deviations of each metric with its least and largest value. States of several days combine by the
update formula for parallel sums of squares, so a longer or moved window reads
the readings of its new days only.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, time, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructType

from slotwise.functions import quoted, with_slot_places
from slotwise.operators.baseline import finished, merged, part, partial
from slotwise.operators.presence import listed_by_hour, mapped_by_hour
from slotwise.operators.readings import typed_readings
from slotwise.sources.files import in_period
from slotwise.sources.sinks import PARTITIONS, with_day_parts, write_partitions
from slotwise.sources.staging import file_system
from slotwise.spec import Period, SeriesSpec

ONE_DAY = timedelta(days=1)


def daily_state(readings: DataFrame, spec: SeriesSpec, period: Period) -> DataFrame:
    """``(date, entity..., hour, _state)`` for each entity, day and hour with a reading on a slot.

    ``_state`` has a field per metric, each a struct of count, sum, squared
    deviations, least and largest value. Readings are combined before they are
    shuffled. Missing cells count towards nothing, readings off the slots neither.
    """
    placed = with_slot_places(typed_readings(in_period(readings, spec, period), spec), spec, period)
    on_slots = placed.where("_hour is not null").withColumns({"date": F.to_date(spec.ts), "hour": F.col("_hour")})
    parts = {part(i): m for i, m in enumerate(spec.metrics)}
    states = on_slots.groupBy("date", *spec.entity, "hour").agg(*[partial(m, True).alias(name) for name, m in parts.items()])
    fields = [F.col(name).alias(m) for name, m in parts.items()]
    return states.select("date", *spec.entity, "hour", F.struct(*fields).alias("_state"))


def absent_days(spark: SparkSession, path: str, days: Sequence[date]) -> list[date]:
    """The days that the state table has no folder for."""
    location, files = file_system(spark, path)
    if not files.exists(location):
        return list(days)
    held = lambda d: file_system(spark, f"{path}/year={d.year}/month={d.month}/day={d.day}")[0]
    return [d for d in days if not files.exists(held(d))]


def spans(days: Sequence[date]) -> list[Period]:
    """Days in ascending order as periods of days in a row."""
    found: list[Period] = []
    for day in days:
        begin = Period.of(day, day + ONE_DAY)
        if found and found[-1].end == begin.start:
            found[-1] = Period(found[-1].start, begin.end)
        else:
            found.append(begin)
    return found


def update_state(
    readings: DataFrame, spec: SeriesSpec, period: Period, path: str, refresh: Sequence[date] = ()
) -> list[date]:
    """Add the days of ``period`` to the state table at ``path``; returns the days that were read.

    Days that the table has are left as they are, but for those in ``refresh``,
    say because readings came late. Only the readings of the days that are left are read, and
    written days replace what was there, so a run that was cut off can be repeated. A
    day without any reading has no folder and is looked at again. One update of a
    table may run at a time.
    """
    if period.start.time() != time.min:
        raise ValueError(f"a state of days must start at midnight, not at {period.start}")
    spark = readings.sparkSession
    days = [period.start.date() + i * ONE_DAY for i in range(period.days)]
    new = sorted({*absent_days(spark, path, days), *(d for d in refresh if d in days)})
    for span in spans(new):
        write_partitions(with_day_parts(daily_state(readings, spec, span), "date"), path, "parquet")
    return new


def read_state(spark: SparkSession, path: str, schema: StructType, period: Period) -> DataFrame:
    """The states of the days of ``period``; others are pruned by their folders.
    ``schema`` is that of ``daily_state``."""
    full = StructType(list(schema.fields))
    for name in PARTITIONS:
        full = full.add(name, IntegerType())
    location, files = file_system(spark, path)
    if not files.exists(location):
        return spark.createDataFrame([], schema)
    day = F.make_date(*[F.col(name) for name in PARTITIONS])
    states = spark.read.schema(full).parquet(path)
    return states.where((day >= F.lit(period.start.date())) & (day < F.lit(period.slots_end.date()))).select(*schema.names)


def state_profiles(states: DataFrame, spec: SeriesSpec, *also: str) -> DataFrame:
    """``(also..., entity..., seasons)``: the states put together, as ``hourly_baseline`` takes them.

    A list that is put together has a state for each day at most.
    """
    parts = {part(i): m for i, m in enumerate(spec.metrics)}
    keys = [*also, *spec.entity]
    listed = [F.collect_list(F.col(f"_state.{quoted(m)}")).alias(name) for name, m in parts.items()]
    by_hour = states.groupBy(*keys, "hour").agg(*listed).withColumns({name: merged(name) for name in parts})
    stats = F.expr(f"struct({', '.join(finished(spec, True))})")
    by_hour = by_hour.select(*keys, F.col("hour").alias("_hour"), F.struct(stats.alias("stats")).alias("_season"))
    found = by_hour.groupBy(*keys).agg(mapped_by_hour("_season").alias("_by_hour"))
    return found.select(*keys, listed_by_hour("_by_hour").alias("seasons"))


def moving_windows(states: DataFrame, period: Period, days: int, step: int) -> DataFrame:
    """Each state once for every window of ``days`` days that it falls into, with the
    window's first day ``_from``. Windows begin every ``step`` days from the start of the
    period and lie whole within it."""
    if days < 1 or step < 1:
        raise ValueError("windows and their steps take a day at least")
    starts = max(0, (period.days - days) // step + 1)
    at = F.datediff("date", F.lit(period.start.date()))
    first = F.greatest(F.lit(0), F.ceil((at - (days - 1)) / step)).cast("int")
    last = F.least(F.lit(starts - 1), F.floor(at / step)).cast("int")
    numbers = F.when(first <= last, F.sequence(first, last))
    numbered = states.withColumn("_window", F.explode(numbers))
    start = F.date_add(F.lit(period.start.date()), F.col("_window") * F.lit(step))
    return numbered.withColumn("_from", start).drop("_window")
