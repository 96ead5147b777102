"""Seasonal baseline per entity, which slots each entity has filled, and what the gate counts.

One aggregate over the readings yields all three. Its result is a *profile*: one
row per entity with 24 seasons (hours of day), each holding count, mean and
sample deviation per metric and a bit set of the slots seen, and the counts of
the audit. A profile is bounded by the length of the period and never by the
number of readings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from slotwise.functions import hours_with_slots, quoted, slot_hour
from slotwise.operators.presence import HOURS, WORDS, dense, listed_by_hour, mapped_by_hour, unseen, with_words, words_per_hour
from slotwise.operators.quality import Audit, audit_counts, audit_of
from slotwise.operators.readings import lacks_entity, slot_of_time, typed_readings
from slotwise.operators.spine import spread
from slotwise.sources.files import CORRUPT
from slotwise.sources.staging import stage
from slotwise.spec import Period, SeriesSpec


@dataclass(frozen=True)
class JoinLimits:
    """Bounds that choose how readings meet their baseline.

    Profiles of more than ``broadcast_bytes`` are joined by a shuffle. In
    that shuffle one task takes about ``task_rows`` readings at most, and there
    are as many tasks as that asks for, however many readings there are.
    """

    broadcast_bytes: int = 128 << 20
    task_rows: int = 1_000_000
    build_bytes: int = 64 << 20


@dataclass(frozen=True)
class Profiles:
    """A staged table of profiles, ``(entity..., _rows, readings, seasons)``, and
    what was counted on the same pass over the readings. All numbers are exact."""

    frame: DataFrame
    audit: Audit
    entities: int
    bytes: int
    largest: int


def entity_profiles(
    readings: DataFrame, spec: SeriesSpec, period: Period, entities: DataFrame | None = None
) -> DataFrame:
    """``(entity..., _rows, readings, seasons)``, one row per entity present.

    ``seasons`` is an array indexed by hour of day; an hour without any
    observation is NULL. Readings off the slot grid count towards nothing but
    still make their entity present. ``entities`` adds entities that may have
    no reading at all.
    """
    found = counted_profiles(readings, spec, period, entities).where(f"not ({lacks_entity(spec)})")
    return found.select(*spec.entity, "_rows", "readings", "seasons")


def counted_profiles(
    readings: DataFrame, spec: SeriesSpec, period: Period, entities: DataFrame | None = None
) -> DataFrame:
    """``entity_profiles`` with the counts of the audit, and rows for incomplete entity keys.

    Readings are combined per (entity, hour, word of slots) before they are shuffled,
    so an entity of any size arrives as a few rows per map task, and the rest
    works on sums that merge exactly. The counts are sums like all else, so a
    task that runs again after an executor is lost counts once.
    """
    rows = with_words(typed_readings(readings, spec, complete_keys=False), spec, period)
    corrupt = F.count(CORRUPT) if CORRUPT in rows.columns else F.lit(0).cast("bigint")
    several = words_per_hour(spec, period) > 1
    parts = {part(i): m for i, m in enumerate(spec.metrics)}
    by_word = rows.groupBy(*spec.entity, "_hour", "_word").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count(spec.ts).alias("_timed"),
        corrupt.alias("_corrupt"),
        F.bit_or("_bit").alias("_bits"),
        *[partial(m, several).alias(name) for name, m in parts.items()],
    )
    if entities is not None:
        silent = entities.select(*spec.entity).where(f"not ({lacks_entity(spec)})")
        by_word = by_word.unionByName(silent, allowMissingColumns=True)
    by_hour = spread(by_word, *spec.entity)
    if several:
        by_hour = (
            by_hour.groupBy(*spec.entity, "_hour")
            .agg(
                *[F.sum(name).alias(name) for name in ("_rows", "_timed", "_corrupt")],
                F.expr(WORDS).alias("_words"),
                *[F.collect_list(name).alias(name) for name in parts],
            )
            .withColumns({"_seen": dense("_words", spec, period)} | {name: merged(name) for name in parts})
        )
    else:  # each row is a whole hour
        by_hour = by_hour.withColumn("_seen", F.array("_bits"))
    stats = ", ".join([f"_rows as {quoted('_n')}", *finished(spec, several)])
    total = lambda value: F.expr(f"coalesce(sum({value}), 0L)")
    totals = {
        "_rows": total("_rows"),
        f"_null_{spec.ts}": total("_rows - _timed"),
        "_corrupt": total("_corrupt"),
        "_off_slot": total("if(_hour is null, _timed, 0L)"),
        "readings": total("if(_hour is null, 0L, _rows)"),
        **{f"_null_{m}": total(f"_rows - {name}.n") for name, m in parts.items()},
    }
    found = (
        by_hour.withColumn("_season", F.struct(F.expr(f"struct({stats})").alias("stats"), F.col("_seen").alias("seen")))
        .groupBy(*spec.entity)
        .agg(*[value.alias(name) for name, value in totals.items()], mapped_by_hour("_season").alias("_by_hour"))
    )
    without = [F.when(F.col(quoted(c)).isNull(), F.col("_rows")).otherwise(0).alias(f"_null_{c}") for c in spec.entity]
    return found.select(*spec.entity, *map(quoted, totals), *without, listed_by_hour("_by_hour").alias("seasons"))


def measured_profiles(
    readings: DataFrame, spec: SeriesSpec, period: Period, folder: str, entities: DataFrame | None = None
) -> Profiles:
    """Profiles staged in ``folder``, with the audit of the readings: one pass over them.

    The counts are observed where the profiles are written, in the last stage of the job.
    There a task's numbers count once however often it runs, unlike those of
    a stage that is repeated for lost shuffle files.

    Give it readings that still have rows without a time (``keep_untimed``) for
    the audit to count them.
    """
    known = f"not ({lacks_entity(spec)})"
    key_bytes = sum((F.octet_length(F.col(c).cast("string")) for c in spec.entity), F.lit(64))
    season = 32 + 16 * len(spec.metrics)
    counted = Observation()
    observed = counted_profiles(readings, spec, period, entities).observe(
        counted,
        *[F.coalesce(F.sum(f"_{name}"), F.lit(0)).alias(name) for name in audit_counts(readings, spec)],
        F.count_if(F.expr(known)).alias("_entities"),
        F.coalesce(F.sum(F.when(F.expr(known), key_bytes + HOURS * season)), F.lit(0)).alias("_bytes"),
        F.coalesce(F.max(F.when(F.expr(known), F.col("_rows"))), F.lit(0)).alias("_largest"),
    )
    stage(observed, folder, "profiles")
    found = counted.get
    numbers = (found[name] for name in ("_entities", "_bytes", "_largest"))
    return staged_profiles(readings.sparkSession, spec, folder, audit_of(found, spec), *numbers)


def staged_profiles(
    spark: SparkSession, spec: SeriesSpec, folder: str, audit: Audit, entities: int, size: int, largest: int
) -> Profiles:
    """The profiles that ``measured_profiles`` has staged in ``folder``, with what it counted."""
    frame = spark.read.parquet(f"{folder}/profiles").where(f"not ({lacks_entity(spec)})")
    return Profiles(frame.select(*spec.entity, "_rows", "readings", "seasons"), audit, entities, size, largest)


def hourly_baseline(profiles: DataFrame, spec: SeriesSpec, period: Period) -> DataFrame:
    """Mean and deviation per (entity, hour) for every hour that has a slot;
    both are NULL where nothing was observed."""
    hours = hours_with_slots(spec, period)
    listed = F.expr(f"cast(array({', '.join(map(str, hours))}) as array<int>)")
    return (
        profiles.select(*spec.entity, "seasons", F.explode(listed).alias("hour"))
        .select(*spec.entity, "hour", F.expr("get(seasons.stats, hour)").alias("_stats"))
        .select(*spec.entity, "hour", *baseline_columns(spec))
    )


def baseline_columns(spec: SeriesSpec) -> list[Column]:
    """The mean and deviation columns out of a ``_stats`` struct."""
    return [F.col(f"_stats.{quoted(c)}").alias(c) for c in [*spec.mean_columns, *spec.stddev_columns]]


def unseen_slots(profiles: Profiles, spec: SeriesSpec, period: Period) -> DataFrame:
    """``(entity..., ts, hour, _stats)`` for each slot without a reading."""
    gaps = unseen(profiles.frame, spec, period, "seasons", "_season.seen", profiles.entities)
    return gaps.select(*spec.entity, spec.ts, "hour", F.col("_season.stats").alias("_stats"))


def heavy_entities(profiles: Profiles, spec: SeriesSpec, limits: JoinLimits) -> DataFrame | None:
    """``(entity..., _parts)`` for entities too large for one task, or None.

    There are fewer of them than the shuffle has partitions, so their list can be broadcast.
    """
    if profiles.largest <= limits.task_rows:
        return None
    parts = F.expr(f"cast(ceil(_rows / {limits.task_rows}) as int)")
    return profiles.frame.where(F.col("_rows") > limits.task_rows).select(*spec.entity, parts.alias("_parts"))


def gathered(readings: DataFrame, spec: SeriesSpec, parts: DataFrame | None, partitions: int) -> DataFrame:
    """Typed readings hashed by entity, the only shuffle of whole readings.

    ``parts`` lists the entities to spread over several tasks; their rows are
    dealt by the map task they come from, which no repetition of equal
    rows can defeat.
    """
    rows = typed_readings(readings, spec)
    if parts is None:
        return rows.repartition(partitions, *spec.entity)
    return (
        rows.join(F.broadcast(parts), list(spec.entity), "left")
        .withColumn("_part", F.expr("coalesce(spark_partition_id() % _parts, 0)"))
        .drop("_parts")
        .repartition(partitions, *spec.entity, "_part")
    )


def partitions_for(profiles: Profiles, limits: JoinLimits) -> int:
    """As many as keep a task's share at ``task_rows``, and the session's number at least."""
    session = int(profiles.frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(session, -(-profiles.audit.rows // limits.task_rows))


def with_broadcast_stats(readings: DataFrame, profiles: Profiles, spec: SeriesSpec, period: Period) -> DataFrame:
    """Readings on the slot grid with their hour and its ``_stats``; the
    readings stay where they were read."""
    rows = _with_hour(typed_readings(readings, spec), spec, period)
    return _matched(rows.join(F.broadcast(_known(profiles, spec)), list(spec.entity), "left"), spec)


def with_shuffled_stats(
    readings: DataFrame, profiles: Profiles, spec: SeriesSpec, period: Period, limits: JoinLimits
) -> DataFrame:
    """The same after one shuffle of the readings. Those of a heavy entity
    meet a copy of its profile in each task that has some of them."""
    parts, partitions = heavy_entities(profiles, spec, limits), partitions_for(profiles, limits)
    rows = gathered(readings, spec, parts, partitions)
    keys = list(spec.entity)
    stats = _known(profiles, spec)
    if parts is not None:
        stats = (
            stats.join(F.broadcast(parts), keys, "left")
            .withColumn("_part", F.explode(F.expr("sequence(0, coalesce(_parts, 1) - 1)")))
            .drop("_parts")
        )
        keys = [*keys, "_part"]
    if profiles.bytes // partitions <= limits.build_bytes:
        stats = stats.hint("shuffle_hash")
    return _matched(_with_hour(rows, spec, period).join(stats, keys, "left"), spec)


def _known(profiles: Profiles, spec: SeriesSpec) -> DataFrame:
    """The statistics of the entities with readings on the slots."""
    return profiles.frame.where("readings > 0").select(*spec.entity, F.col("seasons.stats").alias("_by_hour"))


def _matched(joined: DataFrame, spec: SeriesSpec) -> DataFrame:
    return (
        joined.withColumn("_stats", F.expr("get(_by_hour, hour)"))
        .where("_stats is not null")
        .select(*spec.entity, "hour", spec.ts, *spec.metrics, "_stats")
    )


def _with_hour(rows: DataFrame, spec: SeriesSpec, period: Period) -> DataFrame:
    """Add the hour of the slot at the time column; -1, which no profile has,
    off the slots.

    With a NULL there instead, Spark would move the test for it below the
    shuffle or rollup that the readings come from, and evaluate it twice.
    """
    hour = F.coalesce(slot_hour("_slot", spec, period), F.lit(-1))
    return rows.withColumn("_slot", slot_of_time(spec, period)).withColumn("hour", hour).drop("_slot")


def part(i: int) -> str:
    return f"_part{i}"


def partial(metric: str, several: bool) -> Column:
    """Count, sum and squared deviations from the mean; least and largest value
    as well if ``several`` of these are to be put together."""
    x = F.col(quoted(metric))
    squares = F.coalesce(F.var_pop(x) * F.count(x), F.lit(0.0))
    ends = [F.min(x).alias("lo"), F.max(x).alias("hi")] if several else []
    return F.struct(F.count(x).alias("n"), F.sum(x).alias("s"), squares.alias("q"), *ends)


def merged(parts: str) -> Column:
    """A list of ``partial`` put together, by the update formula for parallel sums of squares."""
    both = (
        "named_struct('n', a.n + b.n, 's', a.s + b.s, "
        "'q', a.q + b.q + power(b.s / b.n - a.s / a.n, 2) * (a.n * (b.n / (a.n + b.n))), "
        "'lo', least(a.lo, b.lo), 'hi', greatest(a.hi, b.hi))"
    )
    step = f"(a, b) -> if(b.n = 0, a, if(a.n = 0, b, {both}))"
    return F.expr(f"aggregate(slice({parts}, 2, greatest(size({parts}) - 1, 0)), get({parts}, 0), {step})")


def finished(spec: SeriesSpec, several: bool) -> list[str]:
    """Mean and sample deviation of each metric; that of equal values is 0, whatever their sums round to."""
    equal = "{p}.lo = {p}.hi" if several else "{p}.q = 0"
    mean = "if({p}.n > 0, {p}.s / {p}.n, null) as {c}"
    deviation = f"if({{p}}.n > 1, if({equal}, 0D, sqrt({{p}}.q / ({{p}}.n - 1))), null) as {{c}}"
    return [
        form.format(p=part(i), c=quoted(c))
        for form, columns in ((mean, spec.mean_columns), (deviation, spec.stddev_columns))
        for i, c in enumerate(columns)
    ]
