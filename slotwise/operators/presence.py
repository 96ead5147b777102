"""Which slots each entity has filled, and which it has not.

The slots of one hour of day are numbered through the period, and those seen
are kept as 64-bit words, one bit per slot, for a period of any length. A word
is a few bytes however many readings stand behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from slotwise.functions import hours_with_slots, number_at_position, slot_time, with_slot_places
from slotwise.operators.readings import with_silent
from slotwise.operators.spine import spread
from slotwise.spec import Period, SeriesSpec

WORD = 64
HOURS = 24


def with_words(rows: DataFrame, spec: SeriesSpec, period: Period) -> DataFrame:
    """Add ``_hour``, ``_word`` and ``_bit`` of the slot at the time column, NULL off the slots."""
    return with_slot_places(rows, spec, period).withColumns(
        {
            "_word": F.expr(f"cast(_position div {WORD} as int)"),
            "_bit": F.expr(f"shiftleft(1L, _position % {WORD})"),
        }
    )


def words_per_hour(spec: SeriesSpec, period: Period) -> int:
    return max(1, -(-period.days * spec.slots_per_hour // WORD))


def dense(words: str, spec: SeriesSpec, period: Period) -> Column:
    """A map from word to bits as an array with every word of the period."""
    last = words_per_hour(spec, period) - 1
    return F.expr(f"transform(sequence(0, {last}), w -> coalesce(try_element_at({words}, w), 0L))")


# An aggregate over the words of an hour: a map from word to bits.
WORDS = "map_from_entries(collect_list(if(_hour is null, null, struct(_word, _bits))))"


def slots_seen(
    rows: DataFrame, spec: SeriesSpec, period: Period, entities: DataFrame | None = None
) -> DataFrame:
    """``(entity..., _seen)`` from typed readings: for each hour of day the words
    of its slots, NULL for an hour without a reading. Readings off the
    slots only make their entity present.

    Bits are combined before they are shuffled, so an entity of any size
    arrives as a few bytes per word and map task.
    """
    words = (
        with_words(with_silent(rows.select(*spec.entity, spec.ts), spec, entities), spec, period)
        .groupBy(*spec.entity, "_hour", "_word")
        .agg(F.bit_or("_bit").alias("_bits"))
    )
    by_hour = (
        spread(words, *spec.entity)
        .groupBy(*spec.entity, "_hour")
        .agg(F.expr(WORDS).alias("_words"))
        .withColumn("_seen", dense("_words", spec, period))
    )
    hours = by_hour.groupBy(*spec.entity).agg(mapped_by_hour("_seen").alias("_by_hour"))
    return hours.select(*spec.entity, listed_by_hour("_by_hour").alias("_seen"))


def mapped_by_hour(value: str) -> Column:
    """An aggregate over the hours of an entity: a map from hour of day to ``value``."""
    return F.expr(f"map_from_entries(collect_list(if(_hour is null, null, struct(_hour, {value}))))")


def listed_by_hour(by_hour: str) -> Column:
    """The map as an array indexed by hour of day; NULL for hours that it lacks."""
    return F.expr(f"transform(sequence(0, {HOURS - 1}), h -> try_element_at({by_hour}, h))")


def unseen(
    present: DataFrame, spec: SeriesSpec, period: Period, seasons: str, seen: str, entities: int | None = None
) -> DataFrame:
    """``(entity..., ts, hour, _season)`` for each expected slot not seen.

    ``seasons`` is an array by hour of day, and ``seen`` the words in one of its
    elements, ``_season``. Words without a gap are passed over whole. Hours are
    dealt to tasks, as many as the slots of the ``entities`` ask for.
    """
    hours = ", ".join(map(str, hours_with_slots(spec, period))) or "-1"
    blank = f"array_repeat(0L, {words_per_hour(spec, period)})"
    slots = None if entities is None else entities * period.days * spec.slots_per_day
    by_hour = present.select(*spec.entity, F.posexplode(seasons).alias("hour", "_season")).where(f"hour in ({hours})")
    words = spread(by_hour, *spec.entity, "hour", rows=slots).select(
        *spec.entity, "hour", "_season", F.posexplode(F.expr(f"coalesce({seen}, {blank})")).alias("_word", "_bits")
    )
    return (
        words.where("_bits <> -1L")
        .select("*", F.explode(F.expr(f"sequence(0, {WORD - 1})")).alias("_place"))
        .where("getbit(_bits, _place) = 0")
        .withColumn("_position", F.expr(f"_word * {WORD} + _place"))
        .withColumn("_number", number_at_position("hour", "_position", spec, period))
        .where("_number is not null")
        .select(*spec.entity, slot_time("_number", spec, period).alias(spec.ts), "hour", "_season")
    )
