"""What a series looks like and which span of time a run covers."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta

# Thresholds (in standard deviations) that decide which cells
# are replaced while cleaning and which cleaned rows are reported.
MASK_SIGMA = 3.0
ANOMALY_SIGMA = 2.0

# Names that results use themselves, as they do names with a leading underscore.
RESERVED = frozenset({"date", "hour", "readings", "seasons", "year", "month", "day", "outlier", "copies"})
# What results add to the names of metrics.
DERIVED = ("{}_mean", "{}_stddev", "{}_min", "{}_max", "zscore_{}")

_DAY = timedelta(days=1)


@dataclass(frozen=True)
class SeriesSpec:
    """Names and parameters of a regular sensor series.

    ``entity`` holds the key columns of a device, ``ts`` the reading time and
    ``metrics`` the measured columns. Readings are expected every ``slot``.
    The season of a slot is its hour of day. ``summary_metrics`` and
    ``anomaly_metric`` default to the last metric.
    """

    entity: tuple[str, ...]
    ts: str
    metrics: tuple[str, ...]
    slot: timedelta = timedelta(hours=1)
    mask_sigma: float = MASK_SIGMA
    anomaly_sigma: float = ANOMALY_SIGMA
    summary_metrics: tuple[str, ...] = ()
    anomaly_metric: str = ""

    def __post_init__(self) -> None:
        for field in ("entity", "metrics", "summary_metrics"):
            value = getattr(self, field)
            object.__setattr__(self, field, (value,) if isinstance(value, str) else tuple(value))
        if not self.entity:
            raise ValueError("a series needs at least one entity column")
        for name in (*self.entity, self.ts, *self.metrics):
            if "." in name or "`" in name or name.startswith("_") or name.lower() in RESERVED:
                raise ValueError(f"not usable as the name of a column of a series: {name}")
        named = [*self.entity, self.ts, *self.metrics, *(form.format(m) for m in self.metrics for form in DERIVED)]
        if len({name.lower() for name in named}) < len(named):
            raise ValueError(f"names of a series, and of what is derived from its metrics, must differ: {named}")
        if self.slot <= timedelta(0) or self.slot.microseconds or _DAY % self.slot:
            raise ValueError(f"slot must be whole seconds and divide a day, not {self.slot}")
        if not self.summary_metrics:
            object.__setattr__(self, "summary_metrics", self.metrics[-1:])
        if not self.anomaly_metric and self.metrics:
            object.__setattr__(self, "anomaly_metric", self.metrics[-1])

    def only(self, *metrics: str) -> SeriesSpec:
        """The same series reduced to some of its metrics."""
        return replace(self, metrics=metrics, summary_metrics=(), anomaly_metric="")

    @property
    def slots_per_day(self) -> int:
        return _DAY // self.slot

    @property
    def slots_per_hour(self) -> int:
        """Most slots that can share one hour of day on one day."""
        return max(1, -(-timedelta(hours=1) // self.slot))

    @property
    def reading_columns(self) -> list[str]:
        return [*self.entity, self.ts, *self.metrics]

    @property
    def mean_columns(self) -> list[str]:
        return [f"{m}_mean" for m in self.metrics]

    @property
    def stddev_columns(self) -> list[str]:
        return [f"{m}_stddev" for m in self.metrics]

    @property
    def cleaned_columns(self) -> list[str]:
        """Column order of a filled or cleaned frame."""
        return [*self.entity, "hour", self.ts, *self.metrics, *self.mean_columns, *self.stddev_columns]


@dataclass(frozen=True)
class Period:
    """Half-open span ``[start, end)``; only its whole days get slots."""

    start: datetime
    end: datetime

    def __post_init__(self) -> None:
        if self.start.microsecond:
            raise ValueError(f"a period must start on a whole second, not at {self.start}")

    @staticmethod
    def of(start: str | date | datetime, end: str | date | datetime) -> Period:
        return Period(_naive(start), _naive(end))

    @property
    def days(self) -> int:
        return max(0, (self.end - self.start).days)

    @property
    def slots_end(self) -> datetime:
        return self.start + self.days * _DAY


def _naive(value: str | date | datetime) -> datetime:
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    elif not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    if value.tzinfo is not None:
        raise ValueError(f"wall-clock time expected, got a zoned one: {value}")
    return value
