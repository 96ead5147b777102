"""Checks on readings: missing cells, readings off the slot grid, repeated keys."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F

from slotwise.functions import number_or_null, slot_number
from slotwise.sources.files import CORRUPT
from slotwise.spec import Period, SeriesSpec


class IncompleteReadings(ValueError):
    """Readings have missing cells, so the run must not go on."""


class RepeatedKeys(ValueError):
    """A keyed write was given several rows for one key."""


@dataclass(frozen=True)
class Audit:
    """Outcome of one pass over the readings."""

    rows: int
    off_slot: int
    missing: dict[str, int] = field(default_factory=dict)
    corrupt: int = 0

    def require_complete(self) -> Audit:
        """Raise with the counts per column if any cell is missing or any line corrupt."""
        bad = {c: n for c, n in {**self.missing, "corrupt lines": self.corrupt}.items() if n}
        if bad:
            counts = ", ".join(f"{c}: {n}" for c, n in bad.items())
            raise IncompleteReadings(f"missing cells in {self.rows} readings ({counts})")
        return self


def _missing(spec: SeriesSpec) -> dict[str, Column]:
    return {
        **{c: F.col(c).isNull() for c in spec.entity},
        spec.ts: F.col(spec.ts).cast("timestamp_ntz").isNull(),
        **{m: number_or_null(m).isNull() for m in spec.metrics},
    }


def incomplete_rows(readings: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The readings that the gate refuses: a missing cell, or a corrupt line."""
    refused = reduce(operator.or_, _missing(spec).values())
    return readings.where(refused | F.col(CORRUPT).isNotNull() if CORRUPT in readings.columns else refused)


def audit_counts(rows: DataFrame, spec: SeriesSpec) -> dict[str, Column]:
    """Aggregates by name: row count, missing cells per column (``null_<column>``, NaN counts as
    missing), corrupt lines (if the scan kept them), readings off the slot grid.
    ``rows`` have wall-clock times and, in ``_number``, the slot at them."""
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in rows.columns else F.lit(False)
    return {
        "rows": F.count(F.lit(1)),
        **{f"null_{c}": F.count_if(bad) for c, bad in _missing(spec).items()},
        "corrupt": F.count_if(corrupt),
        "off_slot": F.count_if(F.col(spec.ts).isNotNull() & F.col("_number").isNull()),
    }


def audit(readings: DataFrame, spec: SeriesSpec, period: Period) -> DataFrame:
    """One row with the ``audit_counts`` of all readings.

    A single aggregate without keys: one small partial result per map task.
    """
    ts = F.col(spec.ts).cast("timestamp_ntz")
    rows = readings.withColumn(spec.ts, ts).withColumn("_number", slot_number(spec.ts, spec, period))
    return rows.agg(*[value.alias(name) for name, value in audit_counts(rows, spec).items()])


def audit_of(row: Row | dict[str, int], spec: SeriesSpec) -> Audit:
    """The audit in a row that has its counts."""
    missing = {c: row[f"null_{c}"] for c in spec.reading_columns}
    return Audit(row["rows"], row["off_slot"], missing, row["corrupt"])


def measure(readings: DataFrame, spec: SeriesSpec, period: Period) -> Audit:
    """Run the audit and bring its one row to the driver."""
    return audit_of(audit(readings, spec, period).first(), spec)


def require_complete(readings: DataFrame, spec: SeriesSpec, period: Period) -> Audit:
    """The audit; raises if any cell is missing or any line corrupt."""
    return measure(readings, spec, period).require_complete()


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if any key occurs more than once."""
    example = repeated_keys(df, keys).first()
    if example is not None:
        raise RepeatedKeys(f"several rows for one key, for example {example.asDict()}")
