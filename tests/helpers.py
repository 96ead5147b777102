"""Small readings, and the same calculations in plain pandas."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from slotwise import Period, SeriesSpec

DEVICES = SeriesSpec(
    entity="device_id", ts="timestamp", metrics=("speed", "direction", "power")
)
ONE = SeriesSpec(entity="id", ts="ts", metrics="x")
ONE_SCHEMA = "id int, ts timestamp_ntz, x double"


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def one_metric(spark: SparkSession, rows) -> DataFrame:
    """Frame of (id, time text, x)."""
    return spark.createDataFrame([(i, at(t) if t else None, x) for i, t, x in rows], ONE_SCHEMA)


def daily_at_midnight(values, entity=1, start="2024-01-01"):
    """One reading per day at 00:00."""
    first = at(start)
    return [(entity, (first + timedelta(days=d)).isoformat(), v) for d, v in enumerate(values)]


def rows_by(df: DataFrame, *keys: str) -> dict:
    found = {}
    for row in df.collect():
        key = tuple(row[k] for k in keys)
        found.setdefault(key if len(keys) > 1 else key[0], []).append(row)
    return found


def brute_fill(rows: list[tuple], spec: SeriesSpec, period: Period) -> pd.DataFrame:
    """Grid, join, group and fill with pandas. ``rows``: entity..., ts, metrics...;
    only entities in the rows get slots."""
    keys = list(spec.entity)
    df = pd.DataFrame(rows, columns=[*keys, spec.ts, *spec.metrics])
    df[spec.ts] = pd.to_datetime(df[spec.ts])
    df[list(spec.metrics)] = df[list(spec.metrics)].astype(float)
    slots = [period.start + i * spec.slot for i in range(period.days * spec.slots_per_day)]
    grid = df[keys].drop_duplicates().merge(pd.DataFrame({spec.ts: pd.to_datetime(slots)}), how="cross")
    full = grid.merge(df, on=[*keys, spec.ts], how="left")
    full["hour"] = full[spec.ts].dt.hour
    for m in spec.metrics:
        groups = full.groupby([*keys, "hour"])[m]
        full[f"{m}_mean"] = groups.transform("mean")
        full[f"{m}_stddev"] = groups.transform(lambda s: s.std(ddof=1))
        full[m] = full[m].fillna(full[f"{m}_mean"])
    return full[spec.cleaned_columns]


def brute_mask(full: pd.DataFrame, spec: SeriesSpec) -> pd.DataFrame:
    full = full.copy()
    for m in spec.metrics:
        deviation = full[f"{m}_stddev"].replace(0.0, np.nan)
        z = ((full[m] - full[f"{m}_mean"]) / deviation).abs()
        full[m] = full[m].where(~(z > spec.mask_sigma), full[f"{m}_mean"])
    return full


def assert_frames(result: DataFrame, expected: pd.DataFrame, spec: SeriesSpec) -> None:
    order = [*spec.entity, spec.ts, *spec.metrics]
    ours = result.select(*spec.cleaned_columns).toPandas()
    both = []
    for frame in (ours, expected[spec.cleaned_columns].copy()):
        frame[spec.ts] = frame[spec.ts].astype("datetime64[us]")
        frame = frame.sort_values(order, kind="stable").reset_index(drop=True)
        both.append(frame)
    pd.testing.assert_frame_equal(*both, check_dtype=False, check_exact=False, rtol=1e-9, atol=1e-9)
