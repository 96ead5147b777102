"""Cleaning and summarising regular sensor time series on Spark."""

from slotwise.plans import JdbcStore, JsonStore, Report, TableStore, clean, run
from slotwise.spec import ANOMALY_SIGMA, MASK_SIGMA, Period, SeriesSpec

__all__ = [
    "ANOMALY_SIGMA",
    "MASK_SIGMA",
    "JdbcStore",
    "JsonStore",
    "Period",
    "Report",
    "SeriesSpec",
    "TableStore",
    "clean",
    "run",
]
