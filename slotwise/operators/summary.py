"""Daily statistics and anomalies of a cleaned frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slotwise.functions import zscore
from slotwise.spec import SeriesSpec


def daily_summary(cleaned: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Mean, min, max and sample deviation per (date, entity) of the summary
    metrics; filled and masked values count."""
    stats = [
        fn(m).alias(f"{m}_{name}")
        for m in spec.summary_metrics
        for name, fn in (("mean", F.avg), ("min", F.min), ("max", F.max), ("stddev", F.stddev_samp))
    ]
    return cleaned.groupBy(F.to_date(spec.ts).alias("date"), *spec.entity).agg(*stats)


def anomalies(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Rows whose anomaly metric lies beyond ``anomaly_sigma``.

    On a cleaned frame, masked and filled cells equal their mean, so this
    yields the rows between the two thresholds. On the output of ``fill_gaps``
    it yields the most extreme readings as well.
    """
    metric = spec.anomaly_metric
    score = f"zscore_{metric}"
    return (
        df.withColumn(score, zscore(metric))
        .where(F.col(score) > spec.anomaly_sigma)
        .withColumn("outlier", F.lit(True))
    )
