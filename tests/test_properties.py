"""Random readings against plain pandas, and what must hold for any of them."""

from datetime import timedelta

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import ONE, assert_frames, brute_fill, brute_mask
from slotwise import Period, clean
from slotwise.functions import zscore
from slotwise.operators import anomalies, fill_gaps, mask_outliers
from slotwise.operators.baseline import JoinLimits

PERIOD = Period.of("2024-03-01", "2024-03-15")
FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

# Most readings are ordinary and fall into a few hours; some are extreme.
value = st.one_of(st.integers(0, 20).map(float), st.sampled_from([500.0, -500.0]))
reading = st.tuples(st.integers(1, 3), st.integers(0, 13), st.integers(0, 3), value)
readings = st.lists(reading, min_size=1, max_size=120).map(
    lambda rows: [(i, PERIOD.start + timedelta(days=d, hours=h), x) for i, d, h, x in rows]
)
limits = st.sampled_from([JoinLimits(), JoinLimits(broadcast_bytes=0, task_rows=5)])


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, ts timestamp_ntz, x double")


@FEW
@given(rows=readings, limits=limits)
def test_cleaning_matches_pandas(spark, rows, limits):
    expected = brute_mask(brute_fill(rows, ONE, PERIOD), ONE)
    assert_frames(clean(frame(spark, rows), ONE, PERIOD, limits=limits), expected, ONE)


@FEW
@given(rows=readings)
def test_invariants(spark, rows):
    unique = list({(i, t): (i, t, x) for i, t, x in rows}.values())
    filled = fill_gaps(frame(spark, unique), ONE, PERIOD)
    cleaned = mask_outliers(filled, ONE)
    entities = len({i for i, _, _ in unique})
    assert cleaned.count() == entities * 24 * PERIOD.days

    masked = filled.where(zscore("x") > ONE.mask_sigma).select("id", "ts")
    in_both = cleaned.join(masked, ["id", "ts"])
    assert in_both.where(F.col("x") != F.col("x_mean")).count() == 0
    assert anomalies(cleaned, ONE).join(masked, ["id", "ts"]).count() == 0

    again = fill_gaps(filled.select("id", "ts", "x").where("x is not null"), ONE, PERIOD)
    both = again.select("id", "ts", F.col("x").alias("second")).join(filled, ["id", "ts"])
    assert both.where("second is not null or x is not null").where("not abs(second - x) < 1e-9").count() == 0
