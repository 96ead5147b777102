"""The same queries as DuckDB SQL, written as plain joins and aggregates."""

from __future__ import annotations

from checks.queries import OTHER_SLOTS, PER_SLOT, digits

METRICS = ("v", "mx", "n")

RANGE_SCAN = """
SELECT event_id, ts, user_id, event_type, value, props
FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-02'
"""

HOURLY_SLOTS = """
WITH span AS (
  SELECT CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) AS first_slot,
         CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) + INTERVAL 23 HOUR AS last_slot
  FROM events
), slots AS (
  SELECT unnest(generate_series(first_slot, last_slot, INTERVAL 1 HOUR)) AS slot_ts FROM span
)
SELECT slot_ts, CAST(hour(slot_ts) AS INTEGER) AS hour FROM slots
"""

STEPS = """
WITH readings AS (
  SELECT {e}, time_bucket(INTERVAL '{minutes} minutes', ts) AS slot_ts,
         avg(value) AS v, max(value) AS mx, CAST(count(*) AS DOUBLE) AS n
  FROM events
  WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31'
  GROUP BY 1, 2
), slots AS (
  SELECT unnest(range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL '{minutes} minutes')) AS slot_ts
), entities AS (
  SELECT DISTINCT {e} FROM readings
), grid AS (
  SELECT {e}, slot_ts, CAST(hour(slot_ts) AS INTEGER) AS hour FROM entities CROSS JOIN slots
), expanded AS (
  SELECT g.{e}, g.slot_ts, g.hour, r.v, r.mx, r.n
  FROM grid g LEFT JOIN readings r ON r.{e} = g.{e} AND r.slot_ts = g.slot_ts
), baseline AS (
  SELECT {e}, hour,
         avg(v) AS v_mean, avg(mx) AS mx_mean, avg(n) AS n_mean,
         stddev_samp(v) AS v_stddev, stddev_samp(mx) AS mx_stddev, stddev_samp(n) AS n_stddev
  FROM expanded GROUP BY {e}, hour
), filled AS (
  SELECT x.{e}, x.hour, x.slot_ts,
         coalesce(x.v, b.v_mean) AS v, coalesce(x.mx, b.mx_mean) AS mx, coalesce(x.n, b.n_mean) AS n,
         b.v_mean, b.mx_mean, b.n_mean, b.v_stddev, b.mx_stddev, b.n_stddev
  FROM expanded x JOIN baseline b ON b.{e} = x.{e} AND b.hour = x.hour
), scored AS (
  SELECT *,
         abs((v - v_mean) / nullif(v_stddev, 0)) AS zscore_v,
         abs((mx - mx_mean) / nullif(mx_stddev, 0)) AS zscore_mx,
         abs((n - n_mean) / nullif(n_stddev, 0)) AS zscore_n
  FROM filled
), cleaned AS (
  SELECT {e}, hour, slot_ts,
         CASE WHEN zscore_v > 3 THEN v_mean ELSE v END AS v,
         CASE WHEN zscore_mx > 3 THEN mx_mean ELSE mx END AS mx,
         CASE WHEN zscore_n > 3 THEN n_mean ELSE n END AS n,
         v_mean, mx_mean, n_mean, v_stddev, mx_stddev, n_stddev
  FROM scored
), daily AS (
  SELECT CAST(slot_ts AS DATE) AS date, {e},
         avg(v) AS v_mean, min(v) AS v_min, max(v) AS v_max, stddev_samp(v) AS v_stddev
  FROM cleaned GROUP BY 1, 2
), anomalies AS (
  SELECT * FROM (SELECT *, abs((v - v_mean) / nullif(v_stddev, 0)) AS zscore_v FROM cleaned) AS rescored
  WHERE zscore_v > 2
)
"""

PARTS = """CAST(year({day}) AS INTEGER) AS year, CAST(month({day}) AS INTEGER) AS month,
CAST(day({day}) AS INTEGER) AS day"""


def _round(*columns: str) -> str:
    return ", ".join(f"round({c}, {digits(c)}) AS {c}" for c in columns)


MEANS = [f"{m}_mean" for m in METRICS]
STDDEVS = [f"{m}_stddev" for m in METRICS]
CLEANED = "{e}, hour, slot_ts, " + _round(*METRICS, *MEANS, *STDDEVS)
DAILY = "date, {e}, " + _round("v_mean", "v_min", "v_max", "v_stddev")
ANOMALIES = CLEANED + ", " + _round("zscore_v") + ", true AS outlier"

TAILS = {
    "daily_summary": f"SELECT {DAILY} FROM daily",
    "readings_hourly": f"SELECT {{e}}, slot_ts, {_round(*METRICS)} FROM readings",
    "null_audit": """
SELECT count(*) AS rows,
       count(*) - count({e}) AS null_{e}, count(*) - count(slot_ts) AS null_slot_ts,
       count(*) - count(v) AS null_v, count(*) - count(mx) AS null_mx, count(*) - count(n) AS null_n
FROM expanded""",
    "readings_audit": """
SELECT count(*) AS rows,
       count(*) - count({e}) AS null_{e}, count(*) - count(ts) AS null_ts, count(*) - count(value) AS null_value,
       count(*) FILTER (WHERE ts <> date_trunc('hour', ts)
                        OR ts < TIMESTAMP '2024-01-01' OR ts >= TIMESTAMP '2024-01-31') AS off_slot
FROM events""",
    "repeated_slots": "SELECT {e}, slot_ts, CAST(n AS BIGINT) AS copies FROM readings WHERE n > 1",
    "distinct_entities": "SELECT {e} FROM entities",
    "expected_grid": "SELECT {e}, slot_ts, hour FROM grid",
    "gap_expand": f"SELECT {{e}}, slot_ts, hour, {_round(*METRICS)} FROM expanded",
    "missing_slots": "SELECT g.{e}, g.slot_ts, g.hour FROM grid g ANTI JOIN readings r USING ({e}, slot_ts)",
    "hourly_baseline": f"SELECT {{e}}, hour, {_round(*MEANS, *STDDEVS)} FROM baseline",
    "baseline_from_state": f"SELECT {{e}}, hour, {_round(*MEANS, *STDDEVS)} FROM baseline",
    "moving_baseline": f"""
, spans AS (
  SELECT unnest(range(DATE '2024-01-01', DATE '2024-01-18', INTERVAL 4 DAY)) AS begin
), inside AS (
  SELECT s.begin, r.* FROM spans s
  JOIN readings r ON r.slot_ts >= s.begin AND r.slot_ts < s.begin + INTERVAL 14 DAY
), hours AS (
  SELECT b.begin, b.{{e}}, CAST(h.hour AS INTEGER) AS hour
  FROM (SELECT DISTINCT begin, {{e}} FROM inside) b CROSS JOIN range(24) AS h(hour)
), windowed AS (
  SELECT CAST(g.begin AS DATE) AS date, g.{{e}}, g.hour,
         avg(v) AS v_mean, avg(mx) AS mx_mean, avg(n) AS n_mean,
         stddev_samp(v) AS v_stddev, stddev_samp(mx) AS mx_stddev, stddev_samp(n) AS n_stddev
  FROM hours g LEFT JOIN inside i ON i.begin = g.begin AND i.{{e}} = g.{{e}} AND hour(i.slot_ts) = g.hour
  GROUP BY 1, 2, 3
)
SELECT date, {{e}}, hour, {_round(*MEANS, *STDDEVS)} FROM windowed""",
    "device_history": f"SELECT {CLEANED} FROM cleaned WHERE {{e}} = (SELECT min({{e}}) FROM cleaned)",
    "impute_gaps": f"SELECT {CLEANED} FROM filled",
    "zscores": "SELECT {e}, hour, slot_ts, " + _round("zscore_v", "zscore_mx", "zscore_n") + " FROM scored",
    "mask_outliers": f"SELECT {CLEANED} FROM cleaned",
    "mask_outliers_one_shuffle": f"SELECT {CLEANED} FROM cleaned",
    "anomalies": f"SELECT {ANOMALIES} FROM anomalies",
    "date_partition_cols": f"SELECT {CLEANED}, {PARTS.format(day='slot_ts')} FROM cleaned",
    "upsert_daily": """
SELECT date, {e}, CASE WHEN date < DATE '2024-01-11' THEN CAST(-1.0 AS DOUBLE) ELSE round(v_mean, 9) END AS v_mean, """
    + _round("v_min", "v_max", "v_stddev")
    + " FROM daily",
    "upsert_cleaned": """
SELECT {e}, hour, slot_ts,
       CASE WHEN slot_ts < TIMESTAMP '2024-01-11' THEN CAST(-1.0 AS DOUBLE) ELSE round(v, 9) END AS v, """
    + _round("mx", "n", *MEANS, *STDDEVS)
    + " FROM cleaned",
    "json_sink_roundtrip": f"SELECT {DAILY}, {PARTS.format(day='date')} FROM daily",
    "json_cleaned_roundtrip": f"SELECT {CLEANED}, {PARTS.format(day='slot_ts')} FROM cleaned",
    "csv_sink_roundtrip": f"SELECT {ANOMALIES} FROM anomalies",
    "incomplete_rows": "SELECT g.{e}, g.slot_ts, g.hour FROM grid g ANTI JOIN readings r USING ({e}, slot_ts)",
    "csv_corrupt_audit": """
SELECT count(*) AS rows, count(*) FILTER (WHERE event_id % 10 = 0) AS corrupt,
       CAST(0 AS BIGINT) AS null_{e}, CAST(0 AS BIGINT) AS null_ts, CAST(0 AS BIGINT) AS null_value
FROM events""",
    "json_merge_roundtrip": f"SELECT {CLEANED} FROM cleaned",
    "stage_roundtrip": f"SELECT {DAILY} FROM daily",
}


def all_oracles() -> dict[str, str]:
    found = {"range_scan": RANGE_SCAN, "csv_scan": RANGE_SCAN, "pruned_csv_scan": RANGE_SCAN, "hourly_slots": HOURLY_SLOTS}
    for name, tail in TAILS.items():
        found[name] = (STEPS + tail).format(e="event_type", minutes=60)
        found[f"{name}_by_user"] = (STEPS + tail).format(e="user_id", minutes=60)
    for name in PER_SLOT:
        for label, slot in OTHER_SLOTS.items():
            sql = (STEPS + TAILS[name]).format(e="event_type", minutes=int(slot.total_seconds()) // 60)
            found[f"{name}_{label}"] = sql
    found["missing_slots_minutely"] = (STEPS + TAILS["missing_slots"]).format(e="event_type", minutes=1)
    return found
