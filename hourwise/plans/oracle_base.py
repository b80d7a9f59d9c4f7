"""Independent DuckDB SQL for the shared tables (the correctness oracle).

Written from the operator definitions, not generated from the Spark plans.
``with_tables(view, upto)`` returns a WITH prefix that defines the CTEs
``raw``, ``hourly``, ``feat`` and ``lab`` for the chosen view.
"""
from __future__ import annotations

EVENTS_SQL = """
SELECT event_id AS row_id, event_type AS sensor,
       CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date_time,
       CASE WHEN date_trunc('hour', ts) = TIMESTAMP '2024-01-01 00:00:00' THEN 'New Years Day'
            WHEN date_trunc('hour', ts) = TIMESTAMP '2024-01-15 00:00:00' THEN 'Labor Day'
            ELSE 'None' END AS holiday,
       CAST(CASE WHEN event_id % 997 = 0 THEN 0.0
            ELSE 250 + 0.5 * CAST(json_extract(props, '$.k') AS INTEGER) END AS DOUBLE) AS temp,
       CAST(CASE WHEN event_id % 1009 = 0 THEN 9831.3
            WHEN event_type = 'error' THEN value / 10 ELSE 0.0 END AS DOUBLE) AS rain_1h,
       CAST(CASE WHEN event_type = 'signup' AND event_id % 3 = 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS snow_1h,
       CAST(user_id % 101 AS DOUBLE) AS clouds_all,
       CASE event_type WHEN 'click' THEN 'Clear' WHEN 'view' THEN 'Clouds' WHEN 'error' THEN 'Rain'
            WHEN 'purchase' THEN 'Fog' ELSE 'Thunderstorm' END AS weather_main,
       CASE WHEN event_id % 7 = 0 THEN 'Sky is ' || event_type
            ELSE 'sky is ' || event_type END AS weather_description,
       CAST(floor(value * 10) AS BIGINT) AS traffic_volume
FROM events"""

ORDERS_SQL = """
SELECT o_orderkey AS row_id, o_orderstatus AS sensor,
       o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS date_time,
       CASE WHEN strftime(o_orderdate, '%m-%d') = '09-04' AND o_orderkey % 3 = 0
            THEN 'Labor Day' ELSE 'None' END AS holiday,
       CAST(CASE WHEN o_orderkey % 499 = 0 THEN 0.0 ELSE 260 + (o_custkey % 400) / 10.0 END AS DOUBLE) AS temp,
       CAST(0 AS DOUBLE) AS rain_1h, CAST(0 AS DOUBLE) AS snow_1h, CAST(o_custkey % 101 AS DOUBLE) AS clouds_all,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Clear' WHEN '2' THEN 'Clouds'
            WHEN '3' THEN 'Rain' WHEN '4' THEN 'Fog' ELSE 'Thunderstorm' END AS weather_main,
       lower(o_orderpriority) AS weather_description,
       CAST(floor(o_totalprice / 100) AS BIGINT) AS traffic_volume
FROM orders"""

RAW = {"events": EVENTS_SQL, "orders": ORDERS_SQL}

CLEAN_CTES = """
std AS (
  SELECT row_id, sensor, date_time, lower(trim(holiday)) AS holiday, temp, rain_1h, snow_1h, clouds_all,
         lower(trim(weather_main)) AS weather_main, lower(trim(weather_description)) AS weather_description,
         traffic_volume
  FROM raw WHERE date_time IS NOT NULL),
dedup AS (
  SELECT * FROM std QUALIFY row_number() OVER (PARTITION BY sensor, date_time ORDER BY row_id) = 1),
tmed AS (SELECT month(date_time) AS m, median(temp) FILTER (WHERE NOT coalesce(temp < 1.0, false)) AS med
         FROM dedup GROUP BY 1),
tall AS (SELECT median(temp) FILTER (WHERE NOT coalesce(temp < 1.0, false)) AS med FROM dedup),
timp AS (
  SELECT d.* REPLACE (CASE WHEN coalesce(d.temp < 1.0, false) THEN coalesce(tmed.med, tall.med)
                           ELSE d.temp END AS temp)
  FROM dedup d LEFT JOIN tmed ON month(d.date_time) = tmed.m CROSS JOIN tall),
rmed AS (SELECT month(date_time) AS m, median(rain_1h) FILTER (WHERE NOT coalesce(rain_1h > 9000, false)) AS med
         FROM timp GROUP BY 1),
rall AS (SELECT median(rain_1h) FILTER (WHERE NOT coalesce(rain_1h > 9000, false)) AS med FROM timp),
hourly AS (
  SELECT d.* REPLACE (CASE WHEN coalesce(d.rain_1h > 9000, false) THEN coalesce(rmed.med, rall.med)
                           ELSE d.rain_1h END AS rain_1h)
  FROM timp d LEFT JOIN rmed ON month(d.date_time) = rmed.m CROSS JOIN rall)"""

WEATHER = ["clear", "clouds", "drizzle", "fog", "haze", "mist", "rain", "smoke", "snow", "squall", "thunderstorm"]

FEATURE_CTES = """
stats AS (
  SELECT avg(temp) AS temp_mean, stddev_samp(temp) AS temp_std, min(clouds_all) AS clouds_min,
         max(clouds_all) AS clouds_max, quantile_cont(traffic_volume, 0.25) AS q1,
         quantile_cont(traffic_volume, 0.5) AS q2, quantile_cont(traffic_volume, 0.75) AS q3
  FROM hourly),
feat AS (
  SELECT h.*,
         CAST(hour(date_time) AS INTEGER) AS hour,
         CAST(isodow(date_time) - 1 AS INTEGER) AS day_of_week,
         dayname(date_time) AS day_name,
         CASE WHEN isodow(date_time) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         sin(2 * pi() * hour(date_time) / 24.0) AS hour_sin,
         cos(2 * pi() * hour(date_time) / 24.0) AS hour_cos,
         sin(2 * pi() * (isodow(date_time) - 1) / 7.0) AS dow_sin,
         cos(2 * pi() * (isodow(date_time) - 1) / 7.0) AS dow_cos,
         """ + ",\n         ".join(
    f"CASE WHEN weather_main = '{w}' THEN 1 ELSE 0 END AS weather_{w}" for w in WEATHER) + """,
         CASE WHEN rain_1h > 0 OR snow_1h > 0 THEN 1 ELSE 0 END AS is_precipitating,
         CASE WHEN weather_main IN ('thunderstorm', 'squall') THEN 1 ELSE 0 END AS is_severe_weather,
         CASE WHEN weather_main IN ('fog', 'mist', 'haze', 'smoke') THEN 1 ELSE 0 END AS is_low_visibility,
         (temp - s.temp_mean) / s.temp_std AS temp_zscore,
         (clouds_all - s.clouds_min) / nullif(s.clouds_max - s.clouds_min, 0) AS clouds_all_minmax,
         CASE WHEN traffic_volume <= s.q1 THEN 'Low' WHEN traffic_volume <= s.q2 THEN 'Medium'
              WHEN traffic_volume <= s.q3 THEN 'High' WHEN traffic_volume IS NOT NULL THEN 'Very High'
         END AS congestion_category,
         CASE WHEN traffic_volume <= s.q1 THEN 'Low' WHEN traffic_volume <= s.q2 THEN 'Medium'
              WHEN traffic_volume <= s.q3 THEN 'High' WHEN traffic_volume IS NOT NULL THEN 'Severe'
         END AS congestion_category_p3
  FROM hourly h CROSS JOIN stats s),
lab AS (
  SELECT *,
         CASE WHEN coalesce(lower(holiday) <> 'none', true) THEN 1 ELSE 0 END AS holiday_flag,
         CAST(month(date_time) AS INTEGER) AS month,
         CAST(year(date_time) AS INTEGER) AS year,
         CASE WHEN congestion_category_p3 IN ('High', 'Severe')
                   AND (weather_main IN ('thunderstorm', 'squall') OR is_low_visibility = 1)
              THEN 1 ELSE 0 END AS high_risk,
         CASE WHEN weather_main = 'clear' THEN 0 WHEN weather_main = 'clouds' THEN 1
              WHEN weather_main IN ('fog', 'mist', 'haze', 'smoke') THEN 3
              WHEN weather_main IN ('thunderstorm', 'squall') THEN 4 ELSE 2 END AS weather_severity,
         CASE WHEN hour > -0.1 AND hour <= 5 THEN 'Overnight (0-5)' WHEN hour <= 9 THEN 'Morning Rush (6-9)'
              WHEN hour <= 15 THEN 'Midday (10-15)' WHEN hour <= 18 THEN 'Evening Rush (16-18)'
              WHEN hour <= 23 THEN 'Evening (19-23)' END AS time_of_day
  FROM feat)"""


CTE_NAMES = ["raw", "std", "dedup", "tmed", "tall", "timp", "rmed", "rall", "hourly", "stats", "feat", "lab"]


def with_tables(view: str = "events", upto: str = "lab", suffix: str = "") -> str:
    """WITH prefix defining raw → hourly (→ feat → lab); ``suffix`` renames every
    CTE (e.g. ``hourly_o``) so two views can be chained in one statement."""
    parts = [f"raw AS ({RAW[view]})"]
    if upto != "raw":
        parts.append(CLEAN_CTES.strip())
    if upto in ("feat", "lab"):
        parts.append(FEATURE_CTES.strip() if upto == "lab" else FEATURE_CTES.strip().rsplit(",\nlab AS", 1)[0])
    body = ",\n".join(parts)
    if suffix:   # none of these names is also a column name or a string literal
        import re
        body = re.sub(r"\b(" + "|".join(CTE_NAMES) + r")\b", lambda m: m.group(1) + suffix, body)
    return "WITH " + body + "\n"
