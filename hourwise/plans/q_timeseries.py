"""Registered time-series queries on the events view, with
``sensor`` as the series key (at sf0.01 each sensor's hourly series has gaps)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import timeseries as TSO
from . import tables
from .oracle_base import with_tables
from .registry import query, rnd, rounded

EV = "events"
SEQUENCE_FEATURES = [
    "traffic_volume_scaled", "hour_sin", "hour_cos", "dow_sin", "dow_cos",
    "is_weekend", "temp_zscore", "is_precipitating", "is_severe_weather",
    "is_low_visibility", "holiday_flag",
]
ASOF_FEATURES = ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "is_weekend", "holiday_flag",
                 "temp_zscore", "is_precipitating", "is_severe_weather", "is_low_visibility"]

BLOCKS_SQL = with_tables(EV) + """
, blk0 AS (SELECT *, lag(date_time) OVER (PARTITION BY sensor ORDER BY date_time) AS prev_t FROM lab),
blk1 AS (SELECT *, CASE WHEN prev_t IS NULL OR epoch(date_time) - epoch(prev_t) > 3600 THEN 1 ELSE 0 END
                   AS is_block_start FROM blk0),
blocks AS (SELECT *, max(CASE WHEN is_block_start = 1 THEN date_time END) OVER (PARTITION BY sensor
                   ORDER BY date_time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS block_start FROM blk1),
tg AS (SELECT *, count(*) OVER (PARTITION BY sensor, block_start ORDER BY date_time
                   ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS n_prev FROM blocks),
targets AS (SELECT * FROM tg WHERE n_prev = 24),
ranked AS (SELECT *, row_number() OVER (ORDER BY date_time, sensor) - 1 AS rk, count(*) OVER () AS n FROM targets),
splits AS (SELECT *, CASE WHEN rk < floor(n * 0.7) THEN 'train' WHEN rk < floor(n * 0.7) + floor(n * 0.1) THEN 'val'
                          ELSE 'test' END AS split,
                     n - floor(n * 0.7) - floor(n * 0.1) AS n_test,
                     rk - floor(n * 0.7) - floor(n * 0.1) AS pos FROM ranked)
"""


def blocks(spark, sf):
    return tables.blocks(spark, sf, EV)


def targets(spark, sf):
    """Rows that have a full 24-row history in their block, split 70/10/20."""
    b = blocks(spark, sf)
    return b, TSO.three_way_split(TSO.full_history(b))


@query("contiguous_blocks", BLOCKS_SQL + "SELECT sensor, date_time, is_block_start, block_start FROM blocks")
def q_blocks(spark, sf):
    return blocks(spark, sf).select("sensor", "date_time", "is_block_start", "block_start")


@query("block_sizes", BLOCKS_SQL + """SELECT sensor, block_start, count(*) AS n_rows,
       CASE WHEN count(*) > 24 THEN 1 ELSE 0 END AS usable FROM blocks GROUP BY 1, 2""")
def q_block_sizes(spark, sf):
    return TSO.block_sizes(blocks(spark, sf))


LAG_SQL = """lag(traffic_volume, 1) OVER w AS lag_1, lag(traffic_volume, 24) OVER w AS lag_24,
       CASE WHEN count(traffic_volume) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) = 6
            THEN avg(traffic_volume) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) END AS roll_mean_6,
       CASE WHEN count(traffic_volume) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) = 24
            THEN avg(traffic_volume) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) END AS roll_mean_24"""


@query("lag_features", rnd(BLOCKS_SQL + f"""SELECT sensor, date_time, {LAG_SQL}
FROM blocks WINDOW w AS (PARTITION BY sensor, block_start ORDER BY date_time)""", "roll_mean_6 roll_mean_24"))
def q_lags(spark, sf):
    out = TSO.lag_features(blocks(spark, sf))
    return rounded(out.select("sensor", "date_time", "lag_1", "lag_24", "roll_mean_6", "roll_mean_24"))


@query("rolling_means", rnd(BLOCKS_SQL + f"""SELECT sensor, date_time, roll_mean_6, roll_mean_24 FROM (
SELECT sensor, date_time, {LAG_SQL} FROM blocks WINDOW w AS (PARTITION BY sensor, block_start ORDER BY date_time))""",
                            "roll_mean_6 roll_mean_24"))
def q_rolls(spark, sf):
    out = TSO.lag_features(blocks(spark, sf), lags=(), rolls=(6, 24))
    return rounded(out.select("sensor", "date_time", "roll_mean_6", "roll_mean_24"))


@query("sequence_windows", BLOCKS_SQL + """SELECT sensor, date_time,
       array_to_string(list(CAST(traffic_volume AS VARCHAR)) OVER w, ',') AS window_volumes,
       array_to_string(list(CAST(weather_severity AS VARCHAR)) OVER w, ',') AS window_severity
FROM blocks
WINDOW w AS (PARTITION BY sensor, block_start ORDER BY date_time ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)
QUALIFY count(*) OVER w = 24""")
def q_sequences(spark, sf):
    seq = TSO.sequence_windows(blocks(spark, sf), ["traffic_volume", "weather_severity"])
    as_text = lambda f: F.array_join(F.transform("window", lambda x: x[f].cast("bigint").cast("string")), ",")
    return seq.select("sensor", "date_time", as_text("traffic_volume").alias("window_volumes"),
                      as_text("weather_severity").alias("window_severity"))


@query("three_way_split", BLOCKS_SQL + """SELECT sensor, date_time, split,
       CASE WHEN split = 'test' THEN CAST(pos AS BIGINT) END AS test_pos FROM splits""")
def q_three_way(spark, sf):
    _, t = targets(spark, sf)
    return t.select("sensor", "date_time", "split", F.col("test_pos").cast("bigint").alias("test_pos"))


@query("chronological_split", with_tables(EV) + """
, r AS (SELECT *, row_number() OVER (ORDER BY date_time, sensor) - 1 AS rk, count(*) OVER () AS n FROM lab)
SELECT sensor, date_time, CASE WHEN rk < floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM r""")
def q_chrono(spark, sf):
    return TSO.chronological_split(tables.labelled(spark, sf, EV), 0.2).select("sensor", "date_time", "split")


@query("train_only_scaling", rnd(BLOCKS_SQL + """
, flagged AS (SELECT b.*, CASE WHEN s.split = 'train' THEN 1 ELSE 0 END AS is_train
              FROM blocks b LEFT JOIN splits s ON b.sensor = s.sensor AND b.date_time = s.date_time),
cov AS (SELECT *, max(is_train) OVER (PARTITION BY sensor, block_start ORDER BY date_time
                  ROWS BETWEEN CURRENT ROW AND 24 FOLLOWING) AS covered FROM flagged)
SELECT avg(traffic_volume) AS scaler_mean, stddev_samp(traffic_volume) AS scaler_std, count(*) AS n_rows
FROM cov WHERE covered = 1""", "scaler_mean scaler_std"))
def q_train_scaling(spark, sf):
    b, t = targets(spark, sf)
    flagged = b.join(t.select("sensor", "date_time", "split"), ["sensor", "date_time"], "left")
    return rounded(TSO.train_only_scaling(flagged))


@query("asof_features", rnd(BLOCKS_SQL + """SELECT sensor, date_time,
       lag(temp_zscore, 1) OVER w AS asof_temp_zscore, lag(is_weekend, 1) OVER w AS asof_is_weekend,
       lag(hour_sin, 1) OVER w AS asof_hour_sin, lag(holiday_flag, 1) OVER w AS asof_holiday_flag
FROM blocks WINDOW w AS (PARTITION BY sensor, block_start ORDER BY date_time)""", "asof_temp_zscore asof_hour_sin"))
def q_asof_features(spark, sf):
    out = TSO.asof_features(blocks(spark, sf), ["temp_zscore", "is_weekend", "hour_sin", "holiday_flag"])
    return rounded(out.select("sensor", "date_time", "asof_temp_zscore", "asof_is_weekend", "asof_hour_sin",
                              "asof_holiday_flag"))


@query("forecast_slice", BLOCKS_SQL + """SELECT sensor, date_time, CAST(pos AS BIGINT) AS test_pos, traffic_volume
FROM splits WHERE split = 'test' AND pos >= floor(n_test / 3) AND pos < floor(n_test / 3) + 336""")
def q_forecast_slice(spark, sf):
    _, t = targets(spark, sf)
    s = TSO.forecast_slice(t.filter(F.col("split") == "test"))
    return s.select("sensor", "date_time", F.col("test_pos").cast("bigint").alias("test_pos"), "traffic_volume")
