"""Views that shape the driver's test tables like raw hourly sensor readings.

Each adapter is a projection over one given table, so its work grows with the
table and every filter/column prune reaches the Parquet scan.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hour_floor(ts) -> F.Column:
    # date_trunc on TIMESTAMP_NTZ yields TIMESTAMP; cast back so the column
    # stays zone-free (the session zone is pinned to UTC for the round trip).
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def readings_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw readings: one row per event, several per hour and sensor."""
    pin_utc(spark)
    return events_to_readings(table(spark, sf_dir, "events"))


def events_to_readings(e: DataFrame) -> DataFrame:
    """The events → readings projection (batch or streaming input)."""
    hour = _hour_floor(F.col("ts"))
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.col("event_id").alias("row_id"),
        F.col("event_type").alias("sensor"),
        hour.alias("date_time"),
        F.when(hour == F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), "New Years Day")
         .when(hour == F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"), "Labor Day")
         .otherwise("None").alias("holiday"),
        F.when(F.col("event_id") % 997 == 0, F.lit(0.0))
         .otherwise(F.lit(250.0) + F.lit(0.5) * k).cast("double").alias("temp"),
        F.when(F.col("event_id") % 1009 == 0, F.lit(9831.3))
         .when(F.col("event_type") == "error", F.col("value") / 10)
         .otherwise(F.lit(0.0)).cast("double").alias("rain_1h"),
        F.when((F.col("event_type") == "signup") & (F.col("event_id") % 3 == 0), F.lit(1.0))
         .otherwise(F.lit(0.0)).alias("snow_1h"),
        (F.col("user_id") % 101).cast("double").alias("clouds_all"),
        F.when(F.col("event_type") == "click", "Clear").when(F.col("event_type") == "view", "Clouds")
         .when(F.col("event_type") == "error", "Rain").when(F.col("event_type") == "purchase", "Fog")
         .otherwise("Thunderstorm").alias("weather_main"),
        F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("Sky is "), F.col("event_type")))
         .otherwise(F.concat(F.lit("sky is "), F.col("event_type"))).alias("weather_description"),
        F.floor(F.col("value") * 10).cast("bigint").alias("traffic_volume"),
    )


def readings_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as raw readings over several years (month medians, yearly trends)."""
    pin_utc(spark)
    return orders_to_readings(table(spark, sf_dir, "orders"))


def orders_to_readings(o: DataFrame) -> DataFrame:
    """The orders → readings projection (batch or streaming input)."""
    prio = F.substring("o_orderpriority", 1, 1)
    return o.select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_orderstatus").alias("sensor"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int")))
        .alias("date_time"),
        F.when((F.date_format("o_orderdate", "MM-dd") == "09-04") & (F.col("o_orderkey") % 3 == 0),
               "Labor Day").otherwise("None").alias("holiday"),
        F.when(F.col("o_orderkey") % 499 == 0, F.lit(0.0))
         .otherwise(F.lit(260.0) + (F.col("o_custkey") % 400).cast("double") / 10.0)
         .cast("double").alias("temp"),
        F.lit(0.0).alias("rain_1h"),
        F.lit(0.0).alias("snow_1h"),
        (F.col("o_custkey") % 101).cast("double").alias("clouds_all"),
        F.when(prio == "1", "Clear").when(prio == "2", "Clouds").when(prio == "3", "Rain")
         .when(prio == "4", "Fog").otherwise("Thunderstorm").alias("weather_main"),
        F.lower("o_orderpriority").alias("weather_description"),
        F.floor(F.col("o_totalprice") / 100).cast("bigint").alias("traffic_volume"),
    )


VIEWS = {"events": readings_events, "orders": readings_orders}
