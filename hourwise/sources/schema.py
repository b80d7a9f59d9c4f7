"""Declared schemas and metadata-only schema gates (no Spark job is started)."""
from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import COMMON_FEATURE_COLUMNS, WEATHER_CATEGORIES

log = logging.getLogger(__name__)

EXPECTED_RAW_COLUMNS = [
    "holiday", "temp", "rain_1h", "snow_1h", "clouds_all",
    "weather_main", "weather_description", "date_time", "traffic_volume",
]

RAW_READING_SCHEMA = T.StructType([
    T.StructField("holiday", T.StringType()),
    T.StructField("temp", T.DoubleType()),
    T.StructField("rain_1h", T.DoubleType()),
    T.StructField("snow_1h", T.DoubleType()),
    T.StructField("clouds_all", T.DoubleType()),
    T.StructField("weather_main", T.StringType()),
    T.StructField("weather_description", T.StringType()),
    T.StructField("date_time", T.StringType()),
    T.StructField("traffic_volume", T.LongType()),
])


class SchemaValidationError(ValueError):
    pass


def schema_gate(df: DataFrame, expected: list[str] = EXPECTED_RAW_COLUMNS,
                strict: bool = False) -> DataFrame:
    """Missing expected columns raise; extra columns are reported and kept
    (or dropped when ``strict``). Reads only ``df.columns``."""
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise SchemaValidationError(f"Missing expected columns: {missing}")
    extra = [c for c in df.columns if c not in expected]
    if extra:
        log.warning("%d unexpected column(s) present: %s", len(extra), extra)
        if strict:
            return df.select(*expected)
    return df


def required_columns_gate(df: DataFrame, required: list[str] = COMMON_FEATURE_COLUMNS) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SchemaValidationError(f"Dataset is missing required column(s): {missing}")
    return df


def reading_contract_reason(df: DataFrame, ts_col: str = "date_time") -> Column:
    """First failed rule of the typed reading contract, NULL when the row is valid:
    clouds in [0, 100], rain and snow >= 0, a known weather value, a parseable time."""
    ts = F.col(ts_col)
    parsed = ts if dict(df.dtypes)[ts_col] != "string" else F.try_to_timestamp(ts)
    w = F.lower(F.trim(F.col("weather_main")))
    return (F.when(parsed.isNull(), "unparseable date_time")
            .when(F.col("clouds_all").isNull() | (F.col("clouds_all") < 0) | (F.col("clouds_all") > 100),
                  "clouds_all out of range")
            .when(F.col("rain_1h").isNull() | (F.col("rain_1h") < 0), "rain_1h negative")
            .when(F.col("snow_1h").isNull() | (F.col("snow_1h") < 0), "snow_1h negative")
            .when(w.isNull() | ~w.isin(WEATHER_CATEGORIES), "unknown weather_main"))


def reading_contract(df: DataFrame, ts_col: str = "date_time") -> DataFrame:
    """Adds ``valid`` and ``reject_reason``; split with ``accepted``/``rejected``."""
    reason = reading_contract_reason(df, ts_col)
    return df.withColumn("reject_reason", reason).withColumn("valid", F.col("reject_reason").isNull())


def accepted(df: DataFrame) -> DataFrame:
    return df.filter("valid").drop("valid", "reject_reason")


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("valid"))
