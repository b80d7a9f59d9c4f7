"""Feature engineering.

Whole-table statistics (mean/std, min/max, quartiles) are computed in ONE
one-row aggregate and broadcast-cross-joined back: one extra scan with
map-side partial aggregation, no global window, nothing collected to the driver.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..sources.schema import required_columns_gate
from .prefix import exact_quantiles

STAT_COLS = ["_temp_mean", "_temp_std", "_clouds_min", "_clouds_max", "_q1", "_q2", "_q3"]


def time_features(df: DataFrame, ts: str = "date_time") -> DataFrame:
    return df.withColumns({
        "hour": C.hour_of(ts), "day_of_week": C.day_of_week(ts),
        "day_name": C.day_name(ts), "is_weekend": C.is_weekend(ts)})


def cyclical_encode(df: DataFrame, hour: str = "hour", dow: str = "day_of_week") -> DataFrame:
    return df.withColumns({
        "hour_sin": C.cyc_sin(hour, 24), "hour_cos": C.cyc_cos(hour, 24),
        "dow_sin": C.cyc_sin(dow, 7), "dow_cos": C.cyc_cos(dow, 7)})


def calendar_extras(df: DataFrame, ts: str = "date_time") -> DataFrame:
    return df.withColumns({"month": F.month(ts), "year": F.year(ts)})


def add_holiday_flag(df: DataFrame, holiday: str = "holiday") -> DataFrame:
    return df.withColumn("holiday_flag", C.holiday_flag(holiday))


def one_hot_weather(df: DataFrame, weather: str = "weather_main",
                    categories: Sequence[str] | None = C.WEATHER_CATEGORIES) -> DataFrame:
    """``weather_<value>`` 0/1 columns. With ``categories=None`` the values seen
    in the data are used (one distinct over a low-cardinality column)."""
    if categories is None:
        categories = sorted(r[0] for r in df.select(weather).distinct().dropna().collect())
    return df.withColumns({f"weather_{v}": C.one_hot(weather, v) for v in categories})


def weather_indicators(df: DataFrame, weather: str = "weather_main") -> DataFrame:
    return df.withColumns({
        "is_precipitating": C.is_precipitating("rain_1h", "snow_1h"),
        "is_severe_weather": C.is_severe(weather),
        "is_low_visibility": C.is_low_visibility(weather)})


def table_stats(df: DataFrame) -> DataFrame:
    """One row: temp mean / sample std, clouds min / max, volume quartiles
    (exact linear interpolation, from the counts of the distinct values)."""
    plain = df.agg(F.avg("temp").alias("_temp_mean"), F.stddev_samp("temp").alias("_temp_std"),
                   F.min("clouds_all").alias("_clouds_min"), F.max("clouds_all").alias("_clouds_max"))
    q = exact_quantiles(df, "traffic_volume", (0.25, 0.5, 0.75), [f"_q{i + 1}" for i in range(3)])
    return plain.crossJoin(F.broadcast(q)).select(*STAT_COLS)                                  # one row each


def with_stats(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    stats = table_stats(df) if stats is None else stats
    return df.crossJoin(F.broadcast(stats))


def zscore(x: str, mean: str, std: str) -> F.Column:
    return F.try_divide(F.col(x) - F.col(mean), F.col(std))


def minmax(x: str, lo: str, hi: str) -> F.Column:
    return F.try_divide(F.col(x) - F.col(lo), F.col(hi) - F.col(lo))


def engineer_features(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Cleaned readings (9 cols + keys) → the 34-column feature table:
    time → weather → scaled numerics → quartile congestion category."""
    out = (with_stats(df, stats)
           .transform(time_features).transform(cyclical_encode)
           .transform(one_hot_weather).transform(weather_indicators)
           .withColumns({
               "temp_zscore": zscore("temp", "_temp_mean", "_temp_std"),
               "clouds_all_minmax": minmax("clouds_all", "_clouds_min", "_clouds_max"),
               "congestion_category": C.quartile_label("traffic_volume", "_q1", "_q2", "_q3"),
               "congestion_category_p3": C.quartile_label("traffic_volume", "_q1", "_q2", "_q3",
                                                          C.CONGESTION_LABELS_P3)}))
    return out.drop(*STAT_COLS)


def label_features(df: DataFrame) -> DataFrame:
    """Feature table → modelling table: holiday flag, month, year, the p3
    congestion scale (same quartiles, `<=` bounds), proxy ``high_risk``, weather
    severity tier and time-of-day bin."""
    high_cong = F.col("congestion_category_p3").isin("High", "Severe")
    risky = F.col("weather_main").isin(C.SEVERE_WEATHER) | (F.col("is_low_visibility") == 1)
    return (df.transform(add_holiday_flag).transform(calendar_extras)
              .withColumns({
                  "high_risk": F.coalesce(high_cong & risky, F.lit(False)).cast("int"),
                  "weather_severity": C.weather_severity("weather_main"),
                  "time_of_day": C.time_of_day("hour")})
              .withColumn("weather_severity_label", C.weather_severity_label("weather_severity")))


def high_risk_summary(df: DataFrame) -> DataFrame:
    """Positive count / rate of the proxy label and the imbalance warning flag."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("high_risk").cast("bigint").alias("n_positive"),
                  F.avg("high_risk").alias("positive_rate")) \
             .withColumn("imbalanced", (F.col("positive_rate") < 0.10).cast("int"))


def scaling_params(df: DataFrame) -> DataFrame:
    """Snapshot of the training statistics used at serving time (one row)."""
    return df.agg(F.avg("temp").alias("temp_mean"), F.stddev_samp("temp").alias("temp_std"),
                  F.min("clouds_all").alias("clouds_min"), F.max("clouds_all").alias("clouds_max"),
                  F.count(F.lit(1)).alias("source_rows"))


def engineer_reading(df: DataFrame, params: DataFrame, ts: str = "date_time",
                     holiday_col: str | None = "holiday") -> DataFrame:
    """Raw readings (batch or stream) + stored scaling parameters → the 24 model
    features in model order. Weather is matched case-insensitively; rows with an
    unknown weather value or an unparseable time get ``feature_error``."""
    w = F.lower(F.trim(F.col("weather_main")))
    t = F.col(ts) if dict(df.dtypes)[ts] != "string" else F.try_to_timestamp(F.col(ts))
    rng = F.col("clouds_max") - F.col("clouds_min")
    base = df.crossJoin(F.broadcast(params.select("temp_mean", "temp_std", "clouds_min", "clouds_max"))) \
             .withColumns({"_w": w, "_t": t})
    hol = C.holiday_flag(holiday_col) if holiday_col else F.lit(0)
    feats = {
        "hour_sin": C.cyc_sin(F.hour("_t"), 24), "hour_cos": C.cyc_cos(F.hour("_t"), 24),
        "dow_sin": C.cyc_sin(F.weekday("_t"), 7), "dow_cos": C.cyc_cos(F.weekday("_t"), 7),
        "is_weekend": C.is_weekend("_t"), "month": F.month("_t"), "year": F.year("_t"),
        **{f"weather_{v}": C.one_hot("_w", v) for v in C.WEATHER_CATEGORIES},
        "is_precipitating": C.is_precipitating(F.coalesce("rain_1h", F.lit(0.0)),
                                               F.coalesce("snow_1h", F.lit(0.0))),
        "is_severe_weather": C.is_severe("_w"), "is_low_visibility": C.is_low_visibility("_w"),
        "temp_zscore": F.try_divide(F.col("temp") - F.col("temp_mean"), F.col("temp_std")),
        "clouds_all_minmax": F.when(rng == 0, F.lit(0.0))
                              .otherwise(F.try_divide(F.col("clouds_all") - F.col("clouds_min"), rng)),
        "holiday_flag": hol,
    }
    err = (F.when(F.col("_t").isNull(), "unparseable date_time")
           .when(~F.coalesce(F.col("_w").isin(C.WEATHER_CATEGORIES), F.lit(False)), "unknown weather_main"))
    keep = [c for c in df.columns if c not in feats]
    return base.select(*keep, *[v.alias(k) for k, v in feats.items()], err.alias("feature_error"))


def feature_matrix(df: DataFrame, features: Sequence[str] = C.COMMON_FEATURE_COLUMNS,
                   output: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """The 24 model features (no leakage column) assembled into one vector."""
    required_columns_gate(df, list(features))
    leak = [c for c in features if c in C.LEAKAGE_COLUMNS]
    if leak:
        raise ValueError(f"leakage columns in feature list: {leak}")
    va = VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="keep")
    return va.transform(df.select(*keep, *features)).select(*keep, *features, output)
