"""Column expressions shared by batch and streaming operators.

Everything here returns a ``Column`` (no job is started), so it stays inside
whole-stage codegen wherever it is used.
"""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's for equal results ---------
WEATHER_CATEGORIES = [
    "clear", "clouds", "drizzle", "fog", "haze", "mist",
    "rain", "smoke", "snow", "squall", "thunderstorm",
]
SEVERE_WEATHER = ["thunderstorm", "squall"]
LOW_VISIBILITY_WEATHER = ["fog", "mist", "haze", "smoke"]
WEEKEND_DAYS = [5, 6]  # Monday = 0 .. Sunday = 6
MIN_PLAUSIBLE_TEMP_K = 1.0
MAX_PLAUSIBLE_RAIN_MM = 9000.0
KELVIN_OFFSET = 273.15
CONGESTION_LABELS = ["Low", "Medium", "High", "Very High"]
CONGESTION_LABELS_P3 = ["Low", "Medium", "High", "Severe"]
WEATHER_SEVERITY_LABELS = {0: "Clear", 1: "Clouds", 2: "Precipitation", 3: "Low visibility", 4: "Severe"}
TIME_OF_DAY_EDGES = [5, 9, 15, 18, 23]  # right-closed upper edges, first bin starts at -0.1
TIME_OF_DAY_LABELS = ["Overnight (0-5)", "Morning Rush (6-9)", "Midday (10-15)",
                      "Evening Rush (16-18)", "Evening (19-23)"]
TIME_FEATURES = ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "is_weekend", "month", "year"]
WEATHER_FEATURES = [f"weather_{w}" for w in WEATHER_CATEGORIES] + [
    "is_precipitating", "is_severe_weather", "is_low_visibility", "temp_zscore", "clouds_all_minmax"]
HOLIDAY_FEATURES = ["holiday_flag"]
COMMON_FEATURE_COLUMNS = TIME_FEATURES + WEATHER_FEATURES + HOLIDAY_FEATURES
LEAKAGE_COLUMNS = ["traffic_volume", "congestion_category", "congestion_category_p3", "high_risk"]
# ---------------------------------------------------------------------------


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_int(c: Column) -> Column:
    return c.cast("int")


def hour_of(ts) -> Column:
    return F.hour(col(ts))


def day_of_week(ts) -> Column:
    """Monday = 0 .. Sunday = 6 (``weekday``; ``dayofweek`` is Sunday = 1)."""
    return F.weekday(col(ts))


def day_name(ts) -> Column:
    return F.date_format(col(ts), "EEEE")


def is_weekend(ts) -> Column:
    return as_int(day_of_week(ts).isin(WEEKEND_DAYS))


def cyc_sin(x, period: float) -> Column:
    return F.sin(F.lit(2 * math.pi) * col(x) / F.lit(float(period)))


def cyc_cos(x, period: float) -> Column:
    return F.cos(F.lit(2 * math.pi) * col(x) / F.lit(float(period)))


def kelvin_to_celsius(x) -> Column:
    return col(x) - F.lit(KELVIN_OFFSET)


def canonical_text(x) -> Column:
    return F.lower(F.trim(col(x)))


def holiday_flag(holiday) -> Column:
    """1 unless the text is 'none' (any case); a NULL holiday counts as a holiday."""
    return as_int(F.coalesce(F.lower(col(holiday)) != F.lit("none"), F.lit(True)))


def temp_fault(temp) -> Column:
    """Below 1 K is a sensor fault; NULL is not a fault."""
    return F.coalesce(col(temp) < F.lit(MIN_PLAUSIBLE_TEMP_K), F.lit(False))


def rain_fault(rain) -> Column:
    return F.coalesce(col(rain) > F.lit(MAX_PLAUSIBLE_RAIN_MM), F.lit(False))


def is_precipitating(rain, snow) -> Column:
    return as_int(F.coalesce((col(rain) > 0) | (col(snow) > 0), F.lit(False)))


def is_severe(weather) -> Column:
    return as_int(F.coalesce(col(weather).isin(SEVERE_WEATHER), F.lit(False)))


def is_low_visibility(weather) -> Column:
    return as_int(F.coalesce(col(weather).isin(LOW_VISIBILITY_WEATHER), F.lit(False)))


def one_hot(weather, value: str) -> Column:
    return as_int(F.coalesce(col(weather) == F.lit(value), F.lit(False)))


def weather_severity(weather) -> Column:
    w = col(weather)
    return (F.when(w == "clear", 0).when(w == "clouds", 1)
            .when(w.isin(LOW_VISIBILITY_WEATHER), 3).when(w.isin(SEVERE_WEATHER), 4)
            .otherwise(2))


def weather_severity_label(severity) -> Column:
    s = col(severity)
    out = None
    for k, v in WEATHER_SEVERITY_LABELS.items():
        out = F.when(s == k, v) if out is None else out.when(s == k, v)
    return out


def time_of_day(hour) -> Column:
    """Right-closed hour bins (-0.1,5], (5,9], (9,15], (15,18], (18,23]."""
    h = col(hour)
    out = F.when((h > -0.1) & (h <= TIME_OF_DAY_EDGES[0]), TIME_OF_DAY_LABELS[0])
    for edge, label in zip(TIME_OF_DAY_EDGES[1:], TIME_OF_DAY_LABELS[1:]):
        out = out.when(h <= edge, label)
    return out


def quartile_label(x, q1, q2, q3, labels=CONGESTION_LABELS) -> Column:
    """Right-closed quartile bins: (-inf,q1] (q1,q2] (q2,q3] (q3,inf)."""
    v = col(x)
    return (F.when(v <= col(q1), labels[0]).when(v <= col(q2), labels[1])
            .when(v <= col(q3), labels[2]).when(v.isNotNull(), labels[3]))


def label_ordinal(x, labels) -> Column:
    v = col(x)
    out = None
    for i, lab in enumerate(labels):
        out = F.when(v == lab, i) if out is None else out.when(v == lab, i)
    return out


def safe_div(num, den) -> Column:
    """ANSI-safe division: NULL on a zero denominator instead of an error."""
    return F.try_divide(col(num), col(den))


def zero_div(num, den) -> Column:
    """Division that reports 0 on a zero denominator (sklearn ``zero_division=0``)."""
    return F.coalesce(F.try_divide(col(num), col(den)), F.lit(0.0))


def safe_corr(x, y) -> Column:
    """Pearson correlation that is NULL (not an error) for a constant column."""
    return F.try_divide(F.covar_pop(col(x), col(y)),
                        F.stddev_pop(col(x)) * F.stddev_pop(col(y)))


def adjusted_skewness(x) -> Column:
    """Bias-corrected sample skewness (pandas ``skew``): population skew times
    sqrt(n(n-1))/(n-2)."""
    n = F.count(col(x)).cast("double")
    return F.skewness(col(x)) * F.sqrt(n * (n - 1)) / F.try_subtract(n, F.lit(2.0))


def mean_of_bool(pred: Column) -> Column:
    return F.avg(F.coalesce(pred, F.lit(False)).cast("double"))
