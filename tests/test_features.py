import datetime as dt
import math

from pyspark.sql import functions as F

from hourwise.functions import columns as C
from hourwise.operators import features as FE


def test_tied_quartiles_right_closed(spark):
    vals = [1, 1, 1, 1, 1, 2, 3, 4]
    df = spark.createDataFrame([(v,) for v in vals], "traffic_volume long") \
        .withColumns({"temp": F.lit(280.0), "clouds_all": F.lit(5.0)})
    st = FE.table_stats(df).collect()[0]
    assert st["_q1"] == 1.0
    out = FE.with_stats(df).select(C.quartile_label("traffic_volume", "_q1", "_q2", "_q3").alias("c")).collect()
    assert [r["c"] for r in out].count("Low") == 5


def test_calendar_and_flags(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 7), None), (dt.datetime(2024, 1, 6, 23), "None")],
                               "date_time timestamp_ntz, holiday string")
    out = FE.time_features(df).withColumn("hf", C.holiday_flag("holiday")).collect()
    assert out[0]["day_of_week"] == 0 and out[0]["day_name"] == "Monday" and out[0]["is_weekend"] == 0
    assert out[1]["day_of_week"] == 5 and out[1]["is_weekend"] == 1
    assert out[0]["hf"] == 1 and out[1]["hf"] == 0        # NULL holiday counts as a holiday


def test_cyclical_and_severity(spark):
    df = spark.createDataFrame([(6, "fog"), (18, "squall"), (3, "drizzle"), (12, "unknown")], "hour int, w string")
    out = df.select(C.cyc_sin("hour", 24).alias("s"), C.weather_severity("w").alias("sev"),
                    C.time_of_day("hour").alias("tod")).collect()
    assert math.isclose(out[0]["s"], 1.0)
    assert [r["sev"] for r in out] == [3, 4, 2, 2]
    assert [r["tod"] for r in out] == ["Morning Rush (6-9)", "Evening Rush (16-18)", "Overnight (0-5)",
                                       "Midday (10-15)"]


def test_engineer_reading_zero_range_and_unknown_weather(spark):
    params = spark.createDataFrame([(280.0, 10.0, 50.0, 50.0, 3)],
                                   "temp_mean double, temp_std double, clouds_min double, clouds_max double, source_rows long")
    raw = spark.createDataFrame([("2024-01-01 08:00:00", 290.0, 50.0, 0.0, 0.0, " FOG ", "None"),
                                 ("2024-01-01 09:00:00", 290.0, 50.0, 0.0, 0.0, "volcano", "None")],
                                "date_time string, temp double, clouds_all double, rain_1h double, snow_1h double, "
                                "weather_main string, holiday string")
    out = FE.engineer_reading(raw, params).collect()
    assert out[0]["clouds_all_minmax"] == 0.0 and out[0]["temp_zscore"] == 1.0
    assert out[0]["weather_fog"] == 1 and out[0]["is_low_visibility"] == 1 and out[0]["feature_error"] is None
    assert out[1]["feature_error"] == "unknown weather_main"


def test_feature_matrix_rejects_leakage(spark):
    df = spark.createDataFrame([(1.0, 2)], "a double, traffic_volume long")
    try:
        FE.feature_matrix(df, ["a", "traffic_volume"])
    except ValueError as ex:
        assert "leakage" in str(ex)
    else:
        raise AssertionError("leakage column accepted")
