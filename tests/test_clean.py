import datetime as dt

import pytest
from hourwise.functions.columns import temp_fault
from hourwise.operators import clean as CL
from hourwise.sources.schema import SchemaValidationError, schema_gate

T = dt.datetime


def raw_frame(spark, rows):
    cols = "row_id long, sensor string, date_time timestamp_ntz, holiday string, temp double, rain_1h double, " \
           "snow_1h double, clouds_all double, weather_main string, weather_description string, traffic_volume long"
    return spark.createDataFrame(rows, cols)


def test_dup_hours_smallest_row_id_survives(spark):
    h = T(2024, 1, 1, 5)
    rows = [(7, "a", h, "None", 280.0, 0.0, 0.0, 10.0, "Rain", "light rain", 100),
            (3, "a", h, "None", 280.0, 0.0, 0.0, 10.0, "Mist", "mist", 100),
            (5, "a", h, "None", 280.0, 0.0, 0.0, 10.0, "Fog", "fog", 100)]
    out = CL.dedupe_min_rowid(raw_frame(spark, rows)).collect()
    assert len(out) == 1 and out[0]["row_id"] == 3 and out[0]["weather_main"] == "Mist"


def test_case_mix_collapse_report(spark):
    h = T(2024, 1, 1, 5)
    descs = ["Sky is Clear", "sky is clear", "sky is clear", " SQUALLS "]
    rows = [(i, "a", h, "None", 280.0, 0.0, 0.0, 1.0, "Clear", d, 1) for i, d in enumerate(descs)]
    rep = {r["column_name"]: r for r in CL.category_collapse_report(raw_frame(spark, rows)).collect()}
    d = rep["weather_description"]
    assert (d["n_before"], d["n_after"], d["n_changed"]) == (3, 2, 1)
    assert rep["holiday"]["n_changed"] == 0
    std = CL.standardize_categoricals(raw_frame(spark, rows)).select("weather_description").distinct().collect()
    assert sorted(r[0] for r in std) == ["sky is clear", "squalls"]


def test_bad_times_dropped_without_ansi_error(spark):
    df = spark.createDataFrame([(1, "2024-01-01 05:00:00"), (2, "not a time"), (3, None)], "row_id long, date_time string")
    out = CL.parse_datetime_or_drop(df, "date_time").collect()
    assert [r["row_id"] for r in out] == [1]
    assert out[0]["date_time"] == T(2024, 1, 1, 5)


def test_month_median_imputation_and_fallback(spark):
    rows = [
        # January: only faulty temps -> overall clean median
        (1, "a", T(2024, 1, 1, 0), "None", 0.0, 0.0, 0.0, 1.0, "clear", "x", 1),
        # February: mixed -> February clean median (270, 280, 290 -> 280)
        (2, "a", T(2024, 2, 1, 0), "None", 270.0, 0.0, 0.0, 1.0, "clear", "x", 1),
        (3, "a", T(2024, 2, 1, 1), "None", 280.0, 0.0, 0.0, 1.0, "clear", "x", 1),
        (4, "a", T(2024, 2, 1, 2), "None", 290.0, 0.0, 0.0, 1.0, "clear", "x", 1),
        (5, "a", T(2024, 2, 1, 3), "None", 0.5, 0.0, 0.0, 1.0, "clear", "x", 1),
        # March: null temp is not a fault and stays null
        (6, "a", T(2024, 3, 1, 0), "None", None, 0.0, 0.0, 1.0, "clear", "x", 1),
        (7, "a", T(2024, 3, 1, 1), "None", 300.0, 0.0, 0.0, 1.0, "clear", "x", 1),
    ]
    out = {r["row_id"]: r["temp"] for r in
           CL.impute_by_group_median(raw_frame(spark, rows), "temp", temp_fault("temp")).collect()}
    assert out[5] == 280.0
    assert out[1] == 285.0          # overall clean median of 270, 280, 290, 300
    assert out[6] is None
    assert out[7] == 300.0


def test_schema_gate(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(SchemaValidationError):
        schema_gate(df, ["a", "c"])
    assert schema_gate(df, ["a"]).columns == ["a", "b"]          # extra kept
    assert schema_gate(df, ["a"], strict=True).columns == ["a"]


def test_dq_metrics_counts(spark):
    h = T(2024, 1, 1, 5)
    rows = [(1, "a", h, "None", 0.0, 9999.0, 0.0, 150.0, "Rain", "r", 1),
            (2, "a", h, "None", 280.0, 0.0, 0.0, 10.0, "Rain", "r", 1),
            (3, "b", h, "None", 280.0, -1.0, 0.0, 10.0, "Rain", "r", 1)]
    m = {(r["stage"], r["metric"]): r["value"] for r in CL.dq_metrics(raw_frame(spark, rows)).collect()}
    assert m[("load", "raw_rows")] == 3
    assert m[("dedupe", "hourly_rows")] == 2
    assert m[("dedupe", "duplicates_removed")] == 1
    assert m[("outliers", "temp_faults")] == 1 and m[("outliers", "rain_faults")] == 1
    assert m[("range_check", "negative_rain_snow")] == 1
    assert m[("range_check", "clouds_out_of_range")] == 1
