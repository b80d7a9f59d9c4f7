"""Registered queries for sources, cleaning, features and SQL analytics
(SURVEY 2.A-2.F), each next to its DuckDB oracle."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..operators import analytics as A
from ..operators import clean as CL
from ..operators import features as FE
from ..sources import adapters, io
from ..sources.schema import reading_contract
from . import tables
from .oracle_base import with_tables
from .registry import query, rnd, rounded

EV, OR = "events", "orders"
CONGESTED = 700          # events-view stand-in for the reference's 5500 veh/hr
HIGH_TEMP = 288.0        # events-view stand-in for the reference's 292 K
KEYS = ["sensor", "date_time"]

W_EV = with_tables(EV)
W_OR = with_tables(OR)
DOUBLES_RAW = "temp rain_1h snow_1h clouds_all"

# ------------------------------------------------------------------ 2.A ----


@query("read_pruned", rnd(with_tables(EV, "raw") + "SELECT row_id, temp, clouds_all FROM raw",
                          "temp clouds_all"))
def q_read_pruned(spark, sf):
    return rounded(tables.raw(spark, sf, EV).select("row_id", "temp", "clouds_all"))


@query("reading_contract", with_tables(EV, "raw") + """
SELECT coalesce(reason, 'accepted') AS reject_reason, count(*) AS n FROM (
  SELECT CASE WHEN date_time IS NULL THEN 'unparseable date_time'
              WHEN clouds_all IS NULL OR clouds_all < 0 OR clouds_all > 100 THEN 'clouds_all out of range'
              WHEN rain_1h IS NULL OR rain_1h < 0 THEN 'rain_1h negative'
              WHEN snow_1h IS NULL OR snow_1h < 0 THEN 'snow_1h negative'
              WHEN lower(trim(weather_main)) IS NULL OR lower(trim(weather_main)) NOT IN
                   ('clear','clouds','drizzle','fog','haze','mist','rain','smoke','snow','squall','thunderstorm')
              THEN 'unknown weather_main' END AS reason
  FROM raw) GROUP BY 1""")
def q_reading_contract(spark, sf):
    df = reading_contract(tables.raw(spark, sf, EV))
    return df.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("reject_reason")) \
             .agg(F.count(F.lit(1)).alias("n"))


HOURLY_COLS = ("row_id, sensor, date_time, holiday, temp, rain_1h, snow_1h, clouds_all, weather_main, "
               "weather_description, traffic_volume")


@query("materialize_hourly", rnd(W_EV + f"SELECT {HOURLY_COLS} FROM hourly", DOUBLES_RAW))
def q_materialize_hourly(spark, sf):
    return rounded(tables.persist_hourly(spark, sf, EV))


@query("write_table", rnd(W_EV + f"SELECT {HOURLY_COLS}, congestion_category FROM feat", DOUBLES_RAW))
def q_write_table(spark, sf):
    df = tables.features(spark, sf, EV).select(*HOURLY_COLS.split(", "), "congestion_category")
    path = io.shared_path(spark, "features")
    io.write_table(df, path)
    return rounded(io.read_table(spark, path))


@query("read_table", rnd(W_EV + f"SELECT {HOURLY_COLS} FROM hourly", DOUBLES_RAW))
def q_read_table(spark, sf):
    """CSV round trip: date_time goes out as text and is parsed back."""
    df = tables.hourly(spark, sf, EV)
    path = io.shared_path(spark, "hourly-csv")
    io.write_table(df.withColumn("date_time", F.date_format("date_time", "yyyy-MM-dd HH:mm:ss")), path, fmt="csv")
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == "date_time" else f.dataType)
                           for f in df.schema.fields])
    back = io.read_table(spark, path, fmt="csv", schema=schema)
    return rounded(back.select(*HOURLY_COLS.split(", ")))


RAW_CSV_SCHEMA = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("sensor", T.StringType())]
                              + list(io.RAW_READING_SCHEMA.fields))


@query("read_raw_csv", rnd(with_tables(EV, "raw") + f"SELECT {HOURLY_COLS} FROM raw", DOUBLES_RAW))
def q_read_raw_csv(spark, sf):
    raw = tables.raw(spark, sf, EV).withColumn("date_time", F.date_format("date_time", "yyyy-MM-dd HH:mm:ss"))
    path = io.shared_path(spark, "raw-csv")
    # written in another column order: the reader binds by the header
    io.write_table(raw.select(*sorted(f.name for f in RAW_CSV_SCHEMA.fields)), path, fmt="csv")
    back = io.read_raw_csv(spark, path, RAW_CSV_SCHEMA)
    back = CL.parse_datetime(back.drop(io.CORRUPT_COL), "date_time", "yyyy-MM-dd HH:mm:ss")
    return rounded(back.select(*HOURLY_COLS.split(", ")))


# ------------------------------------------------------------------ 2.B ----

STD_SQL = with_tables(EV, "raw") + """
SELECT row_id, lower(trim(holiday)) AS holiday, lower(trim(weather_main)) AS weather_main,
       lower(trim(weather_description)) AS weather_description FROM raw"""


@query("standardize_categoricals", STD_SQL)
def q_standardize(spark, sf):
    return CL.standardize_categoricals(tables.raw(spark, sf, EV)) \
             .select("row_id", "holiday", "weather_main", "weather_description")


@query("category_collapse_report", with_tables(EV, "raw") + """
, pairs AS (
  SELECT 'weather_main' AS column_name, weather_main AS spelling FROM raw UNION ALL
  SELECT 'weather_description', weather_description FROM raw UNION ALL
  SELECT 'holiday', holiday FROM raw),
spell AS (SELECT column_name, spelling, count(*) AS n FROM pairs WHERE spelling IS NOT NULL GROUP BY 1, 2),
canon AS (SELECT column_name, lower(trim(spelling)) AS c, count(*) AS k, sum(n) AS rows_, max(n) AS modal
          FROM spell GROUP BY 1, 2)
SELECT column_name, CAST(sum(k) AS BIGINT) AS n_before, count(*) AS n_after,
       CAST(sum(rows_ - modal) AS BIGINT) AS n_changed
FROM canon GROUP BY 1""")
def q_collapse(spark, sf):
    return CL.category_collapse_report(tables.raw(spark, sf, EV))


@query("parse_datetime_or_drop", with_tables(EV, "raw") + """
SELECT row_id, try_strptime(txt, '%Y-%m-%d %H:%M:%S') AS date_time FROM (
  SELECT row_id, CASE WHEN row_id % 13 = 0 THEN 'not a time ' || row_id
                      ELSE strftime(date_time, '%Y-%m-%d %H:%M:%S') END AS txt FROM raw)
WHERE try_strptime(txt, '%Y-%m-%d %H:%M:%S') IS NOT NULL""")
def q_parse(spark, sf):
    raw = tables.raw(spark, sf, EV)
    txt = F.when(F.col("row_id") % 13 == 0, F.concat(F.lit("not a time "), F.col("row_id").cast("string"))) \
           .otherwise(F.date_format("date_time", "yyyy-MM-dd HH:mm:ss"))
    df = raw.select("row_id", txt.alias("date_time"))
    return CL.parse_datetime_or_drop(df, "date_time", "yyyy-MM-dd HH:mm:ss")


@query("dedupe_min_rowid", rnd(W_EV + f"SELECT {HOURLY_COLS} FROM dedup", DOUBLES_RAW))
def q_dedupe(spark, sf):
    df = CL.standardize_categoricals(tables.raw(spark, sf, EV))
    return rounded(CL.dedupe_min_rowid(df, KEYS))


@query("dedupe_keep_first", rnd(W_OR + f"SELECT {HOURLY_COLS} FROM dedup", DOUBLES_RAW))
def q_dedupe_first(spark, sf):
    df = CL.standardize_categoricals(tables.raw(spark, sf, OR))
    return rounded(CL.dedupe_keep_first(df, KEYS, "row_id"))


@query("flag_outliers", W_EV + """
SELECT sensor, count(*) FILTER (WHERE coalesce(temp < 1.0, false)) AS temp_faults,
       count(*) FILTER (WHERE coalesce(rain_1h > 9000, false)) AS rain_faults
FROM dedup GROUP BY sensor""")
def q_flag(spark, sf):
    df = CL.flag_outliers(CL.dedupe_min_rowid(CL.standardize_categoricals(tables.raw(spark, sf, EV)), KEYS))
    return df.groupBy("sensor").agg(F.sum("temp_fault").cast("bigint").alias("temp_faults"),
                                    F.sum("rain_fault").cast("bigint").alias("rain_faults"))


@query("impute_by_group_median", rnd(W_OR + "SELECT row_id, sensor, date_time, temp FROM timp", "temp"))
def q_impute(spark, sf):
    df = CL.dedupe_min_rowid(CL.standardize_categoricals(tables.raw(spark, sf, OR)), KEYS)
    out = CL.impute_by_group_median(df, "temp", C.temp_fault("temp"))
    return rounded(out.select("row_id", "sensor", "date_time", "temp"))


@query("range_check_report", W_EV + """
SELECT count(*) FILTER (WHERE rain_1h < 0) AS n_negative_rain, count(*) FILTER (WHERE snow_1h < 0) AS n_negative_snow,
       count(*) FILTER (WHERE clouds_all < 0 OR clouds_all > 100) AS n_clouds_out_of_range FROM hourly""")
def q_range(spark, sf):
    return CL.range_check_report(tables.hourly(spark, sf, EV))


@query("clean_readings", rnd(W_EV + f"SELECT {HOURLY_COLS} FROM hourly", DOUBLES_RAW))
def q_clean(spark, sf):
    return rounded(tables.hourly(spark, sf, EV))


@query("dq_metrics", W_EV + """
, a AS (SELECT count(*) AS raw_rows, count(*) FILTER (WHERE date_time IS NULL) AS unparseable_dates FROM raw),
b AS (SELECT count(*) AS hourly_rows, count(*) FILTER (WHERE coalesce(temp < 1.0, false)) AS temp_faults,
             count(*) FILTER (WHERE coalesce(rain_1h > 9000, false)) AS rain_faults,
             count(*) FILTER (WHERE rain_1h < 0 OR snow_1h < 0) AS negative_rain_snow,
             count(*) FILTER (WHERE clouds_all < 0 OR clouds_all > 100) AS clouds_out_of_range FROM dedup)
SELECT stage, metric, CAST(value AS BIGINT) AS value FROM (
  SELECT 'load' AS stage, 'raw_rows' AS metric, raw_rows AS value FROM a UNION ALL
  SELECT 'parse', 'unparseable_dates', unparseable_dates FROM a UNION ALL
  SELECT 'dedupe', 'duplicates_removed', raw_rows - unparseable_dates - hourly_rows FROM a, b UNION ALL
  SELECT 'dedupe', 'hourly_rows', hourly_rows FROM b UNION ALL
  SELECT 'outliers', 'temp_faults', temp_faults FROM b UNION ALL
  SELECT 'outliers', 'rain_faults', rain_faults FROM b UNION ALL
  SELECT 'range_check', 'negative_rain_snow', negative_rain_snow FROM b UNION ALL
  SELECT 'range_check', 'clouds_out_of_range', clouds_out_of_range FROM b)""")
def q_dq(spark, sf):
    return CL.dq_metrics(tables.raw(spark, sf, EV), KEYS)


# ------------------------------------------------------------------ 2.C ----

def _lab(spark, sf, view=EV):
    return tables.labelled(spark, sf, view)


def _feat_query(key: str, cols: str, doubles: str = "", view: str = EV, src: str = "lab"):
    sql = with_tables(view) + f"SELECT sensor, date_time, {cols} FROM {src}"
    sql = rnd(sql, doubles) if doubles else sql

    @query(key, sql)
    def _q(spark, sf):
        return rounded(_lab(spark, sf, view).select("sensor", "date_time", *[c.strip() for c in cols.split(",")]))
    return _q


_feat_query("time_features", "hour, day_of_week, day_name, is_weekend")
_feat_query("cyclical_encode", "hour_sin, hour_cos, dow_sin, dow_cos", "hour_sin hour_cos dow_sin dow_cos")
_feat_query("calendar_extras", "month, year", view=OR)
_feat_query("holiday_flag", "holiday, holiday_flag")
_feat_query("one_hot_weather", ", ".join(f"weather_{w}" for w in C.WEATHER_CATEGORIES))
_feat_query("weather_indicators", "is_precipitating, is_severe_weather, is_low_visibility")
_feat_query("zscore", "temp, temp_zscore", "temp temp_zscore")
_feat_query("minmax", "clouds_all, clouds_all_minmax", "clouds_all clouds_all_minmax")
_feat_query("quartile_category", "traffic_volume, congestion_category")
_feat_query("congestion_bucket", "traffic_volume, congestion_category_p3", view=OR)
_feat_query("high_risk_label", "congestion_category_p3, weather_main, high_risk")
_feat_query("time_of_day", "hour, time_of_day")


@query("weather_severity", W_EV + """
SELECT sensor, date_time, weather_main, weather_severity,
       CASE weather_severity WHEN 0 THEN 'Clear' WHEN 1 THEN 'Clouds' WHEN 2 THEN 'Precipitation'
            WHEN 3 THEN 'Low visibility' WHEN 4 THEN 'Severe' END AS weather_severity_label FROM lab""")
def q_severity(spark, sf):
    return _lab(spark, sf).select("sensor", "date_time", "weather_main", "weather_severity",
                                  "weather_severity_label")


@query("kelvin_to_celsius", rnd(W_EV + "SELECT sensor, date_time, temp - 273.15 AS temp_c FROM hourly", "temp_c"))
def q_kelvin(spark, sf):
    return rounded(tables.hourly(spark, sf, EV).select("sensor", "date_time",
                                                       C.kelvin_to_celsius("temp").alias("temp_c")))


SCALING_SQL = """SELECT avg(temp) AS temp_mean, stddev_samp(temp) AS temp_std, min(clouds_all) AS clouds_min,
       max(clouds_all) AS clouds_max, count(*) AS source_rows FROM hourly"""


@query("scaling_params", rnd(W_EV + SCALING_SQL, "temp_mean temp_std clouds_min clouds_max"))
def q_scaling(spark, sf):
    return rounded(FE.scaling_params(tables.hourly(spark, sf, EV)))


@query("apply_scaling_params", rnd(W_EV + f", p AS ({SCALING_SQL})" + """
SELECT o.row_id, (o.temp - p.temp_mean) / p.temp_std AS temp_zscore,
       CASE WHEN p.clouds_max = p.clouds_min THEN 0.0
            ELSE (o.clouds_all - p.clouds_min) / (p.clouds_max - p.clouds_min) END AS clouds_all_minmax
FROM raw o CROSS JOIN p""", "temp_zscore clouds_all_minmax"))
def q_apply_scaling(spark, sf):
    params = FE.scaling_params(tables.hourly(spark, sf, EV))
    out = FE.engineer_reading(tables.raw(spark, sf, EV), params)
    return rounded(out.select("row_id", "temp_zscore", "clouds_all_minmax"))


ER_FEATURES = ", ".join(C.COMMON_FEATURE_COLUMNS)


@query("engineer_reading", rnd(W_EV + f", p AS ({SCALING_SQL})" + """
, r AS (SELECT o.*, lower(trim(o.weather_main)) AS w, p.* FROM raw o CROSS JOIN p)
SELECT row_id,
       sin(2 * pi() * hour(date_time) / 24.0) AS hour_sin, cos(2 * pi() * hour(date_time) / 24.0) AS hour_cos,
       sin(2 * pi() * (isodow(date_time) - 1) / 7.0) AS dow_sin, cos(2 * pi() * (isodow(date_time) - 1) / 7.0) AS dow_cos,
       CASE WHEN isodow(date_time) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CAST(month(date_time) AS INTEGER) AS month, CAST(year(date_time) AS INTEGER) AS year,
""" + ",\n".join(f"       CASE WHEN w = '{w}' THEN 1 ELSE 0 END AS weather_{w}" for w in C.WEATHER_CATEGORIES) + """,
       CASE WHEN coalesce(rain_1h, 0) > 0 OR coalesce(snow_1h, 0) > 0 THEN 1 ELSE 0 END AS is_precipitating,
       CASE WHEN w IN ('thunderstorm', 'squall') THEN 1 ELSE 0 END AS is_severe_weather,
       CASE WHEN w IN ('fog', 'mist', 'haze', 'smoke') THEN 1 ELSE 0 END AS is_low_visibility,
       (temp - temp_mean) / temp_std AS temp_zscore,
       CASE WHEN clouds_max = clouds_min THEN 0.0 ELSE (clouds_all - clouds_min) / (clouds_max - clouds_min) END
         AS clouds_all_minmax,
       CASE WHEN coalesce(lower(holiday) <> 'none', true) THEN 1 ELSE 0 END AS holiday_flag,
       CASE WHEN date_time IS NULL THEN 'unparseable date_time'
            WHEN w NOT IN ('clear','clouds','drizzle','fog','haze','mist','rain','smoke','snow','squall','thunderstorm')
                 OR w IS NULL THEN 'unknown weather_main' END AS feature_error
FROM r""", "hour_sin hour_cos dow_sin dow_cos temp_zscore clouds_all_minmax"))
def q_engineer_reading(spark, sf):
    params = FE.scaling_params(tables.hourly(spark, sf, EV))
    out = FE.engineer_reading(tables.raw(spark, sf, EV), params)
    return rounded(out.select("row_id", *C.COMMON_FEATURE_COLUMNS, "feature_error"))


FEAT_COLS = (HOURLY_COLS + ", hour, day_of_week, day_name, is_weekend, hour_sin, hour_cos, dow_sin, dow_cos, "
             + ", ".join(f"weather_{w}" for w in C.WEATHER_CATEGORIES)
             + ", is_precipitating, is_severe_weather, is_low_visibility, temp_zscore, clouds_all_minmax, "
               "congestion_category")


@query("engineer_features", rnd(W_EV + f"SELECT {FEAT_COLS} FROM feat",
                                DOUBLES_RAW + " hour_sin hour_cos dow_sin dow_cos temp_zscore clouds_all_minmax"))
def q_engineer_features(spark, sf):
    return rounded(tables.features(spark, sf, EV).select(*FEAT_COLS.split(", ")))


@query("feature_matrix")
def q_feature_matrix(spark, sf):
    return FE.feature_matrix(_lab(spark, sf), keep=["sensor", "date_time"])


# ------------------------------------------------------------------ 2.D ----

TREND_SQL = W_OR + """
SELECT CAST(year(date_time) AS INTEGER) AS year, count(*) AS hours_recorded,
       CAST(sum(traffic_volume) AS BIGINT) AS total_volume, avg(traffic_volume) AS avg_hourly_volume
FROM hourly WHERE date_time >= TIMESTAMP '1995-01-01' AND date_time < TIMESTAMP '2001-01-01' GROUP BY 1"""


@query("annual_trends", rnd(TREND_SQL, "avg_hourly_volume"))
def q_annual(spark, sf):
    return rounded(A.annual_trends(tables.hourly(spark, sf, OR), 1995, 2000))


@query("yoy_change", rnd(f"""SELECT *, lag(total_volume) OVER (ORDER BY year) AS prev_year_total,
       total_volume - lag(total_volume) OVER (ORDER BY year) AS yoy_change,
       100.0 * (total_volume - lag(total_volume) OVER (ORDER BY year)) / lag(total_volume) OVER (ORDER BY year)
         AS yoy_pct_change
FROM ({TREND_SQL}) t""", "avg_hourly_volume yoy_pct_change"))
def q_yoy(spark, sf):
    return rounded(A.yoy_change(A.annual_trends(tables.hourly(spark, sf, OR), 1995, 2000)))


def _date_stats_sql(name, where):
    return f"""SELECT '{name}' AS holiday_name, CAST(year(date_time) AS INTEGER) AS year,
       min(CAST(date_time AS DATE)) AS calendar_date, count(*) AS hours_available, avg(temp) AS avg_temp_k,
       avg(temp) - 273.15 AS avg_temp_c, min(temp) AS min_temp_k, max(temp) AS max_temp_k,
       avg(traffic_volume) AS avg_traffic_volume
FROM hourly WHERE {where} GROUP BY 2"""


NY_WHERE = "strftime(date_time, '%m-%d') = '01-01' AND year(date_time) IN (1996, 1997, 1998)"
LD_WHERE = ("CAST(date_time AS DATE) IN (SELECT CAST(date_time AS DATE) FROM hourly WHERE holiday = 'labor day' "
            "AND year(date_time) IN (1995, 1996, 1997, 1998, 1999, 2000, 2001))")
DS_DOUBLES = "avg_temp_k avg_temp_c min_temp_k max_temp_k avg_traffic_volume"


@query("fixed_date_stats", rnd(W_OR + _date_stats_sql("New Years Day", NY_WHERE), DS_DOUBLES))
def q_fixed(spark, sf):
    return rounded(A.fixed_date_stats(tables.hourly(spark, sf, OR), 1, 1, [1996, 1997, 1998]))


@query("tagged_date_stats", rnd(W_OR + _date_stats_sql("Labor Day", LD_WHERE), DS_DOUBLES))
def q_tagged(spark, sf):
    return rounded(A.tagged_date_stats(tables.hourly(spark, sf, OR), "labor day", range(1995, 2002), "Labor Day"))


@query("union_all_sorted", rnd(W_OR + _date_stats_sql("New Years Day", NY_WHERE) + " UNION ALL "
                               + _date_stats_sql("Labor Day", LD_WHERE) + " ORDER BY holiday_name, year", DS_DOUBLES))
def q_union(spark, sf):
    h = tables.hourly(spark, sf, OR)
    return rounded(A.union_all_sorted(A.fixed_date_stats(h, 1, 1, [1996, 1997, 1998]),
                                      A.tagged_date_stats(h, "labor day", range(1995, 2002), "Labor Day")))


@query("descriptive_stats", rnd(W_EV + """
SELECT count(*) AS n, avg(traffic_volume) AS mean, median(traffic_volume) AS median,
       min(traffic_volume) AS min_volume, max(traffic_volume) AS max_volume,
       max(traffic_volume) - min(traffic_volume) AS range_volume,
       stddev_pop(traffic_volume) AS population_stddev, var_pop(traffic_volume) AS population_variance,
       stddev_samp(traffic_volume) AS sample_stddev, var_samp(traffic_volume) AS sample_variance
FROM hourly""", "mean median population_stddev population_variance sample_stddev sample_variance"))
def q_desc(spark, sf):
    return rounded(A.descriptive_stats(tables.hourly(spark, sf, EV)))


@query("exact_median", rnd(W_EV + "SELECT count(*) AS n, CAST(median(traffic_volume) AS DOUBLE) AS median FROM hourly",
                           "median"))
def q_median(spark, sf):
    return rounded(A.exact_median(tables.hourly(spark, sf, EV)))


@query("pearson", rnd(W_EV + """SELECT count(*) AS n,
  covar_pop(temp, traffic_volume) / (stddev_pop(temp) * stddev_pop(traffic_volume)) AS pearson_r FROM hourly""",
                      "pearson_r"))
def q_pearson(spark, sf):
    return rounded(A.pearson(tables.hourly(spark, sf, EV)))


def _pa():
    return F.col("traffic_volume") > CONGESTED


def _pb():
    return F.col("weather_main") == "clear"


PA = f"traffic_volume > {CONGESTED}"
PB = "weather_main = 'clear'"


@query("event_probabilities", rnd(W_EV + f"""
SELECT avg(CASE WHEN {PA} THEN 1.0 ELSE 0.0 END) AS p_congestion, avg(CASE WHEN {PB} THEN 1.0 ELSE 0.0 END)
       AS p_clear_weather, avg(CASE WHEN {PA} AND {PB} THEN 1.0 ELSE 0.0 END) AS p_congestion_and_clear
FROM hourly""", "p_congestion p_clear_weather p_congestion_and_clear"))
def q_event_p(spark, sf):
    return rounded(A.event_probabilities(tables.hourly(spark, sf, EV), _pa(), _pb()))


@query("conditional_probabilities", rnd(W_EV + f"""
SELECT count(*) FILTER (WHERE {PA} AND {PB}) / nullif(count(*) FILTER (WHERE {PA}), 0) AS p_clear_given_congestion,
       count(*) FILTER (WHERE {PA} AND temp > {HIGH_TEMP}) / nullif(count(*) FILTER (WHERE {PA}), 0)
         AS p_hightemp_given_congestion
FROM hourly""", "p_clear_given_congestion p_hightemp_given_congestion"))
def q_cond_p(spark, sf):
    return rounded(A.conditional_probabilities(tables.hourly(spark, sf, EV), _pa(), _pb(),
                                               F.col("temp") > HIGH_TEMP))


@query("independence_check", rnd(W_EV + f"""
SELECT avg(CASE WHEN {PA} AND {PB} THEN 1.0 ELSE 0.0 END) AS p_a_and_b_observed,
       avg(CASE WHEN {PA} THEN 1.0 ELSE 0.0 END) * avg(CASE WHEN {PB} THEN 1.0 ELSE 0.0 END)
         AS p_a_times_p_b_if_independent FROM hourly""", "p_a_and_b_observed p_a_times_p_b_if_independent"))
def q_indep(spark, sf):
    return rounded(A.independence_check(tables.hourly(spark, sf, EV), _pa(), _pb()))


@query("odds_ratio", rnd(W_EV + f"""
, c AS (SELECT count(*) FILTER (WHERE {PA}) / count(*) AS p FROM hourly WHERE weather_main = 'clear'),
  d AS (SELECT count(*) FILTER (WHERE {PA}) / count(*) AS p FROM hourly WHERE weather_main = 'clouds')
SELECT c.p AS p_congestion_given_clear, d.p AS p_congestion_given_cloudy,
       c.p / nullif(1 - c.p, 0) AS odds_congestion_clear, d.p / nullif(1 - d.p, 0) AS odds_congestion_cloudy,
       (c.p / nullif(1 - c.p, 0)) / nullif(d.p / nullif(1 - d.p, 0), 0) AS odds_ratio_clear_vs_cloudy
FROM c, d""", "p_congestion_given_clear p_congestion_given_cloudy odds_congestion_clear odds_congestion_cloudy "
             "odds_ratio_clear_vs_cloudy"))
def q_odds(spark, sf):
    return rounded(A.odds_ratio(tables.hourly(spark, sf, EV), _pa(), _pb(), F.col("weather_main") == "clouds"))


@query("predicate_filters", W_EV + f"""
SELECT CASE WHEN traffic_volume > {CONGESTED} THEN 'high' WHEN traffic_volume < 100 THEN 'low' ELSE 'mid' END
         AS band, count(*) AS n_rows
FROM hourly WHERE (weather_main IN ('clear', 'clouds') OR weather_main = 'rain')
  AND clouds_all BETWEEN 10 AND 90 AND NOT (holiday <> 'none') GROUP BY 1""")
def q_predicates(spark, sf):
    return A.predicate_filters(tables.hourly(spark, sf, EV), CONGESTED, 100)


# ------------------------------------------------------------------ 2.E ----

PROBE_TEXT_SQL = """CASE row_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H')
            WHEN 2 THEN strftime(ts, '%Y-%m-%d') ELSE 'around ' || strftime(ts, '%H:%M') END"""


def _probe_text(spark, sf):
    e = adapters.table(spark, sf, "events")
    ts, rid = F.col("ts"), F.col("event_id")
    txt = (F.when(rid % 4 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm"))
            .when(rid % 4 == 1, F.date_format(ts, "yyyy-MM-dd HH"))
            .when(rid % 4 == 2, F.date_format(ts, "yyyy-MM-dd"))
            .otherwise(F.concat(F.lit("around "), F.date_format(ts, "HH:mm"))))
    return e.select(rid.alias("row_id"), txt.alias("probe_text"))


@query("parse_probe_times", f"""
SELECT row_id, probe_text, probe_time, CASE WHEN probe_time IS NULL THEN 1 ELSE 0 END AS rejected FROM (
  SELECT row_id, probe_text, coalesce(try_strptime(probe_text, '%Y-%m-%d %H:%M'), try_strptime(probe_text, '%Y-%m-%d %H'),
         try_strptime(probe_text, '%Y-%m-%d')) AS probe_time
  FROM (SELECT event_id AS row_id, {PROBE_TEXT_SQL.replace('row_id', 'event_id')} AS probe_text FROM events))""")
def q_parse_probes(spark, sf):
    return A.parse_probe_times(_probe_text(spark, sf))


LOOK_COLS = "sensor, date_time, traffic_volume, weather_main, temp"


@query("lookup_exact", rnd(W_EV + f"SELECT {LOOK_COLS} FROM hourly WHERE date_time = TIMESTAMP '2024-01-10 08:00:00'",
                           "temp"))
def q_lookup_exact(spark, sf):
    return rounded(A.lookup_exact(tables.hourly(spark, sf, EV), "2024-01-10 08:00:00").select(*LOOK_COLS.split(", ")))


@query("lookup_nearest", rnd(W_EV + f"""
SELECT {LOOK_COLS}, CAST(abs(epoch(date_time) - epoch(TIMESTAMP '2024-01-10 08:30:00')) AS BIGINT) AS gap_seconds
FROM hourly ORDER BY gap_seconds, date_time, sensor LIMIT 1""", "temp"))
def q_lookup_nearest(spark, sf):
    out = A.lookup_nearest(tables.hourly(spark, sf, EV), "2024-01-10 08:30:00")
    return rounded(out.select(*LOOK_COLS.split(", "), "gap_seconds"))


ROTATE = {"click": "view", "view": "error", "error": "purchase", "purchase": "signup", "signup": "click"}


def _asof_probes(spark, sf):
    e = adapters.table(spark, sf, "events")
    rot = None
    for a, b in ROTATE.items():
        rot = F.when(F.col("event_type") == a, b) if rot is None else rot.when(F.col("event_type") == a, b)
    return e.select(F.col("event_id").alias("probe_id"), rot.alias("sensor"), F.col("ts").alias("probe_time"))


ROTATE_SQL = "CASE event_type " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in ROTATE.items()) + " END"


@query("asof_join", rnd(W_EV + f"""
, p AS (SELECT event_id AS probe_id, {ROTATE_SQL} AS sensor, ts AS probe_time FROM events),
prv AS (SELECT p.*, h.date_time AS prev_t FROM p ASOF LEFT JOIN hourly h
        ON p.sensor = h.sensor AND p.probe_time >= h.date_time),
nxt AS (SELECT prv.*, h.date_time AS next_t FROM prv ASOF LEFT JOIN hourly h
        ON prv.sensor = h.sensor AND prv.probe_time <= h.date_time),
pick AS (SELECT probe_id, sensor, probe_time,
           CASE WHEN prev_t IS NULL THEN next_t WHEN next_t IS NULL THEN prev_t
                WHEN epoch(probe_time) - epoch(prev_t) <= epoch(next_t) - epoch(probe_time) THEN prev_t
                ELSE next_t END AS match_time FROM nxt)
SELECT pick.probe_id, pick.sensor, pick.probe_time, pick.match_time,
       abs(epoch_us(pick.probe_time) - epoch_us(pick.match_time)) / 1e6 AS gap_seconds,
       h.traffic_volume
FROM pick LEFT JOIN hourly h ON h.sensor = pick.sensor AND h.date_time = pick.match_time""", "gap_seconds"))
def q_asof(spark, sf):
    readings = tables.hourly(spark, sf, EV)
    m = A.asof_join(_asof_probes(spark, sf), readings)
    r = readings.select("sensor", F.col("date_time").alias("match_time"), "traffic_volume")
    return rounded(m.join(r, ["sensor", "match_time"], "left")
                   .select("probe_id", "sensor", "probe_time", "match_time", "gap_seconds", "traffic_volume"))


@query("day_type_filter", W_EV + "SELECT sensor, count(*) AS n_weekend_hours FROM feat WHERE is_weekend = 1 GROUP BY 1")
def q_day_type(spark, sf):
    return A.day_type_filter(tables.features(spark, sf, EV), "weekend") \
            .groupBy("sensor").agg(F.count(F.lit(1)).alias("n_weekend_hours"))


RANK_SQL = W_EV + """SELECT hour, avg(traffic_volume) AS avg_traffic_volume, count(*) AS hours_observed
FROM feat {where} GROUP BY hour ORDER BY avg_traffic_volume {order}, hour LIMIT 5"""


@query("busiest_hours", rnd(RANK_SQL.format(where="", order="DESC"), "avg_traffic_volume"))
def q_busiest(spark, sf):
    return rounded(A.busiest_hours(tables.features(spark, sf, EV), 5, "all"))


@query("quietest_hours", rnd(RANK_SQL.format(where="WHERE is_weekend = 0", order="ASC"), "avg_traffic_volume"))
def q_quietest(spark, sf):
    return rounded(A.quietest_hours(tables.features(spark, sf, EV), 5, "weekday"))


@query("compare_day_types", rnd(W_EV + """
, s AS (SELECT avg(traffic_volume) FILTER (WHERE is_weekend = 0) AS m0, avg(traffic_volume) FILTER (WHERE is_weekend = 1) AS m1,
   median(traffic_volume) FILTER (WHERE is_weekend = 0) AS d0, median(traffic_volume) FILTER (WHERE is_weekend = 1) AS d1,
   stddev_samp(traffic_volume) FILTER (WHERE is_weekend = 0) AS s0, stddev_samp(traffic_volume) FILTER (WHERE is_weekend = 1) AS s1,
   CAST(count(*) FILTER (WHERE is_weekend = 0) AS DOUBLE) AS n0, CAST(count(*) FILTER (WHERE is_weekend = 1) AS DOUBLE) AS n1
   FROM feat)
SELECT statistic, weekday, weekend, weekday - weekend AS difference FROM (
  SELECT 'Mean' AS statistic, m0 AS weekday, m1 AS weekend FROM s UNION ALL SELECT 'Median', d0, d1 FROM s
  UNION ALL SELECT 'Std dev', s0, s1 FROM s UNION ALL SELECT 'Hours (n)', n0, n1 FROM s)""",
                                "weekday weekend difference"))
def q_compare(spark, sf):
    return rounded(A.compare_day_types(tables.features(spark, sf, EV)))


@query("day_readings", rnd(W_EV + f"""SELECT {LOOK_COLS}, congestion_category FROM feat
WHERE CAST(date_time AS DATE) = DATE '2024-01-10' ORDER BY date_time, sensor""", "temp"))
def q_day_readings(spark, sf):
    return rounded(A.day_readings(tables.features(spark, sf, EV), "2024-01-10")
                   .select(*LOOK_COLS.split(", "), "congestion_category"))


@query("condition_summary", rnd(W_EV + """SELECT 'rain' AS condition, count(*) AS n, avg(traffic_volume) AS mean,
       CAST(median(traffic_volume) AS DOUBLE) AS median FROM hourly WHERE weather_main = 'rain'""", "mean median"))
def q_condition(spark, sf):
    return rounded(A.condition_summary(tables.hourly(spark, sf, EV), " Rain "))


@query("category_breakdown", rnd(W_EV + """
, spine AS (SELECT * FROM (VALUES ('Low', 0), ('Medium', 1), ('High', 2), ('Very High', 3)) v(category, ordinal)),
m AS (SELECT * FROM feat WHERE weather_main = 'fog'),
c AS (SELECT congestion_category AS category, count(*) AS n FROM m GROUP BY 1)
SELECT s.category, CAST(s.ordinal AS INTEGER) AS ordinal, coalesce(c.n, 0) AS n,
       coalesce(100.0 * c.n / (SELECT count(*) FROM m), 0.0) AS pct
FROM spine s LEFT JOIN c ON s.category = c.category ORDER BY s.ordinal""", "pct"))
def q_breakdown(spark, sf):
    m = tables.features(spark, sf, EV).filter(F.col("weather_main") == "fog")
    return rounded(A.category_breakdown(m))


@query("format_reading", W_EV + """SELECT sensor, date_time,
       strftime(date_time, '%Y-%m-%d %H:%M') || ' (' || dayname(date_time) || ')  traffic='
       || format('{:,}', traffic_volume) || ' veh/hr  category=' || congestion_category || '  weather='
       || weather_main || '  temp=' || printf('%.1f', temp - 273.15) || '°C' AS reading_text
FROM feat""")
def q_format(spark, sf):
    return A.format_reading(tables.features(spark, sf, EV)).select("sensor", "date_time", "reading_text")


# ------------------------------------------------------------------ 2.F ----

PIVOT_SQL = W_EV + """SELECT hour, avg(traffic_volume) FILTER (WHERE is_weekend = 0) AS weekday_mean,
       avg(traffic_volume) FILTER (WHERE is_weekend = 1) AS weekend_mean FROM feat GROUP BY hour"""


@query("hour_by_daytype_pivot", rnd(PIVOT_SQL, "weekday_mean weekend_mean"))
def q_pivot(spark, sf):
    return rounded(A.hour_by_daytype_pivot(tables.features(spark, sf, EV)))


@query("peak_hour", rnd(f"""SELECT arg_min(hour, (-weekday_mean, hour)) AS weekday_peak_hour, max(weekday_mean) AS weekday_peak_mean,
       arg_min(hour, (-weekend_mean, hour)) AS weekend_peak_hour, max(weekend_mean) AS weekend_peak_mean,
       avg(weekday_mean) - avg(weekend_mean) AS mean_difference FROM ({PIVOT_SQL}) p""",
                        "weekday_peak_mean weekend_peak_mean mean_difference"))
def q_peak(spark, sf):
    return rounded(A.peak_hour(A.hour_by_daytype_pivot(tables.features(spark, sf, EV))))


@query("boxplot_stats", rnd(W_EV + """
, q AS (SELECT is_weekend, quantile_cont(traffic_volume, 0.25) AS q1, quantile_cont(traffic_volume, 0.5) AS median,
               quantile_cont(traffic_volume, 0.75) AS q3 FROM feat GROUP BY 1),
f AS (SELECT q.*, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT CASE WHEN f.is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type, count(*) AS n,
       any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3, any_value(iqr) AS iqr,
       min(traffic_volume) FILTER (WHERE traffic_volume BETWEEN lo AND hi) AS whisker_low,
       max(traffic_volume) FILTER (WHERE traffic_volume BETWEEN lo AND hi) AS whisker_high,
       count(*) FILTER (WHERE NOT (traffic_volume BETWEEN lo AND hi)) AS n_fliers
FROM feat JOIN f ON feat.is_weekend = f.is_weekend GROUP BY f.is_weekend""", "q1 median q3 iqr"))
def q_box(spark, sf):
    return rounded(A.boxplot_stats(tables.features(spark, sf, EV)))


WEATHER_N_SQL = W_EV + """
, s AS (SELECT weather_main, avg(traffic_volume) AS mean, count(*) AS n FROM hourly GROUP BY 1 HAVING count(*) >= 50)
SELECT weather_main, mean, n, CASE WHEN mean < (SELECT median(mean) FROM s) THEN 1 ELSE 0 END AS below_median FROM s"""


@query("mean_by_weather_min_n", rnd(WEATHER_N_SQL, "mean"))
def q_weather_n(spark, sf):
    return rounded(A.mean_by_weather_min_n(tables.hourly(spark, sf, EV), 50))


@query("extreme_difference", rnd(f"""SELECT arg_max(weather_main, mean) AS highest, max(mean) AS highest_mean,
       arg_min(weather_main, mean) AS lowest, min(mean) AS lowest_mean, max(mean) - min(mean) AS difference
FROM ({WEATHER_N_SQL}) x""", "highest_mean lowest_mean difference"))
def q_extreme(spark, sf):
    return rounded(A.extreme_difference(A.mean_by_weather_min_n(tables.hourly(spark, sf, EV), 50)))


@query("sample_rows", rnd(W_EV + """SELECT sensor, date_time, temp, traffic_volume, congestion_category FROM feat
ORDER BY md5('42|' || sensor || '|' || strftime(date_time, '%Y-%m-%d %H:%M:%S')), sensor, date_time LIMIT 4000""",
                          "temp"))
def q_sample(spark, sf):
    return rounded(A.sample_rows(tables.features(spark, sf, EV), 4000, 42)
                   .select("sensor", "date_time", "temp", "traffic_volume", "congestion_category"))


@query("histogram", rnd(W_EV + """
, mm AS (SELECT CAST(min(traffic_volume) AS DOUBLE) AS lo, CAST(max(traffic_volume) AS DOUBLE) AS hi FROM hourly),
b AS (SELECT CAST(coalesce(least(floor((traffic_volume - lo) / ((hi - lo) / 40)), 39), 0) AS INTEGER) AS bin, count(*) AS n
      FROM hourly, mm WHERE traffic_volume IS NOT NULL GROUP BY 1)
SELECT CAST(s.bin AS INTEGER) AS bin, lo + s.bin * ((hi - lo) / 40) AS bin_start, lo + (s.bin + 1) * ((hi - lo) / 40) AS bin_end,
       coalesce(b.n, 0) AS n
FROM (SELECT range AS bin FROM range(40)) s CROSS JOIN mm LEFT JOIN b ON s.bin = b.bin""", "bin_start bin_end"))
def q_hist(spark, sf):
    return rounded(A.histogram(tables.hourly(spark, sf, EV), "traffic_volume", 40))


@query("skewness_adjusted", rnd(W_EV + """SELECT skewness(traffic_volume) AS skewness, avg(traffic_volume) AS mean,
       CAST(median(traffic_volume) AS DOUBLE) AS median FROM hourly""", "skewness mean median"))
def q_skew(spark, sf):
    return rounded(A.skewness_adjusted(tables.hourly(spark, sf, EV)))


SHARE_SQL = W_OR + """SELECT strftime(date_time, '%Y-%m') AS year_month,
       avg(CASE WHEN congestion_category = 'Very High' THEN 1.0 ELSE 0.0 END) * 100 AS pct_very_high
FROM feat GROUP BY 1 ORDER BY 1"""


@query("monthly_share", rnd(SHARE_SQL, "pct_very_high"))
def q_share(spark, sf):
    return rounded(A.monthly_share(tables.features(spark, sf, OR)))


@query("peak_month", rnd(f"""SELECT arg_min(year_month, (-pct_very_high, year_month)) AS peak_month,
       max(pct_very_high) AS peak_pct FROM ({SHARE_SQL}) s""", "peak_pct"))
def q_peak_month(spark, sf):
    return rounded(A.peak_month(A.monthly_share(tables.features(spark, sf, OR))))


CHART_SQL = W_EV + ", " + with_tables(OR, suffix="_o")[len("WITH "):] + """
, piv AS (SELECT hour, avg(traffic_volume) FILTER (WHERE is_weekend = 0) AS wd,
                 avg(traffic_volume) FILTER (WHERE is_weekend = 1) AS we FROM feat GROUP BY hour),
pk AS (SELECT arg_min(hour, (-wd, hour)) AS wh, max(wd) AS wm, arg_min(hour, (-we, hour)) AS eh, max(we) AS em,
              avg(wd) - avg(we) AS md FROM piv),
bx AS (SELECT quantile_cont(traffic_volume, 0.5) FILTER (WHERE is_weekend = 0) AS d0,
              quantile_cont(traffic_volume, 0.5) FILTER (WHERE is_weekend = 1) AS d1 FROM feat),
wn AS (SELECT weather_main, avg(traffic_volume) AS mean FROM hourly GROUP BY 1 HAVING count(*) >= 50),
ex AS (SELECT arg_max(weather_main, mean) AS hi, max(mean) AS him, arg_min(weather_main, mean) AS lo,
              min(mean) AS lom FROM wn),
pr AS (SELECT covar_pop(temp, traffic_volume) / (stddev_pop(temp) * stddev_pop(traffic_volume)) AS r FROM hourly),
sk AS (SELECT skewness(traffic_volume) AS k, avg(traffic_volume) AS m, median(traffic_volume) AS d FROM hourly),
ms AS (SELECT strftime(date_time, '%Y-%m') AS ym,
              avg(CASE WHEN congestion_category = 'Very High' THEN 1.0 ELSE 0.0 END) * 100 AS pct FROM feat_o GROUP BY 1),
pm AS (SELECT arg_min(ym, (-pct, ym)) AS ym, max(pct) AS pp FROM ms)
SELECT 1 AS chart, printf('Weekday traffic peaks at %d:00 (%s veh/hr); weekend traffic peaks at %d:00 (%s veh/hr). '
       || 'Weekdays exceed weekends by %s veh/hr on average.', wh, format('{:,.0f}', wm), eh, format('{:,.0f}', em),
       format('{:,.0f}', md)) AS interpretation FROM pk
UNION ALL SELECT 2, printf('Median weekday volume (%s veh/hr) is %s veh/hr higher than the weekend median (%s veh/hr).',
       format('{:,.0f}', d0), format('{:,.0f}', d0 - d1), format('{:,.0f}', d1)) FROM bx
UNION ALL SELECT 3, printf(chr(39) || '%s' || chr(39) || ' carries the highest average volume (%s veh/hr) and '
       || chr(39) || '%s' || chr(39) || ' the lowest (%s veh/hr), a difference of %s veh/hr.',
       upper(substr(hi, 1, 1)) || substr(hi, 2), format('{:,.0f}', him),
       upper(substr(lo, 1, 1)) || substr(lo, 2), format('{:,.0f}', lom), format('{:,.0f}', him - lom)) FROM ex
UNION ALL SELECT 4, printf('Pearson r = %.3f between temperature and traffic volume.', r) FROM pr
UNION ALL SELECT 5, printf('Skewness is %.2f and the mean (%s) compares with the median (%s).', k,
       format('{:,.0f}', m), format('{:,.0f}', d)) FROM sk
UNION ALL SELECT 6, printf('The share of severely congested hours peaks at %s%% in %s.', format('{:,.0f}', pp),
       strftime(CAST(ym || '-01' AS DATE), '%B %Y')) FROM pm"""


@query("chart_interpretations", CHART_SQL)
def q_interp(spark, sf):
    f = tables.features(spark, sf, EV)
    h = tables.hourly(spark, sf, EV)
    fo = tables.features(spark, sf, OR)
    return A.chart_interpretations(
        A.peak_hour(A.hour_by_daytype_pivot(f)), A.boxplot_stats(f),
        A.extreme_difference(A.mean_by_weather_min_n(h, 50)), A.pearson(h), A.skewness_adjusted(h),
        A.peak_month(A.monthly_share(fo)))


# ------------------------------------------------------------- gates -------

@query("schema_gate", rnd(with_tables(EV, "raw") + """SELECT holiday, temp, rain_1h, snow_1h, clouds_all, weather_main,
       weather_description, date_time, traffic_volume FROM raw""", DOUBLES_RAW))
def q_schema_gate(spark, sf):
    """Expected raw columns present (extra ones reported); strict mode projects them."""
    from ..sources.schema import EXPECTED_RAW_COLUMNS, schema_gate
    return rounded(schema_gate(tables.raw(spark, sf, EV), EXPECTED_RAW_COLUMNS, strict=True))


@query("required_columns_gate", rnd(W_EV + "SELECT sensor, date_time, " + ", ".join(C.COMMON_FEATURE_COLUMNS)
                                    + " FROM lab", "hour_sin hour_cos dow_sin dow_cos temp_zscore clouds_all_minmax"))
def q_required_gate(spark, sf):
    from ..sources.schema import required_columns_gate
    lab = required_columns_gate(_lab(spark, sf), C.COMMON_FEATURE_COLUMNS)
    return rounded(lab.select("sensor", "date_time", *C.COMMON_FEATURE_COLUMNS))
