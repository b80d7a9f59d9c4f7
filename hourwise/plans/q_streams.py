"""Registered streaming queries: each runs a Structured Streaming
query over the events files (availableNow trigger, Parquet sink in the shared
folder) and returns the sink's contents. Oracles encode the append-mode rule:
a window / session is emitted once the watermark (max event time − 2 h) has
passed its end; duplicates are dropped on arrival.
"""
from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import drift as D
from ..operators import features as FE
from ..sources.adapters import events_to_readings
from ..streaming import streams as ST
from . import tables
from .oracle_base import with_tables
from .registry import query, rnd, rounded

EV = "events"
RAW = with_tables(EV, "raw")
M_SQL = "(SELECT max(date_time) FROM raw) - INTERVAL 2 HOUR"


def _readings_stream(spark, sf):
    tables.raw(spark, sf, EV)  # pins the session zone like the batch path
    return events_to_readings(ST.file_stream(spark, sf, "events"))


def _sink(df: DataFrame, name: str, sf: str) -> str:
    """A sink for each query, as it is written now, and input folder: a later session goes on with it, a changed query begins anew."""
    return f"{name}-{hashlib.md5(f'{sf} {ST.identity(df, name)}'.encode()).hexdigest()[:16]}"


def _run(df: DataFrame, name: str, sf: str) -> DataFrame:
    return df.sparkSession.read.parquet(ST.run_available(df, _sink(df, name, sf)))


@query("stream_dedupe_hourly", RAW + "SELECT DISTINCT sensor, date_time FROM raw WHERE date_time IS NOT NULL")
def q_stream_dedupe(spark, sf):
    out = _run(ST.dedupe_hourly(_readings_stream(spark, sf)), "dedupe", sf)
    return out.select("sensor", "date_time")


@query("stream_hourly_agg", rnd(RAW + f"""SELECT sensor, date_time AS window_start, date_time + INTERVAL 1 HOUR AS window_end,
       count(*) AS n_readings, avg(traffic_volume) AS avg_volume FROM raw
WHERE date_time + INTERVAL 1 HOUR <= {M_SQL} GROUP BY 1, 2""", "avg_volume"))
def q_stream_hourly(spark, sf):
    return rounded(_run(ST.hourly_agg(_readings_stream(spark, sf)), "hourly", sf))


@query("stream_rolling_mean", rnd(RAW + f"""
, x AS (SELECT sensor, date_time - to_hours(CAST(k AS INTEGER)) AS window_start, traffic_volume FROM raw, range(0, 6) t(k))
SELECT sensor, window_start, window_start + INTERVAL 6 HOUR AS window_end, count(*) AS n_readings,
       avg(traffic_volume) AS avg_volume
FROM x WHERE window_start + INTERVAL 6 HOUR <= {M_SQL} GROUP BY 1, 2""", "avg_volume"))
def q_stream_rolling(spark, sf):
    return rounded(_run(ST.rolling_mean(_readings_stream(spark, sf)), "rolling", sf))


@query("stream_blocks", RAW + f"""
, h AS (SELECT DISTINCT sensor, date_time FROM raw),
g AS (SELECT *, CASE WHEN lag(date_time) OVER (PARTITION BY sensor ORDER BY date_time) IS NULL
                     OR epoch(date_time) - epoch(lag(date_time) OVER (PARTITION BY sensor ORDER BY date_time)) > 3600
                THEN 1 ELSE 0 END AS st FROM h),
b AS (SELECT *, max(CASE WHEN st = 1 THEN date_time END) OVER (PARTITION BY sensor ORDER BY date_time
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS block_start FROM g),
e AS (SELECT sensor, block_start, max(date_time) + INTERVAL 1 HOUR AS block_end FROM b GROUP BY 1, 2)
SELECT e.sensor, e.block_start, e.block_end, count(*) AS n_readings
FROM e JOIN raw r ON r.sensor = e.sensor AND r.date_time >= e.block_start AND r.date_time < e.block_end
WHERE e.block_end <= {M_SQL} GROUP BY 1, 2, 3""")
def q_stream_blocks(spark, sf):
    return _run(ST.blocks(_readings_stream(spark, sf)), "blocks", sf)


@query("stream_validate", RAW + """
SELECT coalesce(reason, 'accepted') AS reject_reason, count(*) AS n FROM (
  SELECT CASE WHEN date_time IS NULL THEN 'unparseable date_time'
              WHEN clouds_all IS NULL OR clouds_all < 0 OR clouds_all > 100 THEN 'clouds_all out of range'
              WHEN rain_1h IS NULL OR rain_1h < 0 THEN 'rain_1h negative'
              WHEN snow_1h IS NULL OR snow_1h < 0 THEN 'snow_1h negative'
              WHEN lower(trim(weather_main)) IS NULL OR lower(trim(weather_main)) NOT IN
                   ('clear','clouds','drizzle','fog','haze','mist','rain','smoke','snow','squall','thunderstorm')
              THEN 'unknown weather_main' END AS reason
  FROM raw) GROUP BY 1""")
def q_stream_validate(spark, sf):
    out = _run(ST.validate(_readings_stream(spark, sf)), "validate", sf)
    return out.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("reject_reason")) \
              .agg(F.count(F.lit(1)).alias("n"))


@query("stream_score")
def q_stream_score(spark, sf):
    """Raw readings → features with the stored training statistics → the
    registry's champion model, tagged with name / version / alias."""
    from .q_models import _versions, load_by_alias
    from ..operators import tracking as TR
    model = load_by_alias(spark, sf, "champion")
    params = FE.scaling_params(tables.hourly(spark, sf, EV))
    feats = FE.engineer_reading(_readings_stream(spark, sf), params).filter(F.col("feature_error").isNull())
    scored = model.transform(feats).select("row_id", "sensor", "date_time",
                                           F.col("prediction").cast("int").alias("prediction"),
                                           F.col("probability").cast("string").alias("probability"))
    versions = _versions(spark, sf)
    tagged = TR.alias_join(scored, TR.register_versions(versions), TR.alias_table(versions), "champion")
    return _run(tagged, "score", sf)


STREAM_DRIFT_SQL = with_tables(EV) + """
, rw AS (SELECT lower(trim(weather_main)) AS weather_main, CAST(hour(date_time) AS INTEGER) AS hour FROM raw),
rc AS (SELECT weather_main AS bin, count(*) AS r FROM lab GROUP BY 1),
cc AS (SELECT weather_main AS bin, count(*) AS c FROM rw GROUP BY 1),
bw AS (SELECT coalesce(rc.bin, cc.bin) AS bin, coalesce(r, 0) AS r, coalesce(c, 0) AS c
       FROM rc FULL JOIN cc ON rc.bin IS NOT DISTINCT FROM cc.bin),
pw AS (SELECT sum((c * 1.0 / (SELECT sum(c) FROM bw) + 1e-4 - (r * 1.0 / (SELECT sum(r) FROM bw) + 1e-4))
                  * ln((c * 1.0 / (SELECT sum(c) FROM bw) + 1e-4) / (r * 1.0 / (SELECT sum(r) FROM bw) + 1e-4))) AS psi FROM bw),
sp AS (SELECT CAST(range AS INTEGER) AS bin FROM range(25)),
rh AS (SELECT hour AS bin, count(*) AS r FROM lab GROUP BY 1),
ch AS (SELECT hour AS bin, count(*) AS c FROM rw GROUP BY 1),
bh AS (SELECT sp.bin, coalesce(r, 0) AS r, coalesce(c, 0) AS c FROM sp LEFT JOIN rh ON sp.bin = rh.bin
       LEFT JOIN ch ON sp.bin = ch.bin),
ph AS (SELECT sum((c * 1.0 / (SELECT sum(c) FROM bh) + 1e-4 - (r * 1.0 / (SELECT sum(r) FROM bh) + 1e-4))
                  * ln((c * 1.0 / (SELECT sum(c) FROM bh) + 1e-4) / (r * 1.0 / (SELECT sum(r) FROM bh) + 1e-4))) AS psi FROM bh)
SELECT 'batch_0' AS "window", 'feature_drift' AS kind, 'psi_weather_main' AS "check", psi AS value, 0.0 AS reference_value,
       '> 0.25' AS threshold, '' AS extra,
       CASE WHEN psi > 0.25 THEN 'ALERT' WHEN psi > 0.10 THEN 'MODERATE' ELSE 'PASS' END AS status FROM pw
UNION ALL
SELECT 'batch_0', 'feature_drift', 'psi_hour_of_day', psi, 0.0, '> 0.25', '',
       CASE WHEN psi > 0.25 THEN 'ALERT' WHEN psi > 0.10 THEN 'MODERATE' ELSE 'PASS' END FROM ph"""


@query("stream_drift", rnd(STREAM_DRIFT_SQL, "value reference_value"))
def q_stream_drift(spark, sf):
    """Per micro-batch: PSI of weather and hour vs the reference table,
    appended as report rows to a Parquet table (foreachBatch)."""
    from ..sources.io import materialize
    ref = materialize(tables.labelled(spark, sf, EV).select("weather_main", "hour")
                      .withColumn("window", F.lit("reference")), "stream-drift-reference")
    stream = _readings_stream(spark, sf)
    sink = _sink(stream, "drift", sf)
    report_path = f"{ST.sink_path(spark, sink)}/report"

    def per_batch(batch: DataFrame, epoch: int) -> None:
        cur = batch.select(F.lower(F.trim("weather_main")).alias("weather_main"),
                           F.hour("date_time").alias("hour")).withColumn("window", F.lit(f"batch_{epoch}"))
        both = ref.unionByName(cur)
        rows = D.drift_report([D.psi_rows(D.psi_categorical(both, "weather_main"), "psi_weather_main"),
                               D.psi_rows(D.psi_spine(both, "hour", 25), "psi_hour_of_day")])
        # one folder a batch: a batch that is run again replaces its rows
        rows.write.mode("overwrite").parquet(f"{report_path}/epoch={epoch}")

    ST.run_available(stream, sink, foreach_batch=per_batch)
    return rounded(spark.read.parquet(report_path).drop("epoch"))
