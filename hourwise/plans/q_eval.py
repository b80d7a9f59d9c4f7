"""Registered evaluation and drift (2.N) queries.

Scored tables are derived from the events readings: a fixed, transparent
scoring rule stands in for a classifier (so metric operators can be checked
exactly against SQL), and naive persistence (previous hour in the block) is
the regressor. Windows: the chronological 80 % = 'reference', the rest =
'test_period'.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as D
from ..operators import evaluation as EVL
from ..operators import timeseries as TSO
from . import tables
from .oracle_base import with_tables
from .q_timeseries import BLOCKS_SQL
from .registry import query, rnd, rounded

EV = "events"


def rule_score():
    return ((F.col("clouds_all") / 100 + F.col("is_low_visibility") + F.col("is_severe_weather")
             + (F.col("traffic_volume") > 700).cast("int")) / 4.0)


def scored(spark, sf):
    """Labelled readings with window, label, score, prediction, actual, lag
    prediction (materialized once per session)."""
    return tables._memo(spark, ("scored", sf, EV), lambda: _scored(spark, sf))


def _scored(spark, sf):
    split = TSO.chronological_split(tables.blocks(spark, sf, EV), 0.2)
    s = split.withColumn("window", F.when(F.col("split") == "train", "reference").otherwise("test_period")) \
             .withColumns({"label": F.col("high_risk"), "score": rule_score()}) \
             .withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    lagged = TSO.lag_features(s, lags=(1,), rolls=())
    return lagged.withColumns({"actual": F.col("traffic_volume").cast("double"),
                               "persist_pred": F.col("lag_1").cast("double")})


SCORED_SQL = BLOCKS_SQL.replace("WITH raw AS", "WITH raw AS", 1) + """
, r AS (SELECT *, row_number() OVER (ORDER BY date_time, sensor) - 1 AS rk, count(*) OVER () AS nn FROM blocks),
sc AS (SELECT *, CASE WHEN rk < floor(nn * 0.8) THEN 'reference' ELSE 'test_period' END AS "window",
              high_risk AS label,
              (clouds_all / 100 + is_low_visibility + is_severe_weather
               + CASE WHEN traffic_volume > 700 THEN 1 ELSE 0 END) / 4.0 AS score,
              CAST(traffic_volume AS DOUBLE) AS actual,
              CAST(lag(traffic_volume, 1) OVER (PARTITION BY sensor, block_start ORDER BY date_time) AS DOUBLE)
                AS persist_pred
       FROM r),
s AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM sc)
"""

CM_SQL = """count(*) FILTER (WHERE label <> 1 AND prediction <> 1) AS tn, count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp,
       count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp"""

AUC_SQL = """auc AS (
  SELECT "window", (sum(CASE WHEN label = 1 THEN rmin + (c - 1) / 2.0 END) - P * (P + 1) / 2.0) / nullif(P * N, 0) AS roc_auc
  FROM (SELECT "window", label, rank() OVER (PARTITION BY "window" ORDER BY score) AS rmin,
               count(*) OVER (PARTITION BY "window", score) AS c,
               sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY "window") AS P,
               sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY "window") AS N
        FROM s WHERE score IS NOT NULL) x GROUP BY "window", P, N)"""

METRICS_SQL = f""", cm AS (SELECT "window", {CM_SQL} FROM s GROUP BY "window"),
{AUC_SQL}
SELECT cm."window", tp + fp + fn + tn AS n, coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0.0) AS accuracy,
       coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
       coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1, auc.roc_auc
FROM cm LEFT JOIN auc ON cm."window" = auc.window"""


@query("confusion_matrix", SCORED_SQL + f'SELECT "window", {CM_SQL} FROM s GROUP BY 1')
def q_cm(spark, sf):
    return EVL.confusion_matrix(scored(spark, sf), by=["window"])


@query("classification_metrics", rnd(SCORED_SQL + METRICS_SQL, "accuracy precision recall f1 roc_auc"))
def q_cls_metrics(spark, sf):
    return rounded(EVL.classification_metrics(scored(spark, sf), score="score", by=["window"]))


@query("roc_auc", rnd(SCORED_SQL + ", " + AUC_SQL + ' SELECT "window", roc_auc FROM auc', "roc_auc"))
def q_auc(spark, sf):
    return rounded(EVL.roc_auc(scored(spark, sf), by=["window"]))


@query("roc_curve", rnd(SCORED_SQL + """
, c AS (SELECT score AS threshold, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
        FROM s WHERE score IS NOT NULL GROUP BY 1)
SELECT threshold, sum(pos) OVER (ORDER BY threshold DESC) / (SELECT sum(pos) FROM c) AS tpr,
       sum(neg) OVER (ORDER BY threshold DESC) / (SELECT sum(neg) FROM c) AS fpr FROM c""", "threshold tpr fpr"))
def q_roc(spark, sf):
    return rounded(EVL.roc_curve(scored(spark, sf)))


@query("class_weights", rnd(SCORED_SQL + """
, c AS (SELECT label, count(*) AS n FROM s GROUP BY 1)
SELECT label, n, (SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n) AS weight FROM c""", "weight"))
def q_weights(spark, sf):
    return rounded(EVL.class_weights(scored(spark, sf), "label"))


@query("target_summary", rnd(SCORED_SQL + """SELECT "window" AS split, count(*) AS n, avg(CAST(label AS DOUBLE)) AS positive_rate,
       avg(traffic_volume) AS target_mean, stddev_samp(traffic_volume) AS target_std FROM s GROUP BY 1""",
                            "positive_rate target_mean target_std"))
def q_target_summary(spark, sf):
    return rounded(EVL.target_summary(scored(spark, sf), split="window").withColumnRenamed("window", "split"))


REG_SQL = """SELECT {by} count(*) AS n, avg(abs(actual - persist_pred)) AS mae,
       sqrt(avg((actual - persist_pred) * (actual - persist_pred))) AS rmse,
       1 - sum((actual - persist_pred) * (actual - persist_pred))
           / nullif(sum(actual * actual) - sum(actual) * sum(actual) / count(*), 0) AS r2
FROM {src} WHERE actual IS NOT NULL AND persist_pred IS NOT NULL {group}"""


@query("regression_metrics", rnd(SCORED_SQL + REG_SQL.format(by='"window",', src="s", group='GROUP BY "window"'),
                                 "mae rmse r2"))
def q_reg_metrics(spark, sf):
    return rounded(EVL.regression_metrics(scored(spark, sf), "actual", "persist_pred", by=["window"]))


@query("naive_persistence", rnd(BLOCKS_SQL + """
, bl AS (SELECT sensor, date_time, CAST(lag(traffic_volume, 1) OVER (PARTITION BY sensor, block_start
                ORDER BY date_time) AS DOUBLE) AS persist_pred FROM blocks),
t AS (SELECT s.*, CAST(s.traffic_volume AS DOUBLE) AS actual, bl.persist_pred
      FROM bl JOIN splits s ON bl.sensor = s.sensor AND bl.date_time = s.date_time)
""" + REG_SQL.format(by="", src="t", group="AND split = 'test'"), "mae rmse r2"))
def q_naive(spark, sf):
    b = tables.blocks(spark, sf, EV)
    t = TSO.three_way_split(TSO.in_block_features(b, lags=(1,), rolls=()))
    test = t.filter(F.col("split") == "test").withColumns({
        "actual": F.col("traffic_volume").cast("double"), "persist_pred": F.col("lag_1").cast("double")})
    return rounded(EVL.regression_metrics(test, "actual", "persist_pred"))


# ------------------------------------------------------------------ 2.N ----

# the severe-winter window: as many rows as the test period, drawn from the reference's ranks by hashes of the draw's number
def _uniform_sql(name: str) -> str:
    return f"((CAST('0x' || substr(md5('42:{name}:' || draw), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)"


def _normal_sql(name: str) -> str:
    return f"(sqrt(-2.0 * ln({_uniform_sql(name + '1')})) * cos(2 * pi() * {_uniform_sql(name + '2')}))"


WINTER_SQL = f"""
, ref AS (SELECT avg(temp) AS t_mean, stddev_samp(temp) AS t_std, min(clouds_all) AS c_min, max(clouds_all) AS c_max, count(*) AS n_ref
          FROM s WHERE "window" = 'reference'),
drawn AS (SELECT s.*, draw FROM (SELECT range AS draw FROM range((SELECT count(*) FROM s WHERE "window" = 'test_period'))) d, ref
          JOIN s ON s."window" = 'reference' AND s.rk = CAST(floor({_uniform_sql('rank')} * n_ref) AS BIGINT)),
shifted AS (SELECT * REPLACE (temp - 18 + 2 * {_normal_sql('temp')} AS temp,
              least(100.0, greatest(0.0, clouds_all + 35 + 5 * {_normal_sql('clouds')})) AS clouds_all,
              CASE WHEN {_uniform_sql('weather')} < 0.35 THEN 'snow' WHEN {_uniform_sql('weather')} < 0.35 + 0.25 THEN 'fog'
                   WHEN {_uniform_sql('weather')} < 0.35 + 0.25 + 0.15 THEN 'mist'
                   WHEN {_uniform_sql('weather')} < 0.35 + 0.25 + 0.15 + 0.10 THEN 'thunderstorm' ELSE 'clouds' END AS weather_main) FROM drawn),
winter AS (SELECT * REPLACE ('synthetic_severe_winter' AS "window",
              CASE WHEN weather_main IN ('thunderstorm', 'squall') THEN 1 ELSE 0 END AS is_severe_weather,
              CASE WHEN weather_main IN ('fog', 'mist', 'haze', 'smoke') THEN 1 ELSE 0 END AS is_low_visibility,
              CASE WHEN weather_main IN ('drizzle', 'rain', 'snow') THEN 1 ELSE 0 END AS is_precipitating,
              (temp - t_mean) / t_std AS temp_zscore, (clouds_all - c_min) / (c_max - c_min) AS clouds_all_minmax)
           FROM shifted, ref)
"""

WINDOWS_SQL = SCORED_SQL + WINTER_SQL + """
, rescored AS (SELECT * REPLACE ((clouds_all / 100 + is_low_visibility + is_severe_weather
                 + CASE WHEN traffic_volume > 700 THEN 1 ELSE 0 END) / 4.0 AS score) FROM winter),
w AS (SELECT "window", sensor, date_time, hour, temp, clouds_all, weather_main, label, score, prediction, actual, persist_pred FROM s
      UNION ALL
      SELECT "window", sensor, date_time, hour, temp, clouds_all, weather_main, label, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END,
             actual, persist_pred FROM rescored)
"""

# p-values: the asymptotic distribution, by its series from lambda = 1 on and by its theta form below
KS_SQL = """
, rc_{c} AS (SELECT {c} AS v, count(*) AS k FROM w WHERE "window" = 'reference' AND {c} IS NOT NULL GROUP BY 1),
cc_{c} AS (SELECT "window", {c} AS v, count(*) AS k FROM w WHERE "window" <> 'reference' AND {c} IS NOT NULL GROUP BY 1, 2),
grid_{c} AS (SELECT "window", v FROM cc_{c} UNION SELECT x."window", rc_{c}.v FROM (SELECT DISTINCT "window" FROM cc_{c}) x, rc_{c}),
cum_{c} AS (SELECT g."window", sum(coalesce(rc.k, 0)) OVER o AS cr, sum(coalesce(cc.k, 0)) OVER o AS cc,
              sum(coalesce(rc.k, 0)) OVER (PARTITION BY g."window") AS nr, sum(coalesce(cc.k, 0)) OVER (PARTITION BY g."window") AS nc
            FROM grid_{c} g LEFT JOIN rc_{c} rc ON g.v = rc.v LEFT JOIN cc_{c} cc ON g.v = cc.v AND g."window" = cc."window"
            WINDOW o AS (PARTITION BY g."window" ORDER BY g.v)),
ks_{c} AS (SELECT "window", max(abs(cr / nr - cc / nc)) AS ks_stat, max(abs(cr / nr - cc / nc)) * sqrt(any_value(nr) * any_value(nc)
              / (any_value(nr) + any_value(nc))) AS lam FROM cum_{c} GROUP BY 1),
kp_{c} AS (SELECT "window", ks_stat, CASE WHEN lam <= 0 THEN 1.0 ELSE greatest(0.0, least(1.0, CASE WHEN lam < 1
             THEN 1 - sqrt(2 * pi()) / lam * list_sum(list_transform(range(1, 12), lambda j: exp(-pow(2 * j - 1, 2) * pi() * pi() / (8 * lam * lam))))
             ELSE list_sum(list_transform(range(1, 12), lambda j: 2.0 * pow(-1, j - 1) * exp(-2.0 * j * j * lam * lam))) END)) END AS p_value FROM ks_{c})"""


def _windows(spark, sf):
    """reference, test_period, synthetic_severe_winter: scored rows (written once per session)."""
    return tables._memo(spark, ("windows", sf, EV), lambda: _with_winter(scored(spark, sf)))


def winter_rows(s):
    """The severe-winter window of scored rows: as many as the test period has, drawn from the reference."""
    reference = s.filter(F.col("window") == "reference")
    return D.perturb_batch(reference, s.filter(F.col("window") == "test_period").count()).withColumn("window", F.lit("synthetic_severe_winter"))


def _with_winter(s):
    winter = winter_rows(s).drop("draw").withColumn("score", rule_score()).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    return s.unionByName(winter)


@query("ks_two_sample", rnd(WINDOWS_SQL + KS_SQL.format(c="temp") + ' SELECT "window", ks_stat, p_value FROM kp_temp',
                            "ks_stat p_value"))
def q_ks(spark, sf):
    """The asymptotic p-value, as in SQL; the monitor of the fitted models takes the exact one of small windows."""
    return rounded(D.ks_two_sample(_windows(spark, sf), "temp").select("window", "ks_stat", "p_value"))


PSI_TERMS_SQL = """sum((c * 1.0 / tc + 1e-4 - (r * 1.0 / tr + 1e-4)) * ln((c * 1.0 / tc + 1e-4) / (r * 1.0 / tr + 1e-4))) AS psi
   FROM (SELECT *, sum(c) OVER (PARTITION BY "window") AS tc, sum(r) OVER (PARTITION BY "window") AS tr FROM {b}) GROUP BY 1"""

# bins of the reference or of the window; a missing value is no bin
PSI_CAT_SQL = """
, b_{c} AS (SELECT x."window", v.bin, count(*) FILTER (w."window" = 'reference') AS r, count(*) FILTER (w."window" = x."window") AS c
            FROM (SELECT DISTINCT "window" FROM w WHERE "window" <> 'reference') x, (SELECT DISTINCT {c} AS bin FROM w WHERE {c} IS NOT NULL) v
            JOIN w ON w.{c} = v.bin GROUP BY 1, 2),
psi_{c} AS (SELECT "window", """ + PSI_TERMS_SQL.replace("{b}", "b_{c} WHERE r > 0 OR c > 0") + ")"

PSI_HOUR_SQL = """
, b_h AS (SELECT x."window", v.bin, count(*) FILTER (w."window" = 'reference') AS r, count(*) FILTER (w."window" = x."window") AS c
          FROM (SELECT DISTINCT "window" FROM w WHERE "window" <> 'reference') x, (SELECT range AS bin FROM range(25)) v
          LEFT JOIN w ON w.hour = v.bin GROUP BY 1, 2),
psi_h AS (SELECT "window", """ + PSI_TERMS_SQL.replace("{b}", "b_h") + ")"


@query("psi_categorical", rnd(WINDOWS_SQL + PSI_CAT_SQL.format(c="weather_main") + ' SELECT "window", psi FROM psi_weather_main',
                              "psi"))
def q_psi_cat(spark, sf):
    return rounded(D.psi_categorical(_windows(spark, sf), "weather_main"))


@query("psi_hour", rnd(WINDOWS_SQL + PSI_HOUR_SQL + ' SELECT "window", psi FROM psi_h', "psi"))
def q_psi_hour(spark, sf):
    return rounded(D.psi_spine(_windows(spark, sf), "hour", 25))


@query("psi_numeric", rnd(WINDOWS_SQL + """
, mm AS (SELECT x."window", min(temp) AS lo, max(temp) AS hi FROM (SELECT DISTINCT "window" FROM w WHERE "window" <> 'reference') x
         JOIN w ON w."window" IN ('reference', x."window") GROUP BY 1),
bn AS (SELECT mm."window", w."window" = 'reference' AS is_ref, CAST(coalesce(least(floor((temp - lo) / ((hi - lo) / 10)), 9), 0) AS INTEGER) AS bin
       FROM mm JOIN w ON w."window" IN ('reference', mm."window") WHERE temp IS NOT NULL),
b AS (SELECT mm."window", v.range AS bin, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c
      FROM mm, range(10) v LEFT JOIN bn ON bn."window" = mm."window" AND bn.bin = v.range GROUP BY 1, 2)
SELECT "window", """ + PSI_TERMS_SQL.format(b="b"), "psi"))
def q_psi_num(spark, sf):
    return rounded(D.psi_numeric(_windows(spark, sf), "temp", 10))


@query("psi_status", rnd(WINDOWS_SQL + PSI_CAT_SQL.format(c="weather_main") + """
SELECT "window", psi, CASE WHEN psi > 0.25 THEN 'ALERT' WHEN psi > 0.10 THEN 'MODERATE' ELSE 'PASS' END AS status
FROM psi_weather_main""", "psi"))
def q_psi_status(spark, sf):
    p = D.psi_categorical(_windows(spark, sf), "weather_main")
    return rounded(p.withColumn("status", D.psi_status(F.col("psi"))))


F1_DRIFT_SQL = f""", cm AS (SELECT "window", {CM_SQL} FROM w GROUP BY "window"),
f AS (SELECT "window", coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM cm),
fd AS (SELECT c."window", 'prediction_error_drift' AS kind, 'classifier_f1_drift' AS "check", c.f1 AS value,
         r.f1 AS reference_value, printf('reference F1=%.3f, drop > 0.05', r.f1) AS threshold,
         printf('drop=%.3f', r.f1 - c.f1) AS extra, CASE WHEN r.f1 - c.f1 > 0.05 THEN 'ALERT' ELSE 'PASS' END AS status
       FROM f c, f r WHERE c."window" <> 'reference' AND r."window" = 'reference')"""

MAE_DRIFT_SQL = """, m AS (SELECT "window", avg(abs(actual - persist_pred)) AS mae FROM w
       WHERE actual IS NOT NULL AND persist_pred IS NOT NULL GROUP BY "window"),
md AS (SELECT c."window", 'prediction_error_drift' AS kind, 'regressor_mae_drift' AS "check", c.mae AS value,
         r.mae AS reference_value, printf('reference MAE=%.1f, increase > 25%%', r.mae) AS threshold,
         printf('increase=%.1f%%', coalesce((c.mae - r.mae) / nullif(r.mae, 0), 0.0) * 100) AS extra,
         CASE WHEN coalesce((c.mae - r.mae) / nullif(r.mae, 0), 0.0) > 0.25 THEN 'ALERT' ELSE 'PASS' END AS status
       FROM m c, m r WHERE c."window" <> 'reference' AND r."window" = 'reference')"""


@query("f1_drift", rnd(WINDOWS_SQL + F1_DRIFT_SQL + " SELECT * FROM fd", "value reference_value"))
def q_f1_drift(spark, sf):
    return rounded(D.f1_drift(_windows(spark, sf)))


@query("mae_drift", rnd(WINDOWS_SQL + MAE_DRIFT_SQL + " SELECT * FROM md", "value reference_value"))
def q_mae_drift(spark, sf):
    return rounded(D.mae_drift(_windows(spark, sf), "actual", "persist_pred"))


REPORT_SQL = (WINDOWS_SQL + KS_SQL.format(c="temp") + KS_SQL.format(c="clouds_all") + PSI_HOUR_SQL
              + PSI_CAT_SQL.format(c="weather_main") + F1_DRIFT_SQL + MAE_DRIFT_SQL + """
, report AS (
  SELECT "window", 'feature_drift' AS kind, 'ks_temp' AS "check", ks_stat AS value, 0.0 AS reference_value,
         'ks_stat > 0.15 (and p < 0.05)' AS threshold, printf('p_value=%.3e', p_value) AS extra,
         CASE WHEN p_value < 0.05 AND ks_stat > 0.15 THEN 'ALERT' ELSE 'PASS' END AS status FROM kp_temp
  UNION ALL
  SELECT "window", 'feature_drift', 'ks_clouds_all', ks_stat, 0.0, 'ks_stat > 0.15 (and p < 0.05)',
         printf('p_value=%.3e', p_value), CASE WHEN p_value < 0.05 AND ks_stat > 0.15 THEN 'ALERT' ELSE 'PASS' END
  FROM kp_clouds_all
  UNION ALL
  SELECT "window", 'feature_drift', 'psi_hour_of_day', psi, 0.0, '> 0.25', '',
         CASE WHEN psi > 0.25 THEN 'ALERT' WHEN psi > 0.10 THEN 'MODERATE' ELSE 'PASS' END FROM psi_h
  UNION ALL
  SELECT "window", 'feature_drift', 'psi_weather_main', psi, 0.0, '> 0.25', '',
         CASE WHEN psi > 0.25 THEN 'ALERT' WHEN psi > 0.10 THEN 'MODERATE' ELSE 'PASS' END FROM psi_weather_main
  UNION ALL SELECT * FROM fd UNION ALL SELECT * FROM md)
""")


def report_of(w, value_pred: str, exact_to: int):
    """The six checks of every window of a scored table."""
    feats = [D.ks_rows(w, "temp", exact_to=exact_to), D.ks_rows(w, "clouds_all", exact_to=exact_to),
             D.psi_rows(D.psi_spine(w, "hour", 25), "psi_hour_of_day"),
             D.psi_rows(D.psi_categorical(w, "weather_main"), "psi_weather_main")]
    return D.drift_report(feats, [D.f1_drift(w), D.mae_drift(w, "actual", value_pred)])


def report(spark, sf):
    """The scored windows and their report (written once per session)."""
    w = _windows(spark, sf)
    return w, tables._memo(spark, ("drift_report", sf, EV), lambda: report_of(w, "persist_pred", 0))


@query("drift_report", rnd(REPORT_SQL + " SELECT * FROM report", "value reference_value"))
def q_drift_report(spark, sf):
    return rounded(report(spark, sf)[1])


@query("window_status", REPORT_SQL + """SELECT "window",
       CASE WHEN bool_or(status = 'ALERT') THEN 'ALERT' ELSE 'PASS' END AS overall_status, count(*) AS n_checks,
       count(*) FILTER (WHERE status = 'ALERT') AS n_alerts, count(*) FILTER (WHERE status = 'MODERATE') AS n_moderate,
       coalesce(array_to_string(list_sort(list("check") FILTER (WHERE status = 'ALERT')), ', '), '') AS alerting_checks
FROM report GROUP BY 1""")
def q_window_status(spark, sf):
    return D.window_status(report(spark, sf)[1])


@query("drift_summary", REPORT_SQL + """
, ws AS (SELECT "window", CASE WHEN bool_or(status = 'ALERT') THEN 'ALERT' ELSE 'PASS' END AS st FROM report GROUP BY 1),
wn AS (SELECT "window", count(*) AS n FROM w WHERE "window" <> 'reference' GROUP BY 1),
rs AS (SELECT CAST(min(date_time) AS VARCHAR) AS st, CAST(max(date_time) AS VARCHAR) AS en, count(*) AS n
       FROM s WHERE "window" = 'reference')
SELECT CAST(json_object('reference_window', json_object('start', rs.st, 'end', rs.en, 'n_rows', rs.n),
       'windows', (SELECT CAST('{' || string_agg(to_json(ws."window") || ':' || json_object('overall_status', ws.st, 'n_rows', wn.n), ','
                                                 ORDER BY ws."window") || '}' AS JSON)
                   FROM ws JOIN wn ON ws."window" = wn."window")) AS VARCHAR) AS summary_json FROM rs""")
def q_drift_summary(spark, sf):
    w, rep = report(spark, sf)
    return D.drift_summary(w, D.window_status(rep))


WINTER_COLUMNS = ["sensor", "date_time", "draw", "temp", "clouds_all", "weather_main", "is_severe_weather", "is_low_visibility",
                  "is_precipitating", "weather_snow", "temp_zscore", "clouds_all_minmax", "traffic_volume", "high_risk"]


@query("perturb_batch", rnd(SCORED_SQL + WINTER_SQL + "SELECT "
                            + ", ".join(WINTER_COLUMNS).replace("weather_snow", "CASE WHEN weather_main = 'snow' THEN 1 ELSE 0 END AS weather_snow")
                            + " FROM winter", "temp clouds_all temp_zscore clouds_all_minmax"))
def q_perturb(spark, sf):
    """The rows of the synthetic severe-winter window, as many as the test period has."""
    return rounded(winter_rows(scored(spark, sf)).select(*WINTER_COLUMNS))
