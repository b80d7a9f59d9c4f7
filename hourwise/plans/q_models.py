"""Registered model, clustering, tracking and attribution queries (SURVEY 2.A
persistence, 2.H fits, 2.I, 2.K, 2.L).

Fitted-model outputs are checked for rows only (distributed training is not
bit-comparable to any SQL); everything whose result is a deterministic
function of the readings has a DuckDB oracle (cluster assignment against
data-derived centroids, profiles, the leaderboard of deterministic runs,
linear attributions).
"""
from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..functions.columns import COMMON_FEATURE_COLUMNS
from ..operators import clusters as CU
from ..operators import drift as D
from ..operators import evaluation as EVL
from ..operators import explain as EX
from ..operators import models as MD
from ..operators import timeseries as TSO
from ..operators import tracking as TR
from ..sources import io
from . import tables
from .oracle_base import with_tables
from .q_eval import SCORED_SQL, report_of, scored
from .q_eval import _windows as scored_windows
from .registry import query, rnd, rounded

EV = "events"
KEY = ["sensor", "date_time"]
CLUSTER_Z = ["z_hour_sin", "z_hour_cos", "z_weather_severity", "z_traffic_volume"]


def _split(spark, sf):
    return tables._memo(spark, ("cls_split", sf), lambda: TSO.chronological_split(tables.labelled(spark, sf, EV), 0.2))


def _train_test(spark, sf):
    s = _split(spark, sf)
    return s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")


def _classifiers(spark, sf):
    k = (spark.sparkContext.applicationId, "classifiers", sf)
    if k not in tables._MEMO:
        train, test = _train_test(spark, sf)
        n = train.count()
        lr = MD.fit_classifier(MD.logistic_pipeline(n), train)
        rf = MD.fit_classifier(MD.rf_classifier_pipeline(), train)
        keep = [*KEY, F.col("high_risk").alias("label"), F.col("traffic_volume").cast("double").alias("actual")]
        tables._MEMO[k] = {
            "logistic_regression": MD.predict_score(lr, test, keep).checkpoint(),
            "random_forest": MD.predict_score(rf, test, keep).checkpoint(),
            "_models": {"logistic_regression": lr, "random_forest": rf}}
    return tables._MEMO[k]


def _regressors(spark, sf):
    k = (spark.sparkContext.applicationId, "regressors", sf)
    if k not in tables._MEMO:
        train, test = _train_test(spark, sf)
        lin = MD.linear_pipeline().fit(train)
        rf = MD.rf_regressor_pipeline().fit(train)
        keep = [*KEY, F.col("traffic_volume").cast("double").alias("actual")]
        tables._MEMO[k] = {"linear_regression": MD.predict_value(lin, test, keep).checkpoint(),
                           "random_forest": MD.predict_value(rf, test, keep).checkpoint(),
                           "_models": {"linear_regression": lin, "random_forest": rf}}
    return tables._MEMO[k]


def _scored_models(d):
    return {k: v for k, v in d.items() if not k.startswith("_")}


@query("fit_logistic")
def q_fit_logistic(spark, sf):
    return _classifiers(spark, sf)["logistic_regression"]


@query("fit_rf_classifier")
def q_fit_rf_cls(spark, sf):
    return _classifiers(spark, sf)["random_forest"]


@query("predict_score")
def q_predict_score(spark, sf):
    m = _classifiers(spark, sf)["_models"]["logistic_regression"]
    _, test = _train_test(spark, sf)
    return MD.predict_score(m, test, KEY)


@query("fit_linear")
def q_fit_linear(spark, sf):
    return _regressors(spark, sf)["linear_regression"]


@query("fit_rf_regressor")
def q_fit_rf_reg(spark, sf):
    return _regressors(spark, sf)["random_forest"]


@query("predicted_vs_actual")
def q_pred_vs_actual(spark, sf):
    return MD.predicted_vs_actual(_scored_models(_regressors(spark, sf)))


@query("model_comparison")
def q_model_comparison(spark, sf):
    c = MD.classification_comparison(_scored_models(_classifiers(spark, sf)))
    r = MD.regression_comparison(_scored_models(_regressors(spark, sf)))
    cl = c.unpivot(["model"], ["accuracy", "precision", "recall", "f1", "roc_auc"], "metric", "value") \
          .withColumn("task", F.lit("classification"))
    rl = r.unpivot(["model"], ["mae", "rmse", "r2"], "metric", "value").withColumn("task", F.lit("regression"))
    return cl.unionByName(rl)


@query("save_model")
def q_save_model(spark, sf):
    """Persist the fitted pipeline to the shared folder, reload it, score again."""
    m = _classifiers(spark, sf)["_models"]["logistic_regression"]
    path = io.shared_path(spark, "model-logistic")
    m.write().overwrite().save(path)
    back = PipelineModel.load(path)
    _, test = _train_test(spark, sf)
    return MD.predict_score(back, test, KEY)


def saved_regressor(spark, sf) -> str:
    """Folder of the saved forest regressor, beside the classifier's versions (written once per session)."""
    k = (spark.sparkContext.applicationId, "saved_regressor", sf)
    if k not in tables._MEMO:
        path = io.shared_path(spark, "model-rf-regressor")
        _regressors(spark, sf)["_models"]["random_forest"].write().overwrite().save(path)
        tables._MEMO[k] = path
    return tables._MEMO[k]


@query("load_model")
def q_load_model(spark, sf):
    _, test = _train_test(spark, sf)
    return MD.predict_value(PipelineModel.load(saved_regressor(spark, sf)), test, KEY)


@query("save_scored_test_set")
def q_save_scored(spark, sf):
    s = _regressors(spark, sf)["random_forest"]
    path = io.shared_path(spark, "scored-test")
    io.write_table(s, path)
    return spark.read.parquet(path)


# ------------------------------------------------------- sequence forecast ---

SEQ_FEATURES = ["traffic_volume", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "is_weekend", "temp_zscore",
                "is_precipitating", "is_severe_weather", "is_low_visibility", "holiday_flag"]


def _forecast_frame(spark, sf):
    """Targets with a full 24-step history, split 70/10/20 by target time: ``steps``, the 24 × 11 window as one array (volume scaled with
    train-only statistics, as the sequence model saw it), and ``target``, the volume scaled the same way."""
    def build():
        b = tables.blocks(spark, sf, EV)
        sp = TSO.three_way_split(TSO.sequence_windows(b, SEQ_FEATURES))
        flagged = b.join(sp.select(*KEY, "split"), KEY, "left")
        sc = TSO.train_only_scaling(flagged).select("scaler_mean", "scaler_std")              # one row

        def scaled(x):
            return (x.cast("double") - F.col("scaler_mean")) / F.col("scaler_std")
        step = F.transform("window", lambda w: F.array(
            scaled(w["traffic_volume"]), *[F.coalesce(w[c].cast("double"), F.lit(float("nan"))) for c in SEQ_FEATURES[1:]]))
        return sp.crossJoin(F.broadcast(sc)).select(
            *KEY, "split", "traffic_volume", "scaler_mean", "scaler_std", F.flatten(step).alias("steps"),
            scaled(F.col("traffic_volume")).alias("target"))
    return tables._memo(spark, ("forecast_frame", sf), build)


def _forecast_rows(spark, sf, split):
    return _forecast_frame(spark, sf).filter(F.col("split") == split).withColumn("features", array_to_vector("steps"))


def _forecaster(spark, sf):
    """The model of the best round and the history of the rounds that ran."""
    k = (spark.sparkContext.applicationId, "forecaster", sf)
    if k not in tables._MEMO:
        tables._MEMO[k] = MD.fit_forecaster(_forecast_rows(spark, sf, "train"), _forecast_rows(spark, sf, "val"))
    return tables._MEMO[k]


@query("sequence_forecast")
def q_sequence_forecast(spark, sf):
    """GBT of the best round on the flattened window, naive persistence and the forecast forest, on the test targets. Raises if no
    block of readings holds a window."""
    model, _ = _forecaster(spark, sf)
    test = _forecast_rows(spark, sf, "test")
    actual = F.col("traffic_volume").cast("double").alias("actual")

    def unscaled(x):
        return x * F.col("scaler_std") + F.col("scaler_mean")
    pred = model.transform(test).select(*KEY, actual, unscaled(F.col("prediction")).alias("prediction"))
    last_volume = F.col("steps")[(TSO.WINDOW - 1) * len(SEQ_FEATURES)]
    persist = test.select(*KEY, actual, unscaled(last_volume).alias("prediction"))
    rf_model, tree_test = _tree_forest(spark, sf)
    rf = rf_model.transform(tree_test).select(*KEY, actual, "prediction")
    return MD.regression_comparison({"gbt_window": pred, "naive_persistence": persist, "random_forest": rf})


@query("training_history")
def q_training_history(spark, sf):
    """A row per round that ran (patience 6), and the best one. Raises if no block of readings holds a window."""
    return _forecaster(spark, sf)[1]


# ------------------------------------------------------------ clustering ---

def _cluster_input(spark, sf):
    return tables.labelled(spark, sf, EV)


@query("cluster_matrix", rnd(with_tables(EV) + """
, s AS (SELECT avg(hour_sin) AS m0, stddev_samp(hour_sin) AS s0, avg(hour_cos) AS m1, stddev_samp(hour_cos) AS s1,
               avg(weather_severity) AS m2, stddev_samp(weather_severity) AS s2,
               avg(traffic_volume) AS m3, stddev_samp(traffic_volume) AS s3 FROM lab)
SELECT sensor, date_time, (hour_sin - m0) / s0 AS z0, (hour_cos - m1) / s1 AS z1,
       (weather_severity - m2) / s2 AS z2, (traffic_volume - m3) / s3 AS z3 FROM lab, s""", "z0 z1 z2 z3"))
def q_cluster_matrix(spark, sf):
    df = _cluster_input(spark, sf)
    x = CU.cluster_matrix(df).transform(df)
    arr = vector_to_array("features")
    return rounded(x.select(*KEY, *[arr[i].alias(f"z{i}") for i in range(4)]))


def _cluster_points(spark, sf):
    """The standardized vectors, for ten restarts and the k sweep."""
    k = (spark.sparkContext.applicationId, "cluster_points", sf)
    if k not in tables._MEMO:
        from pyspark import StorageLevel
        df = _cluster_input(spark, sf)
        tables._MEMO[k] = CU.cluster_matrix(df).transform(df).select(
            *KEY, "features", "hour", "weather_severity", "weather_severity_label", "traffic_volume", "congestion_category_p3", "is_weekend") \
            .persist(StorageLevel.MEMORY_AND_DISK)
    return tables._MEMO[k]


def _kmeans(spark, sf):
    k = (spark.sparkContext.applicationId, "kmeans", sf)
    if k not in tables._MEMO:
        x = _cluster_points(spark, sf)
        tables._MEMO[k] = (x, CU.fit_kmeans(x, k=5, n_init=10))
    return tables._MEMO[k]


@query("evaluate_k")
def q_evaluate_k(spark, sf):
    x = _cluster_points(spark, sf)
    return CU.evaluate_k(x, range(2, 9), n_init=10)


@query("fit_kmeans")
def q_fit_kmeans(spark, sf):
    x, m = _kmeans(spark, sf)
    assigned = m.transform(x).withColumnRenamed("prediction", "cluster")
    return CU.cluster_profile(assigned)


def _time_of_day_centroids(z):
    """Data-derived centroids: mean standardized features per time-of-day bin."""
    c = z.groupBy("time_of_day").agg(*[F.avg(n).alias(f"c{i}") for i, n in enumerate(CLUSTER_Z)])
    from pyspark.sql import Window
    return c.withColumn("cluster", F.row_number().over(Window.orderBy("time_of_day")) - 1).drop("time_of_day")


def _assigned(spark, sf):
    def build():
        df = _cluster_input(spark, sf)
        z = CU.standardize_columns(df, CU.CLUSTER_FEATURES)
        return CU.assign_clusters(z, _time_of_day_centroids(z), CLUSTER_Z)
    return tables._memo(spark, ("assigned", sf), build)


ASSIGN_SQL = with_tables(EV) + """
, s AS (SELECT avg(hour_sin) AS m0, stddev_samp(hour_sin) AS s0, avg(hour_cos) AS m1, stddev_samp(hour_cos) AS s1,
               avg(weather_severity) AS m2, stddev_samp(weather_severity) AS s2,
               avg(traffic_volume) AS m3, stddev_samp(traffic_volume) AS s3 FROM lab),
z AS (SELECT lab.*, (hour_sin - m0) / s0 AS z0, (hour_cos - m1) / s1 AS z1, (weather_severity - m2) / s2 AS z2,
             (traffic_volume - m3) / s3 AS z3 FROM lab, s),
cen AS (SELECT row_number() OVER (ORDER BY time_of_day) - 1 AS cluster, avg(z0) AS c0, avg(z1) AS c1, avg(z2) AS c2,
               avg(z3) AS c3 FROM z GROUP BY time_of_day),
d AS (SELECT z.*, cen.cluster, (z0 - c0) * (z0 - c0) + (z1 - c1) * (z1 - c1) + (z2 - c2) * (z2 - c2)
             + (z3 - c3) * (z3 - c3) AS dist2 FROM z CROSS JOIN cen),
a AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY sensor, date_time ORDER BY dist2, cluster) = 1)
"""


@query("assign_clusters", ASSIGN_SQL + "SELECT sensor, date_time, CAST(cluster AS INTEGER) AS cluster FROM a")
def q_assign(spark, sf):
    return _assigned(spark, sf).select(*KEY, "cluster")


@query("circular_mean_hour", rnd(ASSIGN_SQL + """SELECT CAST(cluster AS INTEGER) AS cluster,
  CASE WHEN atan2(avg(sin(2 * pi() * hour / 24)), avg(cos(2 * pi() * hour / 24))) / (2 * pi()) * 24 < 0
       THEN atan2(avg(sin(2 * pi() * hour / 24)), avg(cos(2 * pi() * hour / 24))) / (2 * pi()) * 24 + 24
       ELSE atan2(avg(sin(2 * pi() * hour / 24)), avg(cos(2 * pi() * hour / 24))) / (2 * pi()) * 24 END AS avg_hour
FROM a GROUP BY cluster""", "avg_hour"))
def q_circular(spark, sf):
    return rounded(_assigned(spark, sf).groupBy("cluster").agg(CU.circular_mean_hour().alias("avg_hour")))


@query("cluster_profile", rnd(ASSIGN_SQL + """
, md_w AS (SELECT cluster, arg_min(v, (-k, v)) AS dominant_weather FROM
           (SELECT cluster, CASE weather_severity WHEN 0 THEN 'Clear' WHEN 1 THEN 'Clouds' WHEN 2 THEN 'Precipitation'
                   WHEN 3 THEN 'Low visibility' ELSE 'Severe' END AS v, count(*) AS k FROM a GROUP BY 1, 2) GROUP BY 1),
md_c AS (SELECT cluster, arg_min(v, (-k, v)) AS dominant_congestion FROM
           (SELECT cluster, congestion_category_p3 AS v, count(*) AS k FROM a GROUP BY 1, 2) GROUP BY 1),
p AS (SELECT cluster, count(*) AS n_rows,
             atan2(avg(sin(2 * pi() * hour / 24)), avg(cos(2 * pi() * hour / 24))) / (2 * pi()) * 24 AS h,
             avg(weather_severity) AS avg_weather_severity, avg(traffic_volume) AS avg_traffic_volume,
             avg(is_weekend) * 100 AS pct_weekend FROM a GROUP BY cluster)
SELECT CAST(p.cluster AS INTEGER) AS cluster, n_rows, CASE WHEN h < 0 THEN h + 24 ELSE h END AS avg_hour,
       avg_weather_severity, dominant_weather, avg_traffic_volume, dominant_congestion, pct_weekend,
       100.0 * n_rows / (SELECT count(*) FROM a) AS pct_of_data
FROM p JOIN md_w USING (cluster) JOIN md_c USING (cluster)""",
                            "avg_hour avg_weather_severity avg_traffic_volume pct_weekend pct_of_data"))
def q_cluster_profile(spark, sf):
    a = _assigned(spark, sf)
    lab = _cluster_input(spark, sf)
    j = lab.join(a.select(*KEY, "cluster"), KEY)
    return rounded(CU.cluster_profile(j))


@query("cluster_interpretation", ASSIGN_SQL + """
, q AS (SELECT quantile_cont(traffic_volume, 0.25) AS q1, quantile_cont(traffic_volume, 0.5) AS q2,
               quantile_cont(traffic_volume, 0.75) AS q3 FROM lab),
md_w AS (SELECT cluster, arg_min(v, (-k, v)) AS w FROM
           (SELECT cluster, CASE weather_severity WHEN 0 THEN 'Clear' WHEN 1 THEN 'Clouds' WHEN 2 THEN 'Precipitation'
                   WHEN 3 THEN 'Low visibility' ELSE 'Severe' END AS v, count(*) AS k FROM a GROUP BY 1, 2) GROUP BY 1),
md_c AS (SELECT cluster, arg_min(v, (-k, v)) AS c FROM
           (SELECT cluster, congestion_category_p3 AS v, count(*) AS k FROM a GROUP BY 1, 2) GROUP BY 1),
p0 AS (SELECT cluster, atan2(avg(sin(2 * pi() * hour / 24)), avg(cos(2 * pi() * hour / 24))) / (2 * pi()) * 24 AS h0,
              avg(traffic_volume) AS v, avg(is_weekend) * 100 AS pw FROM a GROUP BY cluster),
p AS (SELECT *, CASE WHEN h0 < 0 THEN h0 + 24 ELSE h0 END AS h FROM p0),
t AS (SELECT p.*, md_w.w, md_c.c,
             CASE WHEN h < 5 OR h >= 22 THEN 'overnight' WHEN h < 10 THEN 'morning' WHEN h < 14 THEN 'midday'
                  WHEN h < 18 THEN 'afternoon/evening rush hour' ELSE 'evening' END AS tod,
             CASE WHEN v <= q1 THEN 'low traffic' WHEN v <= q2 THEN 'moderate traffic' WHEN v <= q3 THEN 'high traffic'
                  ELSE 'very high traffic' END AS vol
      FROM p JOIN md_w USING (cluster) JOIN md_c USING (cluster) CROSS JOIN q)
SELECT CAST(cluster AS INTEGER) AS cluster,
       printf('%s conditions (avg. hour %04.1fh), predominantly ''%s'' weather, with %s (avg. %s veh/hr, mostly ''%s'' '
              || 'congestion); %s%% of hours in this cluster are on a weekend.',
              upper(substr(tod, 1, 1)) || substr(tod, 2), h, lower(w), vol, format('{:,.0f}', v), c,
              format('{:,.0f}', pw)) AS interpretation
FROM t""")
def q_cluster_text(spark, sf):
    """Sentences for the clusters of the deterministic assignment (time-of-day
    centroids); the k-means clusters' profile is ``fit_kmeans``."""
    from ..operators.features import table_stats
    a = _assigned(spark, sf)
    lab = _cluster_input(spark, sf)
    prof = CU.cluster_profile(lab.join(a.select(*KEY, "cluster"), KEY))
    q = table_stats(lab).select("_q1", "_q2", "_q3")
    return CU.cluster_interpretation(prof, q).select("cluster", "interpretation")


# -------------------------------------------------------------- tracking ---

LEADER_METRICS = ["accuracy", "f1", "precision", "recall", "roc_auc", "mae", "r2"]


def _deterministic_runs(spark, sf, store):
    """Rule-score classifier on the test window and naive persistence on the
    forecast test targets, logged as child runs of one parent."""
    s = scored(spark, sf).filter(F.col("window") == "test_period")
    cls = EVL.classification_metrics(s, score="score").drop("n")
    b = tables.blocks(spark, sf, EV)
    t = TSO.three_way_split(TSO.in_block_features(b, lags=(1,), rolls=()))
    test = t.filter(F.col("split") == "test").withColumns({
        "actual": F.col("traffic_volume").cast("double"), "persist_pred": F.col("lag_1").cast("double")})
    reg = EVL.regression_metrics(test, "actual", "persist_pred").select("mae", "r2")
    parent = "parent"
    TR.log_run(store, spark.range(1).select(F.lit(1.0).alias("n_children")), "hourwise", "all", parent)
    pid = TR.run_id("hourwise", "all", parent)
    TR.log_run(store, cls, "hourwise", "classification", "rule_score", {"threshold": 0.5}, parent=pid)
    TR.log_run(store, reg, "hourwise", "forecasting", "naive_persistence", {"lag": 1}, parent=pid)


@query("run_leaderboard", rnd(SCORED_SQL + """
, st AS (SELECT * FROM s WHERE "window" = 'test_period'),
cm AS (SELECT count(*) FILTER (WHERE label <> 1 AND prediction <> 1) AS tn, count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp,
              count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp FROM st),
auc AS (SELECT (sum(CASE WHEN label = 1 THEN rmin + (c - 1) / 2.0 END) - P * (P + 1) / 2.0) / nullif(P * N, 0) AS roc_auc
        FROM (SELECT label, rank() OVER (ORDER BY score) AS rmin, count(*) OVER (PARTITION BY score) AS c,
                     sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) OVER () AS P, sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) OVER () AS N
              FROM st) x GROUP BY P, N),
bl AS (SELECT sensor, date_time, CAST(lag(traffic_volume, 1) OVER (PARTITION BY sensor, block_start
             ORDER BY date_time) AS DOUBLE) AS pp FROM blocks),
t AS (SELECT sp.*, CAST(sp.traffic_volume AS DOUBLE) AS actual, bl.pp
      FROM bl JOIN splits sp ON bl.sensor = sp.sensor AND bl.date_time = sp.date_time),
reg AS (SELECT avg(abs(actual - pp)) AS mae,
               1 - sum((actual - pp) * (actual - pp)) / nullif(sum(actual * actual) - sum(actual) * sum(actual) / count(*), 0) AS r2
        FROM t WHERE split = 'test' AND pp IS NOT NULL)
SELECT md5('hourwise/classification/rule_score') AS run_id, 'classification' AS task, 'rule_score' AS algorithm,
       coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0.0) AS accuracy, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1,
       coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
       (SELECT roc_auc FROM auc) AS roc_auc, CAST(NULL AS DOUBLE) AS mae, CAST(NULL AS DOUBLE) AS r2 FROM cm
UNION ALL
SELECT md5('hourwise/forecasting/naive_persistence'), 'forecasting', 'naive_persistence', NULL, NULL, NULL, NULL, NULL, mae, r2
FROM reg""", " ".join(LEADER_METRICS)))
def q_leaderboard(spark, sf):
    store = io.shared_path(spark, "runs")
    _deterministic_runs(spark, sf, store)
    runs, metrics = TR.read_store(spark, store)
    return rounded(TR.run_leaderboard(runs, metrics, LEADER_METRICS))


@query("log_runs")
def q_log_runs(spark, sf):
    """All model runs (fitted classifiers and regressors) logged to a fresh store."""
    store = io.shared_path(spark, "runs-all")
    cls = _scored_models(_classifiers(spark, sf))
    reg = _scored_models(_regressors(spark, sf))
    for name, df in cls.items():
        TR.log_run(store, EVL.classification_metrics(df, score="score"), "hourwise", "classification", name,
                   {"features": len(COMMON_FEATURE_COLUMNS)}, parent="p")
    for name, df in reg.items():
        TR.log_run(store, EVL.regression_metrics(df), "hourwise", "regression", name, parent="p")
    runs, metrics = TR.read_store(spark, store)
    return runs.join(metrics, "run_id")


# --- fixed values: trees, depth and least leaf size of the two versions -------
VERSION_PARAMS = {"v1_baseline": (150, 10, 5), "v2_candidate": (300, 16, 2)}
# -----------------------------------------------------------------------------


def fitted_versions(spark, sf):
    """version -> (folder of the saved model, its scores of the test rows, written once)."""
    k = (spark.sparkContext.applicationId, "fitted_versions", sf)
    if k not in tables._MEMO:
        train, test = _train_test(spark, sf)
        out = {}
        for version, (n, d, leaf) in VERSION_PARAMS.items():
            m = MD.fit_classifier(MD.rf_classifier_pipeline(num_trees=n, max_depth=d, min_leaf=leaf), train)
            path = io.shared_path(spark, f"model-{version}")
            m.write().overwrite().save(path)
            scores = MD.predict_score(m, test, [F.col("high_risk").alias("label")])
            out[version] = (path, io.materialize(scores, f"scores-{version}"))
        tables._MEMO[k] = out
    return tables._MEMO[k]


def _versions(spark, sf):
    def build():
        parts = []
        for version, (n, d, leaf) in VERSION_PARAMS.items():
            _, s = fitted_versions(spark, sf)[version]
            met = EVL.classification_metrics(s, score="score").drop("n").withColumnRenamed("f1", "f1_score")
            parts.append(met.select(F.lit(version).alias("version"), F.lit(n).alias("n_estimators"),
                                    F.lit(d).alias("max_depth"), F.lit(leaf).alias("min_samples_leaf"), "*"))
        return parts[0].unionByName(parts[1])
    return tables._memo(spark, ("versions", sf), build)


def load_by_alias(spark, sf, alias="champion"):
    """The saved model that the alias points to."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(fitted_versions(spark, sf)[TR.version_of(TR.alias_table(_versions(spark, sf)), alias)][0])


def champion_windows(spark, sf):
    """The reference, test and severe-winter rows as the registry's champion and the saved regressor score them: window, the checked
    features, label, prediction, score, actual, value_pred (written once per session)."""
    def build():
        rows = scored_windows(spark, sf).drop("prediction", "score")
        keep = ["window", *KEY, "hour", "temp", "clouds_all", "weather_main", "label", "actual"]
        classes = load_by_alias(spark, sf, "champion").transform(rows)
        both = PipelineModel.load(saved_regressor(spark, sf)).transform(
            classes.withColumns({"_class": F.col("prediction").cast("int"), "score": vector_to_array("probability")[1]})
            .drop("prediction", "rawPrediction", "probability", "features"))
        return both.select(*keep, F.col("_class").alias("prediction"), "score", F.col("prediction").alias("value_pred"))
    return tables._memo(spark, ("champion_windows", sf), build)


def champion_report(spark, sf):
    """The six checks of both windows with the fitted models; the KS p-value is exact where a window and the reference are small."""
    return tables._memo(spark, ("champion_report", sf), lambda: report_of(champion_windows(spark, sf), "value_pred", 10_000))


@query("champion_drift_report")
def q_champion_drift(spark, sf):
    return champion_report(spark, sf)


@query("champion_window_status")
def q_champion_status(spark, sf):
    return D.window_status(champion_report(spark, sf))


@query("champion_drift_summary")
def q_champion_summary(spark, sf):
    return D.drift_summary(champion_windows(spark, sf), D.window_status(champion_report(spark, sf)))


@query("fit_versions")
def q_fit_versions(spark, sf):
    return _versions(spark, sf)


@query("register_versions")
def q_register(spark, sf):
    return TR.register_versions(_versions(spark, sf))


@query("champion")
def q_champion(spark, sf):
    return TR.register_versions(_versions(spark, sf)).filter(F.col("alias") == "champion")


@query("version_comparison")
def q_version_comparison(spark, sf):
    return TR.version_comparison(TR.register_versions(_versions(spark, sf)))


@query("alias_join")
def q_alias_join(spark, sf):
    """Scores of the champion itself, tagged with its version."""
    v = _versions(spark, sf)
    aliases = TR.alias_table(v)
    _, scores = fitted_versions(spark, sf)[TR.version_of(aliases, "champion")]
    return TR.alias_join(scores, TR.register_versions(v), aliases, "champion")


# ----------------------------------------------------------- attribution ---

RULE_WEIGHTS = {"clouds_all": 1 / 400, "is_low_visibility": 0.25, "is_severe_weather": 0.25, "is_congested": 0.25}
RULE_GROUPS = {
    "clouds_all": ("cloud cover (%)", ["clouds_all"], False),
    "is_low_visibility": ("whether visibility is reduced (fog/mist/haze/smoke)", ["is_low_visibility"], False),
    "is_severe_weather": ("whether there's severe weather (thunderstorm/squall)", ["is_severe_weather"], False),
    "is_congested": ("whether volume is above the congestion threshold", ["is_congested"], False),
}


def _rule_attr(spark, sf):
    lab = tables.labelled(spark, sf, EV).withColumn("is_congested", (F.col("traffic_volume") > 700).cast("int"))
    return EX.linear_attribution(lab, RULE_WEIGHTS)


ATTR_SQL = with_tables(EV) + """
, x AS (SELECT *, CASE WHEN traffic_volume > 700 THEN 1 ELSE 0 END AS is_congested FROM lab),
m AS (SELECT avg(clouds_all) AS m_c, avg(is_low_visibility) AS m_l, avg(is_severe_weather) AS m_s, avg(is_congested) AS m_k FROM x),
att AS (SELECT x.*, (clouds_all - m_c) / 400 AS phi_clouds_all, 0.25 * (is_low_visibility - m_l) AS phi_is_low_visibility,
               0.25 * (is_severe_weather - m_s) AS phi_is_severe_weather, 0.25 * (is_congested - m_k) AS phi_is_congested,
               m_c / 400 + 0.25 * m_l + 0.25 * m_s + 0.25 * m_k AS base_value FROM x, m)
"""


@query("linear_attribution", rnd(ATTR_SQL + """SELECT sensor, date_time, phi_clouds_all, phi_is_low_visibility,
       phi_is_severe_weather, phi_is_congested, base_value,
       base_value + phi_clouds_all + phi_is_low_visibility + phi_is_severe_weather + phi_is_congested AS prediction
FROM att""", "phi_clouds_all phi_is_low_visibility phi_is_severe_weather phi_is_congested base_value prediction"))
def q_linear_attr(spark, sf):
    a = _rule_attr(spark, sf)
    return rounded(a.select(*KEY, *[f"phi_{f}" for f in RULE_WEIGHTS], "base_value", "prediction"))


def _group_sql(gid, label, col):
    return f"""SELECT '{gid}' AS feature_group, '{label}' AS label, avg(abs(phi_{col})) AS mean_abs_shap,
       covar_pop(CAST({col} AS DOUBLE), phi_{col}) / nullif(stddev_pop(CAST({col} AS DOUBLE)) * stddev_pop(phi_{col}), 0)
         AS correlation_with_shap, false AS cyclical FROM att"""


@query("group_importance", rnd(ATTR_SQL + ", g AS (" + " UNION ALL ".join(
    _group_sql(gid, lab, cols[0]).replace("'s ", "''s ") for gid, (lab, cols, _) in RULE_GROUPS.items()) + """)
SELECT feature_group, label, mean_abs_shap, correlation_with_shap,
       CASE WHEN correlation_with_shap > 0 THEN 'higher' WHEN correlation_with_shap IS NOT NULL THEN 'lower' END AS direction,
       cyclical FROM g""", "mean_abs_shap correlation_with_shap"))
def q_group_importance(spark, sf):
    return rounded(EX.group_importance(_rule_attr(spark, sf), RULE_GROUPS))


# --- fixed values: features of the forecast forest -----------------------------
TREE_ASOF = ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "is_weekend", "holiday_flag",
             "temp_zscore", "is_precipitating", "is_severe_weather", "is_low_visibility"]
TREE_FEATURES = ["lag_1", "lag_24", "roll_mean_6", "roll_mean_24"] + [f"asof_{c}" for c in TREE_ASOF]
# -----------------------------------------------------------------------------


def _tree_frame(spark, sf):
    def build():
        b = tables.blocks(spark, sf, EV)
        t = TSO.in_block_features(b, asof=TREE_ASOF, history=TSO.WINDOW)
        return TSO.three_way_split(t.select(*KEY, "traffic_volume", *TREE_FEATURES))
    return tables._memo(spark, ("tree_frame", sf), build)


def _tree_forest(spark, sf):
    """The forecast forest (150 trees, depth 10, min leaf 5, all features per
    split) fitted on the train targets' lag / as-of features, and the test rows."""
    k = (spark.sparkContext.applicationId, "tree_forest", sf)
    if k not in tables._MEMO:
        f = _tree_frame(spark, sf)
        train = f.filter(F.col("split") == "train")
        if not train.limit(1).take(1):
            raise ValueError("no train row: no block of readings is long enough for a target")
        tables._MEMO[k] = (MD.rf_regressor_pipeline(TREE_FEATURES).fit(train), f.filter(F.col("split") == "test"))
    return tables._MEMO[k]


def tree_attributions(spark, sf):
    """Exact TreeSHAP of the forecast forest on the test targets, beside the features (written once per session)."""
    def build():
        model, test = _tree_forest(spark, sf)
        # the rows of many files stay where they are; a single file is dealt over the cores
        tasks = max(spark.sparkContext.defaultParallelism, len(test.inputFiles()))
        return EX.tree_attribution(test.repartition(tasks, *KEY), model.stages[-1], TREE_FEATURES, keep=[*KEY, *TREE_FEATURES])
    return tables._memo(spark, ("tree_attributions", sf), build)


@query("tree_attribution")
def q_tree_attribution(spark, sf):
    """Exact TreeSHAP of the forecast forest on the test targets; Σφ + base =
    the forest output. Raises if no block of readings holds a target."""
    return tree_attributions(spark, sf).drop(*TREE_FEATURES)


#: The groups of the forecast features under the names that the forest's columns have.
TREE_GROUPS = {gid: (label, [f"asof_{c}" if c in TREE_ASOF else c for c in cols], cyclical)
               for gid, (label, cols, cyclical) in EX.FEATURE_GROUPS.items()}


@query("top_drivers_text")
def q_top_drivers(spark, sf):
    """The forecast forest's six strongest feature groups on the test targets, in sentences: mean |Σφ| of a group (paired sine and
    cosine summed) and the correlation of the feature with its φ. Raises if no block of readings holds a target."""
    return EX.top_drivers_text(EX.group_importance(tree_attributions(spark, sf), TREE_GROUPS), 6)
