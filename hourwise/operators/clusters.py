"""Clustering of readings by time of day, weather severity and volume.

K-means is Spark ML's distributed k-means|| ; the k sweep moves the centroids of every k and every
start in one pass over the rows a step (numpy inside tasks, sums of a few hundred rows between them). Nearest-centroid assignment against a
given centroid table (k rows, broadcast) is plain column arithmetic, and the
cluster profile is one grouped aggregate.
"""
from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.io import materialize

# --- fixed values: the sentence of a cluster ----------------------------------
CLUSTER_SENTENCE = ("%s conditions (avg. hour %04.1fh), predominantly '%s' weather, with %s (avg. %s veh/hr, mostly '%s' "
                    "congestion); %s%% of hours in this cluster are on a weekend.")
# -----------------------------------------------------------------------------
CLUSTER_FEATURES = ["hour_sin", "hour_cos", "weather_severity", "traffic_volume"]


def cluster_matrix(df: DataFrame, features: Sequence[str] = CLUSTER_FEATURES) -> PipelineModel:
    """Assembler + standardisation (mean 0, unit std) fitted on ``df``. A row with a NULL feature raises: keep such rows
    apart with ``complete_rows``."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="error"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True)]).fit(df)


def complete_rows(df: DataFrame, features: Sequence[str] = CLUSTER_FEATURES) -> tuple[DataFrame, DataFrame]:
    """Rows with all features, and the others with a NULL cluster."""
    ok = F.lit(True)
    for c in features:
        ok = ok & F.col(c).isNotNull()
    return df.filter(ok), df.filter(~ok).withColumn("cluster", F.lit(None).cast("int"))


def fit_kmeans(x: DataFrame, k: int = 5, n_init: int = 10, seed: int = 42):
    """Best of ``n_init`` k-means|| runs (least within-cluster sum of squares)."""
    best = None
    for i in range(n_init):
        m = KMeans(k=k, seed=seed + i, initMode="k-means||", featuresCol="features").fit(x)
        cost = m.summary.trainingCost
        if best is None or cost < best[1]:
            best = (m, cost)
    return best[0]


def _seeded(sample: np.ndarray, k: int, rng: np.random.Generator, steps: int = 300, tol: float = 1e-4) -> np.ndarray:
    """k centroids by k-means++ over a sample, moved by Lloyd steps over the sample until they rest."""
    chosen = [sample[rng.integers(len(sample))]]
    near = ((sample - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < k:
        total = near.sum()
        at = rng.choice(len(sample), p=near / total) if total > 0 else rng.integers(len(sample))
        chosen.append(sample[at])
        near = np.minimum(near, ((sample - sample[at]) ** 2).sum(axis=1))
    centroids = np.array(chosen)
    for _ in range(steps):
        owner = ((centroids ** 2).sum(axis=1) - 2 * sample @ centroids.T).argmin(axis=1)
        n = np.bincount(owner, minlength=k)
        sums = np.stack([np.bincount(owner, c, k) for c in sample.T], axis=1)
        moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
        rest = np.abs(moved - centroids).max() < tol
        centroids = moved
        if rest:
            break
    return centroids


def _points(batch: pd.DataFrame, d: int) -> np.ndarray:
    return np.concatenate(batch["f"].to_list()).reshape(-1, d) if len(batch) else np.zeros((0, d))


def _owners(points: np.ndarray, sets: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each centroid set the nearest centroid of each point (the first on ties) and the squared distance to it."""
    every = np.concatenate(sets)
    square = (points ** 2).sum(axis=1)
    distance = square[:, None] - 2 * points @ every.T + (every ** 2).sum(axis=1)
    at = 0
    for centroids in sets:
        own = distance[:, at:at + len(centroids)]
        at += len(centroids)
        owner = own.argmin(axis=1)
        yield owner, np.maximum(own[np.arange(len(own)), owner], 0)


def _lloyd_sums(points: DataFrame, sets: dict[int, np.ndarray], d: int) -> dict[int, list[np.ndarray]]:
    """One pass over all rows for all centroid sets: of each set its clusters' [rows, cost, sums, sum of squares]. Tasks hand on one row a cluster."""
    numbers, centroids = list(sets), list(sets.values())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = [np.zeros((len(c), d + 3)) for c in centroids]
        for batch in batches:
            x = _points(batch, d)
            square = (x ** 2).sum(axis=1)
            for t, (owner, cost) in zip(total, _owners(x, centroids)):
                t += np.stack([np.bincount(owner, w, len(t)) for w in (None, cost, *x.T, square)], axis=1)
        yield pd.DataFrame([(number, k, row.tolist()) for number, t in zip(numbers, total) for k, row in enumerate(t)], columns=["set", "cluster", "sums"])
    sums = points.mapInPandas(run, "set int, cluster int, sums array<double>").groupBy("set", "cluster").agg(
        F.array(*[F.sum(F.col("sums")[i]) for i in range(d + 3)]).alias("sums"))
    out = {number: np.zeros((len(c), d + 3)) for number, c in sets.items()}
    for r in sums.collect():                       # one row a centroid
        out[r["set"]][r["cluster"]] = r["sums"]
    return {number: [t[:, 0], t[:, 1], t[:, 2:-1], t[:, -1]] for number, t in out.items()}


def _silhouettes(points: DataFrame, best: dict[int, np.ndarray], sums: dict[int, list[np.ndarray]], d: int) -> dict[int, float]:
    """Mean squared-Euclidean silhouette of all rows, for all k in one pass: a row's mean squared distance to a cluster follows from the
    cluster's rows, sums and sum of squares."""
    ks, centroids = list(best), list(best.values())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros(len(ks)), 0
        for batch in batches:
            x = _points(batch, d)
            rows += len(x)
            for i, (k, (owner, _)) in enumerate(zip(ks, _owners(x, centroids))):
                n, _, s, q = sums[k]
                there = np.maximum(n, 1)
                mean = np.where(n > 0, (x ** 2).sum(axis=1)[:, None] - 2 * x @ (s / there[:, None]).T + q / there, np.inf)
                each = np.arange(len(x))
                own = mean[each, owner] * n[owner] / np.maximum(n[owner] - 1, 1)
                mean[each, owner] = np.inf
                other = mean.min(axis=1)
                top = np.maximum(own, other)
                total[i] += np.where((n[owner] > 1) & (top > 0) & np.isfinite(other), (other - own) / np.where(top > 0, top, 1), 0).sum()
        yield pd.DataFrame({"k": ks, "total": total, "rows": rows})
    got = points.mapInPandas(run, "k int, total double, rows long").groupBy("k").agg((F.sum("total") / F.sum("rows")).alias("silhouette"))
    return {r["k"]: r["silhouette"] for r in got.collect()}


def sweep_k(x: DataFrame, ks: Sequence[int], n_init: int = 10, seed: int = 42, seed_rows: int = 4096, max_steps: int = 300,
            tol: float = 1e-4) -> dict[int, tuple[np.ndarray, list[np.ndarray]]]:
    """k -> (centroids, sums) of the best of ``n_init`` starts, all k and starts in one pass over the rows a Lloyd step. A start is seeded on
    ``seed_rows`` rows picked by a hash; every later step, cost and choice is over all rows. A set whose centroids all move less than
    ``tol`` is done and leaves the passes."""
    points = x.select(vector_to_array("features").alias("f"))
    sample = [r["f"] for r in points.orderBy(F.xxhash64("f"), "f").limit(seed_rows).collect()]
    if not sample:
        raise ValueError("no rows to cluster")
    sample = np.array(sample)
    d = sample.shape[1]
    starts = {i * n_init + j: _seeded(sample, k, np.random.default_rng(seed + 1000 * k + j)) for i, k in enumerate(ks) for j in range(n_init)}
    open_, done = dict(starts), {}
    for _ in range(max_steps):
        sums = _lloyd_sums(points, open_, d)
        for number, (n, _, s, _) in sums.items():
            moved = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], open_[number])
            still = np.abs(moved - open_[number]).max() < tol
            (done if still else open_)[number] = moved
            if still:
                del open_[number]
        if not open_:
            break
    done |= open_
    sums = _lloyd_sums(points, done, d)
    out = {}
    for i, k in enumerate(ks):
        best = min(range(i * n_init, (i + 1) * n_init), key=lambda number: sums[number][1].sum())
        out[int(k)] = done[best], sums[best]
    return out


def evaluate_k(x: DataFrame, ks: Sequence[int] = range(2, 9), n_init: int = 1, seed: int = 42) -> DataFrame:
    """Per k: inertia of the best of ``n_init`` starts and the squared-Euclidean silhouette of all rows. The rows' features are written once;
    each Lloyd step of all k and starts is one pass over them, and so is the silhouette."""
    points = materialize(x.select("features"), "cluster-points")
    best = sweep_k(points, ks, n_init, seed)
    d = next(iter(best.values()))[0].shape[1]
    silhouette = _silhouettes(points.select(vector_to_array("features").alias("f")), {k: c for k, (c, _) in best.items()},
                              {k: s for k, (_, s) in best.items()}, d)
    rows = [(k, float(s[1].sum()), float(silhouette[k])) for k, (_, s) in best.items()]
    return x.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def assign_clusters(x: DataFrame, centroids: DataFrame, coords: Sequence[str],
                    names: Sequence[str] = ("c0", "c1", "c2", "c3")) -> DataFrame:
    """Nearest centroid (smallest id on ties) for every row, map-side only: the
    k centroids (a small fixed number) become one broadcast array and each row
    takes the minimum (distance², id) over it — no per-row shuffle."""
    cents = centroids.agg(F.collect_list(F.struct(F.col("cluster").cast("int").alias("cluster"),
                                                  *[F.col(n).cast("double").alias(n) for n in names])).alias("_cents"))
    d2 = lambda c: sum((F.col(a) - c[b]) ** 2 for a, b in zip(coords, names))
    best = F.array_min(F.transform("_cents", lambda c: F.struct(d2(c).alias("d2"), c["cluster"].alias("cluster"))))
    return (x.crossJoin(F.broadcast(cents)).withColumn("_best", best)
             .withColumn("cluster", F.col("_best.cluster")).withColumn("dist2", F.col("_best.d2"))
             .drop("_cents", "_best"))


def standardize_columns(df: DataFrame, cols: Sequence[str], prefix: str = "z_") -> DataFrame:
    """(x − mean) / sample std per column, from one broadcast one-row aggregate."""
    stats = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"_s_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(stats))
    out = out.withColumns({f"{prefix}{c}": F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")) for c in cols})
    return out.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def circular_mean_hour(hour: str = "hour") -> F.Column:
    """atan2(mean sin, mean cos) of the hour angle, back to hours in [0, 24)."""
    ang = F.lit(2 * math.pi) * F.col(hour) / 24
    mean = F.atan2(F.avg(F.sin(ang)), F.avg(F.cos(ang)))
    return F.pmod(mean / F.lit(2 * math.pi) * 24, F.lit(24.0))


def cluster_profile(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Per cluster: rows, % of data, circular mean hour, mean severity and volume,
    modal weather label and congestion level (smallest on ties), % weekend."""
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    prof = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n_rows"), circular_mean_hour().alias("avg_hour"),
        F.avg("weather_severity").alias("avg_weather_severity"),
        F.mode("weather_severity_label", True).alias("dominant_weather"),
        F.avg("traffic_volume").alias("avg_traffic_volume"),
        F.mode("congestion_category_p3", True).alias("dominant_congestion"),
        (F.avg("is_weekend") * 100).alias("pct_weekend"))
    return prof.crossJoin(F.broadcast(total)) \
               .withColumn("pct_of_data", 100 * F.col("n_rows") / F.col("_total")).drop("_total")


def cluster_interpretation(profile: DataFrame, quartiles: DataFrame) -> DataFrame:
    """Sentence per cluster from hour bands (5/10/14/18/22) and volume quartiles."""
    h = F.col("avg_hour")
    tod = (F.when((h < 5) | (h >= 22), "overnight").when(h < 10, "morning").when(h < 14, "midday")
             .when(h < 18, "afternoon/evening rush hour").otherwise("evening"))
    v = F.col("avg_traffic_volume")
    vol = (F.when(v <= F.col("_q1"), "low traffic").when(v <= F.col("_q2"), "moderate traffic")
             .when(v <= F.col("_q3"), "high traffic").otherwise("very high traffic"))
    text = F.format_string(
        CLUSTER_SENTENCE, F.concat(F.upper(F.substring(tod, 1, 1)), F.substring(tod, 2, 100)), h, F.lower("dominant_weather"), vol,
        F.format_number(v, 0), F.col("dominant_congestion"), F.format_number("pct_weekend", 0))
    return profile.crossJoin(F.broadcast(quartiles)).withColumn("interpretation", text) \
                  .drop("_q1", "_q2", "_q3")
