"""Drift monitoring: two-sample KS, PSI (categorical, hour-of-day, numeric),
model-error drift, the long report and per-window status.

``windows`` tables carry a ``window`` column; the reference window is named
by ``ref``. Every statistic is computed for all windows at once (grouped by
window), never by looping over windows on the driver.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from .evaluation import classification_metrics, regression_metrics
from .prefix import ordered_cumsum
from .timeseries import rank_by_time

# --- fixed values (thresholds of the reference's monitor) -------------------
KS_ALERT_P = 0.05
KS_ALERT_STAT = 0.15
PSI_ALERT = 0.25
PSI_MODERATE = 0.10
F1_DROP_ALERT = 0.05
MAE_INCREASE_ALERT_PCT = 0.25
PSI_EPS = 1e-4
# ---------------------------------------------------------------------------


def kolmogorov_p(lam: Column, terms: int = 8) -> Column:
    """Asymptotic two-sided p-value Q(λ), by the series that converges fast on either side of λ = 1:
    2 Σ_{j≥1} (−1)^{j−1} exp(−2 j² λ²), and its theta form
    1 − √(2π)/λ Σ_{j≥1} exp(−(2j−1)² π² / (8 λ²)). ``terms`` of either are exact to double precision."""
    j = F.sequence(F.lit(1), F.lit(terms))
    large = F.aggregate(j, F.lit(0.0), lambda acc, k: acc + F.lit(2.0) * F.pow(F.lit(-1.0), k - 1)
                        * F.exp(F.lit(-2.0) * k * k * lam * lam))
    theta = F.aggregate(j, F.lit(0.0), lambda acc, k: acc + F.exp(
        -F.pow(F.lit(2.0) * k - 1, F.lit(2.0)) * F.lit(math.pi ** 2 / 8) / (lam * lam)))
    small = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / lam * theta
    p = F.when(lam < 1, small).otherwise(large)
    return F.when(lam <= 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)))


def exact_ks_p(d: float, n: int, m: int) -> float:
    """P(D ≥ d) of two samples of n and m values without ties: of all lattice paths from (0, 0) to (n, m), the share that leaves the band
    |i/n − j/m| < d. Paths are counted row by row inside the band, and each exit is weighted by the paths from there to the
    end, so that small probabilities keep their digits. n·m steps in vectors of m."""
    k = round(d * n * m)
    if k <= 0:
        return 1.0
    log_fact = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + m + 1)))])

    def log_paths(i, j):                      # from (i, j) to (n, m), as a share of all paths
        return (log_fact[n - i + m - j] - log_fact[n - i] - log_fact[m - j]) - (log_fact[n + m] - log_fact[n] - log_fact[m])
    inside, first, log_scale, p = np.ones(1), 0, 0.0, 0.0
    for i in range(n + 1):
        lo, hi = max(0, (i * m - k) // n + 1), min(m, -((-i * m - k) // n) - 1)
        if i:
            gone = np.arange(first, min(lo, first + len(inside)))      # a step that row i no longer has room for
            p += float(np.exp(np.log(inside[:len(gone)]) + log_scale + log_paths(i, gone)).sum())
        row = np.zeros(max(0, hi - lo + 1))
        at = np.arange(max(first, lo), min(first + len(inside), hi + 1))
        row[at - lo] = inside[at - first]
        inside, first = np.cumsum(row), lo
        if not len(inside) or not inside[-1]:
            break
        if hi < m:                            # a step beyond the row's end
            p += float(np.exp(np.log(inside[-1]) + log_scale + log_paths(i, hi + 1)))
        top = inside[-1]
        keep = inside > 0
        inside, first = inside[keep] / top, first + int(keep.argmax())
        log_scale += float(np.log(top))
    return min(1.0, p)


def _exact_p(d: Column, n: Column, m: Column) -> Column:
    @F.pandas_udf("double")
    def each(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([exact_ks_p(*x) for x in zip(d, n, m)], dtype=float)
    return each(d, n, m)


def ks_two_sample(df: DataFrame, value: str, window: str = "window", ref: str = "reference", exact_to: int = 0) -> DataFrame:
    """Per non-reference window: D = max |F_ref − F_cur| over the pooled distinct
    values, and its p-value: exact where neither side has more than ``exact_to`` values (ties count as if there were none), else
    asymptotic with λ = D·√(nm/(n+m)).

    Between two values of the window F_cur is flat and F_ref only rises, so the maximum lies at a window's
    value or just below one: the reference is counted and summed once for
    all windows, and only the windows' own values are joined to it."""
    d = df.filter(F.col(value).isNotNull())
    refc = d.filter(F.col(window) == ref).groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("r"))
    cur = d.filter(F.col(window) != ref).groupBy(F.col(window).alias("window"), F.col(value).alias("v")) \
           .agg(F.count(F.lit(1)).alias("c"))
    points = refc.unionByName(cur.select("v").distinct().withColumn("r", F.lit(0).cast("bigint"))) \
                 .groupBy("v").agg(F.sum("r").alias("r"))
    below = ordered_cumsum(points, "v", ["r"])
    cum = ordered_cumsum(cur, "v", ["c"], by=["window"]).join(below, "v")
    n_ref = refc.agg(F.coalesce(F.sum("r"), F.lit(0)).alias("n_ref"))
    n_cur = cur.groupBy("window").agg(F.sum("c").alias("n_cur"))
    f = lambda x, n: F.try_divide(x, F.col(n))
    gap = F.greatest(F.abs(f(F.col("cum_r"), "n_ref") - f(F.col("cum_c"), "n_cur")),
                     F.abs(f(F.col("cum_r") - F.col("r"), "n_ref") - f(F.col("cum_c") - F.col("c"), "n_cur")))
    stat = (cum.join(n_cur, "window").crossJoin(F.broadcast(n_ref))      # one row
               .groupBy("window", "n_ref", "n_cur").agg(F.max(gap).alias("ks_stat")))
    lam = F.col("ks_stat") * F.sqrt(F.col("n_ref") * F.col("n_cur") / (F.col("n_ref") + F.col("n_cur")))
    if not exact_to:
        return stat.withColumn("p_value", kolmogorov_p(lam))
    small = (F.greatest("n_ref", "n_cur") <= exact_to) & (F.col("n_ref") > 0)
    # one row a window; the counts of a larger one do not reach the exact form
    n, m = (F.when(small, F.col(c)).otherwise(F.lit(1)) for c in ("n_ref", "n_cur"))
    return (stat.withColumn("_exact", _exact_p(F.when(small, F.col("ks_stat")).otherwise(F.lit(0.0)), n.cast("long"), m.cast("long")))
                .withColumn("p_value", F.when(small, F.col("_exact")).otherwise(kolmogorov_p(lam))).drop("_exact"))


def _psi_term(r: Column, total_r: Column, c: Column, total_c: Column) -> Column:
    rp = r / total_r + F.lit(PSI_EPS)
    cp = c / total_c + F.lit(PSI_EPS)
    return (cp - rp) * F.log(cp / rp)


def _psi_from_counts(counts: DataFrame) -> DataFrame:
    """counts: (window, bin, r, c) with every bin present → PSI per window."""
    tot = counts.groupBy("window").agg(F.sum("r").alias("_R"), F.sum("c").alias("_C"))
    term = _psi_term(F.col("r"), F.col("_R"), F.col("c"), F.col("_C"))
    return counts.join(tot, "window").groupBy("window").agg(F.sum(term).alias("psi"))


def psi_categorical(df: DataFrame, value: str, window: str = "window", ref: str = "reference") -> DataFrame:
    """PSI over the union of categories seen in the reference or the window; missing values are left out.

    A category that a window lacks adds a term that depends on the reference alone. Those terms are summed
    once, and each window takes back the ones of the categories it has: no product of categories and windows."""
    d = df.filter(F.col(value).isNotNull())
    refc = d.filter(F.col(window) == ref).groupBy(F.col(value).alias("bin")).agg(F.count(F.lit(1)).alias("r"))
    cur = d.filter(F.col(window) != ref).groupBy(F.col(window).alias("window"), F.col(value).alias("bin")) \
           .agg(F.count(F.lit(1)).alias("c"))
    total_r = refc.agg(F.sum("r").alias("_R"))
    absent = _psi_term(F.col("r"), F.col("_R"), F.lit(0.0), F.lit(1.0))
    refc = refc.crossJoin(F.broadcast(total_r)).withColumn("_absent", absent)                  # one row
    base = refc.agg(F.sum("_absent").alias("_base"), F.max("_R").alias("_R"))
    total_c = cur.groupBy("window").agg(F.sum("c").alias("_C"))
    own = (cur.join(refc.select("bin", "r", "_absent"), "bin", "left").join(total_c, "window")
              .crossJoin(F.broadcast(base)))                                                    # one row
    term = _psi_term(F.coalesce("r", F.lit(0)), F.col("_R"), F.col("c"), F.col("_C")) - F.coalesce("_absent", F.lit(0.0))
    return own.groupBy("window", "_base").agg(F.sum(term).alias("_own")) \
              .select("window", (F.col("_base") + F.col("_own")).alias("psi"))


def psi_spine(df: DataFrame, value: str, bins: int, window: str = "window", ref: str = "reference") -> DataFrame:
    """PSI over the fixed integer bins 0..bins-1 (hour of day: bins = 25, as the
    reference passes range(25); the empty bin 24 adds 0)."""
    spark = df.sparkSession
    spine = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    wins = df.filter(F.col(window) != ref).select(F.col(window).alias("window")).distinct()
    inside = F.col(value).cast("int").between(0, bins - 1)                # at most ``bins`` rows to broadcast
    refc = df.filter((F.col(window) == ref) & inside).groupBy(F.col(value).cast("int").alias("bin")) \
             .agg(F.count(F.lit(1)).alias("r"))
    cur = df.filter(F.col(window) != ref).groupBy(F.col(window).alias("window"), F.col(value).cast("int").alias("bin")) \
            .agg(F.count(F.lit(1)).alias("c"))
    grid = wins.crossJoin(F.broadcast(spine))
    both = (grid.join(F.broadcast(refc), "bin", "left").join(cur, ["window", "bin"], "left")
                .select("window", "bin", F.coalesce("r", F.lit(0)).alias("r"), F.coalesce("c", F.lit(0)).alias("c")))
    return _psi_from_counts(both)


def psi_numeric(df: DataFrame, value: str, bins: int = 10, window: str = "window",
                ref: str = "reference") -> DataFrame:
    """Equal-width bins over the pooled [min, max] of reference + window (last bin closed)."""
    refv = df.filter(F.col(window) == ref).select(F.col(value).alias("x"))
    wins = df.filter(F.col(window) != ref).select(F.col(window).alias("window")).distinct()
    pooled = (wins.crossJoin(refv.agg(F.min("x").alias("rmin"), F.max("x").alias("rmax")))
                  .join(df.filter(F.col(window) != ref).groupBy(F.col(window).alias("window"))
                          .agg(F.min(value).alias("cmin"), F.max(value).alias("cmax")), "window")
                  .select("window", F.least("rmin", "cmin").alias("lo"), F.greatest("rmax", "cmax").alias("hi")))
    width = (F.col("hi") - F.col("lo")) / bins
    idx = F.coalesce(F.least(F.floor(F.try_divide(F.col("x") - F.col("lo"), width)), F.lit(bins - 1)), F.lit(0))
    # the reference is binned once for each distinct range (windows inside the reference's range share one), from its
    # value counts, never once a window
    counted = refv.filter(F.col("x").isNotNull()).groupBy("x").agg(F.count(F.lit(1)).alias("_k"))
    ranges = pooled.select("lo", "hi").distinct()
    binned = counted.crossJoin(ranges).groupBy("lo", "hi", idx.cast("int").alias("bin")).agg(F.sum("_k").alias("r"))
    refb = pooled.join(binned, ["lo", "hi"]).select("window", "bin", "r")
    curb = (df.filter((F.col(window) != ref) & F.col(value).isNotNull())
              .select(F.col(window).alias("window"), F.col(value).alias("x")).join(pooled, "window").groupBy("window", idx.cast("int").alias("bin"))
              .agg(F.count(F.lit(1)).alias("c")))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    grid = wins.crossJoin(F.broadcast(spine))
    both = (grid.join(refb, ["window", "bin"], "left").join(curb, ["window", "bin"], "left")
                .select("window", "bin", F.coalesce("r", F.lit(0)).alias("r"), F.coalesce("c", F.lit(0)).alias("c")))
    return _psi_from_counts(both)


def psi_status(psi: Column) -> Column:
    return F.when(psi > PSI_ALERT, "ALERT").when(psi > PSI_MODERATE, "MODERATE").otherwise("PASS")


def _row(window: Column, kind: str, check: str, value: Column, ref_value: Column, threshold: Column,
         extra: Column, status: Column) -> list[Column]:
    return [window.alias("window"), F.lit(kind).alias("kind"), F.lit(check).alias("check"),
            value.cast("double").alias("value"), ref_value.cast("double").alias("reference_value"),
            threshold.alias("threshold"), extra.alias("extra"), status.alias("status")]


def ks_rows(df: DataFrame, value: str, **kw) -> DataFrame:
    ks = ks_two_sample(df, value, **kw)
    status = F.when((F.col("p_value") < KS_ALERT_P) & (F.col("ks_stat") > KS_ALERT_STAT), "ALERT").otherwise("PASS")
    return ks.select(*_row(F.col("window"), "feature_drift", f"ks_{value}", F.col("ks_stat"), F.lit(0.0),
                           F.lit(f"ks_stat > {KS_ALERT_STAT} (and p < {KS_ALERT_P})"),
                           F.format_string("p_value=%.3e", F.col("p_value")), status))


def psi_rows(psi: DataFrame, check: str) -> DataFrame:
    return psi.select(*_row(F.col("window"), "feature_drift", check, F.col("psi"), F.lit(0.0),
                            F.lit(f"> {PSI_ALERT}"), F.lit(""), psi_status(F.col("psi"))))


def f1_drift(scored: DataFrame, label: str = "label", pred: str = "prediction", window: str = "window",
             ref: str = "reference") -> DataFrame:
    m = classification_metrics(scored, label, pred, by=[window])
    r = m.filter(F.col(window) == ref).select(F.col("f1").alias("f1_ref"))
    c = m.filter(F.col(window) != ref).select(F.col(window).alias("window"), F.col("f1").alias("f1_cur"))
    drop = F.col("f1_ref") - F.col("f1_cur")
    return c.crossJoin(F.broadcast(r)).select(*_row(
        F.col("window"), "prediction_error_drift", "classifier_f1_drift", F.col("f1_cur"), F.col("f1_ref"),
        F.format_string("reference F1=%.3f, drop > %s", F.col("f1_ref"), F.lit(str(F1_DROP_ALERT))),
        F.format_string("drop=%.3f", drop), F.when(drop > F1_DROP_ALERT, "ALERT").otherwise("PASS")))


def mae_drift(scored: DataFrame, actual: str = "actual", pred: str = "prediction", window: str = "window",
              ref: str = "reference") -> DataFrame:
    m = regression_metrics(scored, actual, pred, by=[window])
    r = m.filter(F.col(window) == ref).select(F.col("mae").alias("mae_ref"))
    c = m.filter(F.col(window) != ref).select(F.col(window).alias("window"), F.col("mae").alias("mae_cur"))
    inc = F.coalesce(F.try_divide(F.col("mae_cur") - F.col("mae_ref"), F.col("mae_ref")), F.lit(0.0))
    return c.crossJoin(F.broadcast(r)).select(*_row(
        F.col("window"), "prediction_error_drift", "regressor_mae_drift", F.col("mae_cur"), F.col("mae_ref"),
        F.format_string("reference MAE=%.1f, increase > %d%%", F.col("mae_ref"),
                        F.lit(int(MAE_INCREASE_ALERT_PCT * 100))),
        F.format_string("increase=%.1f%%", inc * 100),
        F.when(inc > MAE_INCREASE_ALERT_PCT, "ALERT").otherwise("PASS")))


def drift_report(feature_rows: Sequence[DataFrame], error_rows: Sequence[DataFrame] = ()) -> DataFrame:
    parts = list(feature_rows) + list(error_rows)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def window_status(report: DataFrame) -> DataFrame:
    """ALERT when any check alerts (MODERATE does not), with the sorted list of
    alerting checks."""
    return report.groupBy("window").agg(
        F.when(F.bool_or(F.col("status") == "ALERT"), "ALERT").otherwise("PASS").alias("overall_status"),
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(F.col("status") == "ALERT").alias("n_alerts"),
        F.count_if(F.col("status") == "MODERATE").alias("n_moderate"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("status") == "ALERT", F.col("check")))), ", ")
        .alias("alerting_checks"))


def drift_summary(windows: DataFrame, status: DataFrame, ts: str = "date_time", window: str = "window",
                  ref: str = "reference") -> DataFrame:
    """Nested JSON: the reference span/rows and each window's status and rows."""
    refspan = windows.filter(F.col(window) == ref).agg(
        F.struct(F.min(ts).cast("string").alias("start"), F.max(ts).cast("string").alias("end"),
                 F.count(F.lit(1)).alias("n_rows")).alias("reference_window"))
    rows = windows.filter(F.col(window) != ref).groupBy(F.col(window).alias("window")).agg(F.count(F.lit(1)).alias("n_rows"))
    per = status.join(rows, "window").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(
        "window", F.struct("overall_status", "n_rows"))))).alias("windows"))
    return refspan.crossJoin(per).select(F.to_json(F.struct("reference_window", "windows")).alias("summary_json"))


# --- fixed values: the severe-winter window of the reference's monitor ---------
WINTER_WEATHER = ("snow", "fog", "mist", "thunderstorm", "clouds")
WINTER_SHARE = (0.35, 0.25, 0.15, 0.10, 0.15)
WINTER_COLDER, WINTER_COLDER_SD = 18.0, 2.0
WINTER_CLOUDS, WINTER_CLOUDS_SD = 35.0, 5.0
PRECIPITATING = ("drizzle", "rain", "snow")
# ---------------------------------------------------------------------------


def hashed_uniform(seed: int, name: str, draw: Column) -> Column:
    """A number in (0, 1) that depends on seed, name and draw alone: 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{name}:"), draw.cast("string")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(2 ** 52))


def hashed_normal(seed: int, name: str, draw: Column) -> Column:
    """A standard normal number by Box and Muller from two hashed uniforms."""
    u, v = (hashed_uniform(seed, f"{name}{k}", draw) for k in (1, 2))
    return F.sqrt(F.lit(-2.0) * F.log(u)) * F.cos(F.lit(2 * math.pi) * v)


def perturb_batch(reference: DataFrame, n_rows: int, seed: int = 42, ts: str = "date_time", tie: Sequence[str] = ("sensor",),
                  weather_values: Sequence[str] = WINTER_WEATHER, weather_p: Sequence[float] = WINTER_SHARE) -> DataFrame:
    """Synthetic 'severe winter' window: exactly ``n_rows`` rows of ``reference`` drawn with replacement (``draw`` numbers them), temperature
    −18 K + N(0, 2), clouds +35 + N(0, 5) clipped to [0, 100], weather drawn from the given shares. The one-hot columns, the flags
    (precipitation from the drawn weather) and the scaled columns are derived again, with the reference's statistics; all other columns stay.

    A draw is a hash of its number, looked up as a rank by time: draws and ranks meet in an equi-join, and every run, retry and engine
    draws the same rows. An empty reference gives no rows."""
    ranked = rank_by_time(reference, ts, tie)
    stats = reference.agg(F.avg("temp").alias("_t_mean"), F.stddev_samp("temp").alias("_t_std"), F.min("clouds_all").alias("_c_min"),
                          F.max("clouds_all").alias("_c_max"), F.count(F.lit(1)).alias("_n_ref"))
    draws = (reference.sparkSession.range(n_rows).select(F.col("id").alias("draw")).crossJoin(F.broadcast(stats))      # one row
             .withColumn("_draw_rank", F.floor(hashed_uniform(seed, "rank", F.col("draw")) * F.col("_n_ref"))))
    u = hashed_uniform(seed, "weather", F.col("draw"))
    weather, share = F.when(u < weather_p[0], weather_values[0]), weather_p[0]
    for v, p in zip(weather_values[1:-1], weather_p[1:]):
        share += p
        weather = weather.when(u < share, v)
    weather = weather.otherwise(weather_values[-1])
    rows = draws.join(ranked, F.col("_draw_rank") == F.col("_rank")).withColumns({
        "temp": F.col("temp") - WINTER_COLDER + hashed_normal(seed, "temp", F.col("draw")) * WINTER_COLDER_SD,
        "clouds_all": F.least(F.lit(100.0), F.greatest(
            F.lit(0.0), F.col("clouds_all") + WINTER_CLOUDS + hashed_normal(seed, "clouds", F.col("draw")) * WINTER_CLOUDS_SD)),
        "weather_main": weather})
    derived = {
        **{f"weather_{v}": C.one_hot("weather_main", v) for v in C.WEATHER_CATEGORIES},
        "is_severe_weather": C.is_severe("weather_main"), "is_low_visibility": C.is_low_visibility("weather_main"),
        "is_precipitating": F.col("weather_main").isin(*PRECIPITATING).cast("int"),
        "temp_zscore": F.try_divide(F.col("temp") - F.col("_t_mean"), F.col("_t_std")),
        "clouds_all_minmax": F.try_divide(F.col("clouds_all") - F.col("_c_min"), F.col("_c_max") - F.col("_c_min"))}
    return rows.withColumns({k: v for k, v in derived.items() if k in reference.columns}) \
               .drop("_t_mean", "_t_std", "_c_min", "_c_max", "_n_ref", "_draw_rank", "_rank", "_n")
