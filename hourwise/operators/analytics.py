"""Descriptive / probabilistic SQL analytics, query-application operators and
the aggregates behind the charts.

All of them are hash aggregates (map-side partial aggregation) over the
hourly table; windows appear only over already-aggregated, bounded results
(one row per year / hour / day type).
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from .prefix import exact_quantiles

TS = "date_time"
VOL = "traffic_volume"


def _ts_lit(value) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def year_range(ts: str, start_year: int, end_year: int) -> Column:
    """Years [start, end] as a range predicate on the raw timestamp (pushdown-able,
    unlike a function of the column)."""
    return (F.col(ts) >= _ts_lit(f"{start_year}-01-01 00:00:00")) & \
           (F.col(ts) < _ts_lit(f"{end_year + 1}-01-01 00:00:00"))


def day_ranges(ts: str, days: Sequence[dt.date]) -> Column:
    """OR of [d, d+1) ranges: a calendar-date filter that Parquet can prune on."""
    pred = F.lit(False)
    for d in days:
        pred = pred | ((F.col(ts) >= _ts_lit(f"{d} 00:00:00")) &
                       (F.col(ts) < _ts_lit(f"{d + dt.timedelta(days=1)} 00:00:00")))
    return pred


# ---------------------------------------------------------------- 2.D -------

def annual_trends(df: DataFrame, start_year: int, end_year: int, ts: str = TS, value: str = VOL) -> DataFrame:
    return (df.filter(year_range(ts, start_year, end_year))
              .groupBy(F.year(ts).alias("year"))
              .agg(F.count(F.lit(1)).alias("hours_recorded"),
                   F.sum(value).alias("total_volume"),
                   F.avg(value).alias("avg_hourly_volume")))


def yoy_change(trends: DataFrame) -> DataFrame:
    """LAG over the yearly aggregate (a few dozen rows, so the single-partition
    window is over an already-reduced result)."""
    w = Window.orderBy("year")
    prev = F.lag("total_volume").over(w)
    return trends.withColumns({
        "prev_year_total": prev,
        "yoy_change": F.col("total_volume") - prev,
        "yoy_pct_change": F.try_divide(F.lit(100.0) * (F.col("total_volume") - prev), prev)})


def _date_stats(df: DataFrame, name: str, ts: str) -> DataFrame:
    return (df.groupBy(F.year(ts).alias("year"))
              .agg(F.lit(name).alias("holiday_name"),
                   F.min(F.to_date(ts)).alias("calendar_date"),
                   F.count(F.lit(1)).alias("hours_available"),
                   F.avg("temp").alias("avg_temp_k"),
                   (F.avg("temp") - C.KELVIN_OFFSET).alias("avg_temp_c"),
                   F.min("temp").alias("min_temp_k"), F.max("temp").alias("max_temp_k"),
                   F.avg(VOL).alias("avg_traffic_volume"))
              .select("holiday_name", "year", "calendar_date", "hours_available", "avg_temp_k",
                      "avg_temp_c", "min_temp_k", "max_temp_k", "avg_traffic_volume"))


def fixed_date_stats(df: DataFrame, month: int, day: int, years: Sequence[int],
                     name: str = "New Years Day", ts: str = TS) -> DataFrame:
    days = [dt.date(y, month, day) for y in years]
    return _date_stats(df.filter(day_ranges(ts, days)), name, ts)


def tagged_date_stats(df: DataFrame, tag: str, years: Sequence[int], name: str | None = None,
                      ts: str = TS, holiday: str = "holiday") -> DataFrame:
    """Stats over every reading whose calendar date carries ``tag`` somewhere
    (IN-subquery → left semi join on the date)."""
    tagged_days = (df.filter((F.col(holiday) == tag) & F.year(ts).isin(list(years)))
                     .select(F.to_date(ts).alias("_d")).distinct())
    matched = df.join(tagged_days, F.to_date(F.col(ts)) == F.col("_d"), "left_semi")
    return _date_stats(matched, name or tag, ts)


def union_all_sorted(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("holiday_name", "year")


def descriptive_stats(df: DataFrame, x: str = VOL) -> DataFrame:
    v = F.col(x)
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.avg(v).alias("mean"), F.min(v).alias("min_volume"), F.max(v).alias("max_volume"),
                  (F.max(v) - F.min(v)).alias("range_volume"),
                  F.stddev_pop(v).alias("population_stddev"), F.var_pop(v).alias("population_variance"),
                  F.stddev_samp(v).alias("sample_stddev"), F.var_samp(v).alias("sample_variance"))
    median = exact_quantiles(df, x, (0.5,), ["median"])                                        # one row
    return stats.crossJoin(F.broadcast(median)).select("n", "mean", "median", *stats.columns[2:])


def exact_median(df: DataFrame, x: str = VOL) -> DataFrame:
    median = exact_quantiles(df, x, (0.5,), ["median"])                                        # one row
    return df.agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(median))


def pearson(df: DataFrame, x: str = "temp", y: str = VOL) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), C.safe_corr(F.col(x), F.col(y).cast("double")).alias("pearson_r"))


def _rate(pred: Column) -> Column:
    return C.mean_of_bool(pred)


def event_probabilities(df: DataFrame, a: Column, b: Column) -> DataFrame:
    return df.agg(_rate(a).alias("p_congestion"), _rate(b).alias("p_clear_weather"),
                  _rate(a & b).alias("p_congestion_and_clear"))


def conditional_probabilities(df: DataFrame, a: Column, b: Column, c: Column) -> DataFrame:
    n_a = F.count_if(a)
    return df.agg(F.try_divide(F.count_if(a & b), n_a).alias("p_clear_given_congestion"),
                  F.try_divide(F.count_if(a & c), n_a).alias("p_hightemp_given_congestion"))


def independence_check(df: DataFrame, a: Column, b: Column) -> DataFrame:
    return df.agg(_rate(a & b).alias("p_a_and_b_observed"),
                  (_rate(a) * _rate(b)).alias("p_a_times_p_b_if_independent"))


def odds_ratio(df: DataFrame, event: Column, group_a: Column, group_b: Column) -> DataFrame:
    """Odds of ``event`` in group A vs group B in ONE conditional aggregate
    (instead of two scans and a cross join)."""
    pa = F.try_divide(F.count_if(group_a & event), F.count_if(group_a))
    pb = F.try_divide(F.count_if(group_b & event), F.count_if(group_b))
    oa = F.try_divide(pa, F.lit(1.0) - pa)
    ob = F.try_divide(pb, F.lit(1.0) - pb)
    return df.agg(pa.alias("p_congestion_given_clear"), pb.alias("p_congestion_given_cloudy"),
                  oa.alias("odds_congestion_clear"), ob.alias("odds_congestion_cloudy"),
                  F.try_divide(oa, ob).alias("odds_ratio_clear_vs_cloudy"))


def predicate_filters(df: DataFrame, high: float, low: float) -> DataFrame:
    """The predicate forms in use (>, <, =, IN, BETWEEN, AND, OR, NOT, CASE)."""
    band = (F.when(F.col(VOL) > high, "high").when(F.col(VOL) < low, "low").otherwise("mid"))
    pred = ((F.col("weather_main").isin("clear", "clouds") | (F.col("weather_main") == "rain"))
            & F.col("clouds_all").between(10, 90) & ~(F.col("holiday") != "none"))
    return df.filter(pred).groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- 2.E -------

PROBE_FORMATS = ["yyyy-MM-dd HH:mm", "yyyy-MM-dd HH", "yyyy-MM-dd"]


def parse_probe_times(df: DataFrame, text: str = "probe_text") -> DataFrame:
    """Three formats tried in order; anything else is rejected (not an error)."""
    parsed = F.coalesce(*[F.try_to_timestamp(F.col(text), F.lit(f)) for f in PROBE_FORMATS])
    return df.withColumn("probe_time", parsed.cast("timestamp_ntz")) \
             .withColumn("rejected", F.col("probe_time").isNull().cast("int"))


def lookup_exact(df: DataFrame, at, ts: str = TS) -> DataFrame:
    return df.filter(F.col(ts) == _ts_lit(at))


def lookup_nearest(df: DataFrame, at, ts: str = TS, tie_cols: Sequence[str] = ("sensor",)) -> DataFrame:
    """Row with the least |Δt| (earlier, then ``tie_cols``, on ties) and its gap:
    a TakeOrdered(1) — each task keeps one candidate, no full sort."""
    gap = F.abs(F.unix_timestamp(F.col(ts).cast("timestamp")) - F.unix_timestamp(_ts_lit(at).cast("timestamp")))
    return (df.withColumn("gap_seconds", gap)
              .orderBy("gap_seconds", ts, *tie_cols).limit(1))


def asof_join(probes: DataFrame, readings: DataFrame, probe_ts: str = "probe_time", read_ts: str = TS,
              by: Sequence[str] = ("sensor",), probe_id: str = "probe_id",
              bucket_seconds: int = 86400) -> DataFrame:
    """Nearest reading (either direction, earlier on ties) for every probe.

    Windows run per (by, time bucket, salt): no sensor — however hot — becomes
    one task, and a bucket with several times the mean number of probes is
    split into that many salts, each seeing all of that bucket's readings
    (probes never interact, so the split is exact). A probe without a time has no match. A probe whose bucket has no
    reading on one side takes the neighbour from the bucket-level summary (one
    row per non-empty bucket) via a range-framed window over buckets. The next
    neighbours come from windows in descending order: a frame that grows costs one
    step a row, one that runs to the end is read anew for each row. Returns
    the probe columns plus ``match_time`` and ``gap_seconds``; join to
    ``readings`` on (by, match_time) for more columns.
    """
    by = list(by)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    bucket = lambda c: F.floor(micros(c) / (bucket_seconds * 1_000_000))
    p = probes.select(*by, F.col(probe_id).cast("long").alias("_pid"), F.col(probe_ts).alias("_t")) \
              .withColumn("_b", bucket("_t"))
    untimed = p.filter(F.col("_t").isNull())
    p = p.filter(F.col("_t").isNotNull())
    # salts per (by, bucket) from the probe counts: one row per bucket that has probes
    salts = p.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_np"))
    salts = salts.crossJoin(F.broadcast(salts.agg(F.avg("_np").alias("_mean")))) \
                 .withColumn("_ns", F.greatest(F.lit(1), F.ceil(F.col("_np") / (4 * F.col("_mean")))).cast("int"))
    p = p.join(salts.select(*by, "_b", "_ns"), [*by, "_b"]) \
         .withColumn("_salt", F.pmod(F.xxhash64("_pid"), F.col("_ns")).cast("int")).drop("_ns") \
         .withColumn("_rt", F.lit(None).cast("timestamp_ntz")).withColumn("_k", F.lit(1))
    r = (readings.select(*by, F.col(read_ts).alias("_t")).withColumn("_b", bucket("_t"))
                 .join(salts.select(*by, "_b", "_ns"), [*by, "_b"])          # only buckets that have probes
                 .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_ns") - 1))).drop("_ns")
                 .withColumn("_rt", F.col("_t")).withColumn("_pid", F.lit(None).cast("long")).withColumn("_k", F.lit(0)))
    u = r.unionByName(p)
    part = [*by, "_b", "_salt"]
    inb = (u.withColumn("_prev", F.last("_rt", True).over(
                Window.partitionBy(*part).orderBy("_t", "_k").rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_next", F.last("_rt", True).over(
                Window.partitionBy(*part).orderBy(F.col("_t").desc(), "_k").rowsBetween(Window.unboundedPreceding, 0)))
            .filter(F.col("_k") == 1))
    summ = readings.select(*by, bucket(read_ts).alias("_b"), F.col(read_ts).alias("_x")) \
                   .groupBy(*by, "_b").agg(F.max("_x").alias("_bmax"), F.min("_x").alias("_bmin"))
    pb = salts.select(*by, "_b").withColumn("_bmax", F.lit(None).cast("timestamp_ntz")) \
              .withColumn("_bmin", F.lit(None).cast("timestamp_ntz")).withColumn("_isp", F.lit(1))
    wb, wd = Window.partitionBy(*by).orderBy("_b"), Window.partitionBy(*by).orderBy(F.col("_b").desc())
    nb = (summ.withColumn("_isp", F.lit(0)).unionByName(pb)
              .withColumn("_pb", F.last("_bmax", True).over(wb.rangeBetween(Window.unboundedPreceding, -1)))
              .withColumn("_nb", F.last("_bmin", True).over(wd.rangeBetween(Window.unboundedPreceding, -1)))
              .filter(F.col("_isp") == 1).select(*by, "_b", "_pb", "_nb"))
    cand = inb.join(nb, [*by, "_b"], "left") \
              .withColumn("_prev", F.coalesce("_prev", "_pb")).withColumn("_next", F.coalesce("_next", "_nb"))
    dprev = micros("_t") - micros("_prev")
    dnext = micros("_next") - micros("_t")
    chosen = (F.when(F.col("_prev").isNull(), F.col("_next")).when(F.col("_next").isNull(), F.col("_prev"))
               .when(dprev <= dnext, F.col("_prev")).otherwise(F.col("_next")))
    out = cand.withColumn("match_time", chosen) \
              .withColumn("gap_seconds", F.abs(micros("_t") - micros("match_time")) / 1e6)
    out = out.select(F.col("_pid").alias(probe_id), *by, F.col("_t").alias(probe_ts), "match_time", "gap_seconds")
    return out.unionByName(untimed.select(
        F.col("_pid").alias(probe_id), *by, F.col("_t").alias(probe_ts),
        F.lit(None).cast("timestamp_ntz").alias("match_time"), F.lit(None).cast("double").alias("gap_seconds")))


def day_type_filter(df: DataFrame, day_type: str = "all", flag: str = "is_weekend") -> DataFrame:
    if day_type not in ("all", "weekday", "weekend"):
        raise ValueError(f"Invalid day-type '{day_type}'. Must be one of: all, weekday, weekend.")
    if day_type == "weekday":
        return df.filter(F.col(flag) == 0)
    if day_type == "weekend":
        return df.filter(F.col(flag) == 1)
    return df


def rank_hours(df: DataFrame, top_n: int = 5, day_type: str = "all", ascending: bool = False) -> DataFrame:
    if top_n < 1:
        raise ValueError(f"top must be a positive integer, got {top_n}")
    agg = (day_type_filter(df, day_type).groupBy("hour")
           .agg(F.avg(VOL).alias("avg_traffic_volume"), F.count(F.lit(1)).alias("hours_observed")))
    order = F.col("avg_traffic_volume").asc() if ascending else F.col("avg_traffic_volume").desc()
    return agg.orderBy(order, F.col("hour").asc()).limit(top_n)


def busiest_hours(df: DataFrame, top_n: int = 5, day_type: str = "all") -> DataFrame:
    return rank_hours(df, top_n, day_type, ascending=False)


def quietest_hours(df: DataFrame, top_n: int = 5, day_type: str = "all") -> DataFrame:
    return rank_hours(df, top_n, day_type, ascending=True)


def compare_day_types(df: DataFrame, x: str = VOL, flag: str = "is_weekend") -> DataFrame:
    """Mean, median, sample std and n for weekday vs weekend, long form."""
    wd = F.when(F.col(flag) == 0, F.col(x))
    we = F.when(F.col(flag) == 1, F.col(x))
    medians = exact_quantiles(df, x, (0.5,), ["_d"], [flag]).agg(
        F.max(F.when(F.col(flag) == 0, F.col("_d"))).alias("d0"), F.max(F.when(F.col(flag) == 1, F.col("_d"))).alias("d1"))
    wide = df.agg(F.avg(wd).alias("m0"), F.avg(we).alias("m1"), F.stddev_samp(wd).alias("s0"), F.stddev_samp(we).alias("s1"),
                  F.count(wd).cast("double").alias("n0"), F.count(we).cast("double").alias("n1"))
    wide = wide.crossJoin(F.broadcast(medians))                                                # one row each
    return wide.selectExpr(
        "stack(4, 'Mean', m0, m1, 'Median', d0, d1, 'Std dev', s0, s1, 'Hours (n)', n0, n1) "
        "AS (statistic, weekday, weekend)").withColumn("difference", F.col("weekday") - F.col("weekend"))


def day_readings(df: DataFrame, day: dt.date | str, ts: str = TS) -> DataFrame:
    d = dt.date.fromisoformat(str(day))
    return df.filter(day_ranges(ts, [d])).orderBy(ts, "sensor")


def condition_summary(df: DataFrame, condition: str, weather: str = "weather_main") -> DataFrame:
    cond = condition.strip().lower()
    own = df.filter(F.col(weather) == cond)
    median = exact_quantiles(own, VOL, (0.5,), ["median"])                                     # one row
    return own.agg(F.lit(cond).alias("condition"), F.count(F.lit(1)).alias("n"),
                   F.avg(VOL).alias("mean")).crossJoin(F.broadcast(median))


def unknown_condition_message(df: DataFrame, condition: str, weather: str = "weather_main") -> str | None:
    """Error text listing the valid values when ``condition`` does not occur
    (one probe row; the listing runs only on the error path, over distinct values)."""
    cond = condition.strip().lower()
    if df.filter(F.col(weather) == cond).limit(1).take(1):
        return None
    vals = sorted(r[0] for r in df.select(weather).distinct().dropna().collect())
    return f"Unknown weather condition '{condition}'. Available: {', '.join(vals)}."


def category_breakdown(df: DataFrame, category: str = "congestion_category",
                       labels: Sequence[str] = C.CONGESTION_LABELS) -> DataFrame:
    """Count and % per category with every label listed (0 when absent)."""
    spark = df.sparkSession
    spine = spark.createDataFrame([(i, lab) for i, lab in enumerate(labels)], "ordinal int, category string")
    counts = df.groupBy(F.col(category).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    return (spine.join(counts, "category", "left").crossJoin(F.broadcast(total))
                 .select("category", "ordinal", F.coalesce("n", F.lit(0)).alias("n"),
                         F.coalesce(F.try_divide(F.lit(100.0) * F.col("n"), F.col("_total")), F.lit(0.0)).alias("pct"))
                 .orderBy("ordinal"))


def format_reading(df: DataFrame, ts: str = TS) -> DataFrame:
    """One-line text per reading: time (day name), volume with thousands
    separators, congestion, weather, °C with one decimal."""
    text = F.format_string(
        "%s (%s)  traffic=%s veh/hr  category=%s  weather=%s  temp=%.1f°C",
        F.date_format(ts, "yyyy-MM-dd HH:mm"), F.date_format(ts, "EEEE"),
        F.format_number(F.col(VOL).cast("double"), 0), F.col("congestion_category"),
        F.col("weather_main"), C.kelvin_to_celsius("temp"))
    return df.withColumn("reading_text", text)


# ---------------------------------------------------------------- 2.F -------

def hour_by_daytype_pivot(df: DataFrame) -> DataFrame:
    return (df.groupBy("hour").pivot("is_weekend", [0, 1]).agg(F.avg(VOL))
              .withColumnRenamed("0", "weekday_mean").withColumnRenamed("1", "weekend_mean"))


def peak_hour(pivot: DataFrame) -> DataFrame:
    """argmax hour per day type (smallest hour on ties) and mean-of-means gap."""
    return pivot.agg(
        F.min_by("hour", F.struct(-F.col("weekday_mean"), F.col("hour"))).alias("weekday_peak_hour"),
        F.max("weekday_mean").alias("weekday_peak_mean"),
        F.min_by("hour", F.struct(-F.col("weekend_mean"), F.col("hour"))).alias("weekend_peak_hour"),
        F.max("weekend_mean").alias("weekend_peak_mean"),
        (F.avg("weekday_mean") - F.avg("weekend_mean")).alias("mean_difference"))


def boxplot_stats(df: DataFrame, x: str = VOL, flag: str = "is_weekend") -> DataFrame:
    """Quartiles (linear interpolation), 1.5·IQR whiskers at the furthest data
    point inside the fences, and flier counts, per day type: two aggregates."""
    q = exact_quantiles(df, x, (0.25, 0.5, 0.75), ["q1", "median", "q3"], [flag])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
         .withColumn("_lo", F.col("q1") - 1.5 * F.col("iqr")).withColumn("_hi", F.col("q3") + 1.5 * F.col("iqr"))
    v = F.col(x)
    inside = (v >= F.col("_lo")) & (v <= F.col("_hi"))
    w = (df.join(F.broadcast(q), flag)
           .groupBy(flag).agg(F.min(F.when(inside, v)).alias("whisker_low"),
                              F.max(F.when(inside, v)).alias("whisker_high"),
                              F.count_if(~inside).alias("n_fliers"), F.count(F.lit(1)).alias("n")))
    return (q.join(w, flag)
             .select(F.when(F.col(flag) == 1, "Weekend").otherwise("Weekday").alias("day_type"),
                     "n", "q1", "median", "q3", "iqr", "whisker_low", "whisker_high", "n_fliers"))


def mean_by_weather_min_n(df: DataFrame, min_n: int = 50, weather: str = "weather_main") -> DataFrame:
    """Mean and count per weather value with n ≥ min_n (HAVING), and whether the
    mean is below the median of those means."""
    stats = (df.groupBy(F.col(weather).alias("weather_main"))
               .agg(F.avg(VOL).alias("mean"), F.count(F.lit(1)).alias("n"))
               .filter(F.col("n") >= min_n))
    med = stats.agg(F.median("mean").alias("_med"))
    return (stats.crossJoin(F.broadcast(med))
                 .withColumn("below_median", (F.col("mean") < F.col("_med")).cast("int"))
                 .drop("_med").orderBy("mean"))


def extreme_difference(stats: DataFrame) -> DataFrame:
    return stats.agg(F.max_by("weather_main", "mean").alias("highest"), F.max("mean").alias("highest_mean"),
                     F.min_by("weather_main", "mean").alias("lowest"), F.min("mean").alias("lowest_mean"),
                     (F.max("mean") - F.min("mean")).alias("difference"))


def sample_rows(df: DataFrame, n: int = 4000, seed: int = 42, key: Sequence[str] = ("sensor", TS)) -> DataFrame:
    """Reproducible sample of exactly min(n, rows) rows without replacement:
    rank by an MD5 of the seed and the key (portable: any engine computes the
    same digest) and keep the n smallest — a per-task top-n, no full sort."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    return df.withColumn("_h", h).orderBy("_h", *key).limit(n).drop("_h")


def histogram(df: DataFrame, x: str = VOL, bins: int = 40) -> DataFrame:
    """Equal-width bins on [min, max], last bin closed, every bin listed."""
    spark = df.sparkSession
    mm = df.agg(F.min(x).cast("double").alias("_min"), F.max(x).cast("double").alias("_max"))
    width = (F.col("_max") - F.col("_min")) / bins
    idx = F.least(F.floor(F.try_divide(F.col(x) - F.col("_min"), width)), F.lit(bins - 1))
    counts = (df.crossJoin(F.broadcast(mm)).filter(F.col(x).isNotNull())
                .groupBy(F.coalesce(idx, F.lit(0)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    spine = spark.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(F.broadcast(mm))
    return (spine.join(counts, "bin", "left")
                 .select("bin", (F.col("_min") + F.col("bin") * width).alias("bin_start"),
                         (F.col("_min") + (F.col("bin") + 1) * width).alias("bin_end"),
                         F.coalesce("n", F.lit(0)).alias("n")))


def skewness_adjusted(df: DataFrame, x: str = VOL) -> DataFrame:
    return df.agg(C.adjusted_skewness(F.col(x).cast("double")).alias("skewness"),
                  F.avg(x).alias("mean")).crossJoin(F.broadcast(exact_quantiles(df, x, (0.5,), ["median"])))


def monthly_share(df: DataFrame, category: str = "congestion_category", level: str = "Very High",
                  ts: str = TS) -> DataFrame:
    return (df.groupBy(F.date_format(ts, "yyyy-MM").alias("year_month"))
              .agg((C.mean_of_bool(F.col(category) == level) * 100).alias("pct_very_high"))
              .orderBy("year_month"))


def peak_month(share: DataFrame) -> DataFrame:
    return share.agg(F.min_by("year_month", F.struct(-F.col("pct_very_high"), F.col("year_month")))
                     .alias("peak_month"), F.max("pct_very_high").alias("peak_pct"))


def chart_interpretations(peak: DataFrame, box: DataFrame, weather_ext: DataFrame, corr: DataFrame,
                          skew: DataFrame, month_peak: DataFrame) -> DataFrame:
    """One sentence per chart built from the one-row aggregates (all tiny)."""
    num = lambda c: F.format_number(F.col(c), 0)
    t1 = peak.select(F.lit(1).alias("chart"), F.format_string(
        "Weekday traffic peaks at %d:00 (%s veh/hr); weekend traffic peaks at %d:00 (%s veh/hr). "
        "Weekdays exceed weekends by %s veh/hr on average.",
        "weekday_peak_hour", num("weekday_peak_mean"), "weekend_peak_hour", num("weekend_peak_mean"),
        num("mean_difference")).alias("interpretation"))
    b = box.groupBy().pivot("day_type", ["Weekday", "Weekend"]).agg(F.first("median"))
    t2 = b.select(F.lit(2).alias("chart"), F.format_string(
        "Median weekday volume (%s veh/hr) is %s veh/hr higher than the weekend median (%s veh/hr).",
        num("Weekday"), F.format_number(F.col("Weekday") - F.col("Weekend"), 0), num("Weekend"))
        .alias("interpretation"))
    t3 = weather_ext.select(F.lit(3).alias("chart"), F.format_string(
        "'%s' carries the highest average volume (%s veh/hr) and '%s' the lowest (%s veh/hr), "
        "a difference of %s veh/hr.", F.initcap("highest"), num("highest_mean"), F.initcap("lowest"),
        num("lowest_mean"), num("difference")).alias("interpretation"))
    t4 = corr.select(F.lit(4).alias("chart"), F.format_string(
        "Pearson r = %.3f between temperature and traffic volume.", "pearson_r").alias("interpretation"))
    t5 = skew.select(F.lit(5).alias("chart"), F.format_string(
        "Skewness is %.2f and the mean (%s) compares with the median (%s).", "skewness", num("mean"),
        num("median")).alias("interpretation"))
    t6 = month_peak.select(F.lit(6).alias("chart"), F.format_string(
        "The share of severely congested hours peaks at %s%% in %s.", F.format_number("peak_pct", 0),
        F.date_format(F.to_date(F.concat("peak_month", F.lit("-01"))), "MMMM yyyy")).alias("interpretation"))
    return t1.unionByName(t2).unionByName(t3).unionByName(t4).unionByName(t5).unionByName(t6)
