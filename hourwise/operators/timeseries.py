"""Time-series operators: contiguous blocks, in-block lags and rolling means,
fixed-length sequence windows, as-of features and rank-based splits.

Scale design
------------
Nothing is windowed over a whole sensor or a whole block: a hot sensor (or a
gap-free block spanning years) would become one task. Instead rows are put
into (sensor, time bucket) partitions. Row-based look-backs of k rows inside
a block reach at most k × max_gap back in time (consecutive rows of a block
are ≤ max_gap apart), so each bucket gets a *halo* copy of the preceding
k × max_gap of readings; window results are kept only for the bucket's own
rows. What crosses bucket boundaries (the previous reading, the current
block's start) comes from one-row-per-bucket summaries with range-framed
windows, whose size grows with the time span, not with the row count.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TS = "date_time"
BY = ("sensor",)
HOUR = 3600
WINDOW = 24
DAY = 86400


def _micros(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def _bucket(c, bucket_seconds: int) -> Column:
    return F.floor(_micros(c) / F.lit(bucket_seconds * 1_000_000)).cast("long")


def _with_halo(df: DataFrame, ts: str, halo_seconds: int, bucket_seconds: int) -> DataFrame:
    """Every row in its own bucket (``_halo`` = 0) plus a copy in the next
    bucket (``_halo`` = 1) when it lies within ``halo_seconds`` of that bucket."""
    if halo_seconds > bucket_seconds:
        raise ValueError("bucket_seconds must be at least the halo length")
    own = df.withColumn("_bk", _bucket(ts, bucket_seconds)).withColumn("_halo", F.lit(0))
    next_start = (F.col("_bk") + 1) * F.lit(bucket_seconds * 1_000_000)
    copy = (own.filter(_micros(ts) >= next_start - F.lit(halo_seconds * 1_000_000))
               .withColumn("_bk", F.col("_bk") + 1).withColumn("_halo", F.lit(1)))
    return own.unionByName(copy)


def contiguous_blocks(df: DataFrame, ts: str = TS, by: Sequence[str] = BY, max_gap_seconds: int = HOUR,
                      bucket_seconds: int = 7 * DAY) -> DataFrame:
    """Adds ``is_block_start`` and ``block_start`` (the block's first timestamp,
    which identifies the block): a new block starts when the previous reading
    of the same ``by`` key is more than ``max_gap_seconds`` earlier; a gap of
    exactly ``max_gap_seconds`` stays inside the block."""
    by = list(by)
    d = df.withColumn("_bk", _bucket(ts, bucket_seconds))
    w = Window.partitionBy(*by, "_bk").orderBy(ts)
    wb = Window.partitionBy(*by).orderBy("_bk")
    summ = d.groupBy(*by, "_bk").agg(F.max(ts).alias("_bmax"))
    prev_bucket = summ.withColumn("_pmax", F.last("_bmax", True).over(wb.rangeBetween(Window.unboundedPreceding, -1))) \
                      .select(*by, "_bk", "_pmax")
    d = d.join(prev_bucket, [*by, "_bk"], "left") \
         .withColumn("_prev", F.coalesce(F.lag(ts).over(w), F.col("_pmax")))
    start = F.col("_prev").isNull() | ((_micros(ts) - _micros("_prev")) > F.lit(max_gap_seconds * 1_000_000))
    d = d.withColumn("is_block_start", start.cast("int"))
    starts = d.groupBy(*by, "_bk").agg(F.max(F.when(F.col("is_block_start") == 1, F.col(ts))).alias("_smax"))
    prev_start = starts.withColumn("_pstart", F.last("_smax", True).over(wb.rangeBetween(Window.unboundedPreceding, -1))) \
                       .select(*by, "_bk", "_pstart")
    in_bucket = F.last(F.when(F.col("is_block_start") == 1, F.col(ts)), True) \
                 .over(w.rowsBetween(Window.unboundedPreceding, 0))
    d = d.join(prev_start, [*by, "_bk"], "left") \
         .withColumn("block_start", F.coalesce(in_bucket, F.col("_pstart")))
    return d.drop("_bk", "_pmax", "_prev", "_pstart")


def block_sizes(blocks: DataFrame, by: Sequence[str] = BY, window: int = WINDOW) -> DataFrame:
    """Rows per block and whether it is long enough (> window) for a sequence."""
    return (blocks.groupBy(*by, "block_start").agg(F.count(F.lit(1)).alias("n_rows"))
                  .withColumn("usable", (F.col("n_rows") > window).cast("int")))


def _in_block_frame(blocks: DataFrame, ts: str, by: Sequence[str], lookback_rows: int,
                    max_gap_seconds: int, bucket_seconds: int):
    """(frame with halo, window spec over one bucket of one block)."""
    halo = lookback_rows * max_gap_seconds
    framed = _with_halo(blocks, ts, halo, max(bucket_seconds, halo))
    w = Window.partitionBy(*by, "block_start", "_bk").orderBy(ts)
    return framed, w


def _keep_own(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_halo") == 0).drop("_halo", "_bk")


def lag_features(blocks: DataFrame, value: str = "traffic_volume", lags: Sequence[int] = (1, WINDOW),
                 rolls: Sequence[int] = (6, WINDOW), ts: str = TS, by: Sequence[str] = BY,
                 max_gap_seconds: int = HOUR, bucket_seconds: int = 7 * DAY) -> DataFrame:
    """``lag_k`` and ``roll_mean_k`` (mean of the previous k rows, current row
    excluded, NULL until k rows exist) inside each block."""
    k = max([*lags, *rolls])
    framed, w = _in_block_frame(blocks, ts, by, k, max_gap_seconds, bucket_seconds)
    cols = {f"lag_{n}": F.lag(F.col(value), n).over(w) for n in lags}
    for n in rolls:
        fr = w.rowsBetween(-n, -1)
        cols[f"roll_mean_{n}"] = F.when(F.count(F.col(value)).over(fr) == n, F.avg(F.col(value)).over(fr))
    return _keep_own(framed.withColumns(cols))


def in_block_features(blocks: DataFrame, value: str = "traffic_volume", lags: Sequence[int] = (1, WINDOW),
                      rolls: Sequence[int] = (6, WINDOW), asof: Sequence[str] = (), history: int | None = WINDOW,
                      ts: str = TS, by: Sequence[str] = BY, max_gap_seconds: int = HOUR,
                      bucket_seconds: int = 7 * DAY, prefix: str = "asof_") -> DataFrame:
    """Lags, rolling means, as-of values and the full-history filter in ONE
    windowed pass (one shuffle) instead of one pass per family plus joins."""
    k = max([*lags, *rolls, 1, history or 0])
    framed, w = _in_block_frame(blocks, ts, by, k, max_gap_seconds, bucket_seconds)
    cols = {f"lag_{n}": F.lag(F.col(value), n).over(w) for n in lags}
    for n in rolls:
        fr = w.rowsBetween(-n, -1)
        cols[f"roll_mean_{n}"] = F.when(F.count(F.col(value)).over(fr) == n, F.avg(F.col(value)).over(fr))
    cols.update({f"{prefix}{c}": F.lag(F.col(c), 1).over(w) for c in asof})
    if history:
        cols["_n"] = F.count(F.lit(1)).over(w.rowsBetween(-history, -1))
    out = framed.withColumns(cols)
    if history:
        out = out.filter(F.col("_n") == history).drop("_n")
    return _keep_own(out)


def asof_features(blocks: DataFrame, cols: Sequence[str], ts: str = TS, by: Sequence[str] = BY,
                  max_gap_seconds: int = HOUR, bucket_seconds: int = 7 * DAY,
                  prefix: str = "asof_") -> DataFrame:
    """Calendar/weather values of the last *observed* row before each target
    (the previous row of the block), so a forecast never sees the target hour."""
    framed, w = _in_block_frame(blocks, ts, by, 1, max_gap_seconds, bucket_seconds)
    return _keep_own(framed.withColumns({f"{prefix}{c}": F.lag(F.col(c), 1).over(w) for c in cols}))


def sequence_windows(blocks: DataFrame, features: Sequence[str], window: int = WINDOW, ts: str = TS,
                     by: Sequence[str] = BY, max_gap_seconds: int = HOUR,
                     bucket_seconds: int = 7 * DAY) -> DataFrame:
    """For every row with ``window`` preceding rows in its block: ``window`` =
    ARRAY<STRUCT<features as FLOAT>> of those rows, oldest first. Rows without
    a full window are dropped."""
    framed, w = _in_block_frame(blocks, ts, by, window, max_gap_seconds, bucket_seconds)
    step = F.struct(*[F.col(c).cast("float").alias(c) for c in features])
    seq = F.collect_list(step).over(w.rowsBetween(-window, -1))
    n = F.count(F.lit(1)).over(w.rowsBetween(-window, -1))
    out = framed.withColumns({"_n": n, "window": seq}) \
                .filter((F.col("_halo") == 0) & (F.col("_n") == window))
    return out.drop("_n", "_halo", "_bk")


def full_history(blocks: DataFrame, window: int = WINDOW, ts: str = TS, by: Sequence[str] = BY,
                 max_gap_seconds: int = HOUR, bucket_seconds: int = 7 * DAY) -> DataFrame:
    """Rows with ``window`` preceding rows in their block (the forecast targets)."""
    framed, w = _in_block_frame(blocks, ts, by, window, max_gap_seconds, bucket_seconds)
    n = F.count(F.lit(1)).over(w.rowsBetween(-window, -1))
    return _keep_own(framed.withColumn("_n", n).filter(F.col("_n") == window).drop("_n"))


def rank_by_time(df: DataFrame, ts: str = TS, tie: Sequence[str] = BY) -> DataFrame:
    """Exact 0-based global rank by (ts, tie) without a one-task sort: counts per
    timestamp (a hash aggregate), their running sum in time order with the
    bucketed prefix sum (no single-partition window even when timestamps are
    as many as rows) and a rank among the rows sharing one timestamp (at most
    one per sensor after dedupe). Adds ``_rank`` and ``_n``."""
    from .prefix import ordered_cumsum
    counts = df.groupBy(ts).agg(F.count(F.lit(1)).alias("_c")).withColumn("_tk", _micros(ts))
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    offsets = ordered_cumsum(counts, "_tk", ["_c"]) \
        .select(ts, (F.col("cum__c") - F.col("_c")).alias("_off")).crossJoin(F.broadcast(total))
    within = F.row_number().over(Window.partitionBy(ts).orderBy(*tie)) - 1
    return df.join(offsets, ts).withColumn("_rank", F.col("_off") + within).drop("_off")


def chronological_split(df: DataFrame, test_size: float = 0.2, ts: str = TS, tie: Sequence[str] = BY) -> DataFrame:
    """First ⌊n·(1−test_size)⌋ rows by time → 'train', the rest → 'test'."""
    r = rank_by_time(df, ts, tie)
    cut = F.floor(F.col("_n") * F.lit(1 - test_size))
    return r.withColumn("split", F.when(F.col("_rank") < cut, "train").otherwise("test")).drop("_rank", "_n")


def split_spans(split: DataFrame, ts: str = TS) -> DataFrame:
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("start"),
                                      F.max(ts).alias("end"))


def three_way_split(df: DataFrame, train_frac: float = 0.7, val_frac: float = 0.1, ts: str = TS,
                    tie: Sequence[str] = BY) -> DataFrame:
    """int(n·train) / int(n·val) / rest by target time; adds ``split`` and the
    0-based ``test_pos`` inside the test part."""
    r = rank_by_time(df, ts, tie)
    n_tr = F.floor(F.col("_n") * F.lit(train_frac))
    n_va = F.floor(F.col("_n") * F.lit(val_frac))
    split = F.when(F.col("_rank") < n_tr, "train").when(F.col("_rank") < n_tr + n_va, "val").otherwise("test")
    return (r.withColumn("split", split)
             .withColumn("test_pos", F.when(F.col("split") == "test", F.col("_rank") - n_tr - n_va))
             .withColumn("n_test", F.col("_n") - n_tr - n_va)
             .drop("_rank", "_n"))


def train_only_scaling(blocks_split: DataFrame, value: str = "traffic_volume", window: int = WINDOW,
                       ts: str = TS, by: Sequence[str] = BY, max_gap_seconds: int = HOUR,
                       bucket_seconds: int = 7 * DAY) -> DataFrame:
    """Mean / sample std of ``value`` over the distinct rows that are a train
    target or inside a train target's window: a row is covered when a train
    target sits 0..window rows after it in the same block (a look-ahead, so the
    halo is placed on the following bucket's side by mirroring time)."""
    halo = window * max_gap_seconds
    b = max(bucket_seconds, halo)
    own = blocks_split.withColumn("_bk", _bucket(ts, b)).withColumn("_halo", F.lit(0))
    start = F.col("_bk") * F.lit(b * 1_000_000)
    copy = (own.filter(_micros(ts) < start + F.lit(halo * 1_000_000))
               .withColumn("_bk", F.col("_bk") - 1).withColumn("_halo", F.lit(1)))
    w = Window.partitionBy(*by, "block_start", "_bk").orderBy(ts).rowsBetween(0, window)
    is_train = F.coalesce((F.col("split") == "train").cast("int"), F.lit(0))
    covered = own.unionByName(copy).withColumn("_cov", F.max(is_train).over(w))
    kept = covered.filter((F.col("_halo") == 0) & (F.col("_cov") == 1))
    return kept.agg(F.avg(value).alias("scaler_mean"), F.stddev_samp(value).alias("scaler_std"),
                    F.count(F.lit(1)).alias("n_rows"))


def forecast_slice(test: DataFrame, hours: int = 24 * 14) -> DataFrame:
    """``hours`` test rows starting at position n_test // 3 (by target time)."""
    start = F.floor(F.col("n_test") / 3)
    return test.filter((F.col("test_pos") >= start) & (F.col("test_pos") < start + hours))
