import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from hourwise.operators import timeseries as TS

H = dt.timedelta(hours=1)
T0 = dt.datetime(2024, 1, 1)


def frame(spark, times, sensor="a", values=None):
    values = values or list(range(len(times)))
    return spark.createDataFrame([(sensor, t, int(v)) for t, v in zip(times, values)],
                                 "sensor string, date_time timestamp_ntz, traffic_volume long")


def test_gaps_make_blocks(spark):
    times = [T0 + k * H for k in (0, 1, 2, 5, 6)] + [T0 + 5 * H + dt.timedelta(minutes=30)]
    b = TS.contiguous_blocks(frame(spark, times), bucket_seconds=2 * 3600).orderBy("date_time").collect()
    starts = [r["block_start"] for r in b]
    assert starts == [T0, T0, T0, T0 + 5 * H, T0 + 5 * H, T0 + 5 * H]
    assert sum(r["is_block_start"] for r in b) == 2
    sizes = sorted(r["n_rows"] for r in TS.block_sizes(TS.contiguous_blocks(frame(spark, times))).collect())
    assert sizes == [3, 3]


def test_short_block_windows(spark):
    for n, expected in ((24, 0), (25, 1)):
        times = [T0 + k * H for k in range(n)]
        b = TS.contiguous_blocks(frame(spark, times))
        assert TS.sequence_windows(b, ["traffic_volume"]).count() == expected
        assert TS.full_history(b).count() == expected


def test_roll_head_null_until_full(spark):
    times = [T0 + k * H for k in range(7)]
    b = TS.contiguous_blocks(frame(spark, times, values=[10, 20, 30, 40, 50, 60, 70]))
    out = TS.lag_features(b, lags=(1,), rolls=(6,)).orderBy("date_time").collect()
    assert [r["roll_mean_6"] for r in out[:6]] == [None] * 6
    assert out[6]["roll_mean_6"] == 35.0
    assert out[0]["lag_1"] is None and out[1]["lag_1"] == 10


def test_bucketed_windows_equal_pandas(spark):
    """Small buckets force many bucket boundaries; results must equal a plain
    per-sensor pandas computation."""
    rnd = random.Random(7)
    rows = []
    for s in ("a", "b"):
        t = T0
        for _ in range(300):
            t = t + H * (1 if rnd.random() > 0.08 else rnd.choice([2, 3, 30]))
            rows.append((s, t, rnd.randint(0, 1000)))
    df = spark.createDataFrame(rows, "sensor string, date_time timestamp_ntz, traffic_volume long")
    b = TS.contiguous_blocks(df, bucket_seconds=5 * 3600)
    got = TS.lag_features(b, bucket_seconds=5 * 3600).toPandas().sort_values(["sensor", "date_time"])
    pdf = pd.DataFrame(rows, columns=["sensor", "date_time", "traffic_volume"]).sort_values(["sensor", "date_time"])
    pdf["gap"] = pdf.groupby("sensor")["date_time"].diff().dt.total_seconds().div(3600)
    pdf["block"] = (pdf["gap"].fillna(99) > 1).groupby(pdf["sensor"]).cumsum()
    g = pdf.groupby(["sensor", "block"])["traffic_volume"]
    pdf["lag_24"] = g.shift(24)
    pdf["roll_mean_6"] = g.transform(lambda s: s.shift(1).rolling(6).mean())
    m = got.merge(pdf, on=["sensor", "date_time"], suffixes=("", "_pd"))
    assert len(m) == len(pdf)
    assert ((m["lag_24"].isna() & m["lag_24_pd"].isna()) | (m["lag_24"] == m["lag_24_pd"])).all()
    assert ((m["roll_mean_6"].isna() & m["roll_mean_6_pd"].isna())
            | ((m["roll_mean_6"] - m["roll_mean_6_pd"]).abs() < 1e-9)).all()


def test_splits_add_up(spark):
    times = [T0 + k * H for k in range(103)]
    df = frame(spark, times, "a").unionByName(frame(spark, times, "b"))
    s = TS.three_way_split(df).groupBy("split").count().collect()
    counts = {r["split"]: r["count"] for r in s}
    assert counts == {"train": int(206 * 0.7), "val": int(206 * 0.1), "test": 206 - int(206 * 0.7) - int(206 * 0.1)}
    c = TS.chronological_split(df, 0.2)
    last_train = c.filter(F.col("split") == "train").agg(F.max("date_time")).collect()[0][0]
    first_test = c.filter(F.col("split") == "test").agg(F.min("date_time")).collect()[0][0]
    assert last_train <= first_test
