import datetime as dt
import random

from pyspark.sql import functions as F

from hourwise.operators import analytics as A
from hourwise.operators import timeseries as TS

T0 = dt.datetime(2024, 1, 1)


def test_asof_join_matches_brute_force_across_buckets(spark):
    rnd = random.Random(11)
    readings, probes = [], []
    for s in ("a", "b", "c"):
        t = T0
        for _ in range(60):
            t += dt.timedelta(minutes=rnd.choice([30, 60, 60, 600, 3000]))   # long gaps leave buckets empty
            readings.append((s, t))
    for i in range(400):
        s = rnd.choice(["a", "b", "c", "d"])                                  # 'd' has no readings
        probes.append((i, s, T0 + dt.timedelta(seconds=rnd.randint(-3600, 3600 * 24 * 40))))
    r = spark.createDataFrame(readings, "sensor string, date_time timestamp_ntz")
    p = spark.createDataFrame(probes, "probe_id long, sensor string, probe_time timestamp_ntz")
    got = {row["probe_id"]: row["match_time"] for row in
           A.asof_join(p, r, bucket_seconds=6 * 3600).collect()}
    salted = {row["probe_id"]: row["match_time"] for row in
              A.asof_join(p, r, bucket_seconds=6 * 3600).collect()}
    assert salted == got and len(got) == len(probes)
    by_sensor = {}
    for s, t in readings:
        by_sensor.setdefault(s, []).append(t)
    for pid, s, t in probes:
        cands = by_sensor.get(s, [])
        if not cands:
            assert got[pid] is None
            continue
        best = min(cands, key=lambda c: (abs((c - t).total_seconds()), c))   # earlier wins a tie
        assert got[pid] == best, (pid, s, t)


def test_rank_by_time_with_tied_timestamps(spark):
    rnd = random.Random(5)
    rows = [(s, T0 + dt.timedelta(hours=rnd.randint(0, 50))) for s in "abcdefg" for _ in range(10)]
    rows = list({(s, t) for s, t in rows})
    df = spark.createDataFrame(rows, "sensor string, date_time timestamp_ntz")
    got = {(r["sensor"], r["date_time"]): r["_rank"] for r in TS.rank_by_time(df).collect()}
    expected = {k: i for i, k in enumerate(sorted(rows, key=lambda x: (x[1], x[0])))}
    assert got == expected


def test_stream_blocks_equal_batch_blocks(spark, tmp_path):
    """Session windows over a file stream emit the batch blocks whose end the
    watermark has passed."""
    from hourwise.operators.timeseries import block_sizes, contiguous_blocks
    from hourwise.streaming import streams as ST
    hours = [0, 1, 2, 5, 6, 7, 8, 20, 21, 40]
    rows = [("a", T0 + dt.timedelta(hours=h), 1) for h in hours]
    import pandas as pd
    src = tmp_path / "src"
    src.mkdir()
    pd.DataFrame(rows, columns=["sensor", "date_time", "traffic_volume"]).to_parquet(
        src / "readings.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)
    stream = ST.file_stream(spark, str(src), "readings")
    out = spark.read.parquet(ST.run_available(ST.blocks(stream), "test-blocks"))
    got = sorted((r["block_start"], r["n_readings"]) for r in out.collect())
    batch = block_sizes(contiguous_blocks(spark.createDataFrame(rows, "sensor string, date_time timestamp_ntz, "
                                                                      "traffic_volume long")))
    last = max(T0 + dt.timedelta(hours=h) for h in hours)
    expected = sorted((r["block_start"], r["n_rows"]) for r in batch.collect())
    # the open session (ending after the watermark, max time − 2 h) is still in state
    expected = [e for e in expected if e[0] < last - dt.timedelta(hours=3)]
    assert got == expected


def test_probe_without_a_time_stays_unmatched(spark):
    probes = spark.createDataFrame([(1, "s", None), (2, "s", "2020-01-01 05:10:00")], "probe_id long, sensor string, t string") \
                  .select("probe_id", "sensor", F.col("t").cast("timestamp_ntz").alias("probe_time"))
    read = spark.createDataFrame([("s", "2020-01-01 05:00:00")], "sensor string, t string") \
                .select("sensor", F.col("t").cast("timestamp_ntz").alias("date_time"))
    got = {r.probe_id: r.gap_seconds for r in A.asof_join(probes, read).collect()}
    assert got == {1: None, 2: 600.0}


def test_asof_join_no_frame_runs_to_the_end(spark):
    """Such a frame is read anew for each row: quadratic in a bucket's probes."""
    probes = spark.createDataFrame([(1, "s", T0)], "probe_id long, sensor string, probe_time timestamp_ntz")
    read = spark.createDataFrame([("s", T0)], "sensor string, date_time timestamp_ntz")
    plan = A.asof_join(probes, read)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan


def test_asof_join_next_bucket_and_ties(spark):
    at = lambda hours: T0 + dt.timedelta(hours=hours)
    read = spark.createDataFrame([("s", at(1)), ("s", at(3)), ("s", at(80)), ("s", at(81)), ("s", at(200))],
                                 "sensor string, date_time timestamp_ntz")
    probes = spark.createDataFrame([(1, "s", at(0)), (2, "s", at(2)), (3, "s", at(3)), (4, "s", at(70)), (5, "s", at(70)),
                                    (6, "s", at(150)), (7, "s", at(300)), (8, "t", at(1))],
                                   "probe_id long, sensor string, probe_time timestamp_ntz")
    got = {r.probe_id: r.match_time for r in A.asof_join(probes, read).collect()}
    assert got == {1: at(1), 2: at(1), 3: at(3), 4: at(80), 5: at(80), 6: at(200), 7: at(200), 8: None}
