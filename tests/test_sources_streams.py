"""CSV binding by header, stream sources over many files, late rows, the checkpoint folder."""
import pytest
from pyspark.sql import functions as F

from hourwise import session
from hourwise.sources import io
from hourwise.sources.schema import RAW_READING_SCHEMA, SchemaValidationError
from hourwise.streaming import streams as ST

ROW = {"holiday": "None", "temp": "280.5", "rain_1h": "0", "snow_1h": "0", "clouds_all": "40", "weather_main": "Clear",
       "weather_description": "sky", "date_time": "2012-10-02 09:00:00", "traffic_volume": "5545"}


def csv(tmp_path, names, *rows):
    path = tmp_path / "in.csv"
    path.write_text("\n".join([",".join(names)] + [",".join(r.get(n, "x") for n in names) for r in rows]) + "\n")
    return str(path)


def test_columns_bind_by_header(spark, tmp_path):
    names = ["temp", "holiday", *[n for n in ROW if n not in ("temp", "holiday")]]
    got = io.read_raw_csv(spark, csv(tmp_path, names, ROW)).collect()[0]
    assert (got.holiday, got.temp, got.traffic_volume, got[io.CORRUPT_COL]) == ("None", 280.5, 5545, None)


def test_missing_extra_and_bad_values(spark, tmp_path):
    with pytest.raises(SchemaValidationError, match="holiday"):
        io.read_raw_csv(spark, csv(tmp_path, [n for n in ROW if n != "holiday"], ROW))
    got = io.read_raw_csv(spark, csv(tmp_path, ["more", *ROW], {**ROW, "more": "7"}, {**ROW, "temp": "warm"}))
    assert got.columns == [*RAW_READING_SCHEMA.fieldNames(), "more", io.CORRUPT_COL]
    rows = got.collect()
    assert rows[0].more == "7" and rows[1].temp is None and "warm" in rows[1][io.CORRUPT_COL]
    with pytest.raises(SchemaValidationError, match="no such file"):
        io.read_raw_csv(spark, str(tmp_path / "none.csv"))
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(SchemaValidationError, match="empty"):
        io.read_raw_csv(spark, str(tmp_path / "empty.csv"))


def readings(spark, hours):
    return spark.createDataFrame([(h,) for h in hours], "h int").select(
        F.lit("s").alias("sensor"), F.timestamp_add("HOUR", F.col("h"), F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")).alias("date_time"),
        (F.col("h") * 10).alias("traffic_volume"))


@pytest.fixture
def root(spark, tmp_path, monkeypatch):
    """A shared folder of the test's own."""
    monkeypatch.setattr(ST, "shared_root", lambda _: str(tmp_path / "shared"))
    return tmp_path


def append(spark, folder, hours):
    readings(spark, hours).coalesce(1).write.mode("append").parquet(str(folder / "t.parquet"))


def test_a_named_sink_resumes(spark, root):
    """Run, add a file, run again: only the new rows are read, and the sink has what one run over all rows gives."""
    append(spark, root, range(40))

    def stream():
        return ST.hourly_agg(ST.file_stream(spark, str(root), "t"))
    first = ST.resume(stream(), "agg")
    assert (first.rows, first.late) == (40, 0)
    again = ST.resume(stream(), "agg")
    assert (again.rows, again.path) == (0, first.path)
    append(spark, root, range(40, 60))
    second = ST.resume(stream(), "agg")
    assert (second.rows, second.late) == (20, 0)
    whole = ST.resume(stream(), "agg-whole")
    got, want = (sorted(spark.read.parquet(r.path).collect()) for r in (second, whole))
    assert got == want and len(got) == 57
    # in a new session over the same folder too
    other = spark.newSession()
    append(spark, root, range(60, 70))
    assert ST.resume(ST.hourly_agg(ST.file_stream(other, str(root), "t")), "agg").rows == 10


def test_state_goes_on_in_the_next_run(spark, root):
    """A duplicate that arrives in a later run, and a block that goes on in it."""
    append(spark, root, [0, 1, 2])
    raw = "holiday weather_main weather_description".split()

    def dedupe():
        df = ST.file_stream(spark, str(root), "t")
        return ST.dedupe_hourly(df.withColumns({c: F.lit("x") for c in raw}))

    def blocks():
        return ST.blocks(ST.file_stream(spark, str(root), "t"))
    ST.resume(dedupe(), "dedupe")
    assert spark.read.parquet(ST.resume(blocks(), "blocks").path).count() == 0
    append(spark, root, [2, 3, 20])
    sink = spark.read.parquet(ST.resume(dedupe(), "dedupe").path)
    assert sorted(r.date_time.hour for r in sink.collect()) == [0, 1, 2, 3, 20]
    assert [r.n_readings for r in spark.read.parquet(ST.resume(blocks(), "blocks").path).collect()] == [5]


def test_another_query_under_a_name_raises(spark, root):
    append(spark, root, range(5))
    df = ST.file_stream(spark, str(root), "t")
    ST.resume(ST.rolling_mean(df), "mean")
    ST.resume(ST.rolling_mean(ST.file_stream(spark, str(root), "t")), "mean")
    with pytest.raises(ST.SinkMismatchError):
        ST.resume(ST.rolling_mean(df, length="3 hours"), "mean")
    with pytest.raises(ST.SinkMismatchError):
        ST.resume(ST.hourly_agg(df), "mean")


def test_a_batch_that_is_run_again_replaces_its_rows(spark, root):
    """A run that fails after the rows of a batch were written repeats that batch under its number."""
    append(spark, root, range(5))
    out, fail = str(root / "out"), [True]

    def write(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
        if fail.pop():
            raise RuntimeError("lost")
    with pytest.raises(Exception, match="lost"):
        ST.resume(ST.file_stream(spark, str(root), "t"), "each", foreach_batch=write)
    fail.append(False)
    assert ST.resume(ST.file_stream(spark, str(root), "t"), "each", foreach_batch=write).batches == 1
    assert sorted((r.traffic_volume, r.epoch) for r in spark.read.parquet(out).collect()) == [(h * 10, 0) for h in range(5)]


@pytest.mark.parametrize("files", [1, 4])
def test_stream_reads_every_file(spark, root, tmp_path, files):
    df = readings(spark, range(40))
    target = tmp_path / "t.parquet"
    if files == 1:
        df.coalesce(1).write.parquet(str(tmp_path / "w"))
        next((tmp_path / "w").glob("part-*.parquet")).rename(target)
    else:
        df.repartition(files).write.parquet(str(target))
    out = spark.read.parquet(ST.run_available(ST.hourly_agg(ST.file_stream(spark, str(tmp_path), "t")), f"files{files}"))
    # every window that the watermark (2 hours behind hour 39) has passed
    assert {r.avg_volume for r in out.collect()} == {h * 10.0 for h in range(37)}


def test_late_rows_raise(spark, root):
    append(spark, root, range(30, 40))

    def stream():
        return ST.hourly_agg(ST.file_stream(spark, str(root), "t"))
    assert ST.resume(stream(), "late").late == 0
    append(spark, root, range(3))
    with pytest.raises(ST.LateRowsError, match="3 rows"):
        ST.resume(stream(), "late")
    append(spark, root, range(4))
    assert ST.resume(stream(), "late", allow_late=True).late == 4


def test_late_rows_of_many_batches_are_summed(spark, root):
    """More batches than a query remembers reports of."""
    append(spark, root, [100])
    for _ in range(12):
        append(spark, root, [1])
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        path = str(root / "t.parque") + "[t]"
        df = spark.readStream.schema(spark.read.parquet(str(root / "t.parquet")).schema).option("maxFilesPerTrigger", 1).parquet(path)
        run = ST.resume(ST.hourly_agg(df), "many", allow_late=True)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert run.rows == 13 and run.batches >= 13 and run.late >= 11


def test_a_cluster_without_a_checkpoint_folder_raises(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "x"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
