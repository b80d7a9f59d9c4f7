"""Structured Streaming forms of the batch operators.

Each stream reuses the batch column expressions and writes to a named sink: a
Parquet folder with its checkpoint and the identity of its query, in a stable place of
the cluster's shared folder. The next run of that name resumes where the last one stopped, in another
session too; another query under the same name raises. Event-time state is bounded
by watermarks: windows / sessions / duplicate keys are emitted (append mode)
and dropped from state once the watermark passes them.
"""
from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.clean import standardize_categoricals
from ..session import shared_root
from ..sources.schema import reading_contract

EVENT_TIME = "_et"


class LateRowsError(RuntimeError):
    pass


class SinkMismatchError(RuntimeError):
    pass


def file_stream(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Stream the Parquet files of one table (a folder of part files, or one
    file), with the schema taken from the batch read; new part files are picked
    up as they land. A trigger takes every file that is there, so files out of time order do not
    push the watermark past rows still unread."""
    path = f"{folder.rstrip('/')}/{table}.parquet"
    schema = spark.read.parquet(path).schema
    # as a pattern, the path may be a folder of part files as well as one file
    return spark.readStream.schema(schema).parquet(path[:-1] + "[t]")


def with_event_time(df: DataFrame, ts: str = "date_time", delay: str = "2 hours") -> DataFrame:
    """Event-time column for the watermark (the readings keep zone-free times)."""
    return df.withColumn(EVENT_TIME, F.col(ts).cast("timestamp")).withWatermark(EVENT_TIME, delay)


def dedupe_hourly(readings: DataFrame, delay: str = "2 hours") -> DataFrame:
    """One reading per (sensor, hour); the first arrival wins (which duplicate is
    first is arrival order, not row id as in batch)."""
    return (with_event_time(standardize_categoricals(readings), delay=delay)
            .dropDuplicatesWithinWatermark(["sensor", "date_time"]).drop(EVENT_TIME))


def hourly_agg(readings: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Tumbling 1-hour windows per sensor: readings and mean volume."""
    return (with_event_time(readings, delay=delay)
            .groupBy("sensor", F.window(EVENT_TIME, "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("n_readings"), F.avg("traffic_volume").alias("avg_volume"))
            .select("sensor", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "n_readings", "avg_volume"))


def rolling_mean(readings: DataFrame, length: str = "6 hours", slide: str = "1 hour",
                 delay: str = "2 hours") -> DataFrame:
    """Sliding windows: equal to the batch row frame only when no hour is missing."""
    return (with_event_time(readings, delay=delay)
            .groupBy("sensor", F.window(EVENT_TIME, length, slide).alias("w"))
            .agg(F.count(F.lit(1)).alias("n_readings"), F.avg("traffic_volume").alias("avg_volume"))
            .select("sensor", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "n_readings", "avg_volume"))


def blocks(readings: DataFrame, gap: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Contiguous blocks as session windows per sensor (readings exactly one gap
    apart stay in one session, as in the batch rule)."""
    return (with_event_time(readings, delay=delay)
            .groupBy("sensor", F.session_window(EVENT_TIME, gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("n_readings"))
            .select("sensor", F.col("s.start").cast("timestamp_ntz").alias("block_start"),
                    F.col("s.end").cast("timestamp_ntz").alias("block_end"), "n_readings"))


def validate(readings: DataFrame) -> DataFrame:
    """Stateless contract check: every row with ``valid`` / ``reject_reason``."""
    return reading_contract(readings)


@dataclass
class Run:
    """What one run of a stream did: the sink's folder, batches, rows read, rows dropped behind the watermark."""
    path: str
    batches: int = 0
    rows: int = 0
    late: int = 0


class _Progress(StreamingQueryListener):
    """Sums every progress report of one query (a query itself remembers the last hundred only)."""

    def __init__(self, run: Run):
        self.run, self.query, self.waiting, self.ended = run, None, [], set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.waiting.append(event.progress)

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def finish(self, run_id: str, wait: float = 60.0) -> None:
        """Wait until the query's last report is here, then add its reports up."""
        until = time.monotonic() + wait
        while run_id not in self.ended:
            if time.monotonic() > until:
                raise TimeoutError("the stream's reports did not arrive")
            time.sleep(0.02)
        for p in self.waiting:
            if str(p.runId) == run_id:
                self.run.batches += 1
                self.run.rows += p.numInputRows
                self.run.late += sum(op.numRowsDroppedByWatermark for op in p.stateOperators)


def sink_path(spark: SparkSession, name: str) -> str:
    """The stable folder of a named sink."""
    return f"{shared_root(spark)}/streams/{name}"


def identity(df: DataFrame, mode: str) -> str:
    """A digest of the query: its columns, output mode and plan, without what differs from run to run (expression ids, generated folder names)."""
    plan = df._jdf.queryExecution().analyzed().toString()
    plan = re.sub(r"#\d+L?|@[0-9a-f]+|[0-9a-f]{8,}(-[0-9a-f]{4,})*|Lambda\S*|plan_id=\d+", "", plan)
    return hashlib.sha256(f"{mode}\n{df.schema.json()}\n{plan}".encode()).hexdigest()


def _claim(spark: SparkSession, base: str, name: str, own: str) -> None:
    """Write the query's identity beside a new sink; a sink of another query raises."""
    try:
        found = spark.read.schema("identity string").parquet(f"{base}/_identity").first()
    except AnalysisException:
        found = None
    if found is None:
        spark.range(1).select(F.lit(own).alias("identity")).write.mode("overwrite").parquet(f"{base}/_identity")
    elif found["identity"] != own:
        raise SinkMismatchError(f"the sink {name} belongs to another query")


def resume(df: DataFrame, name: str, mode: str = "append",
           foreach_batch: Callable[[DataFrame, int], None] | None = None, allow_late: bool = False) -> Run:
    """Run a stream over everything that is there and was not read by an earlier run of the sink ``name``, then stop. A Parquet
    sink commits each batch once; ``foreach_batch`` gets a number that is the same when a batch is run again, and must replace what it
    wrote under it. Rows dropped behind the watermark raise, unless ``allow_late`` (the batch that dropped them is committed)."""
    spark = df.sparkSession
    base = sink_path(spark, name)
    _claim(spark, base, name, identity(df, mode))
    run = Run(f"{base}/data")
    progress = _Progress(run)
    spark.streams.addListener(progress)
    try:
        w = df.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True)
        q = (w.foreachBatch(foreach_batch) if foreach_batch is not None else w.format("parquet").option("path", run.path)).start()
        q.awaitTermination()
        progress.finish(str(q.runId))
    finally:
        spark.streams.removeListener(progress)
    if run.late and not allow_late:
        raise LateRowsError(f"stream {name}: {run.late} rows came behind the watermark")
    return run


def run_available(df: DataFrame, name: str, mode: str = "append",
                  foreach_batch: Callable[[DataFrame, int], None] | None = None, allow_late: bool = False) -> str:
    """``resume``, for its folder."""
    return resume(df, name, mode, foreach_batch, allow_late).path
