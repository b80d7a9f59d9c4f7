"""Helpers shared by the training-data operators.

Intermediate tables go to the folder the cluster names in
``spark.checkpoint.dir``; a scratch folder of this process's own is used only
on a ``local`` master with that setting unset (tests).
"""
from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables. Raises on a cluster that names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="hourwise-llm-")
    return _LOCAL[app]


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into a fresh folder under the shared one and read
    it back: lineage is cut and a lost executor rereads files."""
    path = f"{shared_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_state(key: str, make: Callable[[], Any]) -> Any:
    """An object that a Python worker keeps from task to task, such as a bounded cache; made on first use."""
    state = sys.modules.setdefault("_hourwise_worker_state", types.ModuleType("_hourwise_worker_state"))
    if not hasattr(state, key):
        setattr(state, key, make())
    return getattr(state, key)


def small(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows, so that a task never holds a whole batch as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def slices(values: pa.Array, rows: int = 500) -> Iterator[pa.Array]:
    """A column in slices of a few rows, one at least."""
    for at in range(0, max(len(values), 1), rows):
        yield values.slice(at, rows)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(name: str = "text"):
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def unused(docs: DataFrame, name: str) -> str:
    """``name``, longer by underscores as long as ``docs`` has a column of that name."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def sized(df: DataFrame, most: int = 1_000_000) -> DataFrame:
    """``df``, marked for broadcast if it has at most ``most`` rows (call it on narrow, materialized tables);
    beyond that size the join shuffles."""
    return F.broadcast(df) if df.count() <= most else df


def semi_by_id(df: DataFrame, ids: DataFrame, on: str, most: int = 1_000_000) -> DataFrame:
    """Rows of ``df`` whose ``on`` is in ``ids`` (distinct, materialized; null matches null). Few ids are
    broadcast, so that ``df`` is not shuffled."""
    own = unused(df, "__id")
    key = sized(ids.select(F.col(on).alias(own)), most)
    return df.join(key, F.col(on).eqNullSafe(F.col(own)), "left_semi")
