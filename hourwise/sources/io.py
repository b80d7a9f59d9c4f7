"""Readers and writers. Outputs are directories (one file per task), never a
single file funnelled through one task or the driver."""
from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import ensure_checkpoint_dir
from .schema import RAW_READING_SCHEMA, SchemaValidationError, schema_gate

CORRUPT_COL = "_corrupt_record"


def _csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the first header line. A missing path, a path without data
    and a header that repeats a name are reported as such."""
    try:
        names = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    except AnalysisException as ex:
        if "PATH_NOT_FOUND" in str(ex):
            raise SchemaValidationError(f"{path}: no such file") from ex
        if "UNABLE_TO_INFER_SCHEMA" in str(ex):
            raise SchemaValidationError(f"{path}: empty file, no header") from ex
        raise
    if not names:
        raise SchemaValidationError(f"{path}: empty file, no header")
    return names


def read_raw_csv(spark: SparkSession, path: str, schema=RAW_READING_SCHEMA) -> DataFrame:
    """Raw readings CSV, bound by the names of its header, in any column order.
    A missing column raises, an extra one is kept as text; every file's header
    must be that of the first. Only the empty string is NULL; the literal text ``None`` stays text. A line that is malformed, or has a
    value that does not cast, keeps its text in ``_corrupt_record``."""
    names = _csv_header(spark, path)
    wanted = [f for f in schema.fields if f.name != CORRUPT_COL]
    text = StructType([StructField(n, StringType()) for n in [*names, CORRUPT_COL]])
    df = (spark.read.schema(text).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT_COL).csv(path))
    schema_gate(df.drop(CORRUPT_COL), [f.name for f in wanted])
    typed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in wanted}
    failed = F.lit(False)
    for f in wanted:
        failed = failed | (F.col(f"`{f.name}`").isNotNull() & typed[f.name].isNull())
    line = F.concat_ws(",", *[F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in names])
    extra = [F.col(f"`{n}`") for n in names if n not in typed]
    return df.select(*[c.alias(n) for n, c in typed.items()], *extra,
                     F.coalesce(F.col(CORRUPT_COL), F.when(failed, line)).alias(CORRUPT_COL))


def malformed_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT_COL).isNotNull())


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", ts_col: str | None = "date_time",
               require_rows: bool = False, schema: StructType | None = None) -> DataFrame:
    """Re-read a cleaned/feature table; a string ``ts_col`` is parsed (bad → NULL).
    CSV needs a ``schema`` (no scan to infer one). ``require_rows`` checks emptiness with a one-row probe, not a count."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV table is read with a schema")
        reader = reader.option("header", True).option("enforceSchema", False)
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    if ts_col and ts_col in df.columns and dict(df.dtypes)[ts_col] == "string":
        df = df.withColumn(ts_col, F.try_to_timestamp(F.col(ts_col)).cast("timestamp_ntz"))
    if require_rows and not df.limit(1).take(1):
        raise SchemaValidationError(f"{path} has no rows")
    return df


def read_pruned(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Only the named columns reach the scan (ReadSchema is pruned)."""
    return spark.read.parquet(path).select(*columns)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster-wide checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "table", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: cuts
    lineage (survives executor loss) and lets later queries reuse the result."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    write_table(df, path, partition_by=partition_by)
    return spark.read.parquet(path)
