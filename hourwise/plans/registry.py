"""Query registry: every named query is a (spark, sf_dir) -> DataFrame callable,
optionally paired with independent DuckDB SQL computing the same result."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
SIGNIFICANT_BITS = 24
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def rounded(df: DataFrame) -> DataFrame:
    """Round every floating column to ``SIGNIFICANT_BITS`` binary digits (about seven decimal ones), however small or large the value:
    floor(x·p + 0.5) / p with p the power of two that gives x so many bits; the same IEEE operations in Spark and in the SQL
    oracle (``rnd``). Unlike decimal ROUND (whose tie rules differ between the
    engines), values computed from decimal data almost never sit on a binary
    half-grid point, so sums taken in a different order round to the same double."""
    exprs = []
    for f in df.schema.fields:
        name = f.name.replace("`", "``")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            x = F.col(f"`{name}`").cast("double")
            p = F.pow(F.lit(2.0), F.lit(float(SIGNIFICANT_BITS - 1)) - F.floor(F.log2(F.abs(x))))
            plain = (x == 0) | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
            exprs.append(F.when(plain, x).otherwise(F.floor(x * p + F.lit(0.5)) / p).alias(f.name))
        else:
            exprs.append(F.col(f"`{name}`"))
    return df.select(*exprs)


def rnd(sql: str, cols: str) -> str:
    """Wrap SQL so the named DOUBLE columns are rounded like ``rounded``."""
    def one(c: str) -> str:
        x = f'CAST("{c}" AS DOUBLE)'
        p = f"pow(CAST(2 AS DOUBLE), {SIGNIFICANT_BITS - 1} - floor(ln(abs({x})) / ln(CAST(2 AS DOUBLE))))"
        return f"CASE WHEN {x} = 0 OR isnan({x}) OR isinf({x}) THEN {x} ELSE floor({x} * {p} + 0.5) / {p} END AS \"{c}\""
    rep = ", ".join(one(c) for c in cols.split())
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) _q"
