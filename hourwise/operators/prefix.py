"""Exact cumulative sums in value order without a single-partition window.

ROC curves, AUC and the two-sample KS statistic all need running totals over
the sorted distinct values of a column — at scale the number of distinct
scores grows with the data, so ``Window.orderBy(score)`` (one task) is not an
option. Here the rows are range-partitioned by key and written once with the
number of their range (so the input is evaluated once, and the number of ranges follows the data, not a
constant); totals per range give the offsets, and the running sum inside one
range is an ordinary window partitioned by it.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import materialize


def ordered_cumsum(df: DataFrame, key: str, values: Sequence[str], by: Sequence[str] = (),
                   descending: bool = False, prefix: str = "cum_") -> DataFrame:
    """``df`` has one row per (by, key). Adds ``cum_<v>`` = Σ v over rows with a
    key ≤ this key (≥ when ``descending``) within the same ``by`` group."""
    by = list(by)
    d = materialize(df.repartitionByRange(F.col(key)).withColumn("_b", F.spark_partition_id()), "ranges")
    order_b = F.col("_b").desc() if descending else F.col("_b").asc()
    order_k = F.col(key).desc() if descending else F.col(key).asc()
    tot = d.groupBy(*by, "_b").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    wb = Window.partitionBy(*by).orderBy(order_b).rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*by, "_b", *[F.coalesce(F.sum(f"_t_{v}").over(wb), F.lit(0)).alias(f"_o_{v}") for v in values])
    wk = Window.partitionBy(*by, "_b").orderBy(order_k).rowsBetween(Window.unboundedPreceding, 0)
    out = d.join(off, [*by, "_b"], "left")
    out = out.select(*df.columns, *[(F.sum(v).over(wk) + F.col(f"_o_{v}")).alias(f"{prefix}{v}") for v in values])
    return out


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], names: Sequence[str],
                    by: Sequence[str] = ()) -> DataFrame:
    """One row per ``by`` group: exact quantiles (linear interpolation between the two neighbouring
    ranks, as ``percentile``) of the non-null values. The distinct values are counted
    and cut into ranges, so no task holds the values of a whole group. Without any value: no row (``by``
    given) or one row of nulls."""
    by = list(by)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    return quantiles_of_counts(counts, probs, names, by)


def quantiles_of_counts(counts: DataFrame, probs: Sequence[float], names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``exact_quantiles`` of values ``_v`` that occur ``_n`` times."""
    by = list(by)
    cum = ordered_cumsum(counts, "_v", ["_n"], by)
    totals = cum.groupBy(*by).agg(F.sum("_n").alias("_total"))
    cum = cum.join(totals, by) if by else cum.crossJoin(F.broadcast(totals))                   # one row
    aggs = []
    for k, p in enumerate(probs):
        rank = (F.col("_total") - 1) * F.lit(float(p))
        for end, r in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            # the value at a rank is the least one whose running count exceeds it
            aggs.append(F.min(F.when(F.col("cum__n") > r, F.col("_v"))).cast("double").alias(f"_{end}{k}"))
        aggs.append(F.max(rank - F.floor(rank)).alias(f"_w{k}"))
    got = cum.groupBy(*by).agg(*aggs)
    return got.select(*by, *[(F.col(f"_lo{k}") + (F.col(f"_hi{k}") - F.col(f"_lo{k}")) * F.col(f"_w{k}")).alias(name)
                             for k, name in enumerate(names)])
