"""Model-evaluation operators over scored tables (label/score/prediction or
actual/prediction columns), optionally per group (model, window, split).

All are conditional aggregates; ROC/AUC use the distributed ordered prefix
sum over *distinct* scores (ties share one point / are averaged).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import zero_div
from .prefix import ordered_cumsum


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction",
                     by: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label) == 1, F.col(pred) == 1
    return df.groupBy(*by).agg(F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"),
                               F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp"))


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "prediction",
                           score: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """accuracy, precision, recall, F1 (0 on a zero denominator) and, with a
    score column, ROC AUC (NULL when only one class is present)."""
    cm = confusion_matrix(df, label, pred, by)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    prec = zero_div(tp, tp + fp)
    rec = zero_div(tp, tp + fn)
    out = cm.select(*by, (tp + fp + fn + tn).alias("n"),
                    zero_div(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"),
                    zero_div(2 * tp, 2 * tp + fp + fn).alias("f1"))
    if score is not None:
        auc = roc_auc(df, label, score, by)
        out = out.join(auc, list(by), "left") if by else out.crossJoin(auc)
    return out


def _score_counts(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    return (df.filter(F.col(score).isNotNull())
              .groupBy(*by, F.col(score).alias("threshold"))
              .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """One ROC point per distinct score (predict positive when score ≥ threshold)."""
    counts = _score_counts(df, label, score, by)
    cum = ordered_cumsum(counts, "threshold", ["pos", "neg"], by, descending=True)
    totals = counts.groupBy(*by).agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    j = cum.join(totals, list(by)) if by else cum.crossJoin(F.broadcast(totals))
    return j.select(*by, "threshold", F.try_divide(F.col("cum_pos"), F.col("_P")).alias("tpr"),
                    F.try_divide(F.col("cum_neg"), F.col("_N")).alias("fpr"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve = P(score⁺ > score⁻) + ½·P(tie), from per-score
    counts: Σ pos(s)·(neg below s + ½·neg(s)) / (P·N)."""
    counts = _score_counts(df, label, score, by)
    cum = ordered_cumsum(counts, "threshold", ["neg"], by, descending=False)
    below = F.col("cum_neg") - F.col("neg")
    return cum.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))),
                     F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))


def regression_metrics(df: DataFrame, actual: str = "actual", pred: str = "prediction",
                       by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R² = 1 − SSE/SST (SST around the actual mean), in one pass."""
    e = F.col(actual) - F.col(pred)
    d = df.filter(F.col(actual).isNotNull() & F.col(pred).isNotNull())
    n = F.count(F.lit(1))
    sse = F.sum(e * e)
    sst = F.sum(F.col(actual) * F.col(actual)) - F.sum(F.col(actual)) * F.sum(F.col(actual)) / n
    return d.groupBy(*by).agg(n.alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
                              (F.lit(1.0) - F.try_divide(sse, sst)).alias("r2"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """sklearn 'balanced': n / (n_classes · n_c), as a small table to join."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    tot = counts.agg(F.sum("n").alias("_t"), F.count(F.lit(1)).alias("_k"))
    return counts.crossJoin(F.broadcast(tot)) \
                 .select("label", "n", (F.col("_t") / (F.col("_k") * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str = "label", weight_col: str = "weight") -> DataFrame:
    return df.join(F.broadcast(class_weights(df, label).select(F.col("label").alias(label),
                                                               F.col("weight").alias(weight_col))), label)


def target_summary(df: DataFrame, split: str = "split", label: str | None = "high_risk",
                   target: str | None = "traffic_volume") -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n")]
    if label:
        aggs.append(F.avg(F.col(label).cast("double")).alias("positive_rate"))
    if target:
        aggs += [F.avg(target).alias("target_mean"), F.stddev_samp(target).alias("target_std")]
    return df.groupBy(split).agg(*aggs)
