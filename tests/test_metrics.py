import random

from pyspark.sql import functions as F

from hourwise.functions.columns import safe_corr
from hourwise.operators import evaluation as EV
from hourwise.operators.prefix import ordered_cumsum


def test_one_class_metrics(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 1, 0.7), (0, 0, 0.2)], "label int, prediction int, score double")
    m = EV.classification_metrics(df, score="score").collect()[0]
    assert (m["precision"], m["recall"], m["f1"]) == (0.0, 0.0, 0.0)
    assert m["roc_auc"] is None
    assert m["accuracy"] == 2 / 3


def test_auc_equals_pairwise_brute_force(spark):
    rnd = random.Random(3)
    rows = [(int(rnd.random() < 0.3), round(rnd.random(), 1)) for _ in range(400)]   # many ties
    df = spark.createDataFrame(rows, "label int, score double")
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = EV.roc_auc(df).collect()[0]["roc_auc"]
    assert abs(got - brute) < 1e-12
    roc = EV.roc_curve(df).orderBy(F.col("threshold").desc()).collect()
    assert roc[-1]["tpr"] == 1.0 and roc[-1]["fpr"] == 1.0


def test_ordered_cumsum_matches_pandas(spark):
    rnd = random.Random(1)
    rows = [(k, rnd.randint(0, 9)) for k in rnd.sample(range(10_000), 500)]
    df = spark.createDataFrame(rows, "k long, v long")
    got = {r["k"]: r["cum_v"] for r in ordered_cumsum(df, "k", ["v"]).collect()}
    run = 0
    for k, v in sorted(rows):
        run += v
        assert got[k] == run
    got_d = {r["k"]: r["cum_v"] for r in ordered_cumsum(df, "k", ["v"], descending=True).collect()}
    run = 0
    for k, v in sorted(rows, reverse=True):
        run += v
        assert got_d[k] == run


def test_regression_metrics_and_constant_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 5.0)], "actual double, prediction double")
    m = EV.regression_metrics(df).collect()[0]
    assert abs(m["mae"] - (1 + 0 + 2) / 3) < 1e-12
    assert abs(m["r2"] - (1 - 5 / 2)) < 1e-12
    c = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "x double, y double").agg(safe_corr("x", "y").alias("r"))
    assert c.collect()[0]["r"] is None


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "label int")
    w = {r["label"]: r["weight"] for r in EV.class_weights(df).collect()}
    assert w == {0: 8 / (2 * 6), 1: 8 / (2 * 2)}
