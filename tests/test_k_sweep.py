"""The k sweep: ten starts of each k in one pass a step, against numpy, Spark's own fits and its silhouette."""
import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from hourwise.operators import clusters as CU
from hourwise.plans import q_models


def vectors(spark, rows):
    names = [f"c{i}" for i in range(len(rows[0]))]
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows], ", ".join(f"{c} double" for c in names)).repartition(3)
    return VectorAssembler(inputCols=names, outputCol="features").transform(df).cache()


def test_k_sweep_runs_ten_starts(spark, monkeypatch):
    x = vectors(spark, [(k * k,) for k in range(30)])
    starts, seeded, passes, sums = [], CU._seeded, [], CU._lloyd_sums

    def spy(sample, k, rng):
        starts.append(k)
        return seeded(sample, k, rng)

    def count(points, sets, d):
        passes.append(len(sets))
        return sums(points, sets, d)
    monkeypatch.setattr(q_models, "_cluster_points", lambda spark, sf: x)
    monkeypatch.setattr(CU, "_seeded", spy)
    monkeypatch.setattr(CU, "_lloyd_sums", count)
    assert [r.k for r in q_models.q_evaluate_k(spark, "").collect()] == list(range(2, 9))
    assert starts == [k for k in range(2, 9) for _ in range(10)]
    assert passes[0] == passes[-1] == 70  # all sets in one pass


def test_sweep_against_numpy_and_the_library(spark):
    rng = np.random.default_rng(1)
    rows = np.concatenate([rng.normal(m, 0.6, (120, 3)) for m in ([0, 0, 0], [4, 0, 1], [0, 5, 2], [3, 3, 3])])
    x = vectors(spark, rows.tolist())
    got = {r.k: r for r in CU.evaluate_k(x, range(2, 6), n_init=10).collect()}
    best = CU.sweep_k(x, range(2, 6), n_init=10)
    for k, (centroids, sums) in best.items():
        distance = ((rows[:, None] - centroids) ** 2).sum(axis=2)
        owner = distance.argmin(axis=1)
        assert got[k].inertia == pytest.approx(distance.min(axis=1).sum())
        for j in range(k):  # a fixed point of Lloyd's step
            assert np.allclose(rows[owner == j].mean(axis=0), centroids[j], atol=1e-3)
        library = CU.fit_kmeans(x, k, n_init=10)
        assert got[k].inertia <= library.summary.trainingCost * (1 + 1e-3)
        cents = F.lit(0)
        placed = x.select("features", *[F.col(f"c{i}") for i in range(3)])
        each = [sum((F.col(f"c{i}") - float(c[i])) ** 2 for i in range(3)) for c in centroids]
        for j in range(1, k):
            cents = F.when(F.least(*each) == each[j], F.lit(j)).otherwise(cents)
        scored = placed.withColumn("prediction", cents.cast("double"))
        assert got[k].silhouette == pytest.approx(ClusteringEvaluator().evaluate(scored), abs=1e-9)


def test_steps_over_all_rows_follow_a_small_sample(spark):
    """Seeds of a few rows; the steps, costs and choices are over all of them."""
    rng = np.random.default_rng(2)
    rows = np.concatenate([rng.normal(m, 0.8, (400, 2)) for m in (0, 3, 7)])
    for k, (centroids, sums) in CU.sweep_k(vectors(spark, rows.tolist()), [2, 3], n_init=3, seed_rows=20, tol=1e-9).items():
        owner = ((rows[:, None] - centroids) ** 2).sum(axis=2).argmin(axis=1)
        assert sums[0].tolist() == np.bincount(owner, minlength=k).tolist()
        assert all(np.allclose(rows[owner == j].mean(axis=0), centroids[j], atol=1e-6) for j in range(k))


def test_sweep_of_few_and_equal_rows(spark):
    same = CU.evaluate_k(vectors(spark, [(1, 2)] * 9), [2, 3], n_init=2).collect()
    assert [(r.inertia, r.silhouette) for r in same] == [(0.0, 0.0)] * 2
    with pytest.raises(ValueError, match="no rows"):
        CU.evaluate_k(vectors(spark, [(1, 2)]).filter("false"), [2])
