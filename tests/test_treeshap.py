import itertools
import math
import random

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from hourwise.operators import explain as EX


def _cond_expectation(tree, x, subset):
    """E[f(x) | x_S] under the tree's own cover distribution (Algorithm 1)."""
    def rec(nid):
        r = tree[nid]
        if r["left"] < 0:
            return r["value"]
        if r["feature"] in subset:
            return rec(r["left"] if x[r["feature"]] <= r["thr"] else r["right"])
        lc, rc = tree[r["left"]]["cover"], tree[r["right"]]["cover"]
        return (lc * rec(r["left"]) + rc * rec(r["right"])) / (lc + rc)
    return rec(0)


def _brute_shap(trees, x, p):
    phi = np.zeros(p)
    for tree in trees:
        for i in range(p):
            rest = [j for j in range(p) if j != i]
            for k in range(len(rest) + 1):
                for s in itertools.combinations(rest, k):
                    wgt = math.factorial(k) * math.factorial(p - k - 1) / math.factorial(p)
                    phi[i] += wgt * (_cond_expectation(tree, x, set(s) | {i}) - _cond_expectation(tree, x, set(s)))
    return phi / len(trees)


def test_blocks_of_leaves_of_deep_trees(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.random((1500, 4))
    y = np.sin(9 * x[:, 0]) + x[:, 1] * x[:, 2] + rng.normal(size=1500) * 0.3
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, d double, y double")
    va = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="f")
    m = RandomForestRegressor(numTrees=2, maxDepth=16, seed=3, featuresCol="f", labelCol="y").fit(va.transform(df))
    forest = EX.forest_arrays(m, spark)
    assert max(len(t["v"]) for t in forest["trees"]) > 500
    monkeypatch.setattr(EX, "LEAVES", 7)
    assert all(len(b["v"]) <= 7 for t in forest["trees"] for b in EX.leaf_blocks(t))
    phi, base, out = EX.tree_shap_batch(x[:6], forest, 4, chunk=4)
    monkeypatch.setattr(EX, "LEAVES", 10**9)
    whole, base_whole, out_whole = EX.tree_shap_batch(x[:6], forest, 4)
    assert np.allclose(phi, whole, atol=1e-9) and np.allclose(out, out_whole) and base == base_whole
    assert np.allclose(phi.sum(axis=1) + base, out)


def test_tree_shap_matches_brute_force_and_sums_to_prediction(spark):
    rnd = random.Random(4)
    rows = [(rnd.random(), rnd.random(), float(rnd.randint(0, 3))) for _ in range(300)]
    rows = [(a, b, c, 3 * a + (b > 0.5) * 2 + c * a + rnd.random() * 0.1) for a, b, c in rows]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    feats = ["a", "b", "c"]
    m = RandomForestRegressor(numTrees=3, maxDepth=4, seed=3, featuresCol="f", labelCol="y",
                              featureSubsetStrategy="all").fit(VectorAssembler(inputCols=feats, outputCol="f").transform(df))
    forest = EX.forest_arrays(m, spark)
    x = np.array([[r[0], r[1], r[2]] for r in rows[:20]])
    phi, base, out = EX.tree_shap_batch(x, forest, 3, chunk=7)
    pred = [r["prediction"] for r in m.transform(VectorAssembler(inputCols=feats, outputCol="f")
                                                 .transform(spark.createDataFrame(rows[:20], df.schema))).collect()]
    assert np.allclose(out, pred)
    assert np.allclose(phi.sum(axis=1) + base, out)
    # the same trees walked through the model object, for the brute-force check
    trees = []
    for t in m.trees:
        j = t._java_obj.rootNode()
        tree, stack = {}, [(j, 0)]
        nxt = [1]
        while stack:
            node, nid = stack.pop()
            cover = float(node.impurityStats().count())
            if node.numDescendants() == 0:
                tree[nid] = {"left": -1, "value": node.prediction(), "cover": cover}
                continue
            li, ri = nxt[0], nxt[0] + 1
            nxt[0] += 2
            sp = node.split()
            tree[nid] = {"left": li, "right": ri, "feature": sp.featureIndex(), "thr": sp.threshold(), "cover": cover}
            stack += [(node.leftChild(), li), (node.rightChild(), ri)]
        trees.append(tree)
    for r in range(5):
        assert np.allclose(phi[r], _brute_shap(trees, x[r], 3), atol=1e-9)
    attr = EX.tree_attribution(spark.createDataFrame(rows[:20], df.schema).withColumn("k", F.monotonically_increasing_id()),
                               m, feats, keep=["k"]).collect()
    assert len(attr) == 20
    assert all(abs(a["phi_a"] + a["phi_b"] + a["phi_c"] + a["base_value"] - a["tree_output"]) < 1e-9 for a in attr)
