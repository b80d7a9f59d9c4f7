"""The forecaster: patience on the validation loss, the best round's model, the sentences of the forest's own attributions."""
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from hourwise.operators import models as MD
from hourwise.plans import q_models as QM

SF = "/root/testdata/sf0.01"


def test_early_stop():
    assert MD.early_stop([5, 4, 3, 2], 2) == (4, 4)
    assert MD.early_stop([5, 4, 4, 4.5, 1], 2) == (4, 2)          # two flat rounds: the fifth never runs
    assert MD.early_stop([5, 4, 4, 3, 3, 3], 2) == (6, 4)         # a flat round alone does not end it
    assert MD.early_stop([5, 5 - 1e-7, 5 - 2e-7], 2) == (3, 1)    # too little is no improvement
    assert MD.early_stop([1] * 40, 6) == (7, 1)


def test_best_round(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(240, 3))
    y = x[:, 0] + rng.normal(size=240)
    df = spark.createDataFrame([(a.tolist(), float(b), int(i)) for i, (a, b) in enumerate(zip(x, y))], "x array<double>, target double, i int") \
              .withColumn("features", array_to_vector("x"))
    train, val = df.filter("i < 160"), df.filter("i >= 160")
    model, history = MD.fit_forecaster(train, val, max_rounds=12, patience=2)
    rows = history.orderBy("epoch").collect()
    best = rows[0].best_epoch
    assert [r.epoch for r in rows] == list(range(1, len(rows) + 1)) and model.getNumTrees == best
    assert len(rows) == 12 or len(rows) - best == 2
    loss = model.transform(val).agg(F.avg((F.col("prediction") - F.col("target")) ** 2)).first()[0]
    assert loss == pytest.approx(rows[best - 1].val_loss, rel=1e-9) and loss <= min(r.val_loss for r in rows) + 1e-6
    with pytest.raises(ValueError, match="no validation row"):
        MD.fit_forecaster(train, val.limit(0))


def test_sentences_are_those_of_the_forest(spark):
    rows = QM.q_top_drivers(spark, SF).orderBy("rank").collect()
    pdf = QM.tree_attributions(spark, SF).toPandas()
    assert QM.q_tree_attribution(spark, SF).columns == [*QM.KEY, *[f"phi_{c}" for c in QM.TREE_FEATURES], "base_value", "tree_output"]
    phi = pdf[[f"phi_{c}" for c in QM.TREE_FEATURES]].sum(axis=1)
    model, test = QM._tree_forest(spark, SF)
    want = {(r.sensor, r.date_time): r.prediction for r in model.transform(test).collect()}
    assert len(want) == len(pdf)
    for s, t, total, out in zip(pdf.sensor, pdf.date_time, phi + pdf.base_value, pdf.tree_output):
        assert total == pytest.approx(out, abs=1e-6) and out == pytest.approx(want[s, t.to_pydatetime()], abs=1e-6)
    strength = {g: float(np.abs(pdf[[f"phi_{c}" for c in cols]].sum(axis=1)).mean()) for g, (_, cols, _) in QM.TREE_GROUPS.items()}
    assert [r.feature_group for r in rows] == [g for g, _ in sorted(strength.items(), key=lambda x: (-x[1], x[0]))[:6]]
    for r in rows:
        _, cols, cyclical = QM.TREE_GROUPS[r.feature_group]
        assert f"impact of {strength[r.feature_group]:,.0f} veh/hr" in r.sentence
        if not cyclical:
            a, b = pdf[cols[0]].to_numpy(float), pdf[f"phi_{cols[0]}"].to_numpy()
            if a.std() and b.std():
                assert f"r={np.corrcoef(a, b)[0, 1]:+.2f}" in r.sentence
