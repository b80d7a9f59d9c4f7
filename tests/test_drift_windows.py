"""Drift windows: exact draws, exact KS p-values, and the report of the fitted models against numpy."""
import hashlib
import itertools
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourwise.operators import drift as D
from hourwise.operators import models as MD
from hourwise.plans import q_eval, q_models, tables

SF = "/root/testdata/sf0.001"


def uniform(name, draw):
    return (int(hashlib.md5(f"42:{name}:{draw}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52


def normal(name, draw):
    return math.sqrt(-2 * math.log(uniform(name + "1", draw))) * math.cos(2 * math.pi * uniform(name + "2", draw))


def test_exact_ks_equals_all_interleavings():
    for n, m in itertools.product(range(1, 9), range(1, 9)):
        if n + m > 12:
            continue
        gaps = []
        for first in itertools.combinations(range(n + m), n):
            i, d = 0, Fraction(0)
            for t in range(n + m):
                i += t in first
                d = max(d, abs(Fraction(i, n) - Fraction(t + 1 - i, m)))
            gaps.append(d)
        for d in set(gaps):
            assert D.exact_ks_p(float(d), n, m) == pytest.approx(sum(g >= d for g in gaps) / len(gaps), rel=1e-10)


def test_exact_ks_of_large_samples_and_tiny_probabilities():
    lam = 0.05 * math.sqrt(3000 * 2000 / 5000)
    series = sum(2 * (-1) ** (j - 1) * math.exp(-2 * j * j * lam * lam) for j in range(1, 50))
    assert D.exact_ks_p(0.05, 3000, 2000) == pytest.approx(series, rel=0.05)
    # the whole of one sample before the other: two paths of all
    assert D.exact_ks_p(1.0, 40, 30) == pytest.approx(2 / math.comb(70, 30), rel=1e-9)
    assert D.exact_ks_p(0.0, 5, 5) == 1.0


def test_ks_takes_the_exact_form_of_small_windows(spark):
    rows = [("reference", float(v)) for v in (1, 2, 3, 4, 5)] + [("a", float(v)) for v in (4, 6, 7, 8)] + [("b", 3.0), ("b", None)]
    df = spark.createDataFrame(rows, "window string, x double")
    got = {r.window: (r.ks_stat, r.p_value) for r in D.ks_two_sample(df, "x", exact_to=10_000).collect()}
    assert got["a"] == pytest.approx((0.75, D.exact_ks_p(0.75, 5, 4))) and got["b"] == pytest.approx((0.4, 1.0))
    large = {r.window: r.p_value for r in D.ks_two_sample(df, "x", exact_to=4).collect()}
    assert large["a"] != pytest.approx(got["a"][1], rel=1e-3)
    same = df.filter("window = 'reference'").unionByName(df.filter("window = 'reference'").withColumn("window", F.lit("c")))
    assert [r.p_value for r in D.ks_two_sample(same, "x", exact_to=10_000).collect()] == [1.0]


def test_winter_rows_are_drawn_by_rank(spark):
    rows = [("s" if k % 2 else "t", k // 2, 280.0 + k, float(k), "clear", 1, k) for k in range(20)]
    df = spark.createDataFrame(rows, "sensor string, h int, temp double, clouds_all double, weather_main string, is_precipitating int, traffic_volume int") \
              .select("*", F.timestamp_add("HOUR", F.col("h"), F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")).alias("date_time"))
    got = {r.draw: r for r in D.perturb_batch(df, 57).collect()}
    assert sorted(got) == list(range(57))
    ranked = sorted(rows, key=lambda r: (r[1], r[0]))
    for k, r in got.items():
        row = ranked[int(uniform("rank", k) * 20)]
        assert (r.sensor, r.h, r.traffic_volume) == (row[0], row[1], row[6])
        assert r.temp == pytest.approx(row[2] - 18 + 2 * normal("temp", k))
        assert r.clouds_all == pytest.approx(min(100, max(0, row[3] + 35 + 5 * normal("clouds", k))))
        at = int(np.searchsorted(np.cumsum([0.35, 0.25, 0.15, 0.10]), uniform("weather", k), side="right"))
        assert r.weather_main == ("snow", "fog", "mist", "thunderstorm", "clouds")[at]
        assert r.is_precipitating == (r.weather_main == "snow")
    assert D.perturb_batch(df.filter("h < 0"), 5).collect() == [] == D.perturb_batch(df, 0).collect()


@pytest.fixture
def small_models(monkeypatch):
    monkeypatch.setattr(q_models, "VERSION_PARAMS", {"v1_baseline": (5, 4, 5), "v2_candidate": (8, 6, 2)})
    monkeypatch.setattr(MD, "rf_regressor_pipeline", lambda f=MD.rf_regressor_pipeline: f(num_trees=5, max_depth=5))
    before = dict(tables._MEMO)
    yield
    tables._MEMO.clear()
    tables._MEMO.update(before)


def test_report_of_the_fitted_models(spark, small_models):
    """Twelve rows, from the scored rows by numpy; the scores are the saved models' own."""
    w = q_models.champion_windows(spark, SF).toPandas()
    sizes = w.groupby("window").size()
    assert sizes["synthetic_severe_winter"] == sizes["test_period"] and len(sizes) == 3
    report = {(r.window, r.check): r for r in q_models.q_champion_drift(spark, SF).collect()}
    assert len(report) == 12
    ref = w[w.window == "reference"]
    for name in ("test_period", "synthetic_severe_winter"):
        cur = w[w.window == name]
        for c in ("temp", "clouds_all"):
            at = np.union1d(ref[c], cur[c])
            d = np.abs(np.searchsorted(np.sort(ref[c]), at, side="right") / len(ref) - np.searchsorted(np.sort(cur[c]), at, side="right") / len(cur)).max()
            row = report[name, f"ks_{c}"]
            p = D.exact_ks_p(d, len(ref), len(cur))
            assert row.value == pytest.approx(d) and row.extra == f"p_value={p:.3e}"
            assert row.status == ("ALERT" if p < 0.05 and d > 0.15 else "PASS")
        for c, check, bins in (("hour", "psi_hour_of_day", range(25)), ("weather_main", "psi_weather_main", sorted(set(ref.weather_main) | set(cur.weather_main)))):
            r, k = (np.array([(x[c] == b).sum() for b in bins]) / len(x) + 1e-4 for x in (ref, cur))
            psi = float(((k - r) * np.log(k / r)).sum())
            row = report[name, check]
            assert row.value == pytest.approx(psi) and row.status == ("ALERT" if psi > 0.25 else "MODERATE" if psi > 0.1 else "PASS")

        def f1(x):
            tp = ((x.label == 1) & (x.prediction == 1)).sum()
            return 2 * tp / max(1, (x.label == 1).sum() + (x.prediction == 1).sum())

        def mae(x):
            return (x.actual - x.value_pred).abs().mean()
        row = report[name, "classifier_f1_drift"]
        assert (row.value, row.reference_value) == pytest.approx((f1(cur), f1(ref)))
        assert row.status == ("ALERT" if f1(ref) - f1(cur) > 0.05 else "PASS") and row.extra == f"drop={f1(ref) - f1(cur):.3f}"
        row = report[name, "regressor_mae_drift"]
        assert (row.value, row.reference_value) == pytest.approx((mae(cur), mae(ref)))
        assert row.status == ("ALERT" if mae(cur) / mae(ref) - 1 > 0.25 else "PASS")
    status = {r.window: r for r in q_models.q_champion_status(spark, SF).collect()}
    for name, r in status.items():
        alerts = sorted(c for (x, c), row in report.items() if x == name and row.status == "ALERT")
        assert (r.n_checks, r.n_alerts, r.alerting_checks) == (6, len(alerts), ", ".join(alerts))
    # the champion's scores are those of its saved model over the same rows
    champion = q_models.load_by_alias(spark, SF)
    again = MD.predict_score(champion, q_eval._windows(spark, SF).drop("prediction", "score"), ["window", "sensor", "date_time"])
    assert np.allclose(np.sort(again.toPandas().score), np.sort(w.score))
    assert "synthetic_severe_winter" in q_models.q_champion_summary(spark, SF).first().summary_json
