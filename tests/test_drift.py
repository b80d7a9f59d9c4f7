import math
import random

from pyspark.sql import functions as F

from hourwise.operators import drift as D


def windows(spark, ref, cur):
    return spark.createDataFrame([("reference", float(x), str(int(x) % 5), int(x) % 24) for x in ref]
                                 + [("now", float(x), str(int(x) % 5), int(x) % 24) for x in cur],
                                 "window string, x double, cat string, hour int")


def test_same_sample_zero(spark):
    rnd = random.Random(5)
    xs = [rnd.randint(0, 50) for _ in range(300)]
    w = windows(spark, xs, xs)
    ks = D.ks_two_sample(w, "x").collect()[0]
    assert ks["ks_stat"] == 0.0 and ks["p_value"] == 1.0
    assert abs(D.psi_categorical(w, "cat").collect()[0]["psi"]) < 1e-12
    assert abs(D.psi_spine(w, "hour", 25).collect()[0]["psi"]) < 1e-12
    assert abs(D.psi_numeric(w, "x", 10).collect()[0]["psi"]) < 1e-12


def test_ks_against_brute_force(spark):
    rnd = random.Random(9)
    a = [rnd.gauss(0, 1) for _ in range(200)]
    b = [rnd.gauss(0.5, 1) for _ in range(150)]
    w = windows(spark, a, b)
    got = D.ks_two_sample(w, "x").collect()[0]
    d = max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in a + b)
    assert abs(got["ks_stat"] - d) < 1e-12
    lam = d * math.sqrt(len(a) * len(b) / (len(a) + len(b)))
    p = 2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * lam * lam) for j in range(1, 101))
    assert abs(got["p_value"] - min(1.0, max(0.0, p))) < 1e-12


def test_status_logic_reproduces_reference_report(spark):
    """Values of the reference's drift report → its statuses."""
    psi = spark.createDataFrame([(0.00034460485303198,), (0.04609512127054778,), (5.513532948177341,), (0.15,)], "psi double")
    assert [r[0] for r in psi.select(D.psi_status(F.col("psi"))).collect()] == ["PASS", "PASS", "ALERT", "MODERATE"]
    ks = spark.createDataFrame([(0.10345040049291437, 6.047e-61), (0.4832101047443007, 0.0)], "s double, p double")
    st = ks.select(F.when((F.col("p") < D.KS_ALERT_P) & (F.col("s") > D.KS_ALERT_STAT), "ALERT").otherwise("PASS"))
    assert [r[0] for r in st.collect()] == ["PASS", "ALERT"]
    scored = spark.createDataFrame(
        [("reference", 1, 1, 100.0, 90.0)] * 9 + [("reference", 0, 0, 100.0, 110.0)]
        + [("w", 1, 0, 100.0, 60.0)] * 5 + [("w", 1, 1, 100.0, 140.0)] * 5,
        "window string, label int, prediction int, actual double, prediction_r double")
    f1 = D.f1_drift(scored).collect()[0]
    assert f1["status"] == "ALERT" and f1["reference_value"] == 1.0
    mae = D.mae_drift(scored, "actual", "prediction_r").collect()[0]
    assert mae["status"] == "ALERT" and mae["extra"] == "increase=300.0%"
    rep = D.drift_report([D.psi_rows(D.psi_categorical(windows(spark, [1, 2], [1, 2]), "cat"), "psi_cat")],
                         [D.f1_drift(scored)])
    ws = D.window_status(rep).collect()
    assert {r["window"]: r["overall_status"] for r in ws} == {"now": "PASS", "w": "ALERT"}



def test_p_value_of_small_lambda_is_one(spark):
    from hourwise.operators.drift import kolmogorov_p
    got = spark.createDataFrame([(0.001,), (0.007,), (0.3,), (0.9,), (1.1,), (2.0,)], "x double") \
               .select(kolmogorov_p(F.col("x")).alias("p")).collect()
    want = [1.0, 1.0, 0.9999906941986655, 0.3927307079406543, 0.1777181926064012, 0.0006709252557796953]
    assert all(abs(g.p - w) < 1e-12 for g, w in zip(got, want))


def test_psi_leaves_missing_values_out(spark):
    from hourwise.operators.drift import psi_categorical
    rows = [("reference", "a")] * 6 + [("reference", "b")] * 4 + [("w", "a")] * 5 + [("w", "c")] * 5
    plain = spark.createDataFrame(rows, "window string, v string")
    missing = spark.createDataFrame(rows + [("reference", None), ("w", None), ("w", None)], "window string, v string")
    e = 1e-4
    terms = [(0.6, 0.5), (0.4, 0.0), (0.0, 0.5)]
    want = sum((c - r) * math.log((c + e) / (r + e)) for r, c in terms)
    for df in (plain, missing):
        assert abs(psi_categorical(df, "v").collect()[0].psi - want) < 1e-12
