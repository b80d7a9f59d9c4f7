from hourwise.operators import recommend as RC
from hourwise.operators import rules as RU

# an invented hour-of-day profile: quiet at night, hour 15 empty, a lone quiet hour 17
FOG_PROFILE = [(h, n, m, r) for h, n, m, r in zip(
    range(24),
    [9, 12, 13, 15, 24, 20, 19, 26, 21, 13, 7, 4, 2, 4, 2, 0, 4, 2, 3, 3, 2, 2, 6, 8],
    [610.0, 340.0, 300.0, 365.0, 900.0, 2700.0, 5600.0, 6100.0, 5900.0, 5200.0, 4300.0, 4400.0, 4500.0, 4250.0, 4350.0,
     None, 5700.0, 2100.0, 3300.0, 1900.0, 2800.0, 2400.0, 1700.0, 1300.0],
    [0.2, 0.2, 0.25, 0.2, 0.25, 0.3, 0.95, 0.96, 0.95, 0.96, 0.94, 0.95, 0.96, 0.95, 0.93,
     None, 0.94, 0.93, 0.92, 0.4, 0.4, 0.3, 0.25, 0.25])]


def profile(spark):
    return spark.createDataFrame([(0, "fog", h, n, m, r) for h, n, m, r in FOG_PROFILE],
                                 "is_weekend int, weather_key string, hour int, n long, traffic_mean double, risk_prob double")


def test_empty_hour_dropped_from_baseline(spark):
    b = RC.search_range_baseline(profile(spark), 0, 23).collect()[0]
    means = [m for _, _, m, _ in FOG_PROFILE if m is not None]
    assert b["n_hours"] == 23 and abs(b["baseline_traffic"] - sum(means) / 23) < 1e-9


def test_windows_do_not_jump_the_empty_hour(spark):
    rec = RC.recommended_windows(profile(spark), 0, 23, top_n=10).orderBy("rank").collect()
    assert (rec[0]["start"], rec[0]["end"]) == (1, 3)            # quietest hour 2 grows left to the quieter 1
    assert all(r["end"] - r["start"] <= 2 for r in rec)
    for r in rec:
        assert not (r["start"] <= 15 < r["end"])
    avoid = RC.avoid_windows(profile(spark), 0, 23, top_n=5).collect()
    spans = {(r["start"], r["end"]) for r in avoid}
    assert (6, 15) in spans and (16, 17) in spans                # the busy run is cut at the empty hour


def test_rule_formula_matches_reference_row(spark):
    """First row of the reference's rule table: the 9 derived measures follow from the 3 supports."""
    sa, sc, s = 0.018459642637091805, 0.25000616142945165, 0.01678373382624769
    items = [("a, b", ["a", "b"], 2, 0, sa), ("congestion_Low", ["congestion_Low"], 1, 0, sc),
             ("a, b, congestion_Low", ["a", "b", "congestion_Low"], 3, 0, s)]
    fi = spark.createDataFrame(items, "itemset string, items array<string>, size int, freq long, support double")
    r = RU.association_rules(fi, 0.5).collect()[0]
    expected = {"confidence": 0.9092122830440589, "lift": 3.636759501627828, "leverage": 0.012168709429188927,
                "conviction": 8.260961545431494, "zhangs_metric": 0.7386654339917554,
                "jaccard": 0.06668625146886016, "certainty": 0.8789487162601521, "kulczynski": 0.48817278190057833}
    for k, v in expected.items():
        assert abs(r[k] - v) < 1e-9, k
    assert r["consequent"] == "Low" and r["representativity"] == 1.0


def test_fpgrowth_and_subsets_agree(spark):
    import random
    rnd = random.Random(2)
    rows = [([f"time_of_day_{rnd.choice('ABC')}", f"weekday_type_{rnd.choice('XY')}",
              f"weather_{rnd.choice('PQRS')}", f"congestion_{rnd.choice(['Low', 'High'])}"],) for _ in range(500)]
    tx = spark.createDataFrame(rows, "items array<string>")
    a = {(r["itemset"], r["freq"]) for r in RU.frequent_itemsets(tx, 0.02, "fpgrowth").collect()}
    b = {(r["itemset"], r["freq"]) for r in RU.frequent_itemsets(tx, 0.02, "subsets").collect()}
    assert a == b and len(a) > 20
    ra = {(r["antecedents"], r["consequent"]) for r in RU.fpgrowth_rules(tx, 0.02, 0.3).collect()}
    rb = {(r["antecedents"], r["consequent"]) for r in
          RU.association_rules(RU.frequent_itemsets(tx, 0.02, "subsets"), 0.3).collect()}
    assert ra == rb
