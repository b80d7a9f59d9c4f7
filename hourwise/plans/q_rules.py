"""Registered association-rule and travel-recommendation (2.M)
queries on the labelled events readings."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import recommend as RC
from ..operators import rules as RU
from . import tables
from .oracle_base import with_tables
from .registry import query, rnd, rounded

EV = "events"
MIN_SUPPORT = 0.01
# The reference mines at confidence 0.5 (the operator default); on the
# synthetic readings no rule reaches it (max ≈ 0.38), so the registered queries
# use 0.3 — a stand-in threshold like the 700 veh/h and 288 K ones.
MIN_CONFIDENCE = 0.3
RANGE = (6, 20)


def transactions(spark, sf):
    return RU.build_transactions(tables.labelled(spark, sf, EV))


def itemsets(spark, sf, method="subsets"):
    return tables._memo(spark, ("itemsets", sf, method),
                        lambda: RU.frequent_itemsets(transactions(spark, sf), MIN_SUPPORT, method))


def rules(spark, sf):
    return RU.association_rules(itemsets(spark, sf), MIN_CONFIDENCE)


TX_SQL = with_tables(EV) + """
, tx AS (SELECT 'time_of_day_' || time_of_day AS i1,
                'weekday_type_' || CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS i2,
                'weather_' || CASE weather_severity WHEN 0 THEN 'Clear' WHEN 1 THEN 'Clouds' WHEN 2 THEN 'Precipitation'
                                  WHEN 3 THEN 'Low visibility' ELSE 'Severe' END AS i3,
                'congestion_' || congestion_category_p3 AS i4 FROM lab),
sub AS (SELECT list_sort(list_filter([i1, i2, i3, i4], lambda x, k: ((m >> (k - 1)) & 1) = 1)) AS its
        FROM tx, range(1, 16) t(m)),
cnt AS (SELECT its, count(*) AS freq FROM sub GROUP BY its),
fi AS (SELECT array_to_string(its, ', ') AS itemset, its, len(its) AS size, freq, freq / (SELECT count(*) FROM tx) AS support
       FROM cnt WHERE freq / (SELECT count(*) FROM tx) >= 0.01),
cand AS (SELECT array_to_string(list_filter(its, lambda x: NOT starts_with(x, 'congestion_')), ', ') AS antecedents,
                list_filter(its, lambda x: starts_with(x, 'congestion_'))[1] AS c, support AS s
         FROM fi WHERE size >= 2 AND len(list_filter(its, lambda x: starts_with(x, 'congestion_'))) = 1),
j AS (SELECT cand.antecedents, a.support AS sA, cs.support AS sC, cand.s, cand.c
      FROM cand JOIN fi a ON a.itemset = cand.antecedents JOIN fi cs ON cs.itemset = cand.c),
rl AS (SELECT antecedents, sA AS antecedent_support, sC AS consequent_support, s AS support, s / sA AS confidence,
              s / sA / sC AS lift, 1.0 AS representativity, s - sA * sC AS leverage,
              (1 - sC) / nullif(1 - s / sA, 0) AS conviction,
              (s - sA * sC) / nullif(greatest(s * (1 - sA), sA * (sC - s)), 0) AS zhangs_metric,
              s / (sA + sC - s) AS jaccard, (s / sA - sC) / nullif(1 - sC, 0) AS certainty,
              (s / sA + s / sC) / 2 AS kulczynski, replace(c, 'congestion_', '') AS consequent
       FROM j WHERE s / sA / sC >= 1.0 AND s / sA >= """ + str(MIN_CONFIDENCE) + """)
"""

RULE_DOUBLES = ("antecedent_support consequent_support support confidence lift representativity leverage "
                "conviction zhangs_metric jaccard certainty kulczynski")


@query("build_transactions", TX_SQL + "SELECT array_to_string(list_sort([i1, i2, i3, i4]), ', ') AS basket FROM tx")
def q_tx(spark, sf):
    return transactions(spark, sf).select(F.array_join(F.array_sort("items"), ", ").alias("basket"))


@query("frequent_itemsets", rnd(TX_SQL + "SELECT itemset, size, freq, support FROM fi", "support"))
def q_itemsets(spark, sf):
    return rounded(itemsets(spark, sf, "subsets").select("itemset", "size", "freq", "support"))


@query("association_rules", rnd(TX_SQL + "SELECT antecedents, consequent, support, confidence, lift FROM rl",
                                "support confidence lift"))
def q_rules(spark, sf):
    r = rules(spark, sf)
    return rounded(r.select("antecedents", "consequent", "support", "confidence", "lift"))


@query("rule_metrics", rnd(TX_SQL + "SELECT * FROM rl", RULE_DOUBLES))
def q_rule_metrics(spark, sf):
    return rounded(rules(spark, sf))


@query("top_rules", rnd(TX_SQL + """SELECT antecedents AS antecedents_readable, consequent, support, confidence, lift
FROM rl ORDER BY lift DESC, antecedents, consequent LIMIT 15""", "support confidence lift"))
def q_top_rules(spark, sf):
    return rounded(RU.top_rules(rules(spark, sf), 15))


@query("best_rule_per_level", rnd(TX_SQL + """SELECT consequent, antecedents, support, confidence, lift,
       CASE consequent WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 ELSE 3 END AS level_order
FROM rl QUALIFY row_number() OVER (PARTITION BY consequent ORDER BY lift DESC, antecedents) = 1
ORDER BY level_order""", "support confidence lift"))
def q_best_rule(spark, sf):
    return rounded(RU.best_rule_per_level(rules(spark, sf)))


def _phrase_case(x: str) -> str:
    from ..operators.rules import PHRASES
    whens = " ".join(f"WHEN '{c}_{v}' THEN '" + p.replace("'", "''") + "'" for c, m in PHRASES.items()
                     for v, p in m.items())
    return f"CASE {x} {whens} ELSE regexp_replace({x}, '_([^_]*)$', '=\\1') END"


@query("explain_rules", TX_SQL + """SELECT antecedents, consequent,
       printf('When %s, congestion is ''%s'' %.1f%% of the time -- %.2fx more likely than for a random hour. '
              || 'This combination covers %.1f%% of all hours in the dataset.',
              array_to_string(list_transform(string_split(antecedents, ', '), lambda it: """ + _phrase_case("it") + """),
                              ' and '), consequent, confidence * 100, lift, support * 100) AS explanation
FROM rl""")
def q_explain(spark, sf):
    return RU.explain_rules(rules(spark, sf)).select("antecedents", "consequent", "explanation")


# ------------------------------------------------------------------ 2.M ----

SCORE = "(clouds_all / 100 + is_low_visibility + is_severe_weather + CASE WHEN traffic_volume > 700 THEN 1 ELSE 0 END) / 4.0"


def profile(spark, sf):
    def build():
        lab = tables.labelled(spark, sf, EV)
        from .q_eval import rule_score
        return RC.hourly_profile(lab.withColumn("risk_score", rule_score()))
    return tables._memo(spark, ("profile", sf), build)


PROFILE_SQL = with_tables(EV) + f"""
, p AS (SELECT *, {SCORE} AS risk_score FROM lab),
g AS (SELECT is_weekend, '*' AS weather_key, hour, traffic_volume, risk_score, congestion_category_p3 FROM p
      UNION ALL SELECT is_weekend, weather_main, hour, traffic_volume, risk_score, congestion_category_p3 FROM p),
agg AS (SELECT is_weekend, weather_key, hour, count(*) AS n, avg(traffic_volume) AS traffic_mean,
               median(traffic_volume) AS traffic_median, avg(risk_score) AS risk_prob FROM g GROUP BY 1, 2, 3),
md AS (SELECT is_weekend, weather_key, hour, arg_min(c, (-k, c)) AS dominant_congestion
       FROM (SELECT is_weekend, weather_key, hour, congestion_category_p3 AS c, count(*) AS k FROM g GROUP BY 1, 2, 3, 4)
       GROUP BY 1, 2, 3),
grp AS (SELECT DISTINCT is_weekend, weather_key FROM agg),
prof AS (SELECT grp.is_weekend, grp.weather_key, CAST(h.range AS INTEGER) AS hour, coalesce(agg.n, 0) AS n,
                agg.traffic_mean, agg.traffic_median, agg.risk_prob, md.dominant_congestion,
                CASE WHEN coalesce(agg.n, 0) > 0 AND coalesce(agg.n, 0) < 10 THEN 1 ELSE 0 END AS low_confidence
         FROM grp CROSS JOIN range(24) h
         LEFT JOIN agg ON agg.is_weekend = grp.is_weekend AND agg.weather_key = grp.weather_key AND agg.hour = h.range
         LEFT JOIN md ON md.is_weekend = grp.is_weekend AND md.weather_key = grp.weather_key AND md.hour = h.range),
cand AS (SELECT * FROM prof WHERE hour BETWEEN {RANGE[0]} AND {RANGE[1]} AND traffic_mean IS NOT NULL),
base AS (SELECT is_weekend, weather_key, avg(traffic_mean) AS baseline_traffic, avg(risk_prob) AS baseline_risk,
                count(*) AS n_hours FROM cand GROUP BY 1, 2)
"""


@query("hourly_profile", rnd(PROFILE_SQL + "SELECT * FROM prof", "traffic_mean traffic_median risk_prob"))
def q_profile(spark, sf):
    return rounded(profile(spark, sf))


@query("low_confidence_flag", PROFILE_SQL + "SELECT is_weekend, weather_key, hour, n, low_confidence FROM prof")
def q_low_conf(spark, sf):
    return profile(spark, sf).select("is_weekend", "weather_key", "hour", "n", "low_confidence")


@query("search_range_baseline", rnd(PROFILE_SQL + "SELECT * FROM base", "baseline_traffic baseline_risk"))
def q_baseline(spark, sf):
    return rounded(RC.search_range_baseline(profile(spark, sf), *RANGE))


@query("elevated_risk_flag", rnd(PROFILE_SQL + """SELECT c.is_weekend, c.weather_key, c.hour, c.risk_prob, b.baseline_risk,
       CASE WHEN c.risk_prob > 1.5 * b.baseline_risk AND b.baseline_risk > 0 THEN 1 ELSE 0 END AS elevated_risk
FROM cand c JOIN base b ON c.is_weekend = b.is_weekend AND c.weather_key = b.weather_key""", "risk_prob baseline_risk"))
def q_elevated(spark, sf):
    e = RC.elevated_risk(profile(spark, sf), *RANGE)
    return rounded(e.select("is_weekend", "weather_key", "hour", "risk_prob", "baseline_risk", "elevated_risk"))


@query("avoid_windows", rnd(PROFILE_SQL + """
, hi AS (SELECT c.* FROM cand c JOIN base b ON c.is_weekend = b.is_weekend AND c.weather_key = b.weather_key
         WHERE c.traffic_mean >= b.baseline_traffic),
runs AS (SELECT *, hour - row_number() OVER (PARTITION BY is_weekend, weather_key ORDER BY hour) AS run FROM hi),
rr AS (SELECT is_weekend, weather_key, min(hour) AS start, max(hour) + 1 AS "end", avg(traffic_mean) AS traffic_mean,
              avg(risk_prob) AS risk_prob, CAST(sum(n) AS BIGINT) AS n FROM runs GROUP BY is_weekend, weather_key, run)
SELECT is_weekend, weather_key, CAST(row_number() OVER (PARTITION BY is_weekend, weather_key
         ORDER BY traffic_mean DESC, start) AS INTEGER) AS rank, start, "end", traffic_mean, risk_prob, n
FROM rr QUALIFY rank <= 1""", "traffic_mean risk_prob"))
def q_avoid(spark, sf):
    return rounded(RC.avoid_windows(profile(spark, sf), *RANGE, top_n=1))


RECOMMEND_SQL = "WITH RECURSIVE " + PROFILE_SQL[len("WITH "):] + """
, cb AS (SELECT c.*, b.baseline_traffic FROM cand c JOIN base b ON c.is_weekend = b.is_weekend
         AND c.weather_key = b.weather_key),
ord AS (SELECT *, row_number() OVER (PARTITION BY is_weekend, weather_key ORDER BY traffic_mean, hour) AS k
        FROM cb WHERE traffic_mean < baseline_traffic),
steps AS (
  SELECT o.is_weekend, o.weather_key, o.k, o.hour, o.traffic_mean AS m0,
         l.traffic_mean AS ml, r.traffic_mean AS mr, o.baseline_traffic AS base
  FROM ord o
  LEFT JOIN cb l ON l.is_weekend = o.is_weekend AND l.weather_key = o.weather_key AND l.hour = o.hour - 1
  LEFT JOIN cb r ON r.is_weekend = o.is_weekend AND r.weather_key = o.weather_key AND r.hour = o.hour + 1),
rec(is_weekend, weather_key, k, used, ws, we) AS (
  SELECT DISTINCT is_weekend, weather_key, CAST(0 AS BIGINT), CAST([] AS INTEGER[]), CAST(NULL AS INTEGER),
         CAST(NULL AS INTEGER) FROM steps
  UNION ALL
  SELECT s.is_weekend, s.weather_key, s.k,
         CASE WHEN list_contains(rec.used, s.hour) THEN rec.used
              ELSE list_concat(rec.used, [s.hour, nb.pick]) END,
         CASE WHEN list_contains(rec.used, s.hour) THEN NULL ELSE least(s.hour, coalesce(nb.pick, s.hour)) END,
         CASE WHEN list_contains(rec.used, s.hour) THEN NULL ELSE greatest(s.hour, coalesce(nb.pick, s.hour)) + 1 END
  FROM rec JOIN steps s ON s.is_weekend = rec.is_weekend AND s.weather_key = rec.weather_key AND s.k = rec.k + 1
  CROSS JOIN LATERAL (
    SELECT CASE WHEN lok AND (NOT rok OR s.ml <= s.mr) THEN s.hour - 1 WHEN rok THEN s.hour + 1 END AS pick
    FROM (SELECT coalesce(s.ml < s.base AND NOT list_contains(rec.used, s.hour - 1), false) AS lok,
                 coalesce(s.mr < s.base AND NOT list_contains(rec.used, s.hour + 1), false) AS rok)) nb),
win AS (SELECT rec.is_weekend, rec.weather_key, rec.k, rec.ws AS start, rec.we AS "end",
               avg(c.traffic_mean) AS traffic_mean, avg(c.risk_prob) AS risk_prob, CAST(sum(c.n) AS BIGINT) AS n
        FROM rec JOIN cb c ON c.is_weekend = rec.is_weekend AND c.weather_key = rec.weather_key
             AND c.hour >= rec.ws AND c.hour < rec.we
        WHERE rec.ws IS NOT NULL GROUP BY 1, 2, 3, 4, 5)
SELECT is_weekend, weather_key,
       CAST(row_number() OVER (PARTITION BY is_weekend, weather_key ORDER BY traffic_mean, k) AS INTEGER) AS rank,
       CAST(start AS INTEGER) AS start, CAST("end" AS INTEGER) AS "end", traffic_mean, risk_prob, n
FROM win QUALIFY rank <= 3"""


@query("recommended_windows", rnd(RECOMMEND_SQL, "traffic_mean risk_prob"))
def q_recommended(spark, sf):
    return rounded(RC.recommended_windows(profile(spark, sf), *RANGE, top_n=3))


@query("resolve_day_type", """SELECT d AS date, dayname(d) AS day_name, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN isodow(d) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_type,
       strftime(d, '%Y-%m-%d') || ' is a ' || dayname(d) AS note
FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)""")
def q_resolve(spark, sf):
    from ..sources.adapters import table
    probes = table(spark, sf, "events").select(F.to_date("ts").alias("date")).distinct()
    return RC.resolve_day_type(probes)


VALID = ["Clear", "Clouds", "Drizzle", "Fog", "Haze", "Mist", "Rain", "Smoke", "Snow", "Squall", "Thunderstorm"]


@query("normalize_weather", with_tables(EV, "raw") + """
, vals AS (SELECT DISTINCT weather_main AS weather FROM raw
           UNION SELECT DISTINCT split_part(weather_description, ' ', 3) FROM raw)
SELECT weather, v.w AS weather_canonical, CASE WHEN v.w IS NULL THEN 0 ELSE 1 END AS weather_valid
FROM vals LEFT JOIN (SELECT unnest([""" + ", ".join(f"'{w}'" for w in VALID) + """]) AS w) v
  ON lower(trim(vals.weather)) = lower(v.w)""")
def q_normalize(spark, sf):
    raw = tables.raw(spark, sf, EV)
    vals = raw.select(F.col("weather_main").alias("weather")).union(
        raw.select(F.split("weather_description", " ")[2].alias("weather"))).distinct()
    return RC.normalize_weather(vals, "weather").select("weather", "weather_canonical", "weather_valid")


@query("matching_risk_rule", rnd(TX_SQL + """
, dt AS (SELECT * FROM (VALUES ('Weekday'), ('Weekend')) v(day_type))
SELECT dt.day_type, r.antecedents, r.consequent, r.confidence, r.lift FROM dt JOIN rl r
  ON list_contains(string_split(r.antecedents, ', '), 'weekday_type_' || dt.day_type)
WHERE r.consequent IN ('High', 'Severe') AND r.lift >= 1.2
QUALIFY row_number() OVER (PARTITION BY dt.day_type ORDER BY r.lift DESC, r.antecedents) = 1""", "confidence lift"))
def q_matching_rule(spark, sf):
    r = rules(spark, sf)
    out = None
    for d in ("Weekday", "Weekend"):
        m = RU.matching_risk_rule(r, d, min_lift=1.2).select(F.lit(d).alias("day_type"), "antecedents", "consequent",
                                                              "confidence", "lift")
        out = m if out is None else out.unionByName(m)
    return rounded(out)


@query("recommendation_text")
def q_text(spark, sf):
    p = profile(spark, sf)
    rec = RC.recommended_windows(p, *RANGE, top_n=3)
    avoid = RC.avoid_windows(p, *RANGE, top_n=1)
    base = RC.search_range_baseline(p, *RANGE)
    r = rules(spark, sf)
    by_day = [RU.matching_risk_rule(r, d, min_lift=1.2).select(
        F.lit(int(d == "Weekend")).alias("is_weekend"), "antecedents", "consequent", "confidence", "lift")
        for d in ("Weekday", "Weekend")]                                                       # one row each at most
    return RC.recommendation_text(rec, avoid, base, by_day[0].unionByName(by_day[1]))
