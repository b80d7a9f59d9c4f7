"""Association rules over per-reading 'baskets'.

Two exact ways to get the frequent itemsets:
* ``subsets`` — equal baskets are counted with a partial hash aggregate, then
  every non-empty subset of a (fixed, small) distinct basket is emitted with its
  count: 15 subsets of 4 items, whatever the number of rows;
* ``fpgrowth`` — Spark ML's parallel FP-growth, for wide baskets.
Rules are derived from the itemset table (a small self-join), keeping the
reference's filters: lift ≥ 1, confidence ≥ min_confidence and a single
consequent taken from one item column.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: item names, their sentence phrases and the sentence --------
RULE_SENTENCE = ("When %s, congestion is '%s' %.1f%% of the time -- %.2fx more likely than for a random hour. "
                 "This combination covers %.1f%% of all hours in the dataset.")
ITEM_COLUMNS = ["time_of_day", "weekday_type", "weather", "congestion"]
CONGESTION_ORDER = ["Low", "Medium", "High", "Severe"]
PHRASES = {
    "time_of_day": {
        "Overnight (0-5)": "it's overnight (midnight-5am)",
        "Morning Rush (6-9)": "it's the morning rush (6-9am)",
        "Midday (10-15)": "it's midday (10am-3pm)",
        "Evening Rush (16-18)": "it's the evening rush (4-6pm)",
        "Evening (19-23)": "it's evening (7-11pm)",
    },
    "weekday_type": {"Weekday": "it's a weekday", "Weekend": "it's the weekend"},
    "weather": {
        "Clear": "the weather is clear",
        "Clouds": "the weather is cloudy",
        "Precipitation": "it's raining/snowing",
        "Low visibility": "visibility is reduced (fog/mist/haze/smoke)",
        "Severe": "there's severe weather (thunderstorm/squall)",
    },
}
# ---------------------------------------------------------------------------


def build_transactions(df: DataFrame, time_of_day: str = "time_of_day", weekend: str = "is_weekend",
                       weather: str = "weather_severity_label", congestion: str = "congestion_category_p3") -> DataFrame:
    """One basket per reading: 4 items, each prefixed by its column."""
    wt = F.when(F.col(weekend) == 1, "Weekend").otherwise("Weekday")
    items = [F.concat(F.lit("time_of_day_"), F.col(time_of_day)), F.concat(F.lit("weekday_type_"), wt),
             F.concat(F.lit("weather_"), F.col(weather)), F.concat(F.lit("congestion_"), F.col(congestion))]
    return df.select(F.array(*items).alias("items"))


def _itemset_key(arr: Column) -> Column:
    return F.array_join(F.array_sort(arr), ", ")


def frequent_itemsets(tx: DataFrame, min_support: float = 0.01, method: str = "subsets",
                      basket_size: int = 4) -> DataFrame:
    """(itemset, items, size, freq, support) for itemsets with support ≥ min_support."""
    # equal baskets are counted first: what follows works on distinct baskets, whatever the number of rows
    baskets = tx.groupBy(F.array_sort("items").alias("items")).agg(F.count(F.lit(1)).alias("_k"))
    n = baskets.agg(F.sum("_k").alias("_n"))
    if method == "fpgrowth":
        model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0).fit(tx)
        fi = model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq"))
    elif method == "subsets":
        subsets = [F.array(*[F.col("items")[k] for k in range(basket_size) if (m >> k) & 1])
                   for m in range(1, 2 ** basket_size)]
        fi = (baskets.select(F.explode(F.array(*subsets)).alias("items"), "_k")
                     .groupBy("items").agg(F.sum("_k").alias("freq")))
    else:
        raise ValueError(f"unknown method {method}")
    return (fi.crossJoin(F.broadcast(n))
              .select(_itemset_key(F.col("items")).alias("itemset"), "items", F.size("items").alias("size"),
                      "freq", (F.col("freq") / F.col("_n")).alias("support"))
              .filter(F.col("support") >= min_support))


def association_rules(itemsets: DataFrame, min_confidence: float = 0.5, min_lift: float = 1.0,
                      consequent_prefix: str = "congestion_") -> DataFrame:
    """Rules A → {c} with c the one ``consequent_prefix`` item of a frequent
    itemset and A the rest (non-empty), with the reference's 12 measures."""
    is_c = lambda x: x.startswith(consequent_prefix)
    cand = (itemsets.filter(F.col("size") >= 2)
                    .withColumn("_cons", F.filter("items", is_c))
                    .filter(F.size("_cons") == 1)
                    .select(F.array_join(F.filter("items", lambda x: ~is_c(x)), ", ").alias("antecedents"),
                            F.get(F.col("_cons"), 0).alias("_c"), F.col("support").alias("s")))
    sup = itemsets.select("itemset", "support")
    j = (cand.join(sup.withColumnRenamed("itemset", "antecedents").withColumnRenamed("support", "sA"), "antecedents")
             .join(sup.withColumnRenamed("itemset", "_c").withColumnRenamed("support", "sC"), "_c"))
    s, sa, sc = F.col("s"), F.col("sA"), F.col("sC")
    conf = s / sa
    lev = s - sa * sc
    out = j.select(
        "antecedents", sa.alias("antecedent_support"), sc.alias("consequent_support"), s.alias("support"),
        conf.alias("confidence"), (conf / sc).alias("lift"), F.lit(1.0).alias("representativity"),
        lev.alias("leverage"), F.try_divide(F.lit(1.0) - sc, F.lit(1.0) - conf).alias("conviction"),
        F.try_divide(lev, F.greatest(s * (F.lit(1.0) - sa), sa * (sc - s))).alias("zhangs_metric"),
        (s / (sa + sc - s)).alias("jaccard"),
        F.try_divide(conf - sc, F.lit(1.0) - sc).alias("certainty"),
        ((s / sa + s / sc) / 2).alias("kulczynski"),
        F.regexp_replace(F.col("_c"), f"^{consequent_prefix}", "").alias("consequent"))
    return out.filter((F.col("lift") >= min_lift) & (F.col("confidence") >= min_confidence))


def fpgrowth_rules(tx: DataFrame, min_support: float = 0.01, min_confidence: float = 0.5,
                   consequent_prefix: str = "congestion_") -> DataFrame:
    """Spark ML's own rule generator (single-item consequents), filtered the same way."""
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(tx)
    r = model.associationRules
    return (r.filter(F.get(F.col("consequent"), 0).startswith(consequent_prefix) & (F.col("lift") >= 1.0))
             .select(_itemset_key(F.col("antecedent")).alias("antecedents"),
                     F.regexp_replace(F.get(F.col("consequent"), 0), f"^{consequent_prefix}", "")
                     .alias("consequent"),
                     "confidence", "lift", "support"))


def _level_ordinal(c: Column) -> Column:
    out = None
    for i, lev in enumerate(CONGESTION_ORDER):
        out = F.when(c == lev, i) if out is None else out.when(c == lev, i)
    return out


def top_rules(rules: DataFrame, n: int = 15) -> DataFrame:
    """Top n by lift (antecedents as tie-break): a TakeOrdered, no full sort."""
    return (rules.orderBy(F.col("lift").desc(), "antecedents", "consequent").limit(n)
                 .select(F.col("antecedents").alias("antecedents_readable"), "consequent", "support",
                         "confidence", "lift"))


def best_rule_per_level(rules: DataFrame) -> DataFrame:
    """Highest-lift rule per congestion level (first antecedent on ties), level order."""
    best = rules.groupBy("consequent").agg(
        F.min_by("antecedents", F.struct(-F.col("lift"), F.col("antecedents"))).alias("_a"))
    out = rules.join(best.select("consequent", F.col("_a").alias("antecedents")), ["consequent", "antecedents"])
    return out.select("consequent", "antecedents", "support", "confidence", "lift",
                      _level_ordinal(F.col("consequent")).alias("level_order")).orderBy("level_order")


def _phrase_map() -> Column:
    pairs = []
    for col, m in PHRASES.items():
        for value, phrase in m.items():
            pairs += [F.lit(f"{col}_{value}"), F.lit(phrase)]
    return F.create_map(*pairs)


def explain_rules(rules: DataFrame) -> DataFrame:
    """Sentence per rule from the phrase table; items in sorted order (the
    reference iterates a set, so its clause order is not specified)."""
    pm = _phrase_map()
    items = F.split(F.col("antecedents"), ", ")
    clause = F.transform(items, lambda it: F.coalesce(pm[it], F.regexp_replace(it, "_(?=[^_]*$)", "=")))
    text = F.format_string(
        RULE_SENTENCE, F.array_join(clause, " and "), F.col("consequent"), F.col("confidence") * 100, F.col("lift"),
        F.col("support") * 100)
    return rules.withColumn("explanation", text)


def matching_risk_rule(rules: DataFrame, day_type: str, weather_tier: str | None = None,
                       levels: Sequence[str] = ("High", "Severe"), min_lift: float = 2.0) -> DataFrame:
    """Highest-lift rule whose antecedent mentions the day type (and, if given,
    the weather tier) and whose consequent is a high congestion level."""
    items = F.split(F.col("antecedents"), ", ")
    pred = F.array_contains(items, f"weekday_type_{day_type}") & F.col("consequent").isin(list(levels)) \
        & (F.col("lift") >= min_lift)
    if weather_tier:
        pred = pred & F.array_contains(items, f"weather_{weather_tier}")
    return rules.filter(pred).orderBy(F.col("lift").desc(), "antecedents").limit(1)
