"""Feature attributions and their summaries.

For a linear model f(x) = b + Σ wⱼxⱼ with independent features the exact
Shapley values are φⱼ = wⱼ·(xⱼ − E[xⱼ]) and the base value is f(E[x]); this is
pure column arithmetic with one broadcast one-row table of means. Group
importance is a single aggregate over the wide attribution table, unpivoted.
"""
from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_corr

# --- fixed values: sentences, plain-language labels and groups of the forecast features --
CYCLICAL_SENTENCE = (
    "%d. **%s** -- mean |SHAP| impact of %s veh/hr. This is a cyclical (sine/cosine) encoding, so its effect "
    "on the forecast depends on which specific hour/day it represents rather than a single 'higher is more' direction.")
LINEAR_SENTENCE = (
    "%d. **%s** -- mean |SHAP| impact of %s veh/hr. Higher values of this feature %s (Pearson correlation "
    "between feature value and SHAP value: r=%+.2f).")
FEATURE_GROUPS = {
    "lag_1": ("traffic volume one hour earlier", ["lag_1"], False),
    "lag_24": ("traffic volume 24 hours earlier (same hour, previous day)", ["lag_24"], False),
    "roll_mean_6": ("average traffic over the past 6 hours", ["roll_mean_6"], False),
    "roll_mean_24": ("average traffic over the past 24 hours", ["roll_mean_24"], False),
    "hour_of_day": ("hour of day (cyclical encoding)", ["hour_sin", "hour_cos"], True),
    "day_of_week": ("day of week (cyclical encoding)", ["dow_sin", "dow_cos"], True),
    "is_weekend": ("whether it's a weekend", ["is_weekend"], False),
    "holiday_flag": ("whether it's a recognized holiday", ["holiday_flag"], False),
    "temp_zscore": ("temperature (standardized)", ["temp_zscore"], False),
    "is_precipitating": ("whether it's raining/snowing", ["is_precipitating"], False),
    "is_severe_weather": ("whether there's severe weather (thunderstorm/squall)", ["is_severe_weather"], False),
    "is_low_visibility": ("whether visibility is reduced (fog/mist/haze/smoke)", ["is_low_visibility"], False),
}
# -----------------------------------------------------------------------------

#: Leaves of a tree that are worked on at a time.
LEAVES = 512


def linear_attribution(df: DataFrame, weights: Mapping[str, float], intercept: float = 0.0,
                       prefix: str = "phi_") -> DataFrame:
    """Adds φ per feature, ``base_value`` and ``prediction`` (= base + Σφ)."""
    feats = list(weights)
    means = df.agg(*[F.avg(f).alias(f"_m_{f}") for f in feats])
    out = df.crossJoin(F.broadcast(means))
    phi = {f"{prefix}{f}": F.lit(float(weights[f])) * (F.col(f) - F.col(f"_m_{f}")) for f in feats}
    base = F.lit(float(intercept))
    for f in feats:
        base = base + F.lit(float(weights[f])) * F.col(f"_m_{f}")
    out = out.withColumns(phi).withColumn("base_value", base)
    total = F.col("base_value")
    for k in phi:
        total = total + F.col(k)
    return out.withColumn("prediction", total).drop(*[f"_m_{f}" for f in feats])


def group_importance(attr: DataFrame, groups: Mapping[str, tuple[str, Sequence[str], bool]],
                     prefix: str = "phi_") -> DataFrame:
    """Per group: mean |Σφ| (paired sin/cos summed), and for non-cyclical groups
    the correlation between the feature value and its φ (NULL for a constant
    feature) with the direction it implies; sorted by importance."""
    aggs, rows = [], []
    for gid, (label, cols, cyclical) in groups.items():
        s = None
        for c in cols:
            s = F.col(f"{prefix}{c}") if s is None else s + F.col(f"{prefix}{c}")
        aggs.append(F.avg(F.abs(s)).alias(f"_ma_{gid}"))
        if not cyclical:
            aggs.append(safe_corr(F.col(cols[0]).cast("double"), s).alias(f"_r_{gid}"))
        rows.append((gid, label, cyclical))
    wide = attr.agg(*aggs)
    parts = []
    for gid, label, cyclical in rows:
        r = F.lit(None).cast("double") if cyclical else F.col(f"_r_{gid}")
        parts.append(F.struct(F.lit(gid).alias("feature_group"), F.lit(label).alias("label"),
                              F.col(f"_ma_{gid}").alias("mean_abs_shap"), r.alias("correlation_with_shap"),
                              F.when(r > 0, "higher").when(r.isNotNull(), "lower").alias("direction"),
                              F.lit(cyclical).alias("cyclical")))
    out = wide.select(F.explode(F.array(*parts)).alias("g")).select("g.*")
    return out.orderBy(F.col("mean_abs_shap").desc(), "feature_group")


def top_drivers_text(importance: DataFrame, top_n: int = 6) -> DataFrame:
    ranked = importance.orderBy(F.col("mean_abs_shap").desc(), "feature_group").limit(top_n)
    from pyspark.sql import Window
    ranked = ranked.withColumn("rank", F.row_number().over(Window.orderBy(F.col("mean_abs_shap").desc(),
                                                                          "feature_group")))
    phrase = F.when(F.col("direction") == "higher", "push the forecast UP") \
              .when(F.col("direction") == "lower", "push the forecast DOWN") \
              .otherwise("have an unclear directional effect")
    cyc = F.format_string(
        CYCLICAL_SENTENCE, "rank", "label", F.format_number("mean_abs_shap", 0))
    lin = F.format_string(
        LINEAR_SENTENCE, "rank", "label", F.format_number("mean_abs_shap", 0),
        phrase, F.coalesce("correlation_with_shap", F.lit(0.0)))
    return ranked.select("rank", "feature_group", F.when(F.col("cyclical"), cyc).otherwise(lin).alias("sentence"))


# ------------------------------------------------------------ TreeSHAP ------
#
# Exact path-dependent TreeSHAP (Lundberg, Erion & Lee, "Consistent
# individualized feature attribution for tree ensembles", 2018), written in
# a leaf-wise form: for a leaf with unique path features U, zero fractions z_j
# (share of the training weight following the path's branches on j) and
# one fractions o_j(x) ∈ {0, 1} (x satisfies the path's conditions on j),
#   φ_i += v_leaf · (o_i − z_i) · Σ_s q_s · s!(|U|−1−s)!/|U|!,
# where q(t) = Π_{j∈U, j≠i} (z_j + o_j t). The product over U is built once
# per leaf and each factor divided out again, vectorised over rows × leaves.
# The trees come from the saved model's node table (model-sized, broadcast).

def forest_arrays(model, spark, classification: bool = False) -> dict:
    """Per-tree leaf arrays from a fitted tree-ensemble model (RandomForest /
    DecisionTree / GBT, regression or binary classification)."""
    import numpy as np

    from ..sources.io import shared_path
    path = shared_path(spark, "forest")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").toPandas()
    try:
        meta = spark.read.parquet(f"{path}/treesMetadata").toPandas()
        weights = {int(r[0]): float(r[2]) for r in meta.itertuples(index=False)}
    except Exception:  # noqa: BLE001 - single trees have no metadata table
        weights = {}
    trees = []
    for tid, g in nodes.groupby("treeID"):
        by_id = {int(r.id): r for r in g.itertuples(index=False)}

        def cover(r):
            s = list(r.impurityStats)
            return float(sum(s)) if classification else float(s[0])

        def value(r):
            if classification:
                s = list(r.impurityStats)
                return float(s[1]) / float(sum(s)) if sum(s) else 0.0
            return float(r.prediction)

        leaves = []
        stack = [(0, [])]
        while stack:
            nid, path = stack.pop()
            r = by_id[nid]
            if r.leftChild < 0:
                leaves.append((value(r), cover(r), path))
                continue
            sp = r.split if isinstance(r.split, dict) else r.split.asDict()
            f = int(sp["featureIndex"])
            thr = float(list(sp["leftCategoriesOrThreshold"])[0])
            c = cover(r)
            left, right = by_id[int(r.leftChild)], by_id[int(r.rightChild)]
            stack.append((int(r.leftChild), path + [(f, thr, True, cover(left) / c)]))
            stack.append((int(r.rightChild), path + [(f, thr, False, cover(right) / c)]))
        root_cover = cover(by_id[0])
        uniq = []
        for v, cv, path in leaves:
            feats: dict[int, list] = {}
            for f, thr, is_left, frac in path:
                lo, hi, z = feats.get(f, [-np.inf, np.inf, 1.0])
                if is_left:
                    hi = min(hi, thr)
                else:
                    lo = max(lo, thr)
                feats[f] = [lo, hi, z * frac]
            uniq.append((v, cv, feats))
        n_leaves = len(uniq)
        depth = max([len(u[2]) for u in uniq] + [1])
        feat = np.zeros((n_leaves, depth), dtype=np.int64)
        lo = np.full((n_leaves, depth), -np.inf)
        hi = np.full((n_leaves, depth), np.inf)
        z = np.ones((n_leaves, depth))
        valid = np.zeros((n_leaves, depth), dtype=bool)
        u = np.zeros(n_leaves, dtype=np.int64)
        v = np.zeros(n_leaves)
        base = 0.0
        for li, (val, cv, feats) in enumerate(uniq):
            v[li] = val
            base += val * cv / root_cover
            u[li] = len(feats)
            for d, (f, (a, b, zz)) in enumerate(sorted(feats.items())):
                feat[li, d], lo[li, d], hi[li, d], z[li, d], valid[li, d] = f, a, b, zz, True
        w = np.zeros((n_leaves, depth))
        for li in range(n_leaves):
            uu = int(u[li])
            for s in range(uu):
                w[li, s] = math.factorial(s) * math.factorial(uu - 1 - s) / math.factorial(uu)
        trees.append({"feat": feat, "lo": lo, "hi": hi, "z": z, "valid": valid, "v": v, "w": w, "base": base,
                      "weight": weights.get(int(tid), 1.0)})
    return {"trees": trees}


def tree_shap_batch(x, forest: dict, n_features: int, average: bool = True, chunk: int = 256):
    """(φ [n × p], base value, model output [n]) for rows ``x`` [n × p]."""
    import numpy as np
    trees = forest["trees"]
    n = x.shape[0]
    phi = np.zeros((n, n_features))
    out = np.zeros(n)
    total_w = sum(t["weight"] for t in trees) if average else 1.0
    base = sum(t["weight"] * t["base"] for t in trees) / total_w
    for start in range(0, n, chunk):
        xs = x[start:start + chunk]
        for t in trees:
            for block in leaf_blocks(t):
                add_leaves(block, xs, phi[start:start + chunk], out[start:start + chunk], t["weight"] / total_w)
    return phi, base, out


def leaf_blocks(t: dict) -> Iterator[dict]:
    """A tree's leaves, at most ``LEAVES`` at a time: the sums of a leaf do not depend on the others."""
    for a in range(0, len(t["v"]), LEAVES):
        yield {k: t[k][a:a + LEAVES] for k in ("feat", "z", "valid", "v", "w", "lo", "hi")}


def add_leaves(t: dict, xs, phi, out, scale: float) -> None:
    """Add the φ and the output of some leaves to those of the rows ``xs``; arrays of rows × LEAVES × depth at most."""
    import numpy as np
    n_features = phi.shape[1]
    m = xs.shape[0]
    feat, z, valid, v, w = t["feat"], t["z"], t["valid"], t["v"], t["w"]
    n_leaves, depth = feat.shape
    xv = xs[:, feat]                                            # m × L × D
    o = ((xv > t["lo"]) & (xv <= t["hi"]) & valid).astype(float)
    poly = np.zeros((m, n_leaves, depth + 1))
    poly[:, :, 0] = 1.0
    for d in range(depth):
        zd = np.where(valid[:, d], z[:, d], 1.0)[None, :, None]
        nxt = zd * poly
        nxt[:, :, 1:] += o[:, :, d][:, :, None] * poly[:, :, :-1]
        poly = nxt
    out += scale * (np.prod(np.where(valid, o, 1.0), axis=2) @ v)
    for i in range(depth):
        zi = z[:, i][None, :]
        oi = o[:, :, i]
        q_one = np.zeros((m, n_leaves, depth))
        q_one[:, :, depth - 1] = poly[:, :, depth]
        for k in range(depth - 1, 0, -1):
            q_one[:, :, k - 1] = poly[:, :, k] - zi * q_one[:, :, k]
        q_zero = poly[:, :, :depth] / zi[:, :, None]
        q = np.where(oi[:, :, None] > 0, q_one, q_zero)
        s = np.einsum("mld,ld->ml", q, w)
        contrib = np.where(valid[:, i][None, :], (oi - zi) * s * v[None, :], 0.0) * scale
        onehot = np.zeros((n_leaves, n_features))
        onehot[np.arange(n_leaves), feat[:, i]] = 1.0
        phi += contrib @ onehot


def tree_attribution(df: DataFrame, model, features: Sequence[str], keep: Sequence[str] = (),
                     classification: bool = False, prefix: str = "phi_") -> DataFrame:
    """Exact TreeSHAP values per row as a Spark job: ``mapInPandas`` over the
    rows with the model's leaf arrays broadcast (model-sized, not data-sized).
    Adds φ per feature, ``base_value`` and ``tree_output`` (= base + Σφ)."""
    spark = df.sparkSession
    forest = spark.sparkContext.broadcast(forest_arrays(model, spark, classification))
    feats = list(features)
    keep = list(keep)
    schema_fields = [f for f in df.select(*keep).schema.fields]
    from pyspark.sql.types import DoubleType, StructField, StructType
    schema = StructType(schema_fields + [StructField(f"{prefix}{c}", DoubleType()) for c in feats]
                        + [StructField("base_value", DoubleType()), StructField("tree_output", DoubleType())])

    def run(batches):
        fo = forest.value
        for pdf in batches:
            x = pdf[feats].to_numpy(dtype=float)
            phi, base, out = tree_shap_batch(x, fo, len(feats))
            res = pdf[keep].copy()
            for j, c in enumerate(feats):
                res[f"{prefix}{c}"] = phi[:, j]
            res["base_value"] = base
            res["tree_output"] = out
            yield res

    return df.select(*dict.fromkeys(keep + feats)).mapInPandas(run, schema)
