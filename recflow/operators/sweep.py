"""Signal-weight sweep (O1, O2) and model comparison.

Every configuration is evaluated in **one** job: the ranking frame is
expanded by a K-element literal array of configs (K fixed by a parameter),
the hybrid signal is recomputed per config as a column expression, and M9 is
grouped by (config, user).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.functions.weights import SIGNAL_KEYS
from recflow.operators.hybrid import BASELINE_SCORE_COLUMNS, ORDER_DIGITS, hybrid_signal
from recflow.operators.metrics import grouped_ranking, intra_list_diversity

# Draw ranges of the five weights and the similarity threshold.
WEIGHT_RANGES = {"cf": (0.05, 1.0), "embedding": (0.05, 1.0), "price": (0.05, 0.6), "style": (0.05, 0.6),
                 "ctr": (0.05, 0.8)}
THRESHOLD_RANGE = (0.10, 0.60)
_BASES = (2, 3, 5, 7, 11, 13)


def _radical_inverse(i: int, base: int) -> float:
    f, r = 1.0, 0.0
    while i > 0:
        f /= base
        r += f * (i % base)
        i //= base
    return r


def draw_configs(n: int, seed: int = 42) -> list[dict]:
    """O1: n configurations from a scrambled-offset Halton sequence (exactly
    repeatable); weights normalised with P17."""
    out = []
    for i in range(n):
        u = [_radical_inverse(i + 1 + seed, b) for b in _BASES]
        raw = {k: lo + (hi - lo) * u[j] for j, (k, (lo, hi)) in enumerate(WEIGHT_RANGES.items())}
        t_lo, t_hi = THRESHOLD_RANGE
        whole = sum(raw.values())  # the ranges are positive
        out.append({"config_id": i, **{f"w_{k}": raw[k] / whole for k in SIGNAL_KEYS},
                    "similarity_threshold": t_lo + (t_hi - t_lo) * u[5]})
    return out


def config_struct_array(configs: list[dict]):
    return F.array(*[F.struct(F.lit(c["config_id"]).cast("bigint").alias("config_id"),
                              *[F.lit(float(c[f"w_{k}"])).alias(f"w_{k}") for k in SIGNAL_KEYS],
                              F.lit(float(c["similarity_threshold"])).alias("similarity_threshold"))
                     for c in configs])


def evaluate_configs(frame: DataFrame, configs: list[dict], ks=(5, 10)) -> DataFrame:
    """O2 (signal part): metrics of the re-blended hybrid score per config."""
    x = frame.select("user_id", "product_id", "label", "cf_score", "embedding_similarity",
                     "price_sensitivity_match", "style_affinity_score", "historical_ctr",
                     F.explode(config_struct_array(configs)).alias("cfg")).select("*", "cfg.*").drop("cfg")
    x = x.withColumn("hybrid_signal_score", hybrid_signal(w_prefix="w_"))
    m = grouped_ranking(x, "hybrid_signal_score", ks, by=["config_id"])
    cfg = frame.sparkSession.createDataFrame(
        [tuple([c["config_id"]] + [float(c[f"w_{k}"]) for k in SIGNAL_KEYS] + [float(c["similarity_threshold"])])
         for c in configs],
        "config_id long, " + ", ".join(f"w_{k} double" for k in SIGNAL_KEYS) + ", similarity_threshold double")
    return F.broadcast(cfg).join(m, "config_id")


def best_config(results: DataFrame, metric: str = "ndcg_at_5") -> dict:
    """Highest validation metric, ties by config id (one row to the driver)."""
    row = results.orderBy(F.col(metric).desc(), F.col("config_id")).first()
    return row.asDict()


def compare_models(test_frame: DataFrame, catalog: DataFrame, ranker_col: str | None = "ranker_score",
                   ks=(5, 10)) -> DataFrame:
    """Baselines and the ranker on the test split as rows
    (model, metric, value), plus the ranker's lift over the best baseline
    for precision@5 and ndcg@5 (absolute and relative %, denominator floored
    at 1e-8)."""
    from pyspark.sql import Window
    models = dict(BASELINE_SCORE_COLUMNS)
    if ranker_col:
        models["ltr_hybrid"] = ranker_col
    rows = None
    for name, col in models.items():
        m = grouped_ranking(test_frame, col, ks)
        w = Window.partitionBy("user_id").orderBy(F.round(col, ORDER_DIGITS).desc(), F.col("product_id"))
        lists = test_frame.withColumn("rank", F.row_number().over(w)).select("user_id", "product_id", "rank")
        div = intra_list_diversity(lists, catalog, 5).agg(F.round(F.avg("diversity"), 4).alias("value"))
        longm = m.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                                             for c in m.columns])).alias("kv")).select("kv.*")
        part = longm.unionByName(div.select(F.lit("diversity_at_5").alias("metric"), "value")) \
            .select(F.lit(name).alias("model"), "metric", "value")
        rows = part if rows is None else rows.unionByName(part)
    if not ranker_col:
        return rows
    base = rows.where(F.col("model") != "ltr_hybrid").groupBy("metric").agg(F.max("value").alias("best"))
    ltr = rows.where(F.col("model") == "ltr_hybrid").select("metric", F.col("value").alias("ltr"))
    lift = ltr.join(base, "metric").where(F.col("metric").isin("precision_at_5", "ndcg_at_5"))
    abs_l = lift.select(F.lit("lift_abs").alias("model"), "metric", F.round(F.col("ltr") - F.col("best"), 4).alias("value"))
    rel_l = lift.select(F.lit("lift_pct").alias("model"), "metric",
                        F.round((F.col("ltr") - F.col("best")) / F.greatest(F.col("best"), F.lit(1e-8)) * 100, 2)
                        .alias("value"))
    return rows.unionByName(abs_l).unionByName(rel_l)
