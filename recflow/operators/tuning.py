"""Tuning, serving and stored models.

``tune``   best blend by ndcg@5 on the validation users, with it the ranker's parameters by successive halving,
           ranker refit on train + val, one comparison on the test users, ranker refit on everybody;
``save`` / ``load``   the fitted tables, the blend, the threshold and the ranker as Parquet tables in one folder;
``serve``  hybrid top-k from a stored model, ordered by its ranker.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.functions.weights import SIGNAL_KEYS
from recflow.operators import cf as CF, hybrid as H, ranker as RK, ranker_search as RS, sweep as SW

#: tables of a fitted model, by the name of the folder they are stored in
MODEL_TABLES = ("interactions", "catalog", "stats", "price_profile", "shares", "counts", "seeds", "purchased")
CF_TABLES = ("matrix", "left", "gram", "popularity")


@dataclass
class Tuned:
    weights: dict[str, float]
    threshold: float
    ranker: RK.PairwiseRanker
    validation: DataFrame | None = None
    test: DataFrame | None = None
    trials: DataFrame | None = None
    setting: dict | None = None


def blended(frame: DataFrame, weights: dict[str, float], threshold: float) -> DataFrame:
    return frame.withColumn("hybrid_signal_score", H.hybrid_signal(weights, threshold))


def tune(frame: DataFrame, catalog: DataFrame, trials: int = 20, seed: int = 42, ranker_trials: int = 8) -> Tuned:
    """``frame``: the ranking frame with ``split`` and ``label``; ``trials`` blends, ``ranker_trials`` ranker settings."""
    results = SW.evaluate_configs(frame.where(F.col("split") == "val"), SW.draw_configs(trials, seed))
    best = SW.best_config(results)
    weights, threshold = {k: best[f"w_{k}"] for k in SIGNAL_KEYS}, best["similarity_threshold"]
    mixed = blended(frame, weights, threshold)
    setting, tried = RS.successive_halving(mixed, RS.draw_parameters(ranker_trials, seed), seed=seed)
    first = RS.fit_ranker(mixed.where(F.col("split") != "test"), setting)
    test = SW.compare_models(first.score(mixed.where(F.col("split") == "test")), catalog, "ranker_score")
    return Tuned(weights, threshold, RS.fit_ranker(mixed, setting), results, test, tried, setting)


def save(models: H.FittedModels, tuned: Tuned, folder: str) -> None:
    spark = models.interactions.sparkSession
    for name in MODEL_TABLES:
        getattr(models, name).write.mode("overwrite").parquet(f"{folder}/{name}")
    for name in CF_TABLES:
        getattr(models.cf, name).write.mode("overwrite").parquet(f"{folder}/cf_{name}")
    facts = [("global_avg_price", float(models.global_avg_price)), ("n_users", float(models.cf.n_users)),
             ("n_items", float(models.cf.n_items)), ("threshold", float(tuned.threshold))]
    facts += [(f"w_{k}", float(v)) for k, v in tuned.weights.items()]
    facts += [(f"c_{k}", float(v)) for k, v in tuned.ranker.coefficients.items()]
    spark.createDataFrame(facts, "name string, value double").write.mode("overwrite").parquet(f"{folder}/facts")


def load(spark: SparkSession, folder: str) -> tuple[H.FittedModels, Tuned]:
    facts = {r["name"]: r["value"] for r in spark.read.parquet(f"{folder}/facts").collect()}
    tables = {n: spark.read.parquet(f"{folder}/{n}") for n in MODEL_TABLES}
    cf = CF.CFModel(**{n: spark.read.parquet(f"{folder}/cf_{n}") for n in CF_TABLES},
                    n_users=int(facts["n_users"]), n_items=int(facts["n_items"]))
    ranker = RK.PairwiseRanker({c: facts[f"c_{c}"] for c in H.FEATURE_COLUMNS})
    tuned = Tuned({k: facts[f"w_{k}"] for k in SIGNAL_KEYS}, facts["threshold"], ranker)
    return H.FittedModels(**tables, cf=cf, global_avg_price=facts["global_avg_price"]), tuned


def serve(models: H.FittedModels, tuned: Tuned, users: DataFrame, k: int = 5, **query) -> DataFrame:
    return H.hybrid_topk(models, users, k, tuned.weights, tuned.threshold, tuned.ranker, **query)
