"""Hybrid recommender: candidate pools, feature frame, signal blend and
ranking for whole user tables (R17-R23, M18, M20)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recflow.functions.numeric import gate
from recflow.functions.weights import DEFAULT_SIGNAL_WEIGHTS, signal_weights
from recflow.operators import cf as CF, text_index as TI
from recflow.operators import content as C
from recflow.operators import item_stats as S
from recflow.operators import preferences as P
from recflow.operators import ranking_data as RD
from recflow.session import cut_lineage

# The 11 ranker features, in order.
FEATURE_COLUMNS = (
    "cf_score", "embedding_similarity", "price_delta_from_user_avg", "price_sensitivity_match",
    "category_match_score", "material_preference_score", "style_affinity_score", "historical_ctr",
    "purchase_history_count", "interaction_history_count", "hybrid_signal_score",
)
# Baseline models and the score column each ranks by.
BASELINE_SCORE_COLUMNS = {"cf_only": "cf_score", "content_only": "embedding_similarity",
                          "heuristic_hybrid": "hybrid_signal_score"}
ORDER_DIGITS = 9
SERVING_COLUMNS = ("rank", "product_id", "title", "category", "material", "style", "price", "cf_score",
                   "embedding_similarity", "price_sensitivity_match", "historical_ctr", "hybrid_signal_score",
                   "ltr_score")


@dataclass
class FittedModels:
    """R16 + R5 + A8 fitted once over an interaction table (R23: the tables
    are the model; ``tuning`` stores and loads them)."""
    interactions: DataFrame
    catalog: DataFrame          # unit vectors attached (product_id, ..., embedding)
    cf: CF.CFModel
    stats: DataFrame
    price_profile: DataFrame
    shares: DataFrame
    counts: DataFrame
    seeds: DataFrame
    purchased: DataFrame
    global_avg_price: float


def fit_models(interactions: DataFrame, catalog: DataFrame) -> FittedModels:
    """Every table is written once to the checkpoint folder: later steps read it from there, and nothing
    stays in the executors' memory after its last use."""
    inter, catalog = cut_lineage(interactions), cut_lineage(catalog)
    return FittedModels(
        interactions=inter,
        catalog=catalog,
        cf=CF.fit_cf(inter),
        stats=cut_lineage(S.item_stats(inter)),
        price_profile=cut_lineage(P.user_price_profile(inter, catalog)),
        shares=cut_lineage(P.attribute_share(inter, catalog)),
        counts=cut_lineage(P.history_counts(inter)),
        seeds=cut_lineage(P.seed_items(inter, 5)),
        purchased=cut_lineage(P.purchased_items(inter)),
        global_avg_price=P.global_avg_price(catalog),
    )


def hybrid_signal(weights: dict[str, float] | None = None, threshold: float = 0.0, w_prefix: str | None = None):
    """Sum of weight x (cf, gated embedding, price match, style, ctr).
    With ``w_prefix`` the weights and threshold come from config columns."""
    if w_prefix is None:
        w = signal_weights(weights)
        t = F.lit(float(threshold))
    else:
        w = {k: F.col(w_prefix + k) for k in DEFAULT_SIGNAL_WEIGHTS}
        t = F.col("similarity_threshold")
    return (w["cf"] * F.col("cf_score") + w["embedding"] * gate("embedding_similarity", t)
            + w["price"] * F.col("price_sensitivity_match") + w["style"] * F.col("style_affinity_score")
            + w["ctr"] * F.col("historical_ctr"))


def feature_frame(models: FittedModels, candidates: DataFrame, weights: dict[str, float] | None = None,
                  threshold: float = 0.0, query_scores: DataFrame | None = None) -> DataFrame:
    """Candidate rows (user_id, product_id, ...) with the catalog fields
    (J6: unknown ids keep null fields), the 11 features and query_similarity.
    Every input is joined on its key, those of the pair first and the wide ones of the product and the user once each; all
    per-candidate work stays in the candidate table (pool-sized per user)."""
    pairs = candidates.select("user_id", "product_id")
    cat = models.catalog.select("product_id", "title", "category", "material", "color", "style", "price", "rating",
                                "description", "catalog_description")
    f = candidates.join(CF.cf_scores(models.cf, pairs), ["user_id", "product_id"], "left")
    hist = C.pair_similarity(models.seeds, pairs, models.catalog, pairs.count())
    f = f.join(hist.select("user_id", "product_id", F.col("embedding_similarity").alias("_hist")),
               ["user_id", "product_id"], "left")
    if query_scores is not None:
        f = f.join(query_scores.select("user_id", "product_id", "query_similarity"), ["user_id", "product_id"], "left")
        f = f.fillna({"query_similarity": 0.0})
    else:
        f = f.withColumn("query_similarity", F.lit(0.0))
    f = f.withColumn("embedding_similarity", F.greatest(F.coalesce("_hist", F.lit(0.0)), F.col("query_similarity"))) \
        .drop("_hist")
    f = S.ctr_for_candidates(models.stats, f.join(cat, "product_id", "left"))
    f = P.profile_features(f, models.price_profile, models.shares, models.counts, models.global_avg_price)
    return f.withColumn("hybrid_signal_score", hybrid_signal(weights, threshold))


def candidate_pool(models: FittedModels, users: DataFrame, pool: int = 50, index: TI.TextIndex | None = None,
                   queries: DataFrame | None = None) -> DataFrame:
    """R18 for a user table: CF (max(pool/2, 10)), history content (same), query content (same, for
    users with a text in ``queries``), item statistics (max(pool/4, 10)), each without the user's
    purchases; ordered union cut at ``pool`` (U2)."""
    users = users.select("user_id").distinct()
    half, quarter = max(pool // 2, 10), max(pool // 4, 10)
    ex = models.purchased.join(users, "user_id", "left_semi")
    cf = CF.cf_recommend(models.cf, users, half, exclude=ex)
    ct = C.recommend_from_history(models.seeds, users, models.catalog, half, exclude=ex, min_similarity=0.0)
    st = S.item_stats_recommend(models.stats, users, quarter, exclude=ex)
    asked = [] if queries is None else [TI.recommend_from_query(index, queries, half, exclude=ex)]
    # the pool is re-read by every feature join: pin it in the shared checkpoint folder
    return cut_lineage(RD.ordered_union([cf, ct, *asked, st], pool))


def rank_frame(frame: DataFrame, ranker_score: str | None = None) -> DataFrame:
    """With a ranker score: (ltr, hybrid, ctr) desc; else
    ``ltr_score = hybrid`` and (hybrid, ctr, cf) desc; ties by id."""
    r = lambda c: F.round(c, ORDER_DIGITS).desc()  # noqa: E731  (stable order under float noise)
    if ranker_score is None:
        frame = frame.withColumn("ltr_score", F.col("hybrid_signal_score"))
        order = [r("hybrid_signal_score"), r("historical_ctr"), r("cf_score")]
    else:
        frame = frame.withColumn("ltr_score", F.col(ranker_score))
        order = [r("ltr_score"), r("hybrid_signal_score"), r("historical_ctr")]
    w = Window.partitionBy("user_id").orderBy(*order, F.col("product_id"))
    return frame.withColumn("rank", F.row_number().over(w).cast("bigint"))


def hybrid_topk(models: FittedModels, users: DataFrame, k: int = 5, weights: dict[str, float] | None = None,
                threshold: float = 0.0, ranker=None, index: TI.TextIndex | None = None,
                queries: DataFrame | None = None) -> DataFrame:
    """Pool max(10k, 40) -> features -> rank -> first k, 13 columns.  ``queries`` (user_id, text): what
    users ask for, scored by the text index; users without a row are served from their history."""
    pool = candidate_pool(models, users, max(k * 10, 40), index, queries)
    pairs = pool.select("user_id", "product_id")
    scores = None if queries is None else TI.candidate_scores(index, queries, pairs)
    frame = feature_frame(models, pairs, weights, threshold, scores)
    score = None
    if ranker is not None:
        frame = ranker.score(frame)
        score = "ranker_score"
    ranked = rank_frame(cut_lineage(frame), score).where(F.col("rank") <= k)
    return ranked.select("user_id", *SERVING_COLUMNS)


def training_candidates(models: FittedModels, targets: DataFrame, catalog_ids: DataFrame, seed: int = 42,
                        cf_top_k: int = 25, content_top_k: int = 25, popularity_top_k: int = 10,
                        negatives: int = 25) -> DataFrame:
    """Positive + CF + history content + item-stats popularity (not
    purchase-filtered) + random negatives, ordered-union deduped.
    Exclusions are the earlier purchases minus the positive (U4)."""
    users = targets.select("user_id")
    pos = targets.select("user_id", F.col("target_product_id").alias("product_id"), F.lit(1).cast("bigint").alias("rank"))
    ex = models.purchased.join(users, "user_id", "left_semi") \
        .join(pos.select("user_id", "product_id"), ["user_id", "product_id"], "left_anti")
    cf = CF.cf_recommend(models.cf, users, cf_top_k, exclude=ex)
    ct = C.recommend_from_history(models.seeds, users, models.catalog, content_top_k, exclude=ex, min_similarity=0.0)
    pop = S.item_stats_recommend(models.stats, users, popularity_top_k, exclude=None)
    # written once: the random negatives and the union both read it
    hard = cut_lineage(RD.ordered_union([pos, cf, ct, pop]))
    knocked = ex.unionByName(pos.select("user_id", "product_id")) \
        .unionByName(hard.select("user_id", "product_id"))
    rnd = RD.random_negatives(users, catalog_ids, knocked, negatives, seed)
    return cut_lineage(RD.ordered_union([hard.withColumnRenamed("position", "rank"), rnd]))


def ranking_frame(models: FittedModels, targets_split: DataFrame, catalog_ids: DataFrame, seed: int = 42,
                  **pool_args) -> DataFrame:
    """Ranking frame: candidates + features (default weights, threshold 0) +
    label / split / target columns (M20)."""
    cands = training_candidates(models, targets_split, catalog_ids, seed, **pool_args)
    frame = cut_lineage(feature_frame(models, cands.select("user_id", "product_id"), DEFAULT_SIGNAL_WEIGHTS, 0.0))
    t = targets_split.select("user_id", "split", F.col("target_product_id"))
    return frame.join(t, "user_id").withColumn(
        "label", (F.col("product_id") == F.col("target_product_id")).cast("int"))
