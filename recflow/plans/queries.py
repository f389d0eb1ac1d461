"""Registered queries: each ``(spark, sf_dir) -> DataFrame`` over the whole
driver tables.  Floating outputs are rounded to 6 decimals (the SQL oracle
rounds the same way); every computed column carries an explicit alias."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recflow.operators import clean, interactions as I, item_stats as S, preferences as P, profile as V, rfm as R
from recflow.session import cut_lineage
from recflow.sources import tables as src

EVENTS_REFERENCE_DATE = "2024-01-31"
ORDERS_REFERENCE_DATE = "2001-08-02"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _interactions(spark, d):
    return I.build_interactions(src.behavior(spark, d))


# --- step 0 / 1: scans, cleaning, profiling ---------------------------------

def q_popularity_topk(spark: SparkSession, d: str) -> DataFrame:
    return rounded(I.popularity_topk(_interactions(spark, d), 10))


def q_event_scores(spark, d):
    return rounded(_interactions(spark, d).select("user_id", "product_id", "event_type", "timestamp", "score"))


def q_product_descriptions(spark, d):
    return rounded(src.catalog(spark, d))


def q_clean_products(spark, d):
    return rounded(clean.clean_products(src.raw_products(spark, d)))


def q_dedupe_events(spark, d):
    return clean.dedupe(src.raw_behavior(spark, d))


def q_null_counts(spark, d):
    p = V.null_counts(src.raw_products(spark, d)).select(F.lit("products").alias("table_name"), "*")
    b = V.null_counts(src.raw_behavior(spark, d)).select(F.lit("behavior").alias("table_name"), "*")
    return p.unionByName(b)


def q_describe_price(spark, d):
    return rounded(V.describe(clean.clean_products(src.raw_products(spark, d))))


def q_value_counts_event(spark, d):
    return V.value_counts(src.behavior(spark, d), "event_type")


def q_price_histogram(spark, d):
    return rounded(V.histogram(src.raw_products(spark, d), "price", 50))


def q_rfm_events(spark, d):
    return rounded(R.rfm(src.behavior(spark, d), EVENTS_REFERENCE_DATE, products=src.raw_products(spark, d)))


def q_rfm_orders(spark, d):
    return rounded(R.rfm(src.order_purchases(spark, d), ORDERS_REFERENCE_DATE))


# --- step 2: item statistics, profiles ---------------------------------------

def q_item_stats(spark, d):
    return rounded(S.item_stats(_interactions(spark, d)))


def q_item_stats_rank(spark, d):
    return rounded(S.item_stats_rank(S.item_stats(_interactions(spark, d)), 20))


def q_user_price_profile(spark, d):
    return rounded(P.user_price_profile(_interactions(spark, d), src.catalog(spark, d)))


def q_attribute_share(spark, d):
    return rounded(P.attribute_share(_interactions(spark, d), src.catalog(spark, d)))


def q_seed_items(spark, d):
    return P.seed_items(_interactions(spark, d), 5)


def q_history_counts(spark, d):
    return P.history_counts(_interactions(spark, d))


def q_user_item_mean(spark, d):
    return rounded(I.user_item_matrix(_interactions(spark, d), "mean"))


def q_user_item_sum(spark, d):
    return rounded(I.user_item_matrix(_interactions(spark, d), "sum"))


def q_user_means(spark, d):
    return rounded(I.user_means(I.user_item_matrix(_interactions(spark, d), "mean")))


QUERIES = {
    "popularity_topk": q_popularity_topk,
    "event_scores": q_event_scores,
    "product_descriptions": q_product_descriptions,
    "clean_products": q_clean_products,
    "dedupe_events": q_dedupe_events,
    "null_counts": q_null_counts,
    "describe_price": q_describe_price,
    "value_counts_event": q_value_counts_event,
    "price_histogram": q_price_histogram,
    "rfm_events": q_rfm_events,
    "rfm_orders": q_rfm_orders,
    "item_stats": q_item_stats,
    "item_stats_rank": q_item_stats_rank,
    "user_price_profile": q_user_price_profile,
    "attribute_share": q_attribute_share,
    "seed_items": q_seed_items,
    "history_counts": q_history_counts,
    "user_item_mean": q_user_item_mean,
    "user_item_sum": q_user_item_sum,
    "user_means": q_user_means,
}


# --- step 3: collaborative filtering -------------------------------------------

from recflow.operators import cf as CF  # noqa: E402


def q_user_cf(spark, d):
    return CF.user_based(_interactions(spark, d), n=10, neighbours=5)


def q_item_cf(spark, d):
    return rounded(CF.item_based(_interactions(spark, d), n=10))


def q_cf_predict_topk(spark, d):
    inter = _interactions(spark, d)
    model = CF.fit_cf(inter)
    users = model.matrix.select("user_id").distinct()
    return rounded(CF.cf_recommend(model, users, n=20))


def popular_candidates(spark, inter, k: int = 20):
    """Candidate rows: every user of the interactions x the k most popular
    products (k fixed by a parameter, expanded from a k-element literal)."""
    top = [r["product_id"] for r in I.popularity_topk(inter, k).select("product_id").collect()]
    arr = F.array(*[F.lit(int(p)).cast("bigint") for p in top])
    return inter.select("user_id").distinct().select("user_id", F.explode(arr).alias("product_id"))


def q_cf_scores(spark, d):
    inter = _interactions(spark, d)
    model = CF.fit_cf(inter)
    return rounded(CF.cf_scores(model, popular_candidates(spark, inter, 20)))


QUERIES.update({
    "user_cf": q_user_cf,
    "item_cf": q_item_cf,
    "cf_predict_topk": q_cf_predict_topk,
    "cf_scores": q_cf_scores,
})


# --- step 4: vectors and search -------------------------------------------------

from recflow.operators import knn as KNN, pairs as PR, search as SE  # noqa: E402


def unit_catalog(spark, d):
    return SE.unit_catalog(src.searchable_catalog(spark, d))


def q_knn_exact(spark, d):
    cat = unit_catalog(spark, d)
    nb = KNN.knn(cat.select("product_id", "embedding"), 10)
    return rounded(nb.select("query_id", "neighbor_id", "rank", "score"))


def q_similar_pairs_top(spark, d):
    cat = unit_catalog(spark, d)
    return rounded(PR.most_similar_pairs(cat, 5))


def q_pair_stats(spark, d):
    return PR.pair_statistics(unit_catalog(spark, d))


def q_filtered_search(spark, d):
    """Every catalog product searches its own category within +-50 of its
    price, itself excluded, k = 5."""
    cat = unit_catalog(spark, d)
    qs = cat.select(F.col("product_id").alias("query_id"), F.col("embedding").alias("vec"), "category",
                    (F.col("price") - 50).alias("min_price"), (F.col("price") + 50).alias("max_price"),
                    F.array(F.col("product_id")).alias("exclude_ids"))
    hits = SE.vector_search(qs, cat, 5)
    return rounded(SE.result_records(hits, cat))


def q_user_content_recs(spark, d):
    cat = unit_catalog(spark, d)
    purchases = P.purchased_items(_interactions(spark, d))
    return SE.user_content_recs(purchases, cat, 5)


QUERIES.update({
    "knn_exact": q_knn_exact,
    "similar_pairs_top": q_similar_pairs_top,
    "pair_stats": q_pair_stats,
    "filtered_search": q_filtered_search,
    "user_content_recs": q_user_content_recs,
})


# --- step 5: metrics --------------------------------------------------------------

from recflow.operators import metrics as M  # noqa: E402


def q_precision_recall_map(spark, d):
    inter = _interactions(spark, d)
    users = inter.select("user_id").distinct()
    pred = S.item_stats_recommend(S.item_stats(inter), users, 10)
    actual = P.purchased_items(inter)
    return rounded(M.list_metrics(pred, actual, 10))


def q_rmse(spark, d):
    m = I.user_item_matrix(_interactions(spark, d), "mean")
    pairs = m.join(I.user_means(m), "user_id").select(F.col("value").alias("actual"),
                                                      F.col("mean_value").alias("predicted"))
    return rounded(M.rmse(pairs))


def _catalog_knn(spark, d, k=10):
    cat = unit_catalog(spark, d)
    return cat, KNN.knn(cat.select("product_id", "embedding"), k)


def q_retrieval_metrics(spark, d):
    cat, nb = _catalog_knn(spark, d, 10)
    return M.retrieval_metrics(nb, cat, (5, 10))


def q_mrr_ndcg(spark, d):
    cat, nb = _catalog_knn(spark, d, 10)
    return rounded(M.per_query_rank_quality(nb, cat, 10))


def q_diversity(spark, d):
    seeds = P.seed_items(_interactions(spark, d), 5).select("user_id", "product_id",
                                                            F.col("recency_rank").alias("rank"))
    return rounded(M.intra_list_diversity(seeds, unit_catalog(spark, d), 5))


QUERIES.update({
    "precision_recall_map": q_precision_recall_map,
    "rmse": q_rmse,
    "retrieval_metrics": q_retrieval_metrics,
    "mrr_ndcg": q_mrr_ndcg,
    "diversity": q_diversity,
})


# --- steps 6-8: ranking data, hybrid, ranker, sweep ---------------------------------

from recflow.operators import hybrid as H, ranker as RK, ranking_data as RD, sweep as SW  # noqa: E402

SEED = 42


def _ranking_setup(spark, d):
    """Fitted ranking inputs; every query builds its own, so none depends on what ran before it."""
    # parsed once: the targets read it several times
    beh = cut_lineage(src.behavior(spark, d))
    targets = RD.assign_splits(RD.holdout_targets(beh), SEED)
    observed = RD.truncate_history(beh, targets)
    models = H.fit_models(I.build_interactions(observed), unit_catalog(spark, d))
    return beh, targets, observed, models.catalog, models


def q_holdout_targets(spark, d):
    return RD.holdout_targets(src.behavior(spark, d))


def q_truncated_events(spark, d):
    beh = src.behavior(spark, d)
    return RD.truncate_history(beh, RD.holdout_targets(beh))


def q_user_split(spark, d):
    return RD.assign_splits(RD.holdout_targets(src.behavior(spark, d)), SEED)


def q_random_negatives(spark, d):
    beh, targets, observed, cat, models = _ranking_setup(spark, d)
    knocked = models.purchased.unionByName(
        targets.select("user_id", F.col("target_product_id").alias("product_id")))
    return RD.random_negatives(targets.select("user_id"), cat.select("product_id"), knocked, 25, SEED)


def q_ranking_candidates_hard(spark, d):
    """Hard candidates of every eligible user: positive, CF 25, history
    content 25, item-stats popularity 10 -- ordered union."""
    beh, targets, observed, cat, models = _ranking_setup(spark, d)
    return _hard_candidates(targets, models)


def q_hybrid_features(spark, d):
    """Feature frame (default weights) over the full training candidate set."""
    frame, cat = _frame_and_targets(spark, d)
    return rounded(frame.select("user_id", "product_id", "split", "label", *H.FEATURE_COLUMNS))


def q_hybrid_topk(spark, d):
    """Heuristic hybrid top-5 for every user of the behaviour table."""
    inter = _interactions(spark, d)
    models = H.fit_models(inter, unit_catalog(spark, d))
    return rounded(H.hybrid_topk(models, models.interactions.select("user_id"), 5))


def _frame_and_targets(spark, d):
    beh, targets, observed, cat, models = _ranking_setup(spark, d)
    return H.ranking_frame(models, targets, cat.select("product_id"), SEED), cat


def q_signal_sweep(spark, d):
    """20 signal configs evaluated on the validation split in one job."""
    frame, cat = _frame_and_targets(spark, d)
    return rounded(SW.evaluate_configs(frame.where(F.col("split") == "val"), SW.draw_configs(20, SEED)))


def q_pairwise_ranker(spark, d):
    """Ranker fit on train+val, model comparison on test."""
    frame, cat = _frame_and_targets(spark, d)
    rk = RK.fit_pairwise(frame.where(F.col("split").isin("train", "val")))
    test = rk.score(frame.where(F.col("split") == "test"))
    return SW.compare_models(test, cat, "ranker_score")


def q_feature_importance(spark, d):
    frame, cat = _frame_and_targets(spark, d)
    train = frame.where(F.col("split").isin("train", "val"))
    return RK.feature_importance(RK.fit_pairwise(train), train)


QUERIES.update({
    "holdout_targets": q_holdout_targets,
    "truncated_events": q_truncated_events,
    "user_split": q_user_split,
    "random_negatives": q_random_negatives,
    "ranking_candidates_hard": q_ranking_candidates_hard,
    "hybrid_features": q_hybrid_features,
    "hybrid_topk": q_hybrid_topk,
    "signal_sweep": q_signal_sweep,
    "pairwise_ranker": q_pairwise_ranker,
    "feature_importance": q_feature_importance,
})


# --- low-rank, ANN, PCA, text search (rows-only; checked by pytest) ---------------

from recflow.operators import ann as ANN, lowrank as LR  # noqa: E402


def q_svd_topk(spark, d):
    return rounded(LR.svd_topk(_interactions(spark, d), 10, 50))


def q_als_topk(spark, d):
    return rounded(LR.als_topk(_interactions(spark, d), 10))


def q_lsh_recall(spark, d):
    return ANN.lsh_report(unit_catalog(spark, d).select("product_id", "embedding"), 10, SEED)


def q_pca_report(spark, d):
    return ANN.pca_report(unit_catalog(spark, d), dims=(16, 32))


QUERIES.update({
    "svd_topk": q_svd_topk,
    "als_topk": q_als_topk,
    "lsh_recall": q_lsh_recall,
    "pca_report": q_pca_report,
})


def q_hybrid_features_hard(spark, d):
    """R19 on the hard training candidates (positive, CF, content, item
    stats) of every eligible user, default weights, with the label."""
    beh, targets, observed, cat, models = _ranking_setup(spark, d)
    hard = _hard_candidates(targets, models)
    frame = H.feature_frame(models, hard.select("user_id", "product_id"), None, 0.0)
    frame = frame.join(targets.select("user_id", "target_product_id"), "user_id") \
        .withColumn("label", (F.col("product_id") == F.col("target_product_id")).cast("int"))
    return rounded(frame.select("user_id", "product_id", "label", *H.FEATURE_COLUMNS))


def _hard_candidates(targets, models):
    from recflow.operators import content as CT
    users = targets.select("user_id")
    pos = targets.select("user_id", F.col("target_product_id").alias("product_id"),
                         F.lit(1).cast("bigint").alias("rank"))
    ex = models.purchased.join(users, "user_id", "left_semi") \
        .join(pos.select("user_id", "product_id"), ["user_id", "product_id"], "left_anti")
    cf = CF.cf_recommend(models.cf, users, 25, exclude=ex)
    ct = CT.recommend_from_history(models.seeds, users, models.catalog, 25, exclude=ex, min_similarity=0.0)
    pop = S.item_stats_recommend(models.stats, users, 10)
    return cut_lineage(RD.ordered_union([pos, cf, ct, pop]))


QUERIES["hybrid_features_hard"] = q_hybrid_features_hard


def q_signal_sweep_hard(spark, d):
    """O1/O2 on the hard candidates of every eligible user: the 20 drawn
    configs re-blend the hybrid signal and are ranked by M9, in one job."""
    beh, targets, observed, cat, models = _ranking_setup(spark, d)
    hard = _hard_candidates(targets, models)
    frame = H.feature_frame(models, hard.select("user_id", "product_id"), None, 0.0)
    frame = frame.join(targets.select("user_id", "target_product_id"), "user_id") \
        .withColumn("label", (F.col("product_id") == F.col("target_product_id")).cast("int"))
    return rounded(SW.evaluate_configs(frame, SW.draw_configs(20, SEED)))


QUERIES["signal_sweep_hard"] = q_signal_sweep_hard
