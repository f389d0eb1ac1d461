"""Further registered queries: loaders, profiling, look-ups, text search and the full ranking data."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from recflow.functions import text as T
from recflow.operators import ann as ANN, cf as CF, clean, hybrid as H, ivf as IVF, profile as V, ranker as RK, ranker_search as RS, \
    ranking_data as RD, search as SE, text_index as TI, tuning as TU
from recflow.operators.metrics import grouped_ranking
from recflow.plans.queries import QUERIES, SEED, _interactions, _frame_and_targets, _ranking_setup, rounded, unit_catalog
from recflow.session import cut_lineage, ensure_checkpoint_dir
from recflow.sources import files, tables as src


def q_catalog_rounded(spark, d):
    """The checked catalog with prices and ratings to two places."""
    return rounded(clean.normalize_catalog_w3(src.raw_products(spark, d)))


def stored_metadata(spark, d):
    """Stored metadata of the products that have a vector: other titles, categories with gaps."""
    return src.searchable_catalog(spark, d).select(
        "product_id", F.upper("title").alias("title"), F.when(F.col("label") != 0, F.lower("category")).alias("category"))


def q_catalog_assembled(spark, d):
    """Stored metadata over the catalog, gaps filled from the catalog."""
    return rounded(files.assemble_catalog(stored_metadata(spark, d), src.catalog(spark, d)))


def q_events_schema(spark, d):
    return V.schema_info(src.raw_behavior(spark, d))


def q_events_describe_all(spark, d):
    out = V.describe_all(src.behavior(spark, d).select("user_id", "product_id", "event_type"))
    return rounded(out.withColumns({c: F.col(c).cast("double") for c in ("unique", "freq")}))


def q_event_types(spark, d):
    return V.distinct_values(src.behavior(spark, d), "event_type")


def q_first_events(spark, d):
    """V9: the first five events by time, user, product and type."""
    return V.head(src.behavior(spark, d), ["timestamp", "user_id", "product_id", "event_type"], 5)


def q_similar_products(spark, d):
    """The five most similar products of every product with a vector."""
    cat = unit_catalog(spark, d)
    asked = cat.select(F.col("product_id").alias("query_id"), "product_id")
    return rounded(SE.similar_products(asked, cat, 5))


def q_sample_profiles(spark, d):
    """Sample shoppers of the three biggest categories."""
    return SE.sample_user_profiles(src.catalog(spark, d), 3).select(
        "user_id", F.array_join("purchased_product_ids", ",").alias("purchased_product_ids"), "preferred_category")


def q_purchased_products(spark, d):
    """Names of all products that were purchased."""
    bought = src.behavior(spark, d).where(F.col("event_type") == "purchase")
    return SE.show_products(bought.select("product_id"), src.catalog(spark, d))


def q_text_search(spark, d):
    """Every distinct product title against all descriptions."""
    cat = src.catalog(spark, d)
    asked = cat.groupBy("title").agg(F.min("product_id").alias("query_id")).select(
        "query_id", T.query_text("title", is_query=True).alias("text"))
    return rounded(TI.text_search(cat, asked, 5))


def q_vector_store_runs(spark, d):
    """Texts encoded and stored by a first run, by one after every tenth description changed, and by a third."""
    cat = src.catalog(spark, d).select("product_id", "description")
    changed = cat.withColumn("description", F.when(F.col("product_id") % 10 == 0, F.concat("description", F.lit(" New.")))
                             .otherwise(F.col("description")))
    folder = f"{ensure_checkpoint_dir(spark)}/vectors-{uuid.uuid4().hex}"
    out = None
    for run, table in enumerate((cat, changed, changed), 1):
        vectors, encoded = files.build_vectors(table, files.hashing_encoder(64), folder, "hashed words, 64")
        row = vectors.agg(F.lit(run).alias("run"), F.lit(encoded).cast("long").alias("encoded"),
                          F.count(F.lit(1)).alias("products"), F.count_if(F.size("embedding") == 64).alias("vectors"))
        out = row if out is None else out.unionByName(row)
    return out


def q_embedding_report(spark, d):
    """Pair statistics and retrieval metrics of the stored vectors as rows (sections of dimensions that the vectors
    do not exceed are left out)."""
    return rounded(ANN.embedding_report(unit_catalog(spark, d)))


def q_catalog_vector_gaps(spark, d):
    """Products without a vector and vectors without a product, by category."""
    cat, vec = src.catalog(spark, d), src.vectors(spark, d).select("product_id").withColumn("has_vector", F.lit(True))
    both = cat.select("product_id", "category").withColumn("has_product", F.lit(True)).join(vec, "product_id", "full_outer")
    return both.groupBy("category").agg(
        F.count(F.lit(1)).alias("ids"), F.count_if(F.col("has_vector").isNull()).alias("without_vector"),
        F.count_if(F.col("has_product").isNull()).alias("without_product"))


def q_ranker_trials(spark, d):
    """O2: the trials of the ranker's parameters, rung by rung."""
    frame, _ = _frame_and_targets(spark, d)
    return rounded(RS.successive_halving(frame, RS.draw_parameters(8, 42))[1])


def q_gbt_ranking(spark, d):
    """M5's non-linear option: trees fitted on the training users, ranking metrics on the test users."""
    frame, _ = _frame_and_targets(spark, d)
    fitted = RK.fit_pointwise_gbt(frame.where(F.col("split") == "train"), max_iter=10)
    return rounded(grouped_ranking(RK.gbt_scored(fitted, frame.where(F.col("split") == "test")), "ranker_score", (5, 10)))


def q_cf_predictions(spark, d):
    """The scaled prediction of every unseen cell that has one."""
    return rounded(CF.cf_predictions(CF.fit_cf(_interactions(spark, d))))


def q_attribute_search(spark, d):
    """Every product searches by its own values of some attributes, blank ones, price bounds and a threshold."""
    cat = unit_catalog(spark, d)
    turn = F.col("product_id") % 4
    own = lambda column, *turns: F.when(turn.isin(*turns), F.upper(F.col(column))).otherwise(F.lit("  "))
    asked = cat.select(
        F.col("product_id").alias("query_id"), F.col("embedding").alias("vec"), own("category", 3).alias("category"),
        own("style", 0, 3).alias("style"), own("material", 1, 3).alias("material"), own("color", 0, 3).alias("color"),
        F.when(turn == 1, F.col("price") - 20).alias("min_price"), F.when(turn == 3, F.col("price") + 200).alias("max_price"),
        F.when(turn == 0, F.lit(0.0)).when(turn == 2, F.lit(0.2)).alias("threshold"),
        F.array(F.col("product_id")).alias("exclude_ids"))
    return rounded(SE.result_records(SE.vector_search(asked, cat, 5), cat))


def q_user_content_recs_filtered(spark, d):
    """R8 with filters, threshold and duplicate purchases (T22): a user's purchases in time order, some users asking for the
    category of their first one, from a price on, or above a similarity."""
    cat = unit_catalog(spark, d)
    bought = src.behavior(spark, d).where(F.col("event_type") == "purchase").join(
        cat.select("product_id", "category"), "product_id")
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("timestamp", "product_id"))
    bought = bought.select("user_id", "product_id", "category", place.alias("position"))
    asks = bought.where("position = 1").select(
        "user_id", F.when(F.col("user_id") % 2 == 0, F.col("category")).alias("category"),
        F.when(F.col("user_id") % 3 == 0, F.lit(100.0)).alias("min_price"),
        F.when(F.col("user_id") % 5 == 0, F.lit(0.05)).alias("threshold"))
    recs = SE.recommend_for_users(bought.drop("category"), cat, 5, asks)
    return recs.withColumn("matched_from_product_ids", F.array_join("matched_from_product_ids", ","))


def _inverted_file(spark, d):
    cat = unit_catalog(spark, d).select("product_id", "embedding")
    centroids = IVF.fit_centroids(cat, IVF.cells_for(cat.count()), seed=42)
    return cat, cut_lineage(IVF.build(cat, centroids)), centroids


def q_ann_recall(spark, d):
    """What each number of probed cells finds and costs, and the smallest that finds 0.9 of the true neighbours."""
    return IVF.recall_report(*_inverted_file(spark, d), k=10)


def q_ann_neighbours(spark, d):
    """E5: ten approximate neighbours of every product whose id is divisible by 20, among all products."""
    cat, index, centroids = _inverted_file(spark, d)
    probes = IVF.chosen_probes(IVF.recall_report(cat, index, centroids, k=10))
    asked = cat.where(F.col("product_id") % 20 == 0).select(F.col("product_id").alias("query_id"), F.col("embedding").alias("vec"))
    return rounded(IVF.search(asked, index, centroids, 10, probes))


def q_group_sizes(spark, d):
    """Candidates per user of the ranking frame."""
    frame, _ = _frame_and_targets(spark, d)
    return frame.groupBy("user_id").agg(F.count(F.lit(1)).alias("candidates"))


def q_data_summary(spark, d):
    """Facts about the ranking data."""
    _, targets, observed, cat, models = _ranking_setup(spark, d)
    frame = H.ranking_frame(models, targets, cat.select("product_id"), SEED)
    return rounded(RD.data_summary(targets, observed, frame, cat))


def q_hybrid_query_topk(spark, d):
    """R13, R15, R18-R22 with a text: every user asks for the title of the first product (by id) they
    touched that has a vector."""
    cat = unit_catalog(spark, d)
    inter = _interactions(spark, d)
    asked = inter.join(cat.select("product_id", "title"), "product_id").groupBy("user_id").agg(
        F.min_by("title", "product_id").alias("text"))
    models = H.fit_models(inter, cat)
    return rounded(H.hybrid_topk(models, inter.select("user_id"), 5, index=TI.fit_index(cat), queries=asked))


def q_tuned_hybrid_topk(spark, d):
    """Tune, refit, store, load, and serve everybody with the stored ranker."""
    frame, cat = _frame_and_targets(spark, d)
    tuned = TU.tune(frame, cat)
    inter = _interactions(spark, d)
    folder = f"{ensure_checkpoint_dir(spark)}/tuned-{uuid.uuid4().hex}"
    TU.save(H.fit_models(inter, cat), tuned, folder)
    return rounded(TU.serve(*TU.load(spark, folder), inter.select("user_id"), 5))


MORE = {
    "tuned_hybrid_topk": q_tuned_hybrid_topk,
    "hybrid_query_topk": q_hybrid_query_topk,
    "catalog_rounded": q_catalog_rounded,
    "catalog_assembled": q_catalog_assembled,
    "events_schema": q_events_schema,
    "events_describe_all": q_events_describe_all,
    "event_types": q_event_types,
    "first_events": q_first_events,
    "similar_products": q_similar_products,
    "sample_profiles": q_sample_profiles,
    "purchased_products": q_purchased_products,
    "text_search": q_text_search,
    "vector_store_runs": q_vector_store_runs,
    "embedding_report": q_embedding_report,
    "catalog_vector_gaps": q_catalog_vector_gaps,
    "ranker_trials": q_ranker_trials,
    "gbt_ranking": q_gbt_ranking,
    "cf_predictions": q_cf_predictions,
    "attribute_search": q_attribute_search,
    "user_content_recs_filtered": q_user_content_recs_filtered,
    "ann_recall": q_ann_recall,
    "ann_neighbours": q_ann_neighbours,
    "group_sizes": q_group_sizes,
    "data_summary": q_data_summary,
}
QUERIES.update(MORE)
