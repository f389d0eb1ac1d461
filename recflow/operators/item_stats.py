"""Smoothed item statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recflow.functions.numeric import min_max_scale
from recflow.functions.weights import EVENT_WEIGHTS

KNOWN_EVENTS = tuple(EVENT_WEIGHTS)  # view, wishlist, cart, purchase


def item_stats(interactions: DataFrame) -> DataFrame:
    """Per product: counts of the four known event types (missing -> 0),
    ``historical_ctr = (wishlist+cart+purchase+1)/(total+2)``,
    ``purchase_rate = (purchase+1)/(total+2)`` with total over the known
    types only, ``interaction_score = sum(score)`` and its min-max scale.

    Products seen only with unknown types still get a row (ctr 0.5)."""
    counts = interactions.groupBy("product_id").agg(
        *[F.count_if(F.col("event_type") == e).cast("bigint").alias(f"n_{e}") for e in KNOWN_EVENTS],
        F.sum("score").cast("double").alias("interaction_score"))
    total = sum((F.col(f"n_{e}") for e in KNOWN_EVENTS[1:]), F.col(f"n_{KNOWN_EVENTS[0]}")).cast("double")
    positive = (F.col("n_wishlist") + F.col("n_cart") + F.col("n_purchase")).cast("double")
    stats = counts.select(
        "product_id", *[f"n_{e}" for e in KNOWN_EVENTS],
        ((positive + 1.0) / (total + 2.0)).alias("historical_ctr"),
        ((F.col("n_purchase") + 1.0) / (total + 2.0)).alias("purchase_rate"),
        "interaction_score")
    # global range: two scalars, no single-partition window
    rng = stats.agg(F.min("interaction_score").alias("lo"), F.max("interaction_score").alias("hi")).first()
    lo = rng["lo"] if rng["lo"] is not None else 0.0
    hi = rng["hi"] if rng["hi"] is not None else 0.0
    return stats.withColumn("popularity_score", min_max_scale("interaction_score", F.lit(lo), F.lit(hi)))


def stats_order():
    return [F.col("historical_ctr").desc(), F.col("purchase_rate").desc(),
            F.col("interaction_score").desc(), F.col("product_id")]


def item_stats_rank(stats: DataFrame, n: int = 20) -> DataFrame:
    """R10 without exclusions: the global first n by (ctr, purchase rate,
    score) descending, ties by id."""
    top = stats.orderBy(*stats_order()).limit(n)
    return top.select(F.row_number().over(Window.orderBy(*stats_order())).cast("bigint").alias("rank"),
                      "product_id", "historical_ctr", "purchase_rate", "interaction_score")


def item_stats_recommend(stats: DataFrame, users: DataFrame, n: int = 20,
                         exclude: DataFrame | None = None) -> DataFrame:
    """R10 for a table of users: the global order minus each user's excluded
    ids (J8), first n.

    A user with ``e`` excluded ids can only receive items of global position
    ``<= n + e``, so each user takes exactly that many positions
    (``ranking.take_positions``) and
    drops excluded pairs with an anti-join -- no user x catalog grid."""
    from recflow.plans.ranking import global_rank, take_positions
    users = users.select("user_id").distinct()
    if exclude is None:
        ex_counts = users.withColumn("n_ex", F.lit(0).cast("bigint"))
    else:
        ex = exclude.select("user_id", "product_id").distinct()
        ex_counts = users.join(ex.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_ex")), "user_id", "left") \
            .fillna({"n_ex": 0})
    ranked = global_rank(stats.select("product_id", "historical_ctr", "purchase_rate", "interaction_score"),
                         ["historical_ctr", "purchase_rate", "interaction_score", "product_id"],
                         [True, True, True, False], name="g").select("g", "product_id")
    cand = take_positions(ex_counts.select("user_id", (F.lit(n) + F.col("n_ex")).alias("_upto")), ranked, "product_id", "g")
    if exclude is not None:
        cand = cand.join(ex, ["user_id", "product_id"], "left_anti")
    w = Window.partitionBy("user_id").orderBy("g")
    return cand.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= n) \
        .select("user_id", "product_id", "rank")


def ctr_for_candidates(stats: DataFrame, candidates: DataFrame) -> DataFrame:
    """Historical CTR of candidate rows; unknown items get the mean
    CTR of the known ones (a scalar)."""
    mean_ctr = stats.agg(F.avg("historical_ctr")).first()[0]
    mean_ctr = 0.0 if mean_ctr is None else float(mean_ctr)
    return candidates.join(stats.select("product_id", "historical_ctr"), "product_id", "left") \
        .withColumn("historical_ctr", F.coalesce(F.col("historical_ctr"), F.lit(mean_ctr)))
