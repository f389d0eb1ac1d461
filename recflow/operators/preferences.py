"""User preference profile (R16/R17): price profile, attribute shares,
ordered histories, seed items and history counts (A9-A12, N2, N3, J11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recflow.functions.numeric import price_match

HIGH_INTENT = ("purchase", "cart", "wishlist")
ATTRIBUTES = ("category", "material", "style")


def _with_catalog(interactions: DataFrame, catalog: DataFrame) -> DataFrame:
    cat = catalog.select("product_id", "category", "material", "style", "price")
    return interactions.join(cat, "product_id", "left")


def global_avg_price(catalog: DataFrame) -> float:
    """A10 (one scalar)."""
    v = catalog.agg(F.avg("price")).first()[0]
    return 0.0 if v is None else float(v)


def user_price_profile(interactions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Score-weighted mean and population std of price per user.

    std is floored at ``max(sqrt(var), 0.15*avg, 1)``; a user whose weights
    sum to 0 gets the catalog mean and ``max(0.15*mean, 1)``.  Rows whose
    product is missing from the catalog are ignored (T14).  The variance is
    one pass over prices shifted by the catalog mean, which keeps the
    cancellation harmless."""
    g = global_avg_price(catalog)
    rows = _with_catalog(interactions, catalog).where(F.col("price").isNotNull())
    d = F.col("price") - F.lit(g)
    w = F.col("score").cast("double")
    agg = rows.groupBy("user_id").agg(F.sum(w).alias("sw"), F.sum(w * d).alias("swd"), F.sum(w * d * d).alias("swdd"))
    users = interactions.select("user_id").distinct()
    agg = users.join(agg, "user_id", "left")
    zero = F.col("sw").isNull() | (F.abs(F.col("sw")) <= F.lit(1e-8))
    mean_shift = F.col("swd") / F.col("sw")
    avg = F.lit(g) + mean_shift
    var = F.greatest(F.col("swdd") / F.col("sw") - mean_shift * mean_shift, F.lit(0.0))
    return agg.select(
        "user_id",
        F.when(zero, F.lit(g)).otherwise(avg).alias("avg_price"),
        F.when(zero, F.greatest(F.lit(g * 0.15), F.lit(1.0)))
        .otherwise(F.greatest(F.sqrt(var), avg * 0.15, F.lit(1.0))).alias("price_std"))


def attribute_share(interactions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Per user and attribute value, score sum / the user's score sum
    over that attribute (a zero sum divides by 1).  Long form
    ``(user_id, attribute, value, share)``; absent pairs mean 0."""
    rows = _with_catalog(interactions, catalog)
    longv = rows.select("user_id", "score", F.explode(F.array(*[
        F.struct(F.lit(a).alias("attribute"), F.col(a).alias("value")) for a in ATTRIBUTES])).alias("av")) \
        .select("user_id", "av.attribute", "av.value", "score").where(F.col("value").isNotNull())
    per = longv.groupBy("user_id", "attribute", "value").agg(F.sum("score").cast("double").alias("s"))
    # the window holds one user's distinct values of one attribute (bounded by the domain)
    tot = F.sum("s").over(Window.partitionBy("user_id", "attribute"))
    return per.select("user_id", "attribute", "value",
                      (F.col("s") / F.when(tot == 0, F.lit(1.0)).otherwise(tot)).alias("share"))


def first_seen(interactions: DataFrame) -> DataFrame:
    """N2 building block: per (user, product) the first time of the product at
    each history level (purchase / high intent / any)."""
    et = F.col("event_type")
    return interactions.groupBy("user_id", "product_id").agg(
        F.count_if(et == "purchase").alias("n_p"),
        F.count_if(et.isin(*HIGH_INTENT)).alias("n_h"),
        F.min(F.when(et == "purchase", F.col("timestamp"))).alias("t_p"),
        F.min(F.when(et.isin(*HIGH_INTENT), F.col("timestamp"))).alias("t_h"),
        F.min("timestamp").alias("t_a"))


def ordered_history(interactions: DataFrame, level: str = "all") -> DataFrame:
    """A user's products in order of first occurrence (null times last,
    ties by id), as ``(user_id, product_id, position)``."""
    fs = first_seen(interactions)
    col, cond = {"purchase": ("t_p", F.col("n_p") > 0), "high_intent": ("t_h", F.col("n_h") > 0),
                 "all": ("t_a", F.lit(True))}[level]
    w = Window.partitionBy("user_id").orderBy(F.col(col).asc_nulls_last(), F.col("product_id"))
    return fs.where(cond).select("user_id", "product_id", F.row_number().over(w).cast("bigint").alias("position"))


def seed_items(interactions: DataFrame, limit: int = 5) -> DataFrame:
    """The last ``limit`` products of the purchase history, else of the
    high-intent history, else of all interactions (T10: histories keep the
    **first** occurrence).  Rows ``(user_id, product_id, level, recency_rank)``
    with recency_rank 1 = most recent."""
    fs = first_seen(interactions)
    lvl = fs.groupBy("user_id").agg(
        F.when(F.max("n_p") > 0, F.lit(1)).when(F.max("n_h") > 0, F.lit(2)).otherwise(F.lit(3)).alias("level"))
    t = F.when(F.col("level") == 1, F.col("t_p")).when(F.col("level") == 2, F.col("t_h")).otherwise(F.col("t_a"))
    member = F.when(F.col("level") == 1, F.col("n_p") > 0).when(F.col("level") == 2, F.col("n_h") > 0) \
        .otherwise(F.lit(True))
    cand = fs.join(lvl, "user_id").where(member).withColumn("t", t)
    # last positions of (t asc nulls last, id asc) = first of the reverse order
    w = Window.partitionBy("user_id").orderBy(F.col("t").desc_nulls_first(), F.col("product_id").desc())
    return cand.withColumn("recency_rank", F.row_number().over(w).cast("bigint")) \
        .where(F.col("recency_rank") <= limit).select("user_id", "product_id", "level", "recency_rank")


def history_counts(interactions: DataFrame) -> DataFrame:
    """Distinct purchased and distinct interacted products per user."""
    fs = first_seen(interactions)
    return fs.groupBy("user_id").agg(
        F.count_if(F.col("n_p") > 0).cast("bigint").alias("purchase_history_count"),
        F.count(F.lit(1)).cast("bigint").alias("interaction_history_count"))


def purchased_items(interactions: DataFrame) -> DataFrame:
    """Distinct (user, product) purchase pairs (the purchased set)."""
    return interactions.where(F.col("event_type") == "purchase").select("user_id", "product_id").distinct()


def profile_features(candidates: DataFrame, price_profile: DataFrame, shares: DataFrame,
                     counts: DataFrame, g_avg: float) -> DataFrame:
    """Per-user profile reads for candidate rows
    ``(user_id, product_id, price, category, material, style)``; unknown users
    get the catalog mean and tolerance ``max(0.15*avg, 1)``; unknown
    attribute values 0; counts 0."""
    matches = {"category": "category_match_score", "material": "material_preference_score", "style": "style_affinity_score"}
    value_share = F.struct("value", "share")
    # everything about a user in one row, so that the candidates are shuffled to their users once
    own = shares.where(F.col("value").isNotNull()).groupBy("user_id").agg(*[
        F.map_from_entries(F.collect_list(F.when(F.col("attribute") == attr, value_share))).alias(f"_{attr}") for attr in matches])
    own = price_profile.join(counts, "user_id", "full").join(own, "user_id", "full")
    c = candidates.join(own, "user_id", "left")
    avg = F.coalesce(F.col("avg_price"), F.lit(g_avg))
    tol = F.coalesce(F.col("price_std"), F.greatest(avg * 0.15, F.lit(1.0)))
    c = c.withColumns({"_avg": avg, "_tol": tol, **{out: F.coalesce(F.try_element_at(f"_{attr}", F.col(attr)), F.lit(0.0))
                                                    for attr, out in matches.items()}}).drop(*[f"_{attr}" for attr in matches])
    c = c.fillna({"purchase_history_count": 0, "interaction_history_count": 0})
    return c.withColumn("price_delta_from_user_avg", F.col("price") - F.col("_avg")) \
        .withColumn("price_sensitivity_match", price_match("price", "_avg", "_tol")).drop("_avg", "_tol",
                                                                                            "avg_price", "price_std")
