"""Ranking dataset: holdout targets, user split, history cutoff, training
candidates and sampled negatives (M15-M21, N4, N8, F9, F10, A13, A15, A17,
M19, U2, U4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recflow.plans.ranking import global_rank
from recflow.session import cut_lineage


def holdout_targets(behavior: DataFrame) -> DataFrame:
    """Users with at least two distinct purchased products; the target
    is the latest purchase (ties by id, null times last) of a product the
    user bought exactly once; users without such a purchase are skipped.
    Rows (user_id, target_product_id, cutoff_timestamp)."""
    p = behavior.where(F.col("event_type") == "purchase").select("user_id", "product_id", "timestamp")
    per_prod = p.groupBy("user_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    per_user = per_prod.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_products"))
    once = per_prod.where(F.col("n") == 1).join(per_user.where(F.col("n_products") >= 2), "user_id") \
        .select("user_id", "product_id")
    cand = p.join(once, ["user_id", "product_id"])
    w = Window.partitionBy("user_id").orderBy(F.col("timestamp").desc_nulls_last(), F.col("product_id"))
    return cand.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).select(
        "user_id", F.col("product_id").alias("target_product_id"), F.col("timestamp").alias("cutoff_timestamp"))


def assign_splits(targets: DataFrame, seed: int = 42, train_ratio: float = 0.70,
                  val_ratio: float = 0.15) -> DataFrame:
    """Exact split by shuffled position with floor bounds
    (counts equal the reference's; membership comes from a seeded hash order,
    repeatable under any partitioning, T9)."""
    # counted and ranked: computed once
    targets = cut_lineage(targets)
    n = targets.count()
    train_end = int(n * train_ratio)
    val_end = train_end + int(n * val_ratio)
    keyed = targets.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), F.col("user_id").cast("string"))))
    ranked = global_rank(keyed, ["_h", "user_id"], name="_pos")
    split = F.when(F.col("_pos") <= train_end, F.lit("train")).when(F.col("_pos") <= val_end, F.lit("val")) \
        .otherwise(F.lit("test"))
    return ranked.withColumn("split", split).drop("_h", "_pos")


def truncate_history(behavior: DataFrame, targets: DataFrame) -> DataFrame:
    """Keep a row when its user has no cutoff or ts < cutoff (a
    null time with a cutoff drops).  One row per user on the small side."""
    cut = targets.select("user_id", "cutoff_timestamp")
    j = behavior.join(cut, "user_id", "left")
    keep = F.col("cutoff_timestamp").isNull() | (F.col("timestamp") < F.col("cutoff_timestamp"))
    return j.where(keep).drop("cutoff_timestamp")


def ordered_union(sources: list[DataFrame], pool: int | None = None) -> DataFrame:
    """``sources`` are (user_id, product_id, rank) lists in priority
    order; a product keeps its first occurrence (source, rank); the result is
    numbered per user and optionally cut at ``pool``."""
    tagged = None
    for i, s in enumerate(sources):
        t = s.select("user_id", "product_id", F.lit(i).alias("_src"), F.col("rank").cast("bigint").alias("_sr"))
        tagged = t if tagged is None else tagged.unionByName(t)
    first = tagged.groupBy("user_id", "product_id").agg(F.min(F.struct("_src", "_sr")).alias("_o"))
    w = Window.partitionBy("user_id").orderBy("_o")
    out = first.withColumn("position", F.row_number().over(w).cast("bigint"))
    if pool is not None:
        out = out.where(F.col("position") <= pool)
    return out.select("user_id", "product_id", "position", F.col("_o._src").alias("source"))


def _next_prime(n: int) -> int:
    def is_prime(x):
        if x < 2:
            return False
        i = 2
        while i * i <= x:
            if x % i == 0:
                return False
            i += 1
        return True
    m = max(n, 2)
    while not is_prime(m):
        m += 1
    return m


def _draw(seed: int, name: str):
    """60 bits of md5 text per user, the same in every engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{name}:"), F.col("user_id").cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def random_negatives(users: DataFrame, catalog_ids: DataFrame, knocked: DataFrame, size: int = 25,
                     seed: int = 42) -> DataFrame:
    """Per user ``size`` catalog products drawn without replacement,
    none of them knocked out (excluded, positive or hard candidates).

    Each user walks its own seeded permutation of the catalog positions
    ``j -> (a_u * j + b_u) mod p`` (p prime >= catalog size, positions >= n
    skipped) and keeps the first ``size`` allowed products: a user with e
    knocked products needs at most ``size + e + (p - n)`` steps, so the
    per-user work is bounded by its own exclusions -- no user x catalog grid."""
    n = catalog_ids.count()
    if n == 0:
        return users.sparkSession.createDataFrame([], "user_id long, product_id long, rank long")
    p = _next_prime(n)
    kn = knocked.select("user_id", "product_id").distinct()
    kc = users.select("user_id").distinct().join(kn.groupBy("user_id").agg(F.count(F.lit(1)).alias("e")),
                                                 "user_id", "left").fillna({"e": 0})
    a = _draw(seed, "a") % F.lit(p - 1) + 1
    b = _draw(seed, "b") % F.lit(p)
    steps = F.least(F.lit(p), F.lit(size) + F.col("e") + F.lit(p - n)).cast("bigint")
    # dealt before the walks grow: a user's numbers are drawn once, not per step, and all cores walk
    n_parts = max(int(users.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")), 1)
    drawn = kc.select("user_id", a.alias("a"), b.alias("b"), steps.alias("steps")).repartition(n_parts, "user_id")
    walk = drawn.select("user_id", "a", "b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("steps") - 1)).alias("j"))
    walk = walk.select("user_id", "j", F.pmod(F.col("a") * F.col("j") + F.col("b"), F.lit(p)).alias("_g0")) \
        .where(F.col("_g0") < n).withColumn("_g", F.col("_g0") + 1)
    ranked = global_rank(catalog_ids.select("product_id").distinct(), ["product_id"], name="_g")
    cand = walk.join(ranked, "_g").join(kn, ["user_id", "product_id"], "left_anti")
    w = Window.partitionBy("user_id").orderBy("j")
    return cand.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= size) \
        .select("user_id", "product_id", "rank")


def data_summary(targets: DataFrame, observed: DataFrame, ranking: DataFrame, catalog: DataFrame) -> DataFrame:
    """Summary facts as metric rows (metric, value)."""
    sizes = ranking.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    s = sizes.agg(F.round(F.avg("n"), 2).alias("candidate_pool_mean"), F.min("n").alias("candidate_pool_min"),
                  F.max("n").alias("candidate_pool_max")).first()
    facts = {
        "eligible_users": float(targets.count()),
        "observed_interactions": float(observed.count()),
        "ranking_rows": float(ranking.count()),
        "products": float(catalog.count()),
        "candidate_pool_mean": float(s["candidate_pool_mean"] or 0.0),
        "candidate_pool_min": float(s["candidate_pool_min"] or 0),
        "candidate_pool_max": float(s["candidate_pool_max"] or 0),
    }
    for r in targets.groupBy("split").count().collect():
        facts[f"split_{r['split']}_users"] = float(r["count"])
    spark = targets.sparkSession
    return spark.createDataFrame(sorted(facts.items()), "metric string, value double")
