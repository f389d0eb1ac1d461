"""Content scores from seed items (R12, R14); query texts are in ``text_index``."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recflow.operators import knn as K
from recflow.operators.search import rank_level, vector_search
from recflow.plans.fill import complete_in_id_order
from recflow.session import cut_lineage


#: candidate rows of a block of users (every block gets its own copy of the vectors it needs), and pairs that are multiplied
#: at once
ROWS_PER_BLOCK, PAIRS_PER_CHUNK = 131072, 1 << 16


def _similar_to_seeds(pdf: pd.DataFrame) -> pd.DataFrame:
    """Max and mean similarity of the candidates (side 0) of a block of users to their seeds (side 1); side 2 holds the vectors
    of both, each product once for the whole block."""
    cand, seed, vec = (pdf[pdf["side"] == i] for i in range(3))
    vec = vec.sort_values("product_id")
    seed = seed.sort_values("user_id")
    ids = vec["product_id"].to_numpy(dtype="int64")
    cells = lambda x: K.id_cells(ids, np.arange(len(x)), x["product_id"].to_numpy(dtype="int64"))
    (ci, cv), (si, sv) = cells(cand), cells(seed)
    users = seed["user_id"].to_numpy(dtype="int64")[si]
    # every candidate vector meets all vectors of its user's seeds
    pair, other = K.id_cells(users, np.arange(len(ci)), cand["user_id"].to_numpy(dtype="int64")[ci])
    best, total, count = np.full(len(cand), -np.inf), np.zeros(len(cand)), np.zeros(len(cand), np.int64)
    if len(pair):
        x = np.stack(vec["vec"].to_numpy()).astype("float64")
        for at in range(0, len(pair), PAIRS_PER_CHUNK):
            p, o = pair[at:at + PAIRS_PER_CHUNK], other[at:at + PAIRS_PER_CHUNK]
            sim = np.einsum("ij,ij->i", x[cv[p]], x[sv[o]])
            np.maximum.at(best, ci[p], sim)
            total += np.bincount(ci[p], weights=sim, minlength=len(cand))
            count += np.bincount(ci[p], minlength=len(cand))
    mean = total / np.maximum(count, 1)
    known = lambda x: np.where((count > 0) & ~np.isnan(x), x, 0.0)
    return pd.DataFrame({
        "user_id": cand["user_id"].to_numpy(dtype="int64"), "product_id": cand["product_id"].to_numpy(dtype="int64"),
        "embedding_similarity": known(best), "embedding_mean_similarity": known(mean)})


def history_similarity(seeds: DataFrame, candidates: DataFrame, vectors: DataFrame) -> DataFrame:
    """Per (user, candidate) the max and mean similarity to the user's
    seeds that have a vector; no seeds or a candidate without a vector -> 0
    (T15).  Users are dealt into blocks of about ROWS_PER_BLOCK candidates; a block receives each vector it needs once and
    multiplies inside, so there are no seed x candidate rows.  ``candidates`` is asked for its size: it should come from a
    written table."""
    once = candidates.select("user_id", "product_id").distinct()
    return candidates.select("user_id", "product_id").join(
        pair_similarity(seeds, once, vectors, candidates.count()), ["user_id", "product_id"], "left").fillna(
        {"embedding_similarity": 0.0, "embedding_mean_similarity": 0.0})


def pair_similarity(seeds: DataFrame, pairs: DataFrame, vectors: DataFrame, rows: int) -> DataFrame:
    """R12 for distinct pairs, about ``rows`` of them: one row for each that has both ids."""
    blocks = max(1, math.ceil(rows / ROWS_PER_BLOCK), min(48, math.ceil(rows / 4096)))
    pair = lambda df, side: df.where("user_id is not null and product_id is not null").select(
        F.pmod(F.xxhash64(F.col("user_id").cast("bigint")), F.lit(blocks)).cast("int").alias("block"), F.lit(side).alias("side"),
        F.col("user_id").cast("bigint").alias("user_id"), F.col("product_id").cast("bigint").alias("product_id"))
    both = pair(pairs, 0).unionByName(pair(seeds.select("user_id", "product_id"), 1))
    v = vectors.where(F.col("embedding").isNotNull()).select(
        F.col("product_id").cast("bigint").alias("product_id"), F.col("embedding").cast("array<double>").alias("vec"))
    needed = both.select("block", "product_id").distinct().join(v, "product_id").select(
        "block", F.lit(2).alias("side"), F.lit(0).cast("bigint").alias("user_id"), "product_id", "vec")
    # rows without a vector carry an empty one: the time to send a group to Python grows with the square of a run of null arrays
    both = both.withColumn("vec", F.array().cast("array<double>"))
    return both.unionByName(needed).groupBy("block").applyInPandas(
        _similar_to_seeds, "user_id long, product_id long, embedding_similarity double, embedding_mean_similarity double")


def recommend_from_history(seeds: DataFrame, users: DataFrame, catalog: DataFrame, n: int = 20,
                           exclude: DataFrame | None = None, min_similarity: float = 0.0) -> DataFrame:
    """R14 for a table of users: catalog products by (max similarity desc,
    mean similarity desc, id) over the user's seeds, excluded ids removed,
    max similarity >= min_similarity, first n.  Users without seeds get the
    first n catalog ids not excluded (as the reference).

    Candidates are each seed's exact first n products without the user's exclusions: a product outside every seed's list has
    at least n better-or-equal products, so the union holds the answer (up to exact similarity ties).  A product is
    searched once for all users who have it as a seed, as deep as the most demanding of them needs (n and their
    exclusions), and a user joins the levels of its list (``search.rank_level``) up to their own need."""
    users = users.select("user_id").distinct()
    vec = catalog.select("product_id", "embedding")
    seeds = seeds.join(users, "user_id", "left_semi")
    sv = seeds.select("user_id", F.col("product_id").alias("seed_id")).join(
        vec.select(F.col("product_id").alias("seed_id")).distinct(), "seed_id")
    wanted = sv.distinct().withColumn("need", F.lit(n).cast("long"))
    if exclude is not None:
        out = exclude.select("user_id", "product_id").distinct()
        # only excluded products with a vector take places of a list
        places = out.join(vec.select("product_id"), "product_id").groupBy("user_id").agg(F.count(F.lit(1)).alias("places"))
        wanted = wanted.join(places, "user_id", "left").withColumn("need", F.col("need") + F.coalesce("places", F.lit(0))).drop("places")
    wanted = cut_lineage(wanted)
    lists = wanted.groupBy("seed_id").agg(F.max("need").alias("k")).join(
        vec.select(F.col("product_id").alias("seed_id"), F.col("embedding").alias("vec")), "seed_id")
    # one written table, so the numbers stay with their rows
    lists = cut_lineage(lists.withColumn("query_id", F.monotonically_increasing_id()))
    hits = vector_search(lists.select("query_id", "vec", "k"), catalog, n)
    near = hits.join(lists.select("query_id", "seed_id"), "query_id").select(
        "seed_id", "query_id", "product_id", "rank", rank_level(F.col("rank")).alias("level"))
    per = wanted.withColumn("level", F.explode(F.sequence(F.lit(0), rank_level(F.col("need"))))).join(
        near, ["seed_id", "level"]).where(F.col("rank") <= F.col("need"))
    if exclude is not None:
        per = per.join(out, ["user_id", "product_id"], "left_anti")
        place = F.row_number().over(Window.partitionBy("user_id", "query_id").orderBy("rank"))
        per = per.withColumn("place", place).where(F.col("place") <= n)
    cands = cut_lineage(per.select("user_id", "product_id").distinct())
    sims = pair_similarity(seeds, cands, catalog, cands.count())
    ranked = sims.where(F.col("embedding_similarity") >= min_similarity)
    w = Window.partitionBy("user_id").orderBy(F.round("embedding_similarity", K.SCORE_DIGITS).desc(),
                                              F.round("embedding_mean_similarity", K.SCORE_DIGITS).desc(),
                                              F.col("product_id"))
    top = ranked.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= n) \
        .select("user_id", "product_id", "rank", F.col("embedding_similarity").alias("score"))
    seeded = sv.select("user_id").distinct()
    unseeded = users.join(seeded, "user_id", "left_anti")
    need = unseeded.select("user_id", F.lit(n).alias("need"))
    knocked = (exclude.select("user_id", F.col("product_id").alias("item")).join(unseeded, "user_id", "left_semi")
               if exclude is not None else
               need.sparkSession.createDataFrame([], "user_id long, item long"))
    fill = complete_in_id_order(need, knocked, catalog.select(F.col("product_id").alias("item")), "user_id", "item")
    return top.unionByName(fill.select("user_id", F.col("item").alias("product_id"),
                                       F.col("fill_pos").alias("rank"), F.lit(0.0).alias("score")))
