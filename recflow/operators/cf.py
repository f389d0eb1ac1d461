"""Neighbourhood collaborative filtering.

R5 uses the item-Gram identity instead of a user x user matrix: with N the
row-normalised user x item matrix R (zero rows stay zero) and delta_u = 1 for
non-zero rows,

    pred = (N . (N^T R) - delta * R) / max(N . colsum(N) - delta, 1e-8)

``G = N^T R`` is a table of non-zero item pairs (``blocks.gram``).  ``N . G`` is computed per
(user block, item tile) by ``blocks.tiled_product``; a tile returns only what is asked
for: each user's best n, the predictions of given cells, and the range of its unseen cells.  There is
no users x items table and no bound on the catalog.  Cells without a prediction
predict 0, which enters the global range when such cells exist, and they complete
short lists in id order (``plans.fill``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recflow.operators import blocks, knn
from recflow.operators.interactions import popularity, user_item_matrix
from recflow.operators.near_rows import most_similar_rows
from recflow.plans.fill import complete_in_id_order
from recflow.session import cut_lineage

ORDER_DIGITS = knn.SCORE_DIGITS


def _normalized_rows(matrix: DataFrame) -> DataFrame:
    nrm = matrix.groupBy("user_id").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("_nrm"))
    return matrix.join(nrm, "user_id").select(
        "user_id", "product_id", "value",
        F.when(F.col("_nrm") > 0, F.col("value") / F.col("_nrm")).otherwise(F.lit(0.0)).alias("n"),
        (F.col("_nrm") > 0).alias("nonzero"))


# --- R2: user-based (W2) ------------------------------------------------------

def user_based(interactions: DataFrame, n: int = 10, neighbours: int = 5) -> DataFrame:
    """R2: the 5 most cosine-similar other users (ties by user id), the union
    of their items with value > 0, first n by product id (T4: the set order
    of the reference is replaced by id order; own items are kept)."""
    m = cut_lineage(user_item_matrix(interactions, "mean"))
    near = most_similar_rows(m, "user_id", "product_id", "value", neighbours)
    # of a neighbour only the first n items can be among the first n of a union
    w = Window.partitionBy("user_id").orderBy("product_id")
    liked = m.where(F.col("value") > 0).withColumn("r", F.row_number().over(w)).where(F.col("r") <= n) \
        .groupBy(F.col("user_id").alias("neighbor_id")).agg(F.collect_list(F.struct("product_id")).alias("liked"))
    items = near.select(F.col("row").alias("user_id"), F.explode("others").alias("neighbor_id")).join(liked, "neighbor_id") \
        .groupBy("user_id").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("liked")))).alias("items"))
    return items.select("user_id", F.posexplode(F.slice("items", 1, n)).alias("at", "item")).select(
        "user_id", "item.product_id", (F.col("at") + 1).cast("bigint").alias("rank"))


# --- R3: item-based (W2) ------------------------------------------------------

def item_similarity(matrix: DataFrame, n_items: int) -> DataFrame:
    """Cosine between item columns: Gram ``R^T R`` per user block / norms."""
    g = blocks.gram(matrix, matrix, "user_id", "product_id", "product_id", "value", "value", tiles=blocks.tiles_for(n_items))
    norms = matrix.groupBy("product_id").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("nrm"))
    na = norms.select(F.col("product_id").alias("a"), F.col("nrm").alias("na"))
    nb_ = norms.select(F.col("product_id").alias("b"), F.col("nrm").alias("nb"))
    return g.join(na, "a").join(nb_, "b").select(
        F.col("a").alias("product_id"), F.col("b").alias("similar_product_id"),
        (F.col("v") / (F.col("na") * F.col("nb"))).alias("similarity"))


def item_based(interactions: DataFrame, n: int = 10) -> DataFrame:
    """For every item, the n most similar other items (self excluded by
    id, T3); items without overlap fill by id with similarity 0."""
    m = user_item_matrix(interactions, "mean")
    items = m.select("product_id").distinct()
    sim = item_similarity(m, items.count()).where(F.col("product_id") != F.col("similar_product_id")) \
        .where(F.col("similarity") > 0)
    w = Window.partitionBy("product_id").orderBy(F.round("similarity", ORDER_DIGITS).desc(),
                                                 F.col("similar_product_id"))
    top = sim.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= n)
    found = top.groupBy("product_id").agg(F.count(F.lit(1)).alias("k"))
    need = items.join(found, "product_id", "left").select(
        "product_id", (F.lit(n) - F.coalesce(F.col("k"), F.lit(0))).alias("need"))
    knocked = top.select("product_id", F.col("similar_product_id").alias("item")) \
        .unionByName(items.select("product_id", F.col("product_id").alias("item")))
    fill = complete_in_id_order(need, knocked, items.select(F.col("product_id").alias("item")), "product_id", "item")
    filled = fill.join(found, "product_id", "left").select(
        "product_id", F.col("item").alias("similar_product_id"),
        (F.coalesce(F.col("k"), F.lit(0)) + F.col("fill_pos")).cast("bigint").alias("rank"),
        F.lit(0.0).alias("similarity"))
    return top.unionByName(filled)


# --- R5-R7: neighbourhood CF scorer (W4) --------------------------------------

@dataclass
class CFModel:
    matrix: DataFrame        # (user_id, product_id, value) sum matrix, all cells
    left: DataFrame          # (row=user, key=item, x=n, y=value, z=nonzero, d=denominator)
    gram: DataFrame          # (key=item, col=item, v)
    popularity: DataFrame    # (product_id, popularity)
    n_users: int
    n_items: int


def fit_cf(interactions: DataFrame) -> CFModel:
    """R5 over **all** users.  The matrix, its normalised rows and the Gram are written to the
    checkpoint folder: every later step reads them."""
    m = cut_lineage(user_item_matrix(interactions, "sum"))
    dims = m.agg(F.count_distinct("product_id").alias("i"), F.count_distinct("user_id").alias("u"),
                 F.count(F.lit(1)).alias("cells")).first()
    nm = cut_lineage(_normalized_rows(m))
    tiles = blocks.tiles_for(dims["i"])
    g = blocks.gram(nm, m, "user_id", "product_id", "product_id", "n", "value",
                    n_blocks=blocks.blocks_for_rows(2 * dims["cells"], nm.sparkSession, tiles=tiles), tiles=tiles)
    colsum = nm.groupBy("product_id").agg(F.sum("n").alias("c"))
    den = nm.join(colsum, "product_id").groupBy("user_id").agg(
        (F.sum(F.col("n") * F.col("c")) - F.max(F.col("nonzero").cast("double"))).alias("d"))
    left = nm.join(den, "user_id").select(
        F.col("user_id").alias("row"), F.col("product_id").alias("key"), F.col("n").alias("x"), F.col("value").alias("y"),
        F.col("nonzero").cast("double").alias("z"), F.greatest("d", F.lit(1e-8)).alias("d"))
    return CFModel(m, cut_lineage(left), cut_lineage(g.select(F.col("a").alias("key"), F.col("b").alias("col"), "v")),
                   popularity(interactions), dims["u"], dims["i"])


#: share of a tile's cells from which on its best are taken from the dense tile
DENSE_SHARE = 1 / 8


def _predictions(rows, cols, product, own, ri, at=None):
    """(row numbers, column numbers, predictions, unseen) of the cells ``at`` of a tile, or of all those whose prediction
    can differ from zero: work follows these, not the tile."""
    value, nonzero, den = np.zeros(product.shape), np.zeros(len(rows)), np.ones(len(rows))
    i, j, ok = blocks.cells_at(rows, cols, own["row"].to_numpy(), own["other"].to_numpy())
    value[i, j] = own["y"].to_numpy(dtype="float64")[ok]
    nonzero[ri], den[ri] = own["z"].to_numpy(dtype="float64"), own["d"].to_numpy(dtype="float64")
    i, j = np.nonzero((product != 0) | (value != 0)) if at is None else at
    y = value[i, j]
    return i, j, (product[i, j] - nonzero[i] * y) / den[i], y <= 0


def predicted_top(model: CFModel, n: int, exclude: DataFrame | None = None) -> DataFrame:
    """(user_id, product_id, pred): each user's n best unseen, not excluded cells with a prediction,
    per item tile (a window over these gives the overall best n)."""
    def best(rows, cols, product, own, ri, marks):
        i, j, pred, unseen = _predictions(rows, cols, product, own, ri)
        out = np.zeros(product.shape, dtype=bool)
        mi, mj, _ = blocks.cells_at(rows, cols, marks["row"].to_numpy(), marks["other"].to_numpy())
        out[mi, mj] = True
        ok = unseen & (pred != 0) & ~out[i, j]
        i, j, pred = i[ok], j[ok], pred[ok]
        if len(i) >= DENSE_SHARE * product.size:
            dense, allowed = np.zeros(product.shape), np.zeros(product.shape, dtype=bool)
            dense[i, j], allowed[i, j] = pred, True
            i, j = blocks.top_cells(rows, cols, dense, allowed, n, ORDER_DIGITS)
            pred = dense[i, j]
        else:
            best_at = blocks.first_cells(i, cols[j], pred, n, ORDER_DIGITS)
            i, j, pred = i[best_at], j[best_at], pred[best_at]
        return pd.DataFrame({"user_id": rows[i], "product_id": cols[j], "pred": pred})

    marks = None if exclude is None else exclude.select(
        F.col("user_id").alias("row"), F.col("product_id").alias("col"), F.lit(1).alias("mark")).distinct()
    return blocks.tiled_product(model.left, model.gram, model.n_users, model.n_items, best,
                                "user_id long, product_id long, pred double", marks)


def predicted_cells(model: CFModel, cells: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(predictions of the unseen ones of ``cells``, one row (lo, hi): the range of all unseen cells)."""
    def pick(rows, cols, product, own, ri, marks):
        asked = blocks.cells_at(rows, cols, marks["row"].to_numpy(), marks["other"].to_numpy())[:2]
        i, j, pred, ok = _predictions(rows, cols, product, own, ri, asked)
        out = pd.DataFrame({"user_id": rows[i[ok]], "product_id": cols[j[ok]], "pred": pred[ok]})
        _, _, pred, unseen = _predictions(rows, cols, product, own, ri)
        some = pred[unseen & (pred != 0)]
        if len(some):
            out = pd.concat([out, pd.DataFrame({"lo": [some.min()], "hi": [some.max()], "cells": [len(some)]})])
        return out.reindex(columns=["user_id", "product_id", "pred", "lo", "hi", "cells"]).astype(
            {"user_id": "Int64", "product_id": "Int64", "cells": "Int64"})

    marks = None if cells is None else cells.select(
        F.col("user_id").alias("row"), F.col("product_id").alias("col"), F.lit(1).alias("mark")).distinct()
    both = cut_lineage(blocks.tiled_product(
        model.left, model.gram, model.n_users, model.n_items, pick,
        "user_id long, product_id long, pred double, lo double, hi double, cells long", marks))
    seen = model.matrix.agg((F.lit(model.n_users * model.n_items) - F.count_if(F.col("value") > 0)).alias("unseen"))
    span = both.agg(F.coalesce(F.min("lo"), F.lit(0.0)).alias("lo"), F.coalesce(F.max("hi"), F.lit(0.0)).alias("hi"),
                    F.coalesce(F.sum("cells"), F.lit(0)).alias("cells")).crossJoin(F.broadcast(seen))
    zero = F.col("unseen") > F.col("cells")
    lo = F.when(F.col("unseen") == 0, 0.0).when(zero, F.least("lo", F.lit(0.0))).otherwise(F.col("lo"))
    hi = F.when(F.col("unseen") == 0, 1.0).when(zero, F.greatest("hi", F.lit(0.0))).otherwise(F.col("hi"))
    return both.where("user_id is not null").select("user_id", "product_id", "pred"), span.select(lo.alias("lo"), hi.alias("hi"))


def cf_predictions(model: CFModel) -> DataFrame:
    """R6 for every cell that has a prediction: (user_id, product_id, cf_score) of all unseen cells whose prediction is not
    zero, scaled by the global range.  Its size is that of the sparse product, not users x items."""
    def every(rows, cols, product, own, ri, marks):
        i, j, pred, unseen = _predictions(rows, cols, product, own, ri)
        ok = unseen & (pred != 0)
        return pd.DataFrame({"user_id": rows[i[ok]], "product_id": cols[j[ok]], "pred": pred[ok]})

    found = cut_lineage(blocks.tiled_product(model.left, model.gram, model.n_users, model.n_items, every,
                                             "user_id long, product_id long, pred double"))
    own = found.agg(F.min("pred").alias("lo"), F.max("pred").alias("hi"), F.count(F.lit(1)).alias("cells"))
    seen = model.matrix.agg((F.lit(model.n_users * model.n_items) - F.count_if(F.col("value") > 0)).alias("unseen"))
    # cells without a prediction predict zero
    zero = F.when(F.col("unseen") > F.col("cells"), 0.0)
    span = own.crossJoin(F.broadcast(seen)).select(F.least("lo", zero).alias("lo"), F.greatest("hi", zero).alias("hi"))
    scaled = F.when(F.col("hi") <= F.col("lo"), F.lit(0.0)).otherwise((F.col("pred") - F.col("lo")) / (F.col("hi") - F.col("lo")))
    return found.crossJoin(F.broadcast(span)).select("user_id", "product_id", scaled.alias("cf_score"))


def cf_recommend(model: CFModel, users: DataFrame, n: int = 20, exclude: DataFrame | None = None) -> DataFrame:
    """Unseen items by prediction desc (ties by id) minus excluded, first
    n; short lists complete with zero-prediction unseen items in id order.
    Users unknown to the model get the popularity order minus excluded."""
    users = users.select("user_id").distinct()
    known = users.join(model.matrix.select("user_id").distinct(), "user_id", "left_semi")
    unknown = users.join(known, "user_id", "left_anti")
    cand = predicted_top(model, n, exclude).join(known, "user_id", "left_semi")
    w = Window.partitionBy("user_id").orderBy(F.round("pred", ORDER_DIGITS).desc(), F.col("product_id"))
    top = cut_lineage(cand.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= n)
                      .select("user_id", "product_id", "rank", F.col("pred").alias("score")))
    found = top.groupBy("user_id").agg(F.count(F.lit(1)).alias("k"))
    need = known.join(found, "user_id", "left").select(
        "user_id", (F.lit(n) - F.coalesce(F.col("k"), F.lit(0))).alias("need"))
    # a list is short only if it holds all of the user's predictions that are not excluded
    knock = model.matrix.where(F.col("value") > 0).select("user_id", F.col("product_id").alias("item")) \
        .unionByName(top.select("user_id", F.col("product_id").alias("item")))
    if exclude is not None:
        knock = knock.unionByName(exclude.select("user_id", F.col("product_id").alias("item")))
    items = model.matrix.select(F.col("product_id").alias("item")).distinct()
    fill = complete_in_id_order(need, knock, items, "user_id", "item").join(found, "user_id", "left") \
        .select("user_id", F.col("item").alias("product_id"),
                (F.coalesce(F.col("k"), F.lit(0)) + F.col("fill_pos")).cast("bigint").alias("rank"),
                F.lit(0.0).alias("score"))
    out = top.unionByName(fill)
    if unknown.isEmpty():
        return out
    # users unknown to the model: popularity order
    return out.unionByName(popularity_recommend(model.popularity, unknown, n, exclude))


def popularity_recommend(pop: DataFrame, users: DataFrame, n: int, exclude: DataFrame | None) -> DataFrame:
    """Popularity order (score desc, id) minus each user's exclusions, first n."""
    from recflow.plans.ranking import global_rank, take_positions
    ranked = global_rank(pop, ["popularity", "product_id"], [True, False], name="g") \
        .select("g", F.struct("product_id", "popularity").alias("item"))
    if exclude is None:
        return take_positions(users.select("user_id", F.lit(n).alias("_upto")), ranked, "item", "g").select(
            "user_id", "item.product_id", F.col("g").alias("rank"), F.col("item.popularity").alias("score"))
    ex = exclude.select("user_id", "product_id").distinct().join(users, "user_id", "left_semi")
    ec = users.join(ex.groupBy("user_id").agg(F.count(F.lit(1)).alias("e")), "user_id", "left").fillna({"e": 0})
    cand = take_positions(ec.select("user_id", (F.lit(n) + F.col("e")).alias("_upto")), ranked, "item", "g") \
        .select("user_id", "g", "item.*").join(ex, ["user_id", "product_id"], "left_anti")
    w = Window.partitionBy("user_id").orderBy("g")
    return cand.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= n) \
        .select("user_id", "product_id", "rank", F.col("popularity").alias("score"))


def cf_scores(model: CFModel, candidates: DataFrame) -> DataFrame:
    """``cf_score`` for candidate rows (user_id, product_id): an unseen
    cell of a known user and item -> its prediction (0 when not stored)
    scaled by the global range; seen cells, unknown items and unknown users
    -> popularity min-max scaled inside the user's candidate set (T8)."""
    pred, span = predicted_cells(model, candidates)
    users = model.matrix.select("user_id").distinct().withColumn("_ku", F.lit(True))
    items = model.matrix.select("product_id").distinct().withColumn("_ki", F.lit(True))
    seen = model.matrix.where(F.col("value") > 0).select("user_id", "product_id").withColumn("_seen", F.lit(True))
    c = candidates.select("user_id", "product_id").join(users, "user_id", "left").join(items, "product_id", "left") \
        .join(seen, ["user_id", "product_id"], "left").join(pred, ["user_id", "product_id"], "left") \
        .join(model.popularity, "product_id", "left").crossJoin(F.broadcast(span))
    pop = F.coalesce(F.col("popularity"), F.lit(0.0))
    wu = Window.partitionBy("user_id")
    pmin, pmax = F.min(pop).over(wu), F.max(pop).over(wu)
    pop_scaled = F.when(pmax <= pmin, F.lit(0.0)).otherwise((pop - pmin) / (pmax - pmin))
    finite = F.col("_ku").isNotNull() & F.col("_ki").isNotNull() & F.col("_seen").isNull()
    p = F.coalesce(F.col("pred"), F.lit(0.0))
    scaled = F.when(F.col("hi") <= F.col("lo"), F.lit(0.0)).otherwise((p - F.col("lo")) / (F.col("hi") - F.col("lo")))
    return c.select("user_id", "product_id", F.when(finite, scaled).otherwise(pop_scaled).alias("cf_score"))
