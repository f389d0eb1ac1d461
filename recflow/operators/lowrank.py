"""Low-rank recommenders (R4): centred truncated SVD by subspace iteration, and MLlib ALS.

With row means m (over all items, zeros included) the centred matrix is C = R - m 1^T, and its
products with a thin table need only the cells of R and two sums:

    C Q   = R Q   - m (1^T Q)        join of the cells with the item table, sum per user
    C^T Y = R^T Y - 1 (m^T Y)        join of the cells with the user table, sum per item

Randomised subspace iteration repeats Q <- orth(C^T C Q) from a seeded random start.  User and item tables
have one row of ``n_components + OVERSAMPLE`` numbers per id; sums are combined map-side; only matrices of that side
reach the driver (Gram matrices for the orthonormalisation and for the final Rayleigh-Ritz step).  No task and
no driver holds an items x items array, and the number of items has no bound.

Scores of both models are block products of user and item vectors with the user's seen cells
masked, and only each user's best n of a block of items leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recflow.operators import blocks
from recflow.operators.interactions import user_item_matrix
from recflow.plans.ranking import global_rank
from recflow.session import cut_lineage

OVERSAMPLE = 10
ITERATIONS = 4
#: directions whose squared length is this small against the longest are rounding noise
NOISE = 1e-13
USERS_PER_BLOCK = 2048
ITEMS_PER_BLOCK = 4096
SCORE_DIGITS = 9


class LowRank:
    """``users`` (user_id, m, vec), ``items`` (product_id, vec); the rank-k prediction of a cell is
    vec_u . core . vec_i + m, and the right singular vectors are vec_i . ritz."""

    def __init__(self, users: DataFrame, items: DataFrame, ritz: np.ndarray, singular: np.ndarray):
        self.users, self.items, self.ritz, self.singular = users, items, ritz, singular

    @property
    def core(self) -> np.ndarray:
        return self.ritz @ self.ritz.T


def _sums(cells: DataFrame, table: DataFrame, key: str, by: str, width: int) -> DataFrame:
    """Per ``by``: the sum over its cells of value * vec of the cell's ``key``, and the first m."""
    joined = cells.join(table.select(key, "vec"), key)
    each = joined.groupBy(by).agg(F.first("m").alias("m"), *[
        F.sum(F.col("value") * F.col("vec")[j]).alias(f"s{j}") for j in range(width)])
    return each.select(by, "m", F.array(*[F.col(f"s{j}") for j in range(width)]).alias("vec"))


def _shifted(vec: str, scale, shift: np.ndarray):
    """vec - scale * shift, elementwise."""
    minus = F.array(*[F.lit(float(x)) for x in shift])
    return F.zip_with(vec, minus, lambda x, s: x - scale * s)


def _gram(table: DataFrame, width: int, weight) -> np.ndarray:
    """[vec, weight]^T [vec, weight] summed over all rows; (width + 1)^2 numbers reach the driver."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width + 1, width + 1))
        for b in batches:
            x = np.column_stack([np.stack(b["vec"].to_numpy()), b["w"].to_numpy(dtype="float64")]) if len(b) else None
            if x is not None:
                total += x.T @ x
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()}).astype({"i": "int64", "j": "int64"})

    rows = table.select("vec", weight.alias("w")).mapInPandas(partial, "i long, j long, v double")
    out = np.zeros((width + 1, width + 1))
    for r in rows.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = r["v"]
    return out


def _times(table: DataFrame, key: str, matrix: np.ndarray) -> DataFrame:
    """vec . matrix of every row."""

    @F.pandas_udf("array<double>")
    def product(vec: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack(vec.to_numpy()) @ matrix)) if len(vec) else pd.Series([], dtype=object)

    return table.select(key, product("vec").alias("vec"))


def _orthonormaliser(gram: np.ndarray) -> np.ndarray:
    """Matrix T for which X T is orthonormal, given X^T X; directions of rounding noise are left out."""
    w, u = np.linalg.eigh(gram)
    keep = w > NOISE * max(w.max(), 1e-300)
    return u[:, keep] / np.sqrt(w[keep])


def fit_svd(matrix: DataFrame, n_components: int = 50, iterations: int = ITERATIONS, seed: int = 42) -> LowRank:
    """Truncated SVD of the row-centred user x item table ``matrix`` (user_id, product_id, value)."""
    n_items = matrix.select("product_id").distinct().count()
    means = matrix.groupBy("user_id").agg((F.sum("value") / F.lit(float(max(n_items, 1)))).alias("m"))
    cells = cut_lineage(matrix.select("user_id", "product_id", F.col("value").cast("double").alias("value")).join(means, "user_id"))
    k = max(1, min(n_components, n_items - 1))
    width = max(1, min(n_components + OVERSAMPLE, n_items))
    start = F.array(*[F.pmod(F.xxhash64("product_id", F.lit(seed), F.lit(j)), F.lit(1 << 30)) / float(1 << 30) - 0.5
                      for j in range(width)])
    items = cut_lineage(cells.select("product_id").distinct().withColumn("vec", start))
    one = F.lit(1.0)
    gram = _gram(items, width, one)
    for step in range(iterations + 1):
        users = _sums(cells, items, "product_id", "user_id", width)
        users = cut_lineage(users.withColumn("vec", _shifted("vec", F.col("m"), gram[width, :width])))
        of_users = _gram(users, width, F.col("m"))
        if step == iterations:
            break
        raw = _sums(cells, users, "user_id", "product_id", width)
        raw = cut_lineage(raw.withColumn("vec", _shifted("vec", one, of_users[width, :width])))
        turn = _orthonormaliser(_gram(raw, width, one)[:width, :width])
        if not turn.shape[1]:  # the centred matrix is zero
            break
        items, width = cut_lineage(_times(raw, "product_id", turn)), turn.shape[1]
        gram = _gram(items, width, one)
    # Rayleigh-Ritz: the best k directions inside the subspace, whose basis need not be quite orthonormal
    basis = _orthonormaliser(gram[:width, :width])
    w, u = np.linalg.eigh(basis.T @ of_users[:width, :width] @ basis)
    order = np.argsort(-w)[:k]
    return LowRank(users, items, basis @ u[:, order], np.sqrt(np.maximum(w[order], 0)))


def top_unseen(users: DataFrame, items: DataFrame, seen: DataFrame, n: int, core: np.ndarray | None = None) -> DataFrame:
    """(user_id, product_id, rank, score): each user's first n items outside ``seen`` (user_id, product_id) by
    vec_u . core . vec_i + m, ties by id.  ``users``: user_id, m, vec; ``items``: product_id, vec."""
    nu = max(1, -(-users.count() // USERS_PER_BLOCK))
    ni = max(1, -(-items.count() // ITEMS_PER_BLOCK))
    ub = F.pmod(F.xxhash64("user_id"), F.lit(nu)).cast("int").alias("ub")
    ib = F.pmod(F.xxhash64("product_id"), F.lit(ni)).cast("int").alias("ib")
    every = lambda count, name: F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)
    zero, no_vec = F.lit(0).cast("long"), F.lit(None).cast("array<double>")
    own = users.select(ub, every(ni, "ib"), F.col("user_id").alias("a"), zero.alias("b"), F.col("m").alias("x"),
                       F.col("vec").cast("array<double>").alias("vec"), F.lit(0).alias("side"))
    other = items.select(every(nu, "ub"), ib, zero.alias("a"), F.col("product_id").alias("b"), F.lit(0.0).alias("x"),
                         F.col("vec").cast("array<double>").alias("vec"), F.lit(1).alias("side"))
    marks = seen.select(ub, ib, F.col("user_id").alias("a"), F.col("product_id").alias("b"), F.lit(0.0).alias("x"),
                        no_vec.alias("vec"), F.lit(2).alias("side"))
    parts = own.unionByName(other.select(*own.columns)).unionByName(marks)

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        side = pdf["side"].to_numpy()
        u, i, s = (pdf[side == x].sort_values(["a", "b"]) for x in (0, 1, 2))
        rows, cols = u["a"].to_numpy(), i["b"].to_numpy()
        if not len(rows) or not len(cols):
            r = c = np.zeros(0, np.int64)
            score = np.zeros((0, 0))
        else:
            left = np.stack(u["vec"].to_numpy())
            left = left if core is None else left @ core
            score = left @ np.stack(i["vec"].to_numpy()).T + u["x"].to_numpy()[:, None]
            allowed = np.ones(score.shape, dtype=bool)
            sr, sc, _ = blocks.cells_at(rows, cols, s["a"].to_numpy(), s["b"].to_numpy())
            allowed[sr, sc] = False
            r, c = blocks.top_cells(rows, cols, score, allowed, n, SCORE_DIGITS)
        return pd.DataFrame({"user_id": rows[r].astype("int64"), "product_id": cols[c].astype("int64"), "score": score[r, c]})

    found = parts.groupBy("ub", "ib").applyInPandas(best, "user_id long, product_id long, score double")
    order = Window.partitionBy("user_id").orderBy(F.round("score", SCORE_DIGITS).desc(), F.col("product_id"))
    ranked = found.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= n)
    return ranked.select("user_id", "product_id", "rank", "score")


def svd_recommend(matrix: DataFrame, n: int = 10, n_components: int = 50, iterations: int = ITERATIONS) -> DataFrame:
    """R4 for every user: predictions of items with a zero cell, first n by
    prediction desc (ties by id).  Rows (user_id, product_id, rank, score)."""
    model = fit_svd(matrix, n_components, iterations)
    seen = matrix.where(F.col("value") != 0).select("user_id", "product_id")
    return top_unseen(model.users, model.items, seen, n, model.core)


INT_MAX = (1 << 31) - 1


def _int_ids(matrix: DataFrame, column: str) -> DataFrame:
    """(column, index): an int for every id -- the id itself where all fit, else its position."""
    ids = matrix.select(column).distinct()
    low, high = ids.agg(F.min(column), F.max(column)).first()
    if low is None or (low >= -INT_MAX and high <= INT_MAX):
        return ids.withColumn("index", F.col(column).cast("int"))
    return global_rank(ids, [column], name="index").withColumn("index", F.col("index").cast("int"))


def als_recommend(matrix: DataFrame, n: int = 10, rank: int = 10, max_iter: int = 10, reg: float = 0.1,
                  seed: int = 42) -> DataFrame:
    """R4 with MLlib ALS on the long matrix; scores and unseen items as for the SVD."""
    uid, pid = cut_lineage(_int_ids(matrix, "user_id")), cut_lineage(_int_ids(matrix, "product_id"))
    indexed = matrix.join(uid.withColumnRenamed("index", "u"), "user_id").join(
        pid.withColumnRenamed("index", "i"), "product_id")
    als = ALS(userCol="u", itemCol="i", ratingCol="value", rank=rank, maxIter=max_iter, regParam=reg, seed=seed,
              checkpointInterval=5)
    model = als.fit(indexed.select("u", "i", "value"))
    users = model.userFactors.join(uid, F.col("id") == F.col("index")).select(
        "user_id", F.lit(0.0).alias("m"), F.col("features").alias("vec"))
    items = model.itemFactors.join(pid, F.col("id") == F.col("index")).select("product_id", F.col("features").alias("vec"))
    seen = matrix.where(F.col("value") != 0).select("user_id", "product_id")
    return top_unseen(cut_lineage(users), cut_lineage(items), seen, n)


def svd_topk(interactions: DataFrame, n: int = 10, n_components: int = 50) -> DataFrame:
    return svd_recommend(user_item_matrix(interactions, "mean"), n, n_components)


def als_topk(interactions: DataFrame, n: int = 10) -> DataFrame:
    return als_recommend(user_item_matrix(interactions, "mean"), n)
