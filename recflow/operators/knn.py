"""Blocked all-pairs work over row vectors.

Rows are hashed into ``nb`` blocks; each unordered block pair (p <= q) is
one group that receives the rows of both blocks (every row is replicated
``nb`` times, ``nb`` grows with the data so a group stays bounded).  Inside a
group NumPy computes the block of inner products and keeps only what the
consumer needs: the per-row top-k (k-NN) or the scores of unordered pairs
(pair statistics).  Rows carry either a dense vector or sparse cells.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recflow.operators.near_rows import Best, survivors

ROWS_PER_BLOCK = 16384
SCORE_DIGITS = 9  # similarity is rounded to this many digits before ordering (stable ties)
#: a side is cut into up to FEW_BLOCKS smaller blocks of this many rows, so that small tables use several cores
FEW_BLOCKS, LEAST_ROWS = 4, 2048
#: rows and numbers of a block of which each pair is met
PAIR_ROWS, PAIR_CELLS = 65536, 1 << 22
#: rows and columns of a product that are held at once, and cells whose exact scores are
CHUNK_ROWS, CHUNK_COLS, CHUNK_BOTH, CHUNK_CELLS = 512, 4096, 2048, 1 << 16


def n_blocks_for(n_rows: int, rows_per_block: int = ROWS_PER_BLOCK) -> int:
    return max(1, math.ceil(n_rows / rows_per_block), min(FEW_BLOCKS, math.ceil(n_rows / LEAST_ROWS)))


def _pair_groups(df: DataFrame, nb: int) -> DataFrame:
    """Replicate each row to every unordered block pair containing its block."""
    b = F.pmod(F.xxhash64("id"), F.lit(nb))
    other = F.explode(F.sequence(F.lit(0), F.lit(nb - 1)))
    return df.withColumn("blk", b.cast("int")).withColumn("oth", other) \
        .withColumn("pa", F.least("blk", "oth")).withColumn("pb", F.greatest("blk", "oth")).drop("oth")


def pair_groups(df: DataFrame) -> DataFrame:
    """``_pair_groups`` of (id, vec) with blocks of PAIR_ROWS and PAIR_CELLS at most, as every block is copied once per block, and
    smaller ones while that leaves cores without work."""
    size = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("width")).first()
    per_block = max(1, min(PAIR_ROWS, PAIR_CELLS // max(size["width"] or 1, 1)))
    few = math.ceil(math.sqrt(3 * df.sparkSession.sparkContext.defaultParallelism))
    nb = max(1, math.ceil(size["n"] / per_block), min(few, math.ceil(size["n"] / LEAST_ROWS)))
    # a number that is asked for is not lowered by the bytes, which say nothing of the work
    return _pair_groups(df, nb).repartition(nb * (nb + 1), "pa", "pb")


def _dense(pdf: pd.DataFrame, sel) -> tuple[np.ndarray, np.ndarray]:
    part = pdf[sel]
    ids = part["id"].to_numpy(dtype="int64")
    if len(part) == 0:
        return ids, np.zeros((0, 0))
    return ids, np.stack([np.asarray(v, dtype="float64") for v in part["vec"].to_numpy()])


def id_cells(ids: np.ndarray, r: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, positions in the sorted ``ids``) of all cells of row ``r[i]`` whose id is ``wanted[i]``."""
    lo, hi = np.searchsorted(ids, wanted, side="left"), np.searchsorted(ids, wanted, side="right")
    n = hi - lo
    return np.repeat(r, n), np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())


def best_cells(rows: np.ndarray, cols: np.ndarray, ids: np.ndarray, wanted: np.ndarray,
               out: tuple[np.ndarray, np.ndarray] | None = None, ok=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row numbers, column numbers, scores) of each row's first ``wanted`` columns by inner product (rounded, descending),
    then id; ``ids`` ascending.  ``out`` are cells (rows, columns) that are left out, ``ok(row slice, column slice)`` a mask of the
    others.

    The product is made in single precision and in pieces; cells that its error allows among the first ones get their exact
    score, so no row is sorted as a whole."""
    r, c, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    found = [(r, c, score)]
    if not len(rows) or not len(cols):
        return r, c, score
    norm = lambda x: np.sqrt((x * x).sum(axis=1))
    reach, size = norm(cols), norm(rows)
    single = bool(np.isfinite(reach).all() and np.isfinite(size).all() and max(reach.max(), size.max()) < 1e15)
    kind, eps = (np.float32, 2.0 ** -23) if single else (np.float64, 2.0 ** -52)
    small, wide = rows.astype(kind), cols.astype(kind)
    slack = 2 * (rows.shape[1] + 4) * eps * size * np.nanmax(reach) + 2 * 10.0 ** -SCORE_DIGITS
    least = np.finfo(kind).min
    for a in range(0, len(rows), CHUNK_ROWS):
        b = min(a + CHUNK_ROWS, len(rows))
        want = wanted[a:b]
        gone = [x[(out[0] >= a) & (out[0] < b)] for x in out] if out is not None else None
        r, c, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        floor = np.full(b - a, -np.inf)  # the least score that still matters
        for at in range(0, len(cols), CHUNK_COLS):
            to = min(at + CHUNK_COLS, len(cols))
            s = small[a:b] @ wide[at:to].T
            if not single:
                s[np.isnan(s)] = -np.inf
            if ok is not None:
                s[~ok(slice(a, b), slice(at, to))] = -np.inf
            if gone is not None:
                here = (gone[1] >= at) & (gone[1] < to)
                s[gone[0][here] - a, gone[1][here] - at] = -np.inf
            first = np.flatnonzero(~np.isfinite(floor) & (want <= to - at) & (want > 0))
            if len(first):
                top = int(want[first].max())
                floor[first] = np.partition(s[first], to - at - top, axis=1)[:, to - at - top]
            i, j = np.nonzero(s >= np.where(np.isfinite(floor), np.maximum(floor - slack[a:b], least), least)[:, None].astype(kind))
            exact = [np.einsum("ij,ij->i", rows[a + i[x:x + CHUNK_CELLS]], cols[at + j[x:x + CHUNK_CELLS]])
                     for x in range(0, len(i), CHUNK_CELLS)]
            r, c, score = np.concatenate([r, i]), np.concatenate([c, at + j]), np.concatenate([score, *exact])
            order = np.lexsort((c, -np.round(score, SCORE_DIGITS), r))
            r, c, score = r[order], c[order], score[order]
            keep = np.arange(len(r)) - np.searchsorted(r, r, side="left") < want[r]
            r, c, score = r[keep], c[keep], score[keep]
            count = np.bincount(r, minlength=b - a)
            full = (count >= want) & (count > 0)
            floor[full] = score[np.cumsum(count)[full] - 1]
        found.append((r + a, c, score))
    return tuple(np.concatenate(x) for x in zip(*found))


def top_rows(qids: np.ndarray, rows: np.ndarray, nids: np.ndarray, cols: np.ndarray, k: int, exclude_self: bool) -> pd.DataFrame:
    """(query_id, neighbor_id, score): per row the first k columns by (score desc, id)."""
    order = np.argsort(nids, kind="stable")
    nids, cols = nids[order], cols[order]
    out = id_cells(nids, np.arange(len(qids)), qids) if exclude_self else None
    r, c, score = best_cells(rows, cols, nids, np.full(len(qids), k, np.int64), out)
    return pd.DataFrame({"query_id": qids[r].astype("int64"), "neighbor_id": nids[c].astype("int64"), "score": score})


def top_both(qids: np.ndarray, rows: np.ndarray, nids: np.ndarray, cols: np.ndarray, k: int) -> pd.DataFrame:
    """``top_rows`` of two blocks without a common id in both directions, from one product."""
    norm = lambda x: np.sqrt((x * x).sum(axis=1))
    size, reach = norm(rows), norm(cols)
    if not len(rows) or not len(cols) or not max(size.max(), reach.max()) < 1e15:
        return pd.concat([top_rows(qids, rows, nids, cols, k, False), top_rows(nids, cols, qids, rows, k, False)])
    small, wide = rows.astype(np.float32), cols.astype(np.float32)
    error = 2 * (rows.shape[1] + 4) * 2.0 ** -23
    sides = [(Best(len(rows), k), error * size * reach.max() + 2 * 10.0 ** -SCORE_DIGITS),
             (Best(len(cols), k), error * reach * size.max() + 2 * 10.0 ** -SCORE_DIGITS)]
    for a in range(0, len(rows), CHUNK_ROWS):
        for b in range(0, len(cols), CHUNK_BOTH):
            s = small[a:a + CHUNK_ROWS] @ wide[b:b + CHUNK_BOTH].T
            for (best, slack), at, axis in zip(sides, (a, b), (1, 0)):
                mine = slice(at, at + s.shape[1 - axis])
                i, j = survivors(s, best.floor[mine], slack[mine], k, axis)
                score = [np.einsum("ij,ij->i", rows[a + i[x:x + CHUNK_CELLS]], cols[b + j[x:x + CHUNK_CELLS]])
                         for x in range(0, len(i), CHUNK_CELLS)]
                best.add(at, *((i, nids[b + j]) if axis else (j, qids[a + i])), np.concatenate([np.zeros(0), *score]))
    found = pd.concat([best.frame(ids) for (best, _), ids in zip(sides, (qids, nids))])
    return found.rename(columns={"row": "query_id", "other": "neighbor_id"})


def _make_knn_fn(k: int, exclude_self: bool):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pa, pb = int(pdf["pa"].iloc[0]), int(pdf["pb"].iloc[0])
        ia, A = _dense(pdf, (pdf["blk"] == pa).to_numpy())
        if pa == pb:
            return top_rows(ia, A, ia, A, k, exclude_self)
        ib, B = _dense(pdf, (pdf["blk"] == pb).to_numpy())
        return top_both(ia, A, ib, B, k)
    return fn


def knn(rows: DataFrame, k: int, id_col: str = "product_id", vec_col: str = "embedding",
        exclude_self: bool = True, nb: int | None = None, candidates: DataFrame | None = None) -> DataFrame:
    """Exact top-k neighbours of every row by inner product, self
    excluded by id (T3); ties by neighbour id.  ``candidates`` (same shape)
    restricts the neighbour side (filtered search); queries are ``rows``.

    Returns (query_id, neighbor_id, score, rank)."""
    q = rows.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    if candidates is not None:
        return _knn_bipartite(q, candidates.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")),
                              k, exclude_self, nb)
    groups = _pair_groups(q, nb) if nb else pair_groups(q)
    partial = groups.groupBy("pa", "pb").applyInPandas(
        _make_knn_fn(k, exclude_self), "query_id long, neighbor_id long, score double")
    return _final_topk(partial, k)


def _final_topk(partial: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.round("score", SCORE_DIGITS).desc(), F.col("neighbor_id"))
    return partial.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)


def _knn_bipartite(q: DataFrame, c: DataFrame, k: int, exclude_self: bool, nb: int | None) -> DataFrame:
    """Queries x candidates: query blocks x candidate blocks."""
    nq = n_blocks_for(q.count())
    nc = nb or n_blocks_for(c.count())
    qb = q.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(nq)).cast("int")) \
        .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(nc - 1)))).withColumn("side", F.lit(0))
    cb = c.withColumn("cb", F.pmod(F.xxhash64("id"), F.lit(nc)).cast("int")) \
        .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)))).withColumn("side", F.lit(1))

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        ia, A = _dense(pdf, (pdf["side"] == 0).to_numpy())
        ib, B = _dense(pdf, (pdf["side"] == 1).to_numpy())
        return top_rows(ia, A, ib, B, k, exclude_self)
    partial = qb.unionByName(cb).groupBy("qb", "cb").applyInPandas(fn, "query_id long, neighbor_id long, score double")
    return _final_topk(partial, k)


def _make_pairs_fn():
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pa, pb = int(pdf["pa"].iloc[0]), int(pdf["pb"].iloc[0])
        ia, A = _dense(pdf, (pdf["blk"] == pa).to_numpy())
        if pa == pb:
            S = A @ A.T
            r, c = np.triu_indices(len(ia), k=1)
            left, right, sc = ia[r], ia[c], S[r, c]
        else:
            ib, B = _dense(pdf, (pdf["blk"] == pb).to_numpy())
            S = A @ B.T
            r, c = np.meshgrid(np.arange(len(ia)), np.arange(len(ib)), indexing="ij")
            left, right, sc = ia[r.ravel()], ib[c.ravel()], S.ravel()
        lo = np.minimum(left, right)
        hi = np.maximum(left, right)
        return pd.DataFrame({"left_id": lo.astype("int64"), "right_id": hi.astype("int64"), "score": sc})
    return fn


def all_pairs(rows: DataFrame, id_col: str = "product_id", vec_col: str = "embedding",
              nb: int | None = None) -> DataFrame:
    """Every unordered pair (left_id < right_id) with its inner
    product.  Quadratic by definition (the pair statistics need every
    pair); computed as block products, never as a row-level cross join."""
    q = rows.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    nb = nb or n_blocks_for(q.count())
    return _pair_groups(q, nb).groupBy("pa", "pb").applyInPandas(
        _make_pairs_fn(), "left_id long, right_id long, score double")
