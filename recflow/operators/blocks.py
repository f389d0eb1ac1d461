"""Sparse x sparse products in blocks.

``gram(left, right, key)`` computes ``sum_key left[key, a] * right[key, b]`` for every
(a, b) pair.  Keys are hashed into key blocks and both sides into tiles of about
``SIDE_PER_TILE`` ids; a task holds one key block of one pair of tiles, multiplies it in
chunks of keys (cell by cell where that is less work than a dense product) and returns the
non-zero sums, which a ``groupBy(a, b).sum`` combines.  No per-key pair rows are emitted, so a hot key
costs one dense vector per tile, not deg^2 rows, and no task holds a whole side.

``tiled_product`` computes the rows of ``left x right`` per (row block, column tile).  A row block receives the right
rows of those keys only that its own cells have, each once, so what is shuffled is at most one right row per left cell,
and a hub key costs one copy per block.  A block is as long as the number of tasks allows, because every block gets its own copy
of those rows; it is multiplied in tiles of ROWS_PER_TILE rows.  Inside a tile the sparse cells are multiplied pair by pair where
that is less work than a dense product.  The tile goes to a function that keeps what is wanted of it (a top-n, single cells, a
range), so the full product is never a table.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 400_000
KEYS_PER_CHUNK = 1024
SIDE_PER_TILE = 2048
ROWS_PER_TILE = 2048
#: most rows of a row block of ``tiled_product``, and tasks that it makes before blocks grow beyond a tile
ROWS_PER_ROW_BLOCK, LEAST_TASKS = 16384, 48

#: cells multiplied pair by pair at once, and the dense multiplications that cost as much as one such pair
PAIRS_PER_CHUNK = 1 << 21
DENSE_PER_PAIR = 64

_SCHEMA = "a long, b long, v double"


def _block_product(pdf: pd.DataFrame) -> pd.DataFrame:
    left = pdf[pdf["side"] == 0]
    right = pdf[pdf["side"] == 1]
    if left.empty or right.empty:
        return pd.DataFrame({"a": pd.Series([], dtype="int64"), "b": pd.Series([], dtype="int64"),
                             "v": pd.Series([], dtype="float64")})
    keys, kinv = np.unique(pdf["k"].to_numpy(), return_inverse=True)
    lk = kinv[(pdf["side"] == 0).to_numpy()]
    rk = kinv[(pdf["side"] == 1).to_numpy()]
    a_ids, a_idx = np.unique(left["c"].to_numpy(), return_inverse=True)
    b_ids, b_idx = np.unique(right["c"].to_numpy(), return_inverse=True)
    lx = left["x"].to_numpy(dtype="float64")
    rx = right["x"].to_numpy(dtype="float64")
    acc = _multiply(len(a_ids), len(b_ids), len(keys), (lk, a_idx, lx), (rk, b_idx, rx))
    ia, ib = np.nonzero(acc)
    return pd.DataFrame({"a": a_ids[ia].astype("int64"), "b": b_ids[ib].astype("int64"), "v": acc[ia, ib]})


def blocks_for_rows(n: int, spark, rows_per_block: int = ROWS_PER_BLOCK, tiles: int = 1) -> int:
    """Key blocks for ``n`` rows of both sides: a task holds one of ``tiles`` tiles of each side, and every further block adds
    partial sums of the same cells."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    return max(math.ceil(parts / tiles ** 2), math.ceil(n / (rows_per_block * tiles)), 1)


def row_blocks_for(n_rows: int, col_tiles: int) -> int:
    """Row blocks of ``tiled_product``: single tiles while there are few tasks, then longer ones."""
    return max(tiles_for(n_rows, ROWS_PER_ROW_BLOCK), min(tiles_for(n_rows, ROWS_PER_TILE), math.ceil(LEAST_TASKS / col_tiles)))


def n_blocks_for(df: DataFrame, rows_per_block: int = ROWS_PER_BLOCK, tiles: int = 1) -> int:
    return blocks_for_rows(df.count(), df.sparkSession, rows_per_block, tiles)


def tiles_for(n: int, per_tile: int = SIDE_PER_TILE) -> int:
    return max(1, math.ceil(n / per_tile))


def _tile(column: str, tiles: int):
    return F.pmod(F.xxhash64(column), F.lit(tiles)).cast("int")


def _every(tiles: int):
    return F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))


def gram(left: DataFrame, right: DataFrame, key: str, left_col: str, right_col: str,
         left_val: str, right_val: str, n_blocks: int | None = None, tiles: int = 1) -> DataFrame:
    """``(a, b, v)`` with ``v = sum over key of left * right`` (non-zeros only); ``tiles``: the
    number of tiles of each side (``tiles_for`` the number of ids)."""
    lsel = left.select(F.col(key).alias("k"), F.col(left_col).cast("bigint").alias("c"),
                       F.col(left_val).cast("double").alias("x"), F.lit(0).alias("side"))
    rsel = right.select(F.col(key).alias("k"), F.col(right_col).cast("bigint").alias("c"),
                        F.col(right_val).cast("double").alias("x"), F.lit(1).alias("side"))
    nb = n_blocks or n_blocks_for(lsel.unionByName(rsel).where(F.col("x") != 0), tiles=tiles)
    lsel = lsel.withColumn("ta", _tile("c", tiles)).withColumn("tb", _every(tiles))
    rsel = rsel.withColumn("tb", _tile("c", tiles)).withColumn("ta", _every(tiles)).select(*lsel.columns)
    both = lsel.unionByName(rsel).where(F.col("x") != 0).withColumn("blk", F.pmod(F.xxhash64("k"), F.lit(nb)))
    partial = both.groupBy("blk", "ta", "tb").applyInPandas(_block_product, _SCHEMA)
    return partial.groupBy("a", "b").agg(F.sum("v").alias("v"))


def _multiply(n_rows: int, n_cols: int, n_keys: int, left: tuple, right: tuple) -> np.ndarray:
    """Dense sum over keys of the sparse cells (key, row, x) and (key, col, x)."""
    product = np.zeros((n_rows, n_cols))
    flat = product.reshape(-1)
    (lk, ri, lx), (rk, ci, rx) = ([v[order] for v in side] for side in (left, right)
                                  for order in [np.argsort(side[0], kind="stable")])
    first = np.searchsorted(rk, np.arange(n_keys + 1))
    size = np.diff(first)[lk]  # right cells that each left cell meets
    for start in range(0, n_keys, KEYS_PER_CHUNK):
        stop = min(start + KEYS_PER_CHUNK, n_keys)
        lo, hi = np.searchsorted(lk, [start, stop])
        pairs = int(size[lo:hi].sum())
        if not pairs:
            continue
        if pairs * DENSE_PER_PAIR >= n_rows * (stop - start) * n_cols:
            a, b = np.zeros((n_rows, stop - start)), np.zeros((stop - start, n_cols))
            np.add.at(a, (ri[lo:hi], lk[lo:hi] - start), lx[lo:hi])
            mine = slice(first[start], first[stop])
            np.add.at(b, (rk[mine] - start, ci[mine]), rx[mine])
            product += a @ b
            continue
        upto = np.cumsum(size[lo:hi])
        at = lo
        while at < hi:  # at least one left cell at a time
            done = int(upto[at - lo - 1]) if at > lo else 0
            to = max(at + 1, lo + int(np.searchsorted(upto, done + PAIRS_PER_CHUNK, side="right")))
            n = size[at:to]
            cell = np.repeat(np.arange(at, to), n)
            other = np.repeat(first[lk[at:to]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            np.add.at(flat, ri[cell] * n_cols + ci[other], lx[cell] * rx[other])
            at = to
    return product


def tiled_product(left: DataFrame, right: DataFrame, n_rows: int, n_cols: int, keep: Callable, schema: str,
                  marks: DataFrame | None = None) -> DataFrame:
    """``left`` (row, key, x, and any of y, z, d) times ``right`` (key, col, v), per tile.

    ``marks`` (row, col, mark) are cells that the tile's function needs to know.  ``keep`` is
    called with (rows, cols, product, left rows of the tile, row numbers of these, marks) and returns a
    frame of ``schema``."""
    tc = tiles_for(n_cols)
    tr = row_blocks_for(n_rows, tc)
    wide = [c if c in left.columns else F.lit(0.0).alias(c) for c in ("y", "z", "d")]
    parts = left.select(F.lit(0).alias("side"), "row", F.col("key").alias("other"), "x", *wide) \
        .withColumn("ti", _tile("row", tr)).withColumn("tj", _every(tc))
    zero = [F.lit(0.0).alias(c) for c in ("y", "z", "d")]
    needed = left.select(F.col("key").alias("other"), _tile("row", tr).alias("ti")).distinct()
    r = right.select(F.lit(1).alias("side"), F.col("col").alias("row"), F.col("key").alias("other"), F.col("v").alias("x"), *zero)
    parts = parts.unionByName(r.join(needed, "other").withColumn("tj", _tile("row", tc)).select(*parts.columns))
    if marks is not None:
        m = marks.select(F.lit(2).alias("side"), "row", F.col("col").alias("other"), F.col("mark").cast("double").alias("x"), *zero)
        parts = parts.unionByName(m.withColumn("ti", _tile("row", tr)).withColumn("tj", _tile("other", tc)).select(*parts.columns))

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        side = pdf["side"].to_numpy()
        own, g, m = pdf[side == 0].sort_values("row"), pdf[side == 1].sort_values("other"), pdf[side == 2].sort_values("row")
        rows, ri = np.unique(own["row"].to_numpy(), return_inverse=True)
        cols, ci = np.unique(g["row"].to_numpy(), return_inverse=True)
        keys, ki = np.unique(np.concatenate([own["other"].to_numpy(), g["other"].to_numpy()]), return_inverse=True)
        lk, rk = ki[:len(own)], ki[len(own):]
        lx, rx = own["x"].to_numpy(dtype="float64"), g["x"].to_numpy(dtype="float64")
        kept = []
        for start in range(0, max(len(rows), 1), ROWS_PER_TILE):
            tile = rows[start:start + ROWS_PER_TILE]
            mine = slice(*np.searchsorted(ri, [start, start + len(tile)]))
            marked = slice(np.searchsorted(m["row"], tile[0]), np.searchsorted(m["row"], tile[-1], side="right")) \
                if len(tile) else slice(0)
            at = ri[mine] - start
            product = _multiply(len(tile), len(cols), len(keys), (lk[mine], at, lx[mine]), (rk, ci, rx))
            kept.append(keep(tile, cols, product, own[mine], at, m[marked]))
        return pd.concat(kept) if len(kept) > 1 else kept[0]

    return parts.groupBy("ti", "tj").applyInPandas(fn, schema)


def top_cells(rows: np.ndarray, cols: np.ndarray, scores: np.ndarray, allowed: np.ndarray, n: int,
              digits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, column numbers) of each row's n best allowed cells: score rounded to ``digits``
    descending, then column id."""
    ordered = bool((cols[1:] >= cols[:-1]).all())
    if ordered and n > 0 and allowed.size and np.count_nonzero(allowed) > 4 * n * len(rows) and not np.isnan(scores).any():
        # only cells that reach the row's n-th score are sorted; of those equal to it the first columns are enough
        value = np.where(allowed, np.round(scores, digits), -np.inf)
        top = min(n, len(cols))
        last = np.partition(value, len(cols) - top, axis=1)[:, len(cols) - top][:, None]
        more, same = value > last, (value == last) & (value > -np.inf)
        need = top - np.count_nonzero(more, axis=1)[:, None]
        allowed = more | (same & (np.cumsum(same, axis=1, dtype=np.int32) <= need))
    i, j = np.nonzero(allowed)
    at = first_cells(i, cols[j], scores[i, j], n, digits)
    return i[at], j[at]


def first_cells(i: np.ndarray, ids: np.ndarray, scores: np.ndarray, n: int, digits: int) -> np.ndarray:
    """Positions, in order, of each row's n best of the given cells (row number, column id, score), as ``top_cells``."""
    order = np.lexsort((ids, -np.round(scores, digits), i))
    row = i[order]
    return order[np.arange(len(row)) - np.searchsorted(row, row, side="left") < n]


def cells_at(rows: np.ndarray, cols: np.ndarray, r: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row numbers, column numbers, which of the given cells are in the tile)."""
    i = np.minimum(np.searchsorted(rows, r), max(len(rows) - 1, 0))
    j = np.minimum(np.searchsorted(cols, c), max(len(cols) - 1, 0))
    if len(rows) == 0 or len(cols) == 0:
        return i[:0], j[:0], np.zeros(len(r), dtype=bool)
    ok = (rows[i] == r) & (cols[j] == c)
    return i[ok], j[ok], ok
