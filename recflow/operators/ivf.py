"""Approximate neighbours by an inverted file.

Unit vectors are dealt to the cell of their nearest centroid; a query looks only into its
``probes`` nearest cells.  Centroids are fitted by spherical k-means on at most ``SAMPLE_ROWS`` rows, every row is
indexed.  There are about sqrt(rows) cells, so the centroids, which are sent to all tasks, grow with the
square root of the table (10^8 rows of 64 numbers: 5 MB).

Within the probed cells the search is exact, so a true neighbour is found if and only if its cell is probed.
That makes the recall of every probe count one join of the true neighbours with the cells' order for the
query, and ``recall_report`` picks the smallest that reaches the target.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recflow.operators import knn as K
from recflow.session import cut_lineage

SAMPLE_ROWS = 1_000_000
ROUNDS = 3
TARGET_RECALL = 0.9
#: queries whose true neighbours measure the recall
EVALUATED = 1_000
MEMBERS_PER_PART, QUERIES_PER_PART = 4096, 1024


def _draw(seed: int, id_col: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def cells_for(rows: int) -> int:
    return max(1, round(math.sqrt(rows)))


def cell_order(centroids: np.ndarray, depth: int):
    """Pandas UDF: vector -> its ``depth`` nearest cells, nearest first (ties: smaller number)."""

    @F.pandas_udf("array<int>")
    def order(vec: pd.Series) -> pd.Series:
        if not len(vec):
            return pd.Series([], dtype=object)
        score = np.stack(vec.to_numpy()).astype("float64") @ centroids.T
        # the nearest one needs no order of all cells
        near = score.argmax(axis=1)[:, None] if depth == 1 else np.argsort(-score, axis=1, kind="stable")
        return pd.Series(list(near[:, :depth].astype(np.int32)))

    return order


def fit_centroids(vectors: DataFrame, n_cells: int, rounds: int = ROUNDS, seed: int = 42, sample_rows: int = SAMPLE_ROWS,
                  id_col: str = "product_id", vec_col: str = "embedding") -> np.ndarray:
    """Centroids of spherical k-means; the start is a seeded draw of rows, an empty cell keeps its centroid."""
    rows = vectors.select(id_col, F.col(vec_col).cast("array<double>").alias("vec")).withColumn("draw", _draw(seed, id_col))
    count = vectors.count()
    if count > sample_rows:
        share = sample_rows / count
        rows = rows.where(F.conv(F.substring("draw", 1, 8), 16, 10).cast("long") < int(share * (1 << 32)))
    rows = cut_lineage(rows)
    start = rows.orderBy("draw", id_col).limit(n_cells).select("vec").collect()
    centroids = np.array([r["vec"] for r in start], dtype="float64")
    width = centroids.shape[1] if len(centroids) else 0
    for _ in range(rounds if len(centroids) else 0):
        near = rows.select("vec", cell_order(centroids, 1)("vec")[0].alias("cell"))
        means = near.groupBy("cell").agg(F.array(*[F.avg(F.col("vec")[j]) for j in range(width)]).alias("mean")).collect()
        for r in means:
            mean = np.array(r["mean"])
            centroids[r["cell"]] = mean / max(np.linalg.norm(mean), 1e-12)
    return centroids


def build(vectors: DataFrame, centroids: np.ndarray, id_col: str = "product_id", vec_col: str = "embedding") -> DataFrame:
    """(cell, id, vec): the inverted file.  ``write.partitionBy("cell")`` stores it so that a search reads
    the probed cells only."""
    vec = F.col(vec_col).cast("array<double>")
    return vectors.select(F.col(id_col).alias("id"), vec.alias("vec")).withColumn("cell", cell_order(centroids, 1)("vec")[0])


def _best_in_part(k: int, exclude_self: bool):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        q, m = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        if q.empty or m.empty:
            return pd.DataFrame(columns=["query_id", "neighbor_id", "score"]).astype(
                {"query_id": "int64", "neighbor_id": "int64", "score": "float64"})
        vec = lambda x: np.stack(x["vec"].to_numpy()).astype("float64")
        return K.top_rows(q["id"].to_numpy(), vec(q), m["id"].to_numpy(), vec(m), k, exclude_self)
    return fn


def search(queries: DataFrame, index: DataFrame, centroids: np.ndarray, k: int, probes: int,
           exclude_self: bool = True) -> DataFrame:
    """(query_id, neighbor_id, score, rank): the first k members of the ``probes`` nearest cells of each query
    (query_id, vec); ties by id.  Large cells are split, and the queries of much asked cells as well."""
    asked = queries.select(F.col("query_id").alias("id"), F.col("vec").cast("array<double>").alias("vec")).withColumn(
        "cell", F.explode(cell_order(centroids, probes)("vec")))
    asked = cut_lineage(asked)
    parts = lambda df, size, name: df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))
    sizes = cut_lineage(parts(index, MEMBERS_PER_PART, "mp").join(parts(asked, QUERIES_PER_PART, "qp"), "cell"))
    deal = lambda count: F.pmod(F.xxhash64("id"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    q = asked.join(sizes, "cell").withColumn("q", deal("qp")).withColumn("m", every("mp")).withColumn("side", F.lit(0))
    m = index.join(sizes, "cell").withColumn("m", deal("mp")).withColumn("q", every("qp")).withColumn("side", F.lit(1))
    columns = ["cell", "m", "q", "side", "id", "vec"]
    partial = q.select(*columns).unionByName(m.select(*columns)).groupBy("cell", "m", "q").applyInPandas(
        _best_in_part(k, exclude_self), "query_id long, neighbor_id long, score double")
    return K._final_topk(partial, k)


def recall_report(vectors: DataFrame, index: DataFrame, centroids: np.ndarray, k: int = 10, target: float = TARGET_RECALL,
                  evaluated: int = EVALUATED, seed: int = 42, id_col: str = "product_id",
                  vec_col: str = "embedding") -> DataFrame:
    """One row per probe count 1, 2, 4, ... up to all cells: cells, probes, recall against the exact neighbours of
    ``evaluated`` drawn queries, candidate_pairs they would score, the share of all their pairs, and whether it is
    the smallest that reaches ``target``."""
    n_cells = len(centroids)
    chosen = vectors.select(id_col, vec_col).orderBy(_draw(seed, id_col), id_col).limit(evaluated)
    chosen = cut_lineage(chosen.select(F.col(id_col).alias("query_id"), F.col(vec_col).cast("array<double>").alias("vec")))
    sample = chosen.select(F.col("query_id").alias(id_col), F.col("vec").alias(vec_col))
    truth = cut_lineage(K.knn(sample, k, id_col, vec_col, candidates=vectors.select(id_col, vec_col)))
    probed = cut_lineage(chosen.select("query_id", F.posexplode(cell_order(centroids, n_cells)("vec")).alias("at", "cell")))
    where = index.select(F.col("id").alias("neighbor_id"), "cell")
    found = truth.join(where, "neighbor_id").join(probed, ["query_id", "cell"]).select("query_id", "at")
    per_query = truth.groupBy("query_id").agg(F.count(F.lit(1)).alias("wanted"))
    sizes = index.groupBy("cell").agg(F.count(F.lit(1)).alias("members"))
    work = probed.join(sizes, "cell")
    own = index.join(chosen.select(F.col("query_id").alias("id")), "id").select("id", "cell").join(
        probed.withColumnRenamed("query_id", "id"), ["id", "cell"])
    settings = [2 ** i for i in range(n_cells.bit_length()) if 2 ** i < n_cells] + [n_cells]
    hits = F.array(*[F.count_if(F.col("at") < p) for p in settings])
    recalls = per_query.join(found.groupBy("query_id").agg(hits.alias("h")), "query_id", "left").agg(
        F.array(*[F.avg(F.coalesce(F.col("h")[i], F.lit(0)) / F.col("wanted")) for i in range(len(settings))]).alias("recall"))
    # a query does not score itself
    pairs = work.agg(F.array(*[F.coalesce(F.sum(F.when(F.col("at") < p, F.col("members"))), F.lit(0))
                               for p in settings]).alias("members"))
    selves = own.agg(F.array(*[F.count_if(F.col("at") < p) for p in settings]).alias("selves"))
    total = vectors.agg(F.count(F.lit(1)).alias("n"))
    one = recalls.crossJoin(pairs).crossJoin(selves).crossJoin(total).crossJoin(chosen.agg(F.count(F.lit(1)).alias("asked")))
    rows = one.select("n", "asked", F.posexplode(F.arrays_zip("recall", "members", "selves")).alias("i", "r"))
    probes = F.element_at(F.array(*[F.lit(p) for p in settings]), F.col("i") + 1)
    out = rows.select(F.lit(n_cells).cast("long").alias("cells"), probes.cast("long").alias("probes"),
                      F.round("r.recall", 4).alias("recall"), (F.col("r.members") - F.col("r.selves")).alias("candidate_pairs"),
                      F.round((F.col("r.members") - F.col("r.selves")) / (F.col("asked") * (F.col("n") - 1)), 4).alias("pair_share"))
    # one row per setting: a window over a handful of rows
    first = F.min(F.when(F.col("recall") >= target, F.col("probes"))).over(Window.partitionBy("cells"))
    return out.withColumn("selected", F.coalesce(F.col("probes") == first, F.lit(False)))


def chosen_probes(report: DataFrame) -> int:
    row = report.where("selected").first()
    return int(row["probes"]) if row else 1
