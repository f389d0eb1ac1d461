"""Steps of the ranking frame whose cost grew faster than their rows."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.group import GroupedData

from recflow.operators import blocks as B, content as C, preferences as P, ranker_search as RS, search as SE
from recflow.sources import tables as src


def test_no_null_arrays_go_to_python(spark, monkeypatch):
    """Runs of null arrays take quadratic time to send to a group."""
    sent, plain = [], GroupedData.applyInPandas

    def seen(self, *args):
        arrays = [c for c, t in self._df.dtypes if t.startswith("array")]
        sent.append(self._df.where(" or ".join(f"{c} is null" for c in arrays)).count())
        return plain(self, *args)

    monkeypatch.setattr(GroupedData, "applyInPandas", seen)
    vectors = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(6)] + [(9, None)], "product_id long, embedding array<double>")
    seeds = spark.createDataFrame([(1, 0), (1, 2), (2 ** 53 + 1, 3)], "user_id long, product_id long")
    pairs = spark.createDataFrame([(1, 4), (1, 9), (2 ** 53 + 1, 5), (7, 5), (None, 3)], "user_id long, product_id long")
    got = {(r[0], r[1]): r[2:] for r in C.pair_similarity(seeds, pairs, vectors, 5).collect()}
    assert got == {(1, 4): (9.0, 5.0), (1, 9): (0.0, 0.0), (2 ** 53 + 1, 5): (16.0, 16.0), (7, 5): (0.0, 0.0)}
    catalog = vectors.where("embedding is not null").selectExpr(
        "*", "'a' as category", "'b' as style", "'c' as material", "'d' as color", "1.0D as price")
    asked = vectors.where("product_id < 3").selectExpr("product_id as query_id", "embedding as vec")
    assert SE.vector_search(asked, catalog, 2).count() == 6
    some = asked.withColumn("exclude_ids", F.when(F.col("query_id") == 1, F.array(F.lit(5))))
    hits = {(r["query_id"], r["rank"]): r["product_id"] for r in SE.vector_search(some, catalog, 2).collect()}
    assert hits[1, 1] == 4 and hits[2, 1] == 5
    assert len(sent) == 3 and not any(sent)


def test_row_blocks_grow_before_their_number(spark):
    """Every row block gets its own copy of the right rows, every key block its own partial sums."""
    assert B.row_blocks_for(1_500, 1) == 1 and B.row_blocks_for(90_000, 1) == 44 and B.row_blocks_for(90_000, 3) == 16
    assert B.row_blocks_for(540_000, 18) == 33
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert B.blocks_for_rows(1, spark) == parts and B.blocks_for_rows(1, spark, tiles=parts) == 1
    assert B.blocks_for_rows(52_000_000, spark, tiles=18) == 8


@pytest.mark.parametrize("side", [2, 5, 2048])
def test_row_blocks_of_several_tiles(spark, monkeypatch, side):
    monkeypatch.setattr(B, "ROWS_PER_TILE", side)
    monkeypatch.setattr(B, "LEAST_TASKS", 1)
    rng = np.random.default_rng(4)
    a, b = (np.where(rng.random(s) < 0.4, rng.normal(size=s), 0) for s in ((23, 11), (11, 13)))
    a[:, 0] = 1.0
    rows = lambda m: [(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))]
    left = spark.createDataFrame(rows(a), "row long, key long, x double")
    right = spark.createDataFrame(rows(b), "key long, col long, v double")
    marks = spark.createDataFrame([(i, i % 13, 1) for i in range(23)], "row long, col long, mark int")

    def every(ids, cols, product, own, ri, m):
        assert len(ids) <= B.ROWS_PER_TILE and (ids[ri] == own["row"]).all() and set(m["row"]) <= set(ids)
        i, j = np.nonzero(product)
        out = pd.DataFrame({"row": ids[i], "col": cols[j], "v": product[i, j], "marked": 0})
        return pd.concat([out, pd.DataFrame({"row": m["row"], "col": m["other"], "v": 0.0, "marked": 1})])

    got = B.tiled_product(left, right, 23, 13, every, "row long, col long, v double, marked long", marks).collect()
    product = np.zeros((23, 13))
    for r in got:
        product[r["row"], r["col"]] += r["v"]
    assert np.allclose(product, a @ b)
    assert sorted((r["row"], r["col"]) for r in got if r["marked"]) == [(i, i % 13) for i in range(23)]


def test_profile_joins_the_user_once(spark):
    cands = spark.createDataFrame([(1, 5, 10.0, "a", "m", None), (1, 6, 30.0, "b", "x", "s"), (2, 5, 10.0, "a", "m", "s"), (None, 5, 1.0, "a", "m", "s")],
                                  "user_id long, product_id long, price double, category string, material string, style string")
    prices = spark.createDataFrame([(1, 20.0, 4.0), (None, 1.0, 1.0)], "user_id long, avg_price double, price_std double")
    shares = spark.createDataFrame([(1, "category", "a", 0.25), (1, "category", "b", 0.75), (2, "style", "s", 1.0), (1, "material", "m", 1.0)],
                                   "user_id long, attribute string, value string, share double")
    counts = spark.createDataFrame([(3, 1, 1), (1, 2, 7)], "user_id long, purchase_history_count long, interaction_history_count long")
    out = P.profile_features(cands, prices, shares, counts, 100.0)
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("Join LeftOuter") == 1
    got = {(r["user_id"], r["product_id"]): (r["category_match_score"], r["material_preference_score"], r["style_affinity_score"],
                                             r["price_delta_from_user_avg"], r["purchase_history_count"], r["interaction_history_count"])
           for r in out.collect()}
    assert got == {(1, 5): (0.25, 1.0, 0.0, -10.0, 2, 7), (1, 6): (0.75, 0.0, 0.0, 10.0, 2, 7), (2, 5): (0.0, 0.0, 1.0, -90.0, 0, 0),
                   (None, 5): (0.0, 0.0, 0.0, -99.0, 0, 0)}


def test_only_products_with_a_vector_are_normalised(spark, tmp_path):
    part = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame([(i, "red oak", "b", "t", 3, 9.0) for i in (1, 2, 2, 3)], part).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(2, [1.0], 0), (2, [2.0], 0), (4, [1.0], 0)], "vec_id long, embedding array<float>, label int").write.parquet(
        f"{tmp_path}/embeddings.parquet")
    out = src.searchable_catalog(spark, str(tmp_path))
    assert "Join LeftSemi" in out._jdf.queryExecution().analyzed().toString()
    assert sorted((r["product_id"], r["embedding"][0]) for r in out.collect()) == [(2, 1.0), (2, 1.0), (2, 2.0), (2, 2.0)]


def test_ranker_sums_read_arrow_batches(spark, monkeypatch):
    """no array object per row; the sums are those of the plain formula, over empty partitions too."""
    rng = np.random.default_rng(8)
    d, h, beta, hard = rng.normal(size=(40, 3)), rng.random(40), rng.normal(size=(2, 3)), np.array([0.0, 2.0])
    rows = spark.createDataFrame([(x.tolist(), float(y)) for x, y in zip(d, h)], "d array<double>, h double").repartition(3)
    rows = rows.unionByName(rows.where("h > 2"))
    monkeypatch.setattr(type(rows), "mapInPandas", None)
    weight, gradient, hessian = RS._sums(rows, beta, hard)
    for s in range(2):
        p, w = 1 / (1 + np.exp(d @ beta[s])), 1 + hard[s] * h
        assert np.allclose(weight[s], w.sum()) and np.allclose(gradient[s], -((w * p) @ d))
        assert np.allclose(hessian[s], (d * (w * p * (1 - p))[:, None]).T @ d)
