"""Lists taken by position, and sparse products in tiles."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from recflow.operators import blocks, item_stats as S
from recflow.plans import ranking as RK
from recflow.plans.fill import complete_in_id_order


@pytest.mark.parametrize("head", [1024, 5])
def test_positions_from_the_head_and_beyond(spark, monkeypatch, head):
    monkeypatch.setattr(RK, "HEAD", head)
    monkeypatch.setattr(RK, "SALTS", 3)
    ranked = spark.createDataFrame([(g, g * 10) for g in range(1, 41)], "g long, item long")
    asked = spark.createDataFrame([("a", 3), ("b", 0), ("c", 12), ("d", 100), ("e", 5)], "q string, _upto long")
    got = {}
    for r in RK.take_positions(asked, ranked, "item", "g").collect():
        got.setdefault(r["q"], []).append((r["g"], r["item"]))
    want = {q: [(g, g * 10) for g in range(1, min(n, 40) + 1)] for q, n in (("a", 3), ("c", 12), ("d", 100), ("e", 5))}
    assert {q: sorted(v) for q, v in got.items()} == want


@pytest.mark.parametrize("head", [1024, 8])
def test_one_user_with_many_exclusions(spark, monkeypatch, head):
    monkeypatch.setattr(RK, "HEAD", head)
    stats = spark.range(60).select(F.col("id").alias("product_id"), (F.lit(1.0) / (F.col("id") + 2)).alias("historical_ctr"),
                                   F.lit(0.1).alias("purchase_rate"), F.lit(1.0).alias("interaction_score"))
    users = spark.createDataFrame([(u,) for u in range(30)], "user_id long")
    exclude = spark.createDataFrame([(7, p) for p in range(0, 50)] + [(8, 1), (8, 1), (9, 999)], "user_id long, product_id long")
    got = {}
    for r in S.item_stats_recommend(stats, users, 5, exclude).orderBy("user_id", "rank").collect():
        got.setdefault(r["user_id"], []).append(r["product_id"])
    assert got.pop(7) == [50, 51, 52, 53, 54] and got.pop(8) == [0, 2, 3, 4, 5]
    assert all(v == [0, 1, 2, 3, 4] for v in got.values()) and len(got) == 28


def test_no_join_on_positions_in_the_plan(spark):
    ranked = spark.createDataFrame([(g, g) for g in range(1, 40)], "g long, item long")
    plan = RK.take_positions(spark.createDataFrame([("a", 3)], "q string, _upto long"), ranked, "item", "g")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" not in text


def test_fill_with_more_knocked_items_than_the_head(spark, monkeypatch):
    monkeypatch.setattr(RK, "HEAD", 4)
    universe = spark.range(1, 30).withColumnRenamed("id", "item")
    need = spark.createDataFrame([(1, 3), (2, 2), (3, 0)], "q long, need long")
    knocked = spark.createDataFrame([(1, i) for i in range(1, 20)] + [(2, 2)], "q long, item long")
    got = sorted((r["q"], r["fill_pos"], r["item"]) for r in complete_in_id_order(need, knocked, universe, "q", "item").collect())
    assert got == [(1, 1, 20), (1, 2, 21), (1, 3, 22), (2, 1, 1), (2, 2, 3)]


@pytest.mark.parametrize("dense_per_pair,pairs", [(0, 7), (10**9, 7), (64, 1 << 21)])
def test_tile_products_dense_and_sparse(monkeypatch, dense_per_pair, pairs):
    monkeypatch.setattr(blocks, "DENSE_PER_PAIR", dense_per_pair)
    monkeypatch.setattr(blocks, "PAIRS_PER_CHUNK", pairs)
    monkeypatch.setattr(blocks, "KEYS_PER_CHUNK", 16)
    rng = np.random.default_rng(2)
    for rows, cols, keys, cells in ((1, 1, 1, 1), (9, 7, 50, 60), (30, 20, 40, 500)):
        side = lambda n: (rng.integers(0, keys, cells), rng.integers(0, n, cells), rng.normal(size=cells))
        left, right = side(rows), side(cols)
        a, b = np.zeros((rows, keys)), np.zeros((keys, cols))
        np.add.at(a, (left[1], left[0]), left[2])
        np.add.at(b, (right[0], right[1]), right[2])
        assert np.allclose(blocks._multiply(rows, cols, keys, left, right), a @ b)
