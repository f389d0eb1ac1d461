"""CF identity vs dense NumPy formulas; blocked k-NN vs brute force."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from recflow.operators import cf as CF, knn as K


def _random_interactions(spark, seed=3, users=12, items=9):
    rng = np.random.default_rng(seed)
    rows = []
    for u in range(users):
        for i in rng.choice(items, size=rng.integers(1, 5), replace=False):
            et = rng.choice(["view", "wishlist", "cart", "purchase", "error"])
            rows.append((u, int(i), str(et)))
    df = spark.createDataFrame(rows, "user_id long, product_id long, event_type string")
    from recflow.operators.interactions import build_interactions
    return build_interactions(df), rows


def _weighted_means(rows):
    """{user: {unseen item: prediction}} by definition: for every other user, how alike the two are, and
    the mean of what they gave the item, weighted by that."""
    scores = {"view": 3.0, "wishlist": 5.0, "cart": 7.0, "purchase": 20.0}
    table = {}
    for user, item, event in rows:
        own = table.setdefault(user, {})
        own[item] = own.get(item, 0.0) + scores.get(event, 0.0)
    catalog = sorted({i for own in table.values() for i in own})

    def length(user):
        return sum(x * x for x in table[user].values()) ** 0.5

    def alike(one, two):
        if not length(one) or not length(two):
            return 0.0
        return sum(x * table[two].get(i, 0.0) for i, x in table[one].items()) / (length(one) * length(two))

    out = {}
    for user in table:
        near = {other: alike(user, other) for other in table if other != user}
        whole = sum(near.values())
        out[user] = {item: sum(a * table[other].get(item, 0.0) for other, a in near.items()) / whole if whole else 0.0
                     for item in catalog if table[user].get(item, 0.0) <= 0}
    return out


@pytest.mark.parametrize("side", [2048, 3])
def test_cf_predictions_match_the_definition(spark, monkeypatch, side):
    from recflow.operators import blocks
    monkeypatch.setattr(blocks.tiles_for, "__defaults__", (side,))
    monkeypatch.setattr(blocks, "ROWS_PER_TILE", side)
    inter, rows = _random_interactions(spark)
    want = _weighted_means(rows)
    model = CF.fit_cf(inter)
    items = sorted({r[1] for r in rows})
    cells, span = CF.predicted_cells(model, inter.select("user_id").distinct().crossJoin(inter.select("product_id").distinct()))
    got = {(r["user_id"], r["product_id"]): r["pred"] for r in cells.collect()}
    for user, own in want.items():
        for item, value in own.items():
            assert got.get((user, item), 0.0) == pytest.approx(value, abs=1e-12)
    every = [v for own in want.values() for v in own.values()]
    ends = span.first()
    assert ends["lo"] == pytest.approx(min(every)) and ends["hi"] == pytest.approx(max(every))
    # recommend: ordered by prediction, cells without one complete in id order
    rec = CF.cf_recommend(model, inter.select("user_id"), n=len(items)).collect()
    for user, own in want.items():
        mine = [r["product_id"] for r in sorted((r for r in rec if r["user_id"] == user), key=lambda r: r["rank"])]
        assert mine == sorted(own, key=lambda i: (-round(own[i], 9), i))


def test_cf_takes_a_large_catalog(spark):
    """More items than one tile or the former bound of 20,000."""
    inter = spark.range(25_000).selectExpr("id div 5 as user_id", "id as product_id", "'view' as event_type", "3.0D as score")
    inter = inter.unionByName(spark.range(10, 15).selectExpr("id as user_id", "7L as product_id", "'view' as event_type", "3.0D as score"))
    model = CF.fit_cf(inter)
    assert model.n_items == 25_000
    rec = CF.cf_recommend(model, inter.select("user_id").where("user_id < 15"), n=3).collect()
    assert len(rec) == 45
    # user 1 (items 5 to 9) is near users 10 to 14 through item 7: each gives a fifth of its items
    assert [r["product_id"] for r in sorted(rec, key=lambda r: r["rank"]) if r["user_id"] == 1] == [50, 51, 52]


def test_knn_blocked_matches_bruteforce(spark):
    rng = np.random.default_rng(7)
    X = rng.normal(size=(40, 6))
    X /= np.linalg.norm(X, axis=1, keepdims=True)
    X[5] = X[4]   # identical vectors: ties broken by id
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(40)], "product_id long, embedding array<double>")
    got = K.knn(df, 3, nb=3).collect()
    S = X @ X.T
    for q in range(40):
        order = sorted([j for j in range(40) if j != q], key=lambda j: (-round(S[q, j], 9), j))[:3]
        mine = [r["neighbor_id"] for r in sorted([r for r in got if r["query_id"] == q], key=lambda r: r["rank"])]
        assert mine == order
    pairs = K.all_pairs(df, nb=3)
    assert pairs.count() == 40 * 39 // 2
    assert pairs.where(F.col("left_id") >= F.col("right_id")).count() == 0


@pytest.mark.parametrize("scale", [1.0, 1e20])
def test_both_sides_of_a_pair_of_blocks(spark, monkeypatch, scale):
    """one product serves the neighbours of both blocks; rows of any length, equal rows, zero rows; huge numbers."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(150, 6)) * rng.uniform(0.01, 3, size=(150, 1))
    x[5], x[40:60], x[70] = x[4], x[90], 0.0
    x *= scale
    for name, value in (("PAIR_ROWS", 60), ("CHUNK_ROWS", 7), ("CHUNK_BOTH", 11)):
        monkeypatch.setattr(K, name, value)
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(150)], "product_id long, embedding array<double>")
    s = np.round(x @ x.T, 9)
    got = {}
    for r in K.knn(df, 5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["neighbor_id"]))
    for q in range(150):
        if scale == 1:
            assert [n for _, n in sorted(got[q])] == sorted((j for j in range(150) if j != q), key=lambda j: (-s[q, j], j))[:5]
        else:
            assert len(got[q]) == 5


@pytest.mark.parametrize("share", [0.0, 2.0])
def test_best_cells_of_a_tile_do_not_depend_on_how_full_it_is(spark, monkeypatch, share):
    """Taken from the dense tile or from its cells alone."""
    inter, rows = _random_interactions(spark)
    monkeypatch.setattr(CF, "DENSE_SHARE", share)
    want = _weighted_means(rows)
    items = sorted({r[1] for r in rows})
    got = {}
    for r in CF.predicted_top(CF.fit_cf(inter), len(items)).collect():
        got.setdefault(r["user_id"], {})[r["product_id"]] = r["pred"]
    for user, own in want.items():
        assert got.get(user, {}) == pytest.approx({i: v for i, v in own.items() if v != 0}, abs=1e-12)


def test_gram_of_sparse_keys_builds_no_dense_sides():
    """A block of many keys with a cell each: only the sums are a dense array."""
    import tracemalloc

    import pandas as pd

    from recflow.operators import blocks
    n = 2048
    ids = np.arange(n)
    cells = pd.concat([pd.DataFrame({"k": ids, "c": ids, "x": 2.0, "side": side}) for side in (0, 1)])
    tracemalloc.start()
    out = blocks._block_product(cells)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (out["a"] == out["b"]).all() and (out["v"] == 4.0).all() and len(out) == n
    assert peak < 1.5 * 8 * n * n
