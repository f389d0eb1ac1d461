"""Subspace iteration against dense linear algebra; ALS against its own factors."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from recflow.operators import lowrank as LR


def cells(rng, users, items, per_user, groups=6):
    """Sparse rows with ``groups`` tastes; few items of a taste are popular and most are rare."""
    rows = {}
    for u in range(users):
        home = u % groups
        liked = (rng.random(per_user) ** 3 * (items // groups)).astype(int) * groups + home
        for i in np.concatenate([liked, rng.integers(0, items, max(1, per_user // 5))]):
            rows[u, int(i)] = float(rng.integers(1, 20))
    return [(u, i, v) for (u, i), v in rows.items()]


def dense(rows):
    users, items = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    at = {p: j for j, p in enumerate(items)}
    matrix = np.zeros((len(users), len(items)))
    for u, i, v in rows:
        matrix[users.index(u), at[i]] = v
    return users, items, matrix


@pytest.mark.parametrize("n_items,per_user,k", [(300, 12, 6), (50_000, 400, 6)])
def test_reconstruction_error_is_the_smallest(spark, n_items, per_user, k):
    rows = cells(np.random.default_rng(n_items), 300, n_items, per_user)
    matrix = spark.createDataFrame(rows, "user_id long, product_id long, value double").repartition(8)
    model = LR.fit_svd(matrix, k)
    _, items, r = dense(rows)
    assert n_items < 50_000 or len(items) > 30_000
    c = r - r.mean(axis=1, keepdims=True)
    total = (c ** 2).sum()
    best = np.sort(np.linalg.eigvalsh(c @ c.T))[::-1][:k]
    vec = {x["product_id"]: x["vec"] for x in model.items.collect()}
    assert sorted(vec) == items
    v = np.array([vec[i] for i in items]) @ model.ritz
    assert np.allclose(v.T @ v, np.eye(k), atol=1e-8)
    error = ((c - c @ v @ v.T) ** 2).sum()
    assert error <= 1.01 * (total - best.sum()) and np.allclose(model.singular[:k - 1] ** 2, best[:k - 1], rtol=0.02)


def test_unseen_items_only_and_blocks(spark, monkeypatch):
    rows = cells(np.random.default_rng(3), 40, 90, 8)
    matrix = spark.createDataFrame(rows, "user_id long, product_id long, value double")
    whole = {tuple(r)[:3] for r in LR.svd_recommend(matrix, 7, 90).collect()}
    users, items, r = dense(rows)
    # all components: the prediction is the matrix itself, so unseen items all score 0 and come in id order
    want = {(u, i, k + 1) for a, u in enumerate(users)
            for k, i in enumerate([i for j, i in enumerate(items) if r[a, j] == 0][:7])}
    assert whole == want
    monkeypatch.setattr(LR, "USERS_PER_BLOCK", 7)
    monkeypatch.setattr(LR, "ITEMS_PER_BLOCK", 11)
    assert {tuple(r)[:3] for r in LR.svd_recommend(matrix, 7, 90).collect()} == want


def test_als_takes_large_ids_and_skips_seen_items(spark):
    rng = np.random.default_rng(4)
    rows = [(u, int(i), 20.0 if u % 2 == i % 2 else 1.0) for u in range(60) for i in rng.choice(80, 20, replace=False)]
    shift = 1 << 40
    matrix = spark.createDataFrame([(u + shift, i + shift, v) for u, i, v in rows],
                                   "user_id long, product_id long, value double")
    recs = LR.als_recommend(matrix, 5, max_iter=4).collect()
    seen = {(u + shift, i + shift) for u, i, _ in rows}
    assert len(recs) == 60 * 5 and not {(r["user_id"], r["product_id"]) for r in recs} & seen
    by_user = {}
    for r in recs:
        by_user.setdefault(r["user_id"], []).append((r["rank"], r["score"], r["product_id"]))
    for ranked in by_user.values():
        ranked.sort()
        assert [x[0] for x in ranked] == [1, 2, 3, 4, 5]
        assert all(a[1] >= b[1] - 1e-9 for a, b in zip(ranked, ranked[1:]))
    # users rate items of their own parity high, so unseen ones of that parity come first
    assert np.mean([(r["user_id"] - r["product_id"]) % 2 == 0 for r in recs]) > 0.9


def test_one_item(spark):
    matrix = spark.createDataFrame([(1, 5, 3.0), (2, 5, 1.0)], "user_id long, product_id long, value double")
    assert LR.svd_recommend(matrix).where(F.col("user_id") == 1).collect() == []
