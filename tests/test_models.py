"""Low-rank model vs dense NumPy SVD; pairwise ranker on planted data."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from recflow.operators import lowrank as LR, ranker as RK
from recflow.operators.hybrid import FEATURE_COLUMNS


def test_svd_matches_dense_truncated_svd(spark):
    rng = np.random.default_rng(5)
    users, items, k = 15, 8, 3
    R = np.where(rng.random((users, items)) < 0.4, rng.integers(1, 20, (users, items)).astype(float), 0.0)
    R[0] = 0.0
    R[0, 1] = 4.0
    rows = [(u, i, float(R[u, i])) for u in range(users) for i in range(items) if R[u, i] != 0]
    m = spark.createDataFrame(rows, "user_id long, product_id long, value double")
    present = sorted({i for _, i, _ in rows})
    Rp = R[:, present]
    users_present = sorted({u for u, _, _ in rows})
    Rp = Rp[users_present]
    mean = Rp.mean(axis=1, keepdims=True)
    C = Rp - mean
    _, _, vt = np.linalg.svd(C, full_matrices=False)
    V = vt[:k].T
    P = C @ V @ V.T + mean
    got = LR.svd_recommend(m, n=3, n_components=k).collect()
    for a, u in enumerate(users_present):
        cand = [b for b in range(len(present)) if Rp[a, b] == 0]
        want = sorted(cand, key=lambda b: (-round(P[a, b], 9), present[b]))[:3]
        mine = sorted([r for r in got if r["user_id"] == u], key=lambda r: r["rank"])
        assert [r["product_id"] for r in mine] == [present[b] for b in want]
        for r, b in zip(mine, want):
            assert r["score"] == pytest.approx(P[a, b], abs=1e-9)


def test_pairwise_ranker_learns_planted_signal(spark):
    rng = np.random.default_rng(11)
    rows = []
    for u in range(60):
        pos = int(rng.integers(0, 20))
        for p in range(20):
            f = rng.normal(size=len(FEATURE_COLUMNS))
            label = int(p == pos)
            f[3] += 3.0 * label          # price_sensitivity_match carries the signal
            f[10] = rng.normal()          # the hybrid score is noise here
            rows.append((u, p, label, *map(float, f)))
    schema = "user_id long, product_id long, label int, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    frame = spark.createDataFrame(rows, schema)
    rk = RK.fit_pairwise(frame)
    assert rk.coefficients["price_sensitivity_match"] > 0
    assert max(rk.coefficients, key=lambda c: abs(rk.coefficients[c])) == "price_sensitivity_match"
    from recflow.operators.metrics import grouped_ranking
    ltr = grouped_ranking(rk.score(frame), "ranker_score", (5,)).first()["ndcg_at_5"]
    heur = grouped_ranking(frame, "hybrid_signal_score", (5,)).first()["ndcg_at_5"]
    assert ltr > heur
    imp = RK.feature_importance(rk, frame).orderBy("rank").first()
    assert imp["feature"] == "price_sensitivity_match"
