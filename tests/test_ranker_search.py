"""Pooled fits and successive halving against single fits and the full grid; trees on a curved signal."""
import numpy as np
import pytest

from recflow.operators import ranker as RK, ranker_search as RS
from recflow.operators.hybrid import FEATURE_COLUMNS
from recflow.operators.metrics import grouped_ranking


def frame(spark, users=90, seed=3, curved=False):
    rng = np.random.default_rng(seed)
    rows = []
    for u in range(users):
        pos = int(rng.integers(0, 12))
        for p in range(12):
            f = rng.normal(size=len(FEATURE_COLUMNS))
            f[-1] = rng.random()
            if curved:
                f[3] = rng.normal() * (0.2 if p == pos else 1.0) if p != pos else 0.05 * rng.normal()
            elif p == pos:
                f[3] += 1.5
                f[5] -= 0.7
            rows.append((u, p, int(p == pos), ("train", "val", "test")[u % 3], *map(float, f)))
    schema = "user_id long, product_id long, label int, split string, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    return spark.createDataFrame(rows, schema).cache()


def test_pooled_fit_is_every_single_fit(spark):
    df = frame(spark)
    rows = RS.difference_rows(df).cache()
    settings = [{"setting": i, "reg": reg, "hard": 0.0} for i, reg in enumerate((1e-3, 0.01, 0.3))]
    betas = RS.pooled_fit(rows, settings)
    for s, beta in zip(settings, betas):
        single = RK.fit_pairwise(df, reg=s["reg"]).coefficients
        assert beta == pytest.approx([single[c] for c in FEATURE_COLUMNS], abs=2e-3)
    # a weighted pair counts as that many pairs
    d = np.stack([r["d"] for r in rows.collect()])
    h = np.array([r["h"] for r in rows.collect()])
    beta, w = RS.pooled_fit(rows, [{"setting": 0, "reg": 0.05, "hard": 3.0}])[0], 1 + 3 * h
    slope = -(w / (1 + np.exp(d @ beta))) @ d / w.sum() + 0.05 * (d ** 2).mean(axis=0) * beta
    assert np.abs(slope).max() < 1e-8


def test_halving_against_the_full_grid(spark):
    df = frame(spark)
    settings = RS.draw_parameters(6, 1)
    assert all(1e-4 <= s["reg"] <= 1 and 0 <= s["hard"] <= 4 for s in settings)
    best, trials = RS.successive_halving(df, settings, (0.3, 0.6, 1.0))
    rows = trials.collect()
    assert [sum(r["rung"] == k for r in rows) for k in range(3)] == [6, 3, 2]
    users = [{r["users"] for r in rows if r["rung"] == k} for k in range(3)]
    assert all(len(u) == 1 for u in users) and max(users[0]) < max(users[2]) == 30
    for k in (1, 2):  # a rung holds what the one before kept
        assert {r["setting"] for r in rows if r["rung"] == k} == {r["setting"] for r in rows if r["rung"] == k - 1 and r["kept"]}
    train, val = df.where("split = 'train'"), df.where("split = 'val'")
    grid = RS.evaluate(val, settings, RS.pooled_fit(RS.difference_rows(train).cache(), settings))
    assert {r["setting"]: r["ndcg_at_5"] for r in rows if r["rung"] == 2} == {
        r["setting"]: grid[r["setting"]] for r in rows if r["rung"] == 2}
    assert grid[best["setting"]] >= max(grid.values()) - 0.03
    ranker = RS.fit_ranker(train, best)
    direct = grouped_ranking(ranker.score(val), "ranker_score", (5,)).first()["ndcg_at_5"]
    assert direct == grid[best["setting"]] and direct > 0.6


def test_trees_find_a_curved_signal(spark):
    df = frame(spark, 120, curved=True)
    train, test = df.where("split <> 'test'"), df.where("split = 'test'")
    trees = RK.gbt_scored(RK.fit_pointwise_gbt(train, max_iter=10), test)
    line = RK.fit_pairwise(train).score(test)
    ndcg = [grouped_ranking(x, "ranker_score", (5,)).first()["ndcg_at_5"] for x in (trees, line)]
    assert trees.count() == test.count() and ndcg[0] > ndcg[1] + 0.1


def test_no_training_rows(spark):
    assert not RS.pooled_fit(RS.difference_rows(frame(spark, 6).where("label = 0")), RS.draw_parameters(2)).any()
