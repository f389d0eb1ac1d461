"""Operators on hand-made tables (traps T1, T3, T12, T14, T18, T23...)."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from recflow.operators import clean, interactions as I, item_stats as S, preferences as P, profile as V, rfm as R
from recflow.operators.quantiles import exact_percentiles


def D(d, h=0):
    return dt.datetime(2024, 1, d, h)


def test_popularity_reference_case(spark):
    df = spark.createDataFrame([(1, 101, 5.0), (1, 102, 4.0), (2, 101, 5.0)], "user_id long, product_id long, score double")
    out = [r["product_id"] for r in I.popularity_topk(df, 2).orderBy("rank").collect()]
    assert out == [101, 102]


def test_require_columns_sorted_message(spark):
    df = spark.createDataFrame([(1,)], "a long")
    with pytest.raises(ValueError, match=r"\['b', 'c'\]"):
        V.require_columns(df, ["c", "b", "a"])


def test_rfm_event_price_and_fills(spark):
    beh = spark.createDataFrame(
        [(1, 10, "purchase", D(30), 5.0), (1, 11, "purchase", D(1), None), (2, 10, "view", D(2), 9.0)],
        "user_id long, product_id long, event_type string, timestamp timestamp_ntz, price double")
    out = {r["user_id"]: r for r in R.rfm(beh, "2024-01-31").collect()}
    assert (out[1]["recency"], out[1]["frequency"], out[1]["monetary"]) == (1, 2, 5.0)   # T1: own price, NaN skipped
    assert (out[2]["recency"], out[2]["frequency"], out[2]["monetary"]) == (999, 0, 0.0)


def test_clean_order_median_over_raw_rows(spark):
    rows = [(1, "a", "x", "y", "z", "w", None, 4.0, "d"), (2, "a", "x", "y", "z", "w", 10.0, None, "d"),
            (3, "a", "x", "y", "z", "w", -1.0, 4.5, "d"), (3, "a", "x", "y", "z", "w", -1.0, 4.5, "d")]
    df = spark.createDataFrame(rows, "product_id long, name string, category string, material string, color string, "
                                     "style string, price double, rating double, description string")
    out = {r["product_id"]: r for r in clean.clean_products(df).collect()}
    # median over all raw rows (10, -1, -1) = -1 fills product 1 -> then filtered out by price > 0
    assert set(out) == {2}
    assert out[2]["rating"] == pytest.approx((4.0 + 4.5 + 4.5) / 3)
    assert out[2]["category"] == "X"


def test_item_stats_unknown_types(spark):
    inter = spark.createDataFrame([(1, 7, "error", 0.0), (1, 8, "purchase", 20.0), (2, 8, "view", 3.0)],
                                  "user_id long, product_id long, event_type string, score double")
    st = {r["product_id"]: r for r in S.item_stats(inter).collect()}
    assert st[7]["historical_ctr"] == 0.5            # T12: a row, total over known types only
    assert st[8]["historical_ctr"] == pytest.approx(2 / 4)
    assert st[8]["purchase_rate"] == pytest.approx(2 / 4)
    assert st[7]["popularity_score"] == 0.0 and st[8]["popularity_score"] == 1.0


def test_seed_levels_and_first_occurrence(spark):
    rows = [(1, 5, "view", D(1)), (1, 6, "cart", D(2)), (1, 5, "view", D(9)),
            (2, 1, "purchase", D(3)), (2, 2, "view", D(4)), (3, 9, "view", None), (3, 8, "view", D(1))]
    inter = I.build_interactions(spark.createDataFrame(rows, "user_id long, product_id long, event_type string, "
                                                             "timestamp timestamp_ntz"))
    s = P.seed_items(inter, 5).collect()
    got = {(r["user_id"], r["product_id"]): (r["level"], r["recency_rank"]) for r in s}
    assert got[(1, 6)] == (2, 1) and (1, 5) not in got      # high-intent level wins
    assert got[(2, 1)] == (1, 1) and (2, 2) not in got
    assert got[(3, 9)] == (3, 1) and got[(3, 8)] == (3, 2)   # T11: null time counts as most recent


def test_price_profile_zero_weights_fall_back(spark):
    cat = spark.createDataFrame([(1, "c", "m", "s", 100.0), (2, "c", "m", "s", 300.0)],
                                "product_id long, category string, material string, style string, price double")
    inter = spark.createDataFrame([(1, 1, "error", 0.0), (2, 1, "view", 3.0), (2, 2, "view", 3.0)],
                                  "user_id long, product_id long, event_type string, score double")
    out = {r["user_id"]: r for r in P.user_price_profile(inter, cat).collect()}
    assert out[1]["avg_price"] == 200.0 and out[1]["price_std"] == 30.0
    assert out[2]["avg_price"] == pytest.approx(200.0) and out[2]["price_std"] == pytest.approx(100.0)


def test_exact_percentiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = rng.normal(size=301).round(3)
    vals[:100] = 0.5   # a hot value spread over partitions
    df = spark.createDataFrame([(float(v), int(i % 2)) for i, v in enumerate(vals)], "v double, g int")
    out = {r["g"]: r for r in exact_percentiles(df, "v", [0.1, 0.5, 0.9], by=["g"]).collect()}
    for g in (0, 1):
        ref = np.percentile(vals[np.arange(len(vals)) % 2 == g], [10, 50, 90])
        assert [out[g]["p10"], out[g]["p50"], out[g]["p90"]] == pytest.approx(list(ref))


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "price double")
    h = {r["bin"]: r["count"] for r in V.histogram(df, "price", 5).collect()}
    assert h == {1: 1, 2: 0, 3: 1, 4: 0, 5: 1}


def test_percentiles_with_one_huge_outlier(spark):
    """Nearly all values far from the largest: buckets still hold small shares, and the answer is exact."""
    import numpy as np
    from pyspark.sql import functions as F
    from recflow.operators.quantiles import exact_percentiles
    rng = np.random.default_rng(1)
    values = np.append(rng.random(20_000), [1e9, 0.5, 0.5, 0.5])
    df = spark.createDataFrame([(float(v), i % 2) for i, v in enumerate(values)], "v double, g int")
    got = exact_percentiles(df, "v", [0.0, 0.1, 0.5, 0.99, 1.0], names=list("abcde")).first()
    want = np.percentile(values, [0, 10, 50, 99, 100])
    assert np.allclose([got[c] for c in "abcde"], want, rtol=1e-12)
    by = {r["g"]: r["m"] for r in exact_percentiles(df, "v", [0.5], by=["g"], names=["m"]).collect()}
    for g in (0, 1):
        own = [v for i, v in enumerate(values) if i % 2 == g]
        assert abs(by[g] - np.percentile(own, 50)) < 1e-12
    assert exact_percentiles(df.where(F.lit(False)), "v", [0.5], names=["m"]).count() == 0


def test_ranker_takes_missing_features(spark):
    from recflow.operators import ranker as RK
    cols = list(RK.FEATURE_COLUMNS)
    rows = [(u, p, 1 if p == 0 else 0, None if p == 2 else float(p == 0)) for u in range(6) for p in range(3)]
    df = spark.createDataFrame(rows, "user_id long, product_id long, label int, x double").selectExpr(
        "user_id", "product_id", "label", *[f"x as {c}" for c in cols])
    fitted = RK.fit_pairwise(df)
    got = {(r["user_id"], r["product_id"]): r["ranker_score"] for r in fitted.score(df).collect()}
    assert all(v == v for v in fitted.coefficients.values())
    assert all(got[u, 0] > got[u, 2] == 0.0 for u in range(6))
