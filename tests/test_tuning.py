"""Tuned models: what is loaded serves the same as what was fitted."""
import numpy as np

from recflow.operators import hybrid as H, ranking_data as RD, text_index as TI, tuning as TU
from recflow.operators.interactions import build_interactions


def _tables(spark):
    rng = np.random.default_rng(4)
    events = []
    for u in range(20):
        for t in range(18):
            kind = ["view", "view", "wishlist", "cart", "purchase"][rng.integers(5)]
            events.append((u, int(rng.integers(0, 25)), kind, f"2024-01-{t + 1:02d} 00:00:00"))
    behavior = spark.createDataFrame(events, "user_id long, product_id long, event_type string, timestamp string").selectExpr(
        "user_id", "product_id", "event_type", "cast(timestamp as timestamp_ntz) as timestamp")
    vec = rng.normal(size=(25, 6))
    vec /= np.linalg.norm(vec, axis=1, keepdims=True)
    words = ["red", "blue", "oak", "pine", "sofa", "lamp"]
    catalog = spark.createDataFrame(
        [(i, f"{words[i % 6]} {words[(i * 5 + 1) % 6]}", f"c{i % 3}", f"m{i % 4}", f"r{i % 5}", f"s{i % 2}", 10.0 + i, 4.0,
          f"{words[i % 6]} thing number {i}", "", vec[i].tolist()) for i in range(25)],
        "product_id long, title string, category string, material string, color string, style string, price double, "
        "rating double, description string, catalog_description string, embedding array<double>")
    return behavior, catalog


def test_loaded_model_serves_like_the_fitted_one(spark, tmp_path):
    behavior, catalog = _tables(spark)
    targets = RD.assign_splits(RD.holdout_targets(behavior), 42)
    models = H.fit_models(build_interactions(RD.truncate_history(behavior, targets)), catalog)
    frame = H.ranking_frame(models, targets, catalog.select("product_id"), 42, cf_top_k=5, content_top_k=5, popularity_top_k=5, negatives=5)
    tuned = TU.tune(frame, catalog, trials=3)
    best = max(tuned.validation.collect(), key=lambda r: (r["ndcg_at_5"], -r["config_id"]))
    assert tuned.weights["cf"] == best["w_cf"] and tuned.threshold == best["similarity_threshold"]
    assert {r["model"] for r in tuned.test.collect()} >= {"ltr_hybrid", "lift_abs"}
    full = H.fit_models(build_interactions(behavior), catalog)
    TU.save(full, tuned, str(tmp_path))
    users = behavior.select("user_id").distinct()
    asked = users.selectExpr("user_id", "'blue sofa' as text")
    query = {"index": TI.fit_index(catalog), "queries": asked}
    want = sorted(tuple(r) for r in TU.serve(full, tuned, users, 5, **query).collect())
    got = sorted(tuple(r) for r in TU.serve(*TU.load(spark, str(tmp_path)), users, 5, **query).collect())
    assert len(got) == len(want) == 100
    for a, b in zip(got, want):
        assert a[:3] == b[:3] and np.allclose(a[8:], b[8:], atol=1e-9)


def test_text_index_against_plain_cosines(spark):
    import math
    import re
    docs = [(1, "Red oak sofa"), (2, "red, RED lamp"), (3, "pine lamp in red"), (4, ""), (5, None), (6, "blue pine")]
    index = TI.fit_index(spark.createDataFrame(docs, "product_id long, description string"))
    queries = {10: "red lamp", 11: "unknown words", 12: "Pine!"}
    got = {(r["user_id"], r["product_id"]): (r["score"], r["rank"]) for r in TI.recommend_from_query(
        index, spark.createDataFrame(list(queries.items()), "user_id long, text string"), 6).collect()}
    words = {i: re.findall(r"\w+", (t or "").lower()) for i, t in docs}
    df = {w: sum(w in ws for ws in words.values()) for ws in words.values() for w in ws}

    def unit(ws):
        v = {w: ws.count(w) * math.log(7 / (df[w] + 1)) for w in ws if w in df}
        n = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / n for w, x in v.items()} if n else {}

    for q, t in queries.items():
        own = unit(re.findall(r"\w+", t.lower()))
        scores = {i: sum(x * own.get(w, 0) for w, x in unit(ws).items()) for i, ws in words.items()}
        order = sorted(scores, key=lambda i: (-round(scores[i], 9), i))
        assert [i for i, _ in sorted(((i, got[q, i][1]) for i in scores), key=lambda x: x[1])] == order
        assert all(abs(got[q, i][0] - scores[i]) < 1e-9 for i in scores)
