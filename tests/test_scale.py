"""Work that grows with users, copies or pairs: kernels against plain loops, and what is searched or held at once."""
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from recflow.operators import ann as ANN, blocks as B, content as C, knn as K, pairs as PR, search as SE, text_index as TI


def unit(rng, n, d=5, copies=0):
    x = rng.normal(size=(n, d))
    x[n - copies:] = x[:copies]
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_best_cells_against_whole_order(monkeypatch):
    """No row is sorted as a whole, copies and masks included."""
    monkeypatch.setattr(K, "CHUNK_ROWS", 7)
    monkeypatch.setattr(K, "CHUNK_COLS", 11)
    monkeypatch.setattr(K, "CHUNK_CELLS", 5)
    rng = np.random.default_rng(3)
    rows, cols = unit(rng, 23), unit(rng, 60, copies=25)
    ids, wanted = np.arange(60) * 3, rng.integers(0, 70, size=23)
    out = (rng.integers(0, 23, size=80), rng.integers(0, 60, size=80))
    mask = rng.random((23, 60)) < 0.8
    r, c, score = K.best_cells(rows, cols, ids, wanted, out, lambda a, b: mask[a, b])
    allowed = mask.copy()
    allowed[out] = False
    for row in range(23):
        exact = rows[row] @ cols.T
        want = [j for _, j in sorted((-round(exact[j], 9), j) for j in np.flatnonzero(allowed[row]))][:wanted[row]]
        assert c[r == row].tolist() == want
        assert np.allclose(score[r == row], exact[want])


@pytest.mark.parametrize("dense", [False, True])
def test_top_cells_sort_few(monkeypatch, dense):
    """ties and full tiles are cut before the sort."""
    rng = np.random.default_rng(4)
    scores = rng.integers(0, 4, size=(30, 200)) / 4.0
    allowed = rng.random((30, 200)) < (0.9 if dense else 0.02)
    rows, cols = np.arange(30), np.arange(200) * 2
    sizes = []
    real = np.lexsort
    monkeypatch.setattr(B.np, "lexsort", lambda keys: sizes.append(len(keys[0])) or real(keys))
    i, j = B.top_cells(rows, cols, scores, allowed, 5, 9)
    for r in range(30):
        assert j[i == r].tolist() == [x for _, x in sorted((-scores[r, x], x) for x in np.flatnonzero(allowed[r]))][:5]
    assert max(sizes) <= 4 * 5 * 30


def test_a_seed_is_searched_once(spark, monkeypatch):
    """Users with the same seed share one search, whatever they exclude."""
    rng = np.random.default_rng(5)
    x = unit(rng, 40)
    cat = spark.createDataFrame([(i, x[i].tolist(), None, None, None, None, 1.0) for i in range(40)],
                                "product_id long, embedding array<double>, category string, style string, material string, "
                                "color string, price double")
    seeds = {u: sorted({u % 3, 3 + u % 2}) for u in range(60)}
    gone = {u: set(rng.integers(0, 45, size=u % 12).tolist()) for u in range(60)}
    searched = []
    real = C.vector_search
    monkeypatch.setattr(C, "vector_search", lambda q, *a: searched.append(q.count()) or real(q, *a))
    got = C.recommend_from_history(
        spark.createDataFrame([(u, s) for u in seeds for s in seeds[u]], "user_id long, product_id long"),
        spark.createDataFrame([(u,) for u in seeds], "user_id long"), cat, 6,
        spark.createDataFrame([(u, p) for u in gone for p in gone[u]], "user_id long, product_id long"), 0.0).collect()
    assert searched == [5]
    sims = x @ x.T
    for u in seeds:
        best = {p: (round(max(sims[p, s] for s in seeds[u]), 9), round(np.mean([sims[p, s] for s in seeds[u]]), 9))
                for p in range(40) if p not in gone[u]}
        want = [p for _, _, p in sorted((-b, -m, p) for p, (b, m) in best.items() if b >= 0)][:6]
        assert [r["product_id"] for r in sorted((r for r in got if r["user_id"] == u), key=lambda r: r["rank"])] == want


def test_history_similarity_makes_no_pair_rows(spark, monkeypatch):
    """Seeds meet candidates inside blocks of users."""
    monkeypatch.setattr(C, "PAIRS_PER_CHUNK", 3)
    x = unit(np.random.default_rng(6), 8)
    vectors = spark.createDataFrame([(i, x[i].tolist()) for i in range(8)] + [(9, None)], "product_id long, embedding array<double>")
    seeds = spark.createDataFrame([(1, 0), (1, 2), (1, 2), (2, 77), (2, None), (3, 9)], "user_id long, product_id long")
    cands = spark.createDataFrame([(1, 4), (1, 5), (1, 5), (1, 99), (2, 4), (3, 4), (4, 1), (None, 3)], "user_id long, product_id long")
    out = C.history_similarity(seeds, cands, vectors)
    assert "FlatMapGroupsInPandas" in out._jdf.queryExecution().toString()
    got = sorted((r["user_id"] or 0, r["product_id"], round(r["embedding_similarity"], 9), round(r["embedding_mean_similarity"], 9))
                 for r in out.collect())
    sims = lambda p: [x[p] @ x[s] for s in (0, 2, 2)]
    one = lambda p: (1, p, round(max(sims(p)), 9), round(np.mean(sims(p)), 9))
    assert got == sorted([one(4), one(5), one(5), (1, 99, 0, 0), (2, 4, 0, 0), (3, 4, 0, 0), (4, 1, 0, 0), (0, 3, 0, 0)])


def test_lsh_pairs_without_pair_rows(spark, monkeypatch):
    """the same pairs and neighbours as MLlib's join, which is not asked."""
    rng = np.random.default_rng(7)
    x = unit(rng, 90, 6, copies=20)
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(90)], "product_id long, embedding array<double>")
    v = df.select(F.col("product_id").alias("id"), array_to_vector("embedding").alias("features"))
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=0.5, numHashTables=2, seed=42).fit(v)
    pairs = model.approxSimilarityJoin(v, v, 2.0 + 1e-9, distCol="dist").select("datasetA.id", F.col("datasetB.id").alias("other"), "dist")
    pairs = [(r[0], r[1], round(r[2], 9)) for r in pairs.collect() if r[0] != r[1]]
    monkeypatch.setattr(BucketedRandomProjectionLSHModel, "approxSimilarityJoin", None)
    monkeypatch.setattr(ANN, "LSH_ROWS", 16)
    monkeypatch.setattr(ANN, "LSH_ROWS_AT_ONCE", 5)
    near, count = ANN.lsh_neighbours(df, 4, 0.5, 2)
    assert count.first()["candidate_pairs"] == len(pairs)
    got = sorted((r["query_id"], r["rank"], r["neighbor_id"]) for r in near.collect())
    want = []
    for i in range(90):
        want += [(i, at + 1, o) for at, (_, o) in enumerate(sorted((d, o) for a, o, d in pairs if a == i)[:4])]
    assert got == want


@pytest.mark.parametrize("length,tables,unit_rows", [(2.0, 3, True), (0.3, 3, True), (2.5, 2, False)])
def test_lsh_meets_every_pair_of_rows_once(spark, monkeypatch, length, tables, unit_rows):
    """buckets that hold most rows are not multiplied table by table; few and many collisions, vectors longer than one, equal ids."""
    rng = np.random.default_rng(3)
    x = unit(rng, 120, 5, copies=15) * (1 if unit_rows else rng.uniform(0.2, 1.9, size=(120, 1)))
    ids = [*range(118), 3, 3]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "product_id long, embedding array<double>")
    v = df.select(F.col("product_id").alias("id"), array_to_vector("embedding").alias("features"))
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=length, numHashTables=tables, seed=42).fit(v)
    hashes = np.array([[int(h[0]) for h in r["hashes"]] for r in model.transform(v).collect()])
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    ok = (hashes[:, None] == hashes[None]).any(axis=2) & (dist < 2.0 + 1e-9) & (np.array(ids)[:, None] != np.array(ids)[None])
    for name, value in (("LSH_ROWS_AT_ONCE", 6), ("LSH_COLS_AT_ONCE", 10)):
        monkeypatch.setattr(ANN, name, value)
    monkeypatch.setattr(ANN.K, "PAIR_ROWS", 50)
    blocks_met = []
    real = ANN.K.pair_groups
    monkeypatch.setattr(ANN.K, "pair_groups", lambda df: blocks_met.append(1) or real(df))
    near, count = ANN.lsh_neighbours(df, 4, length, tables)
    assert blocks_met == [1] * (length > 0.3)  # otherwise the buckets have fewer pairs
    assert count.first()["candidate_pairs"] == ok.sum()
    got = {}
    for r in near.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["neighbor_id"]))
    for i in range(118):
        if ids.count(i) == 1 and ok[i].any():
            order = np.lexsort((ids, np.where(ok[i], np.round(dist[i], 9), np.inf)))[:min(4, ok[i].sum())]
            assert [n for _, n in sorted(got[i])] == [ids[j] for j in order], i
        elif not ok[i].any():
            assert i not in got or ids.count(i) > 1


def test_lsh_report_finds_the_true_neighbours_once(spark, monkeypatch):
    """the exact neighbours are kept, not found again for each setting."""
    folder = []
    real = ANN.neighbour_recall
    monkeypatch.setattr(ANN, "neighbour_recall", lambda near, truth: folder.append(truth._jdf.queryExecution().toString()) or real(near, truth))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(unit(np.random.default_rng(1), 40, 4))],
                               "product_id long, embedding array<double>")
    assert ANN.lsh_report(df, 3).count() == 3
    assert len(folder) == 3 and not any("FlatMapGroupsInPandas" in plan for plan in folder)


def test_best_pairs_hold_few_scores():
    """a pair of blocks is multiplied in pieces."""
    rng = np.random.default_rng(8)
    x = unit(rng, 1600, 4)
    side = lambda s, a, b: pd.DataFrame({"side": s, "id": np.arange(a, b), "vec": list(x[a:b])})
    tracemalloc.start()
    got = PR._best_pairs(4)(pd.concat([side(0, 0, 800), side(1, 800, 1600)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16e6
    for frame, low, high in ((got, 0, 800), (PR._best_pairs(4)(side(0, 0, 800)), 0, 0)):
        s = np.round(x[:800] @ (x[800:].T if high else x[:800].T), 9)
        want = sorted((-s[i, j], i, j + high) for i in range(800) for j in range(800) if high or i < j)[:4]
        assert list(zip(frame["left_id"], frame["right_id"])) == [(i, j) for _, i, j in want]


def test_a_text_is_searched_once(spark, monkeypatch):
    """users who ask the same share one search, whatever they exclude; F14: no data-sized side of a join is broadcast."""
    monkeypatch.setattr(TI, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(TI, "HOT_POSTINGS", 6)
    words = ["red", "blue", "oak", "tin", "lamp", "desk", "rug"]
    rng = np.random.default_rng(9)
    cat = spark.createDataFrame([(i, " ".join(rng.choice(words, size=4))) for i in range(50)], "product_id long, description string")
    index = TI.fit_index(cat)
    texts = ["red lamp", "oak", "blue rug desk", None]
    asked = [(u, texts[u % 4]) for u in range(40)]
    gone = {u: set(rng.integers(0, 55, size=u % 9).tolist()) for u in range(40)}
    scores = {}
    for r in TI.all_scores(index, spark.createDataFrame(list(enumerate(texts)), "q long, text string"), "q").collect():
        scores.setdefault(r["q"], {})[r["product_id"]] = r["score"]
    searched = []
    real = TI.top_scores
    monkeypatch.setattr(TI, "top_scores", lambda i, q, *a, **k: searched.append(q.count()) or real(i, q, *a, **k))
    got = TI.recommend_from_query(index, spark.createDataFrame(asked, "user_id long, text string"), 8, spark.createDataFrame(
        [(u, p) for u in gone for p in gone[u]], "user_id long, product_id long")).collect()
    assert searched == [3]
    for u, _ in asked:
        own = scores.get(u % 4, {})
        want = [p for _, p in sorted((-round(own.get(p, 0.0), 9), p) for p in range(50) if p not in gone[u])][:8]
        assert [r["product_id"] for r in sorted((r for r in got if r["user_id"] == u), key=lambda r: r["rank"])] == want
    plan = index.encode(spark.createDataFrame([(1, "red")], "q long, text string"), "q")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" not in plan
