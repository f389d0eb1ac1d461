"""Pair statistics, most similar pairs and the inverted file against dense NumPy."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from recflow.operators import ivf, pairs as PR

SCHEMA = "product_id long, embedding array<double>, category string, material string, style string, color string"


def catalog(spark, n, groups=0, seed=1, width=8):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width))
    if groups:
        x = rng.normal(size=(groups, width))[np.arange(n) % groups] + 0.15 * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[n // 2] = x[0]  # equal vectors
    attrs = [[None if rng.random() < 0.1 else f"{a}{rng.integers(3)}" for a in "cmsk"] for _ in range(n)]
    rows = [(3 * i + 1, x[i].tolist(), *attrs[i]) for i in range(n)]
    return x, attrs, spark.createDataFrame(rows, SCHEMA)


def class_scores(x, attrs):
    i, j = np.triu_indices(len(x), k=1)
    s = (x @ x.T)[i, j]
    same = [np.array([attrs[a][k] is not None and attrs[a][k] == attrs[b][k] for a, b in zip(i, j)]) for k in range(4)]
    any_other = same[1] | same[2] | same[3]
    masks = [np.ones(len(s), bool), same[0], same[0] & any_other, same[0] & same[1] & same[2] & same[3], ~same[0]]
    return {name: s[m] for name, m in zip(PR.PAIR_CLASSES, masks)}


@pytest.mark.parametrize("rows_per_block,max_values,buckets", [(2048, 200_000, 4096), (60, 10, 8)])
def test_pair_statistics(spark, monkeypatch, rows_per_block, max_values, buckets):
    for name, value in (("ROWS_PER_BLOCK", rows_per_block), ("MAX_VALUES", max_values), ("BUCKETS", buckets)):
        monkeypatch.setattr(PR, name, value)
    x, attrs, df = catalog(spark, 150)
    got = {r["pair_class"]: r for r in PR.pair_statistics(df, digits=9).collect()}
    want = {k: v for k, v in class_scores(x, attrs).items() if len(v)}
    assert set(got) == set(want)
    for name, s in want.items():
        r = got[name]
        assert r["count"] == len(s)
        for column, value in (("min", s.min()), ("max", s.max()), ("mean", s.mean()), ("std", s.std()), *(
                (f"p{p}", np.percentile(s, p)) for p in (10, 25, 50, 75, 90))):
            assert r[column] == pytest.approx(value, abs=2e-9), (name, column)


@pytest.mark.parametrize("buckets,max_values,per_block", [(4096, 50, 40), (16, 10, 64), (64, 200_000, 64)])
def test_pair_statistics_in_pieces(spark, monkeypatch, buckets, max_values, per_block):
    """Several blocks, pieces smaller than a category, rounding settled by buckets or by value: the same rows, and no more
    than three products of all pairs at two levels."""
    for name, value in (("ROWS_PER_BLOCK", per_block), ("WIDEST", 1), ("CHUNK_ROWS", 7), ("CHUNK_COLS", 11),
                        ("HELD_SCORES", 100), ("MAX_VALUES", max_values), ("BUCKETS", buckets)):
        monkeypatch.setattr(PR, name, value)
    passes = []
    own = PR._pass
    monkeypatch.setattr(PR, "_pass", lambda *a: passes.append(a[2]) or own(*a))
    x, attrs, df = catalog(spark, 180, groups=20)
    got = {r["pair_class"]: r for r in PR.pair_statistics(df).collect()}
    want = {k: v for k, v in class_scores(x, attrs).items() if len(v)}
    assert set(got) == set(want)
    for name, s in want.items():
        assert got[name]["count"] == len(s)
        for column, value in (("min", s.min()), ("max", s.max()), ("mean", s.mean()), ("std", s.std()), *(
                (f"p{p}", np.percentile(s, p)) for p in (10, 25, 50, 75, 90))):
            assert got[name][column] == round(float(value), 4), (name, column)
    if buckets == 4096:
        assert len(passes) <= 2  # and the first one, which also finds the moments


@pytest.mark.parametrize("inner", [True, False])
def test_a_score_comes_once_with_its_kind(inner):
    """the classes of a pair share its score; pieces fit a core's cache."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(90, 4))
    attrs = [[None if rng.random() < 0.2 else f"{a}{rng.integers(2)}" for a in "cmsk"] for _ in range(90)]
    blk = np.zeros(90, int) if inner else np.arange(90) % 2
    frame = pd.DataFrame({"id": np.arange(90), "vec": list(x), "blk": blk, "pa": 0, "pb": 0 if inner else 1})
    for k, name in enumerate(PR.ATTRIBUTES):
        frame[name] = [a[k] for a in attrs]
    got = [[] for _ in PR.KINDS]
    for kind, scores in PR._pieces(frame, 7, 11):
        assert 0 < len(scores) <= 77
        got[kind] += np.round(scores, 9).tolist()
    want = [[] for _ in PR.KINDS]
    for i in range(90):
        for j in range(i + 1, 90):
            if inner or blk[i] != blk[j]:
                same = [a is not None and a == b for a, b in zip(attrs[i], attrs[j])]
                want[same[0] * (1 + any(same[1:]) + all(same[1:]))].append(round(float(x[i] @ x[j]), 9))
    assert [sorted(k) for k in got] == [sorted(k) for k in want]
    assert PR.CHUNK_ROWS * PR.CHUNK_COLS <= 1 << 16


def test_equal_scores_and_too_few_rows(spark):
    rows = [(i, [1.0, 0.0], "a", "b", "c", "d") for i in range(40)]
    r = {x["pair_class"]: x for x in PR.pair_statistics(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(r) == set(PR.PAIR_CLASSES[:4]) and r["overall"]["count"] == 780
    assert all(x["p10"] == x["p90"] == x["max"] == 1.0 and x["std"] == 0.0 for x in r.values())
    for n in (0, 1):
        df = spark.createDataFrame(rows[:n], SCHEMA)
        assert PR.pair_statistics(df).collect() == [] and PR.most_similar_pairs(df).collect() == []


@pytest.mark.parametrize("groups,rows_per_block,n", [(0, 2048, 5), (12, 40, 30), (12, 40, 100_000)])
def test_most_similar_pairs(spark, monkeypatch, groups, rows_per_block, n):
    monkeypatch.setattr(PR, "ROWS_PER_BLOCK", rows_per_block)
    x, _, df = catalog(spark, 200, groups)
    got = [(r["left_id"], r["right_id"]) for r in PR.most_similar_pairs(df, n).collect()]
    i, j = np.triu_indices(len(x), k=1)
    s = np.round((x @ x.T)[i, j], 9)
    order = np.lexsort((j, i, -s))[:n]
    assert got == [(3 * a + 1, 3 * b + 1) for a, b in zip(i[order], j[order])]


def test_most_similar_pairs_of_stored_tables(spark, tmp_path):
    """Normalised vectors joined from files: the cell of a row is a join key."""
    from recflow.plans.queries import QUERIES
    x = np.random.default_rng(5).normal(size=(120, 8)).astype("float32")
    spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label long") \
        .write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([(i, f"red round item {i}", "BRAND", "TYPE", i % 50, 1.0 + i) for i in range(120)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double") \
        .write.parquet(f"{tmp_path}/part.parquet")
    got = [(r["left_id"], r["right_id"]) for r in QUERIES["similar_pairs_top"](spark, str(tmp_path)).collect()]
    x = x.astype("float64") / np.linalg.norm(x.astype("float64"), axis=1, keepdims=True)
    i, j = np.triu_indices(len(x), k=1)
    order = np.argsort(-(x @ x.T)[i, j], kind="stable")[:5]
    assert got == [(a, b) for a, b in zip(i[order], j[order])]


def dense_neighbours(x, k):
    s = np.round(x @ x.T, 9)
    np.fill_diagonal(s, -9)
    return np.argsort(-s, axis=1, kind="stable")[:, :k]


def test_all_probes_are_exact_and_few_suffice_on_clustered_rows(spark, monkeypatch):
    monkeypatch.setattr(ivf, "MEMBERS_PER_PART", 25)
    monkeypatch.setattr(ivf, "QUERIES_PER_PART", 30)
    x, _, df = catalog(spark, 900, 30, seed=3, width=16)
    centroids = ivf.fit_centroids(df, ivf.cells_for(900))
    assert centroids.shape == (30, 16)
    index = ivf.build(df, centroids).cache()
    queries = df.select(F.col("product_id").alias("query_id"), F.col("embedding").alias("vec"))
    truth = dense_neighbours(x, 5)

    def found(probes):
        out = {}
        for r in ivf.search(queries, index, centroids, 5, probes).collect():
            out.setdefault((r["query_id"] - 1) // 3, []).append((r["rank"], (r["neighbor_id"] - 1) // 3))
        return {q: [n for _, n in sorted(v)] for q, v in out.items()}

    assert found(30) == {q: truth[q].tolist() for q in range(900)}
    report = ivf.recall_report(df, index, centroids, 5, evaluated=900).orderBy("probes").collect()
    assert [r["probes"] for r in report] == [1, 2, 4, 8, 16, 30] and report[-1]["recall"] == 1.0
    assert report[-1]["candidate_pairs"] == 900 * 899 and report[-1]["pair_share"] == 1.0
    chosen = [r for r in report if r["selected"]]
    assert len(chosen) == 1 and chosen[0]["recall"] >= 0.9 and chosen[0]["pair_share"] < 0.15
    for r in report[:3]:
        got = found(r["probes"])
        recall = np.mean([len(set(got.get(q, [])) & set(truth[q])) / 5 for q in range(900)])
        assert r["recall"] == pytest.approx(recall, abs=1e-4)


def test_centroids_from_a_sample(spark):
    _, _, df = catalog(spark, 600, 6, seed=4)
    few = ivf.fit_centroids(df, 6, sample_rows=100)
    assert few.shape == (6, 8) and ivf.build(df, few).count() == 600
    assert ivf.fit_centroids(df.limit(0), 3).size == 0


def test_the_report_makes_its_catalog_once(spark, monkeypatch):
    """the sections read a written table, not the joins behind it."""
    from recflow.operators import ann as ANN, metrics as M
    _, _, df = catalog(spark, 40)
    joined = df.drop("color").join(df.select("product_id", "color"), "product_id")
    plans = []
    real = M.retrieval_metrics
    monkeypatch.setattr(M, "retrieval_metrics", lambda near, cat: plans.append(cat._jdf.queryExecution().toString()) or real(near, cat))
    got = ANN.embedding_report(joined).collect()
    assert {r["section"] for r in got} == {"pair_stats", "retrieval"}
    assert len(plans) == 1 and "Join" not in plans[0]
