"""Vectors stored by content, PCA and LSH against dense NumPy."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from recflow.operators import ann as ANN
from recflow.sources import files

SCHEMA = "product_id long, description string"


def test_second_run_encodes_only_what_changed(spark, tmp_path):
    folder = str(tmp_path / "store")
    seen = []

    def encode(rows):
        seen.append(sorted(r["text"] for r in rows.collect()))
        return files.hashing_encoder(16)(rows)

    rows = [(1, "red oak sofa"), (2, "red oak sofa"), (3, "blue lamp"), (4, None), (5, "")]
    out, n = files.build_vectors(spark.createDataFrame(rows, SCHEMA), encode, folder, "e1")
    assert n == 3 and seen == [["", "blue lamp", "red oak sofa"]] and out.columns == ["product_id", "description", "embedding"]
    vec = {r["product_id"]: r["embedding"] for r in out.collect()}
    assert vec[1] == vec[2] and np.linalg.norm(vec[1]) == pytest.approx(1, abs=1e-6) and not any(vec[4]) and len(vec) == 5
    out, n = files.build_vectors(spark.createDataFrame(rows, SCHEMA), encode, folder, "e1")
    assert n == 0 and len(seen) == 1 and out.count() == 5
    rows[2] = (3, "green lamp")
    out, n = files.build_vectors(spark.createDataFrame([*rows, (6, "blue lamp")], SCHEMA), encode, folder, "e1")
    assert n == 1 and seen[-1] == ["green lamp"] and out.count() == 6
    assert {r["product_id"]: r["embedding"] for r in out.collect()}[6] == vec[3]
    _, n = files.build_vectors(spark.createDataFrame(rows, SCHEMA), encode, folder, "another encoder")
    assert n == 3


def test_uncommitted_batches_do_not_count(spark, tmp_path):
    folder = str(tmp_path / "store")
    assert files.committed_vectors(spark, folder) is None
    empty, n = files.build_vectors(spark.createDataFrame([], SCHEMA), files.hashing_encoder(8), folder, "e")
    assert n == 0 and empty.collect() == []
    df = spark.createDataFrame([(1, "a b"), (2, "c")], SCHEMA)

    def fails(rows):
        files.hashing_encoder(8)(rows).write.parquet(f"{folder}/batches/left-over")
        raise RuntimeError("encoder lost")

    with pytest.raises(RuntimeError):
        files.build_vectors(df, fails, folder, "e")
    assert files.committed_vectors(spark, folder) is None
    assert files.build_vectors(df, files.hashing_encoder(8), folder, "e")[1] == 2


def vectors(n=120, width=10, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)) * np.linspace(3, 0.3, width) + 0.4
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_pca_against_centred_svd(spark):
    x = vectors()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "product_id long, embedding array<double>")
    reduced, ratio = ANN.pca_reduce(df, 4)
    c = x - x.mean(axis=0)
    u, s, _ = np.linalg.svd(c, full_matrices=False)
    assert ratio == pytest.approx((s[:4] ** 2).sum() / (s ** 2).sum(), abs=1e-9)
    want = u[:, :4] * s[:4]
    want /= np.linalg.norm(want, axis=1, keepdims=True)
    got = np.array([r["embedding"] for r in reduced.orderBy("product_id").collect()])
    assert np.allclose(got @ got.T, want @ want.T, atol=1e-8)
    for k in (1, 10):
        with pytest.raises(ValueError):
            ANN.pca_reduce(df, k)


def test_lsh_report(spark):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors(60))], "product_id long, embedding array<double>")
    rows = ANN.lsh_report(df, 5).orderBy("setting").collect()
    assert len(rows) == 3 and sum(r["selected"] for r in rows) == 1
    assert all(0 <= r["recall"] <= 1 and 0 < r["candidate_pairs"] <= 60 * 60 for r in rows)
    best = max(rows, key=lambda r: (r["recall"], -r["candidate_pairs"]))
    assert best["selected"] and best["recall"] > 0.8
    x = vectors(60)
    s = x @ x.T
    np.fill_diagonal(s, -9)
    truth = np.argsort(-s, axis=1)[:, :5]
    c = ANN.LSH_CANDIDATES[2]
    near, _ = ANN.lsh_neighbours(df, 5, c["bucket_length"], c["num_hash_tables"])
    found = {(r["query_id"], r["neighbor_id"]) for r in near.collect()}
    recall = np.mean([len({(q, int(n)) for n in truth[q]} & found) / 5 for q in range(60)])
    assert rows[2]["recall"] == pytest.approx(recall, abs=1e-4)


def test_summary_rows_are_written_and_read(spark, tmp_path):
    rows = spark.createDataFrame([("m", 0.5)], "metric string, value double")
    files.write_report(rows, str(tmp_path / "r"))
    assert files.read_report(spark, str(tmp_path / "r")).select("metric", "value").collect() == rows.collect()
    spark.createDataFrame([(1, 2.0)], "user_id int, recency double").write.parquet(str(tmp_path / "u"))
    assert files.read_user_features(spark, str(tmp_path / "u")).schema["user_id"].dataType.simpleString() == "bigint"
    cat = spark.createDataFrame([(1, "S", "M", "C"), (3, "S", "M", "C"), (2, "s", "m", "c")],
                                "product_id long, style string, material string, category string")
    asked = sorted(map(tuple, files.search_batch(cat).collect()))
    assert asked == [(1, "s m c", "C"), (2, "s m c", "c")]
    assert sorted(r[0] for r in files.catalog_ids(cat).collect()) == [1, 2, 3]
    with pytest.raises(ValueError):
        files.check_catalog_vectors(cat, cat.where(F.col("product_id") < 3))
