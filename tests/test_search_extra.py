"""E11 similar products, J7/J12 lookups, R9/S17 sample shopper batch, M13/M14 report rows."""
import pytest
from pyspark.sql import functions as F

from recflow.operators import ann, search as SE
from recflow.sources import tables as src

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def cat(spark):
    return SE.unit_catalog(src.searchable_catalog(spark, SF)).persist()


def test_similar_products_excludes_self_and_unknown_raises(spark, cat):
    ids = [r[0] for r in cat.select("product_id").orderBy("product_id").limit(3).collect()]
    q = spark.createDataFrame([(i, p) for i, p in enumerate(ids)], "query_id long, product_id long")
    hits = SE.similar_products(q, cat, 5).collect()
    assert len(hits) == 15
    by_q = {}
    for h in hits:
        by_q.setdefault(h["query_id"], []).append(h)
    for qi, p in enumerate(ids):
        assert p not in {h["product_id"] for h in by_q[qi]}
        scores = [h["score"] for h in sorted(by_q[qi], key=lambda h: h["rank"])]
        assert scores == sorted(scores, reverse=True)
    bad = spark.createDataFrame([(0, 10 ** 12)], "query_id long, product_id long")
    with pytest.raises(KeyError):
        SE.similar_products(bad, cat, 5)


def test_show_products_and_sample_batch(spark, cat):
    ids = spark.createDataFrame([(1,), (1,), (2,)], "product_id long")
    assert SE.show_products(ids, cat).count() == cat.where(F.col("product_id").isin(1, 2)).count()
    recs = SE.sample_batch_recommendations(cat, 5, 3)
    shoppers = recs.select("user_id").distinct().collect()
    assert 1 <= len(shoppers) <= 3
    assert all(r["user_id"].endswith("_shopper") for r in shoppers)
    assert recs.groupBy("user_id").agg(F.max("rank").alias("m")).where(F.col("m") > 5).count() == 0


def test_encoder_comparison_reports_failures(spark, cat):
    def broken(c):
        raise RuntimeError("no model")
    out = ann.encoder_comparison(cat, {"stored": lambda c: c, "broken": broken})
    status = {r["encoder"]: r["status"] for r in out.select("encoder", "status").distinct().collect()}
    assert status["stored"] == "ok" and status["broken"].startswith("failed")
