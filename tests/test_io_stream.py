"""Sources/sinks round trips and the streaming path on the smoke tables."""
import os
import shutil
import tempfile

from pyspark.sql import functions as F

from recflow.sources import files as FS
from recflow.sources import tables as src
from recflow.streaming import behavior_stream as BS

SF = "/root/testdata/sf0.001"


def test_csv_roundtrip_and_behavior_coercion(spark):
    d = tempfile.mkdtemp(prefix="recflow-test-")
    df = spark.createDataFrame([(1, 2, " View ", "2024-01-02 03:04:05"), (3, 4, None, "not a time")],
                               "user_id long, product_id long, event_type string, timestamp string")
    FS.write_csv(df, f"{d}/beh")
    out = FS.read_behavior_csv(spark, f"{d}/beh").orderBy("user_id").collect()
    assert out[0]["event_type"] == "view" and out[0]["timestamp"] is not None
    assert out[1]["event_type"] == "view" and out[1]["timestamp"] is None


def test_vectors_sink_and_consistency(spark):
    d = tempfile.mkdtemp(prefix="recflow-test-")
    cat = src.searchable_catalog(spark, SF)
    facts = FS.write_vectors(cat, d, "stored", SF)
    assert facts.first()["products"] == cat.count()
    back = FS.read_vectors(spark, d)
    FS.check_catalog_vectors(back, back)
    assembled = FS.assemble_catalog(back.select("product_id", F.lit("X").alias("title")), src.catalog(spark, SF))
    assert assembled.where(F.col("title") == "X").count() == back.count()


def test_stream_counts_equal_batch(spark):
    d = tempfile.mkdtemp(prefix="recflow-stream-")
    os.makedirs(f"{d}/in")
    shutil.copy(f"{SF}/events.parquet", f"{d}/in/events.parquet")
    q = BS.start_item_counts(BS.read_event_stream(spark, f"{d}/in"), f"{d}/counts", f"{d}/ckpt")
    q.processAllAvailable()
    q.stop()
    got = {r["product_id"]: r["interaction_score"] for r in BS.read_item_counts(spark, f"{d}/counts").collect()}
    from recflow.operators.interactions import build_interactions
    from recflow.operators.item_stats import item_stats
    want = {r["product_id"]: r["interaction_score"]
            for r in item_stats(build_interactions(src.behavior(spark, SF))).collect()}
    assert got == want
