"""Behaviour as a stream.

The reference reads events once as a static table; nothing in it is
stateful over time.  The same projections apply unchanged to a streaming
DataFrame (scan -> clean -> score), so a live event feed can keep the item
statistics and popularity tables current: each micro-batch is aggregated
and merged into the stored aggregate by ``foreachBatch`` (idempotent per
batch id, restartable from the checkpoint location).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recflow.functions.weights import event_score
from recflow.sources.tables import clean_behavior, mapped_event_type

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def read_event_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 16) -> DataFrame:
    """Streaming scan of event files (explicit schema) in the behaviour role."""
    ev = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
    raw = ev.select(F.col("user_id"), F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
                    mapped_event_type(F.col("event_type")).alias("event_type"), F.col("ts").alias("timestamp"))
    return clean_behavior(raw).withColumn("score", event_score("event_type"))


def batch_counts(batch: DataFrame) -> DataFrame:
    """Per-product partial counts of one micro-batch (the A7/A3 inputs)."""
    et = F.col("event_type")
    return batch.groupBy("product_id").agg(
        *[F.count_if(et == e).cast("bigint").alias(f"n_{e}") for e in ("view", "wishlist", "cart", "purchase")],
        F.sum("score").alias("interaction_score"))


def merge_counts(current: DataFrame | None, delta: DataFrame) -> DataFrame:
    """Add a batch's counts to the running totals (a keyed aggregate)."""
    if current is None:
        return delta
    return current.unionByName(delta).groupBy("product_id").agg(
        *[F.sum(c).alias(c) for c in delta.columns if c != "product_id"])


def start_item_counts(stream: DataFrame, table_path: str, checkpoint: str):
    """Keep per-product counts at ``table_path`` up to date; each batch is
    written to its own folder named by batch id, so a replayed batch
    overwrites itself instead of counting twice."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch_counts(batch).write.mode("overwrite").parquet(f"{table_path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint).start()


def read_item_counts(spark: SparkSession, table_path: str) -> DataFrame:
    """Totals over all written batches."""
    parts = spark.read.parquet(table_path)
    return parts.groupBy("product_id").agg(*[F.sum(c).alias(c) for c in parts.columns
                                             if c not in ("product_id", "batch")])
