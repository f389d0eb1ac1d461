"""Parquet scans of the driver tables and the adapters that give them the
roles of the recommender's logical tables (products, behaviour, purchases,
vectors).

Every scan selects the columns it needs, so Parquet column pruning and
predicate pushdown reach the file reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.functions import text as T

# How the driver's ``events.event_type`` maps onto the
# behaviour vocabulary.  ``error`` stays unmapped on purpose (score 0).
EVENT_TYPE_MAP = {
    "view": "view",
    "click": "wishlist",
    "signup": "cart",
    "purchase": "purchase",
    "error": "error",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` in the role of the raw product table."""
    part = table(spark, sf_dir, "part")
    words = F.split(F.col("p_name"), " ")
    return part.select(
        F.col("p_partkey").cast("bigint").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("material"),
        F.coalesce(F.try_element_at(words, F.lit(1)), F.lit("")).alias("color"),
        F.coalesce(F.try_element_at(words, F.lit(2)), F.lit("")).alias("style"),
        F.col("p_retailprice").cast("double").alias("price"),
        (F.lit(2.5) + (F.col("p_size") % 26) / F.lit(10.0)).alias("rating"),
        F.col("p_name").alias("description"),
    )


def mapped_event_type(col: Column) -> Column:
    expr = None
    for src, dst in EVENT_TYPE_MAP.items():
        expr = (F.when(col == src, F.lit(dst)) if expr is None
                else expr.when(col == src, F.lit(dst)))
    return expr.otherwise(col)


def raw_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the role of the raw behaviour table."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        mapped_event_type(F.col("event_type")).alias("event_type"),
        F.col("ts").alias("timestamp"),
    )


def behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behaviour scan with cleaned event type (null -> view, lower)."""
    return clean_behavior(raw_behavior(spark, sf_dir))


def clean_behavior(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.lower(T.clean_text(F.col("event_type"), "view")).alias("event_type"),
        F.col("timestamp"),
    )


def order_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with their own price: orders joined with lineitem (trap T1)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("bigint").alias("user_id"),
        F.col("l_partkey").cast("bigint").alias("product_id"),
        F.lit("purchase").alias("event_type"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("l_extendedprice").cast("double").alias("price"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored embedding table ``(product_id, embedding ARRAY<FLOAT>, label)``."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").cast("bigint").alias("product_id"),
        F.col("embedding"),
        F.col("label").cast("bigint").alias("label"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised catalog (W4 shape)."""
    from recflow.operators.clean import normalize_catalog
    return normalize_catalog(raw_products(spark, sf_dir))


def searchable_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows that own a vector, with the vector attached."""
    from recflow.operators.clean import normalize_catalog
    found = vectors(spark, sf_dir)
    # only products with a vector are normalised
    return normalize_catalog(raw_products(spark, sf_dir).join(found.select("product_id"), "product_id", "left_semi")).join(
        found, "product_id")
