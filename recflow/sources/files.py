"""File scans and sinks (S1-S4, S8-S17) with explicit schemas.

Sinks write partitioned files through the DataFrame writer (no driver
round trip); reports are metric rows written as JSON lines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recflow.operators.clean import check_ids
from recflow.operators.profile import require_columns
from recflow.session import cut_lineage

PRODUCTS_SCHEMA = T.StructType([
    T.StructField("product_id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("material", T.StringType()),
    T.StructField("color", T.StringType()), T.StructField("style", T.StringType()),
    T.StructField("price", T.DoubleType()), T.StructField("rating", T.DoubleType()),
    T.StructField("description", T.StringType())])
BEHAVIOR_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("product_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("timestamp", T.StringType())])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and an explicit schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, no index column."""
    df.write.mode(mode).option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """S3: Parquet scan; selecting columns here prunes the file read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """S4."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_behavior_csv(spark: SparkSession, path: str) -> DataFrame:
    """S7 from CSV: ids cast, timestamp coerced (invalid -> null, ANSI-safe),
    event type cleaned (null -> view, lower)."""
    from recflow.sources.tables import clean_behavior
    raw = read_csv(spark, path, BEHAVIOR_SCHEMA)
    raw = raw.withColumn("timestamp", F.try_to_timestamp(F.col("timestamp")).cast("timestamp_ntz"))
    return clean_behavior(check_ids(raw, "user_id", "product_id"))


def read_user_features(spark: SparkSession, path: str) -> DataFrame:
    """S8."""
    return spark.read.parquet(path).withColumn("user_id", F.col("user_id").cast("bigint"))


def write_vectors(catalog_with_vectors: DataFrame, path: str, model_name: str, source_path: str,
                  mode: str = "overwrite") -> DataFrame:
    """Catalog joined with its vectors as one Parquet table (keyed by
    id, no positional coupling) plus a one-row run-facts table next to it."""
    write_parquet(catalog_with_vectors, f"{path}/vectors", mode)
    spark = catalog_with_vectors.sparkSession
    dim = catalog_with_vectors.select(F.size("embedding").alias("d")).first()
    n = catalog_with_vectors.count()
    facts = spark.createDataFrame([(model_name, source_path, int(dim["d"]) if dim else 0, n)],
                                  "model_name string, source_path string, dim int, products long")
    write_parquet(facts, f"{path}/facts", mode)
    return facts


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Stored vector table."""
    return spark.read.parquet(f"{path}/vectors")


# --- vector store: built if absent, keyed by content (S9, S10, M14) ---

def text_digest(text: Column, encoder: str) -> Column:
    """Key of a stored vector: the encoder's name and the text (null counts as empty)."""
    return F.sha2(F.concat(F.lit(f"{encoder}\n"), F.coalesce(text, F.lit(""))), 256)


def committed_vectors(spark: SparkSession, folder: str) -> DataFrame | None:
    """(digest, embedding) of all committed batches; None if there is none.

    A batch is a folder of its own and counts only once its name is in ``commits``, which is written after it: what a
    failed or running job left is not read."""
    from pyspark.errors import AnalysisException
    try:
        batches = sorted(r["batch"] for r in spark.read.schema("batch string, rows long").parquet(f"{folder}/commits").collect())
    except AnalysisException:  # no such folder yet
        return None
    if not batches:
        return None
    return spark.read.parquet(*[f"{folder}/batches/{b}" for b in batches]).select("digest", "embedding")


def build_vectors(catalog: DataFrame, encode: Callable[[DataFrame], DataFrame], folder: str, encoder: str,
                  text: str = "description") -> tuple[DataFrame, int]:
    """(catalog with ``embedding``, number of texts encoded now).

    ``encode`` turns (digest, text) rows into (digest, embedding) rows.  It gets each text once that no committed batch
    has, so a second run encodes nothing and a changed description only itself."""
    spark = catalog.sparkSession
    keyed = catalog.withColumn("digest", text_digest(F.col(text), encoder))
    stored = committed_vectors(spark, folder)
    todo = keyed.select("digest", F.coalesce(F.col(text), F.lit("")).alias("text")).dropDuplicates(["digest"])
    if stored is not None:
        todo = todo.join(stored.select("digest"), "digest", "left_anti")
    todo = cut_lineage(todo)
    new = todo.count()
    if new:
        batch = f"batch-{uuid.uuid4().hex}"
        encode(todo).select("digest", "embedding").write.parquet(f"{folder}/batches/{batch}")
        spark.createDataFrame([(batch, new)], "batch string, rows long").write.mode("append").parquet(f"{folder}/commits")
    stored = committed_vectors(spark, folder)
    if stored is None:  # an empty catalog
        return keyed.withColumn("embedding", F.lit(None).cast("array<float>")).drop("digest"), 0
    # two jobs at once may have stored a text twice
    return keyed.join(stored.dropDuplicates(["digest"]), "digest").drop("digest"), new


def hashing_encoder(dims: int = 64) -> Callable[[DataFrame], DataFrame]:
    """Unit vectors of hashed word counts, no corpus needed (a text without words: zeros)."""
    def encode(rows: DataFrame) -> DataFrame:
        words = rows.withColumn("words", F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
        counted = HashingTF(inputCol="words", outputCol="tf", numFeatures=dims).transform(words)
        unit = Normalizer(inputCol="tf", outputCol="unit").transform(counted)
        return unit.select("digest", vector_to_array("unit", "float32").alias("embedding"))
    return encode


def write_report(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Metric rows as JSON lines."""
    rows.write.mode(mode).json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A JSON report (one object per line, or ``multiLine`` documents)."""
    return spark.read.json(path)


def assemble_catalog(stored: DataFrame | None, catalog: DataFrame) -> DataFrame:
    """Stored metadata left-joined to the catalog; stored values win,
    gaps are filled from the catalog (T16: a plain coalesce).  Without
    stored metadata the catalog itself (ordered by id only at output)."""
    if stored is None:
        return catalog
    s = stored.select("product_id", *[F.col(c).alias("s_" + c) for c in stored.columns if c != "product_id"])
    j = catalog.join(s, "product_id", "left")
    cols = [F.coalesce(F.col("s_" + c), F.col(c)).alias(c) if ("s_" + c) in j.columns else F.col(c)
            for c in catalog.columns if c != "product_id"]
    return j.select("product_id", *cols)


def check_catalog_vectors(catalog: DataFrame, vectors: DataFrame) -> None:
    """Ids must match between catalog and vector table (full outer
    join on the key, count of unmatched ids)."""
    a = catalog.select("product_id").withColumn("_c", F.lit(1))
    b = vectors.select("product_id").withColumn("_v", F.lit(1))
    bad = a.join(b, "product_id", "full_outer").where(F.col("_c").isNull() | F.col("_v").isNull())
    n = bad.count()
    if n:
        raise ValueError(f"catalog and vectors disagree on {n} product ids")


def catalog_ids(catalog: DataFrame) -> DataFrame:
    """S15."""
    return catalog.select("product_id")


def search_batch(catalog: DataFrame) -> DataFrame:
    """A query table derived from the catalog: every distinct
    (style, material, category) text searched inside its own category."""
    require_columns(catalog, ["style", "material", "category", "product_id"])
    q = catalog.groupBy("style", "material", "category").agg(F.min("product_id").alias("query_id"))
    return q.select("query_id", F.concat_ws(" ", F.lower("style"), F.lower("material"), F.lower("category"))
                    .alias("text"), "category")
