"""Catalog and behaviour cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.functions import numeric as N
from recflow.functions import text as T
from recflow.operators.profile import require_columns
from recflow.operators.quantiles import exact_median

PRODUCT_COLUMNS = ("product_id", "name", "category", "material", "color", "style", "price", "rating", "description")
CATALOG_COLUMNS = ("product_id", "title", "category", "material", "color", "style", "price", "rating",
                   "description", "catalog_description")


def check_ids(df: DataFrame, *cols: str) -> DataFrame:
    """A null id raises with its count (the integer cast would fail)."""
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    bad = df.where(cond).limit(1).count()
    if bad:
        n = df.where(cond).count()
        raise ValueError(f"{n} rows have a null id in {list(cols)}")
    return df


def normalize_catalog(products: DataFrame, catalog_default: str = "Unknown") -> DataFrame:
    """One projection producing the normalised catalog (W4 shape).

    ``catalog_default`` is ``"Unknown"`` for the W4 loader and ``""`` for
    the W3 one."""
    require_columns(products, PRODUCT_COLUMNS)
    price = N.nan_to_null("price")
    rating = N.nan_to_null("rating")
    labels = {c: T.normalize_label(c) for c in ("category", "material", "color", "style")}
    return products.select(
        F.col("product_id").cast("bigint").alias("product_id"),
        T.clean_text("name").alias("title"),
        *[labels[c].alias(c) for c in ("category", "material", "color", "style")],
        price.alias("price"),
        rating.alias("rating"),
        T.description(labels["style"], labels["material"], labels["category"], labels["color"], price)
        .alias("description"),
        T.clean_text("description", catalog_default).alias("catalog_description"),
    )


def normalize_catalog_w3(products: DataFrame) -> DataFrame:
    """W3 loader -- required-column check, prices/ratings rounded to 2 dp,
    catalog description defaults to empty."""
    cat = normalize_catalog(products, catalog_default="")
    return cat.withColumn("price", N.round_to("price", 2)).withColumn("rating", N.round_to("rating", 2)) \
        .withColumn("description", T.description("style", "material", "category", "color", "price"))


def clean_products(products: DataFrame) -> DataFrame:
    """Cleaning notebook order (T18): capitalise -> fill (median over all raw
    rows / mean) -> whole-row dedupe -> range filter (price > 0, rating <= 5)."""
    cap = products.select(
        *[T.capitalize(c).alias(c) if c in ("category", "material", "color", "style") else F.col(c)
          for c in products.columns])
    cap = cap.withColumn("price", N.nan_to_null("price")).withColumn("rating", N.nan_to_null("rating"))
    median_price = exact_median(cap, "price")
    mean_rating = cap.agg(F.avg("rating")).first()[0]
    filled = cap.withColumn("price", F.coalesce(F.col("price"), F.lit(median_price).cast("double"))) \
                .withColumn("rating", F.coalesce(F.col("rating"), F.lit(mean_rating).cast("double")))
    return filled.dropDuplicates().where((F.col("price") > 0) & (F.col("rating") <= 5))


def dedupe(df: DataFrame) -> DataFrame:
    """F8: whole-row dedupe (hash aggregate with a map-side partial step)."""
    return df.dropDuplicates()
