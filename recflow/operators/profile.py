"""Validation and profiling (V1-V9), each one distributed aggregate."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recflow.operators.quantiles import exact_percentiles

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """V1: raise with the sorted missing names."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def _is_missing(df: DataFrame, c: str):
    col = F.col(c)
    dt = df.schema[c].dataType
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def null_counts(df: DataFrame) -> DataFrame:
    """V2: ``isnull().sum()`` as rows ``(column_name, null_count)``; NaN counts."""
    wide = df.agg(*[F.count_if(_is_missing(df, c)).cast("bigint").alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "null_count")


def schema_info(df: DataFrame) -> DataFrame:
    """V3: column, type and non-null count."""
    counts = df.agg(*[F.count_if(~_is_missing(df, c)).cast("bigint").alias(c) for c in df.columns]) \
        .unpivot([], df.columns, "column_name", "non_null")
    types = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
        "position int, column_name string, dtype string")
    return F.broadcast(types).join(counts, "column_name").orderBy("position")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """V4: count, mean, sample std, min, quartiles (exact, linear), max per
    numeric column, as rows ``(column_name, count, mean, std, min, p25, p50, p75, max)``."""
    cols = list(columns) if columns else numeric_columns(df)
    longv = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias("v"))
        for c in cols])).alias("kv")).select("kv.column_name", "kv.v")
    base = longv.groupBy("column_name").agg(
        F.count("v").cast("bigint").alias("count"), F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
    q = exact_percentiles(longv, "v", [0.25, 0.5, 0.75], by=["column_name"], names=["p25", "p50", "p75"])
    return base.join(q, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_all(df: DataFrame) -> DataFrame:
    """V5: describe of every column; strings add unique, top (ties: smallest
    value) and freq."""
    num = describe(df)
    str_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not str_cols:
        return num
    longs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in str_cols])).alias("kv")) \
        .select("kv.column_name", "kv.v").where(F.col("v").isNotNull())
    freq = longs.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    stats = freq.groupBy("column_name").agg(
        F.sum("n").cast("bigint").alias("count"), F.count(F.lit(1)).cast("bigint").alias("unique"),
        F.max("n").cast("bigint").alias("freq"))
    # deterministic top: smallest value among the most frequent
    top = freq.join(stats.select("column_name", "freq"), "column_name") \
        .where(F.col("n") == F.col("freq")).groupBy("column_name").agg(F.min("v").alias("top"))
    strs = stats.join(top, "column_name")
    return num.unionByName(strs, allowMissingColumns=True)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """V6: ``value_counts`` ordered by count desc then value."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).cast("bigint").alias("count"))
            .orderBy(F.col("count").desc(), F.col(column)))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """V7: equal-width histogram over [min, max]; the maximum falls in the
    last bin (``width_bucket`` would put it in bin n+1).  All bins are
    returned, empty ones with count 0."""
    vals = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    bounds = vals.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    lo, hi = bounds["lo"], bounds["hi"]
    spark = df.sparkSession
    grid = spark.range(1, bins + 1).select(F.col("id").cast("bigint").alias("bin"))
    if lo is None:
        return grid.select("bin", F.lit(None).cast("double").alias("lower"),
                           F.lit(None).cast("double").alias("upper"), F.lit(0).cast("bigint").alias("count"))
    if hi > lo:
        b = F.least(F.width_bucket(F.col("v"), F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins))
    else:
        b = F.lit(1).cast("bigint")
    counts = vals.select(b.cast("bigint").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / bins
    return F.broadcast(grid).join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("lower"),
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("upper"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("count"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """V8."""
    return df.select(column).distinct()


def head(df: DataFrame, key: str | Sequence[str], n: int = 5) -> DataFrame:
    """V9: first rows by an explicit key (``TakeOrderedAndProject``)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*keys).limit(n)
