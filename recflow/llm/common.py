"""Column helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.session import cut_lineage

#: separators of whitespace words: space and \t \n \v \f \r
SPACES = r"[ \x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of at most ``rows`` rows between Spark and Python for the jobs run inside, which bounds
    what a worker holds where rows carry whole texts or sets; the session's own setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(name)
    spark.conf.set(name, str(min(int(own), rows) if int(own) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, own)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (whatever the case of its letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where the
    body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def whitespace_words(text: Column) -> Column:
    """Array of the words of a text (null: no words)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else changed."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def join_hot(rows: DataFrame, table: DataFrame, key: str, share: int = 256, keys: DataFrame | None = None,
             how: str = "inner") -> DataFrame:
    """Inner or left join of ``rows`` to ``table`` (one row per key, no null keys).  Keys that hold at least one
    ``share``-th of all rows, so at most ``share`` of them, are joined by broadcast and the others by a
    shuffle, so no task gets the rows of a hot key.  ``keys``: a written table with the key of each row, if
    ``rows`` itself is dear to read."""
    keys = rows if keys is None else keys
    total = keys.count()
    hot = F.broadcast(cut_lineage(keys.groupBy(key).count().where(F.col("count") * share >= total).select(key)))
    head = rows.join(hot, key, "left_semi").join(F.broadcast(table.join(hot, key, "left_semi")), key, how)
    return head.unionByName(rows.join(hot, key, "left_anti").join(table, key, how))
