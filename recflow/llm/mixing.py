"""Mixing sources to target weights.

Every row gets a hash-random key; rows are dealt into equal key ranges within
their source, each range is sorted, and prefix sums of the sizes come from range
totals plus a running sum inside the range.  Each source is cut at its exact
budget; a budget above the source's size repeats whole epochs first.

Ranges are ``2^RANGE_BITS`` per source at every size of the input: keys are uniform,
so a source that holds a third of all rows is dealt over all of them.  Only
(source, key, size) and the caller's id columns are shuffled, never the text.

Defined results: a null text has size 0 and takes 0; a null source is a source of its
own, ordered last; repeated rows count as often as they occur (ties of the key are
ordered by id, then size); a source of size 0 has target 0; an empty
table gives no rows; other columns are not returned unless named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recflow.llm.common import SPACES, free_name
from recflow.plans.ranking import prefix_sums

RANGE_BITS = 12
WEIGHT_CYCLE = (1, 2, 3)
MAX_REPEATS = 3
WORD = r"[^ \x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mixing_key(ident: Column, seed: str) -> Column:
    """60-bit key from md5 text, the same in every engine."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(ident.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def source_targets(sized: DataFrame, max_repeats: int = MAX_REPEATS,
                   weights: Sequence[int] = WEIGHT_CYCLE) -> DataFrame:
    """(source, source_size, weight, target): shares of the total by weight, none above
    ``max_repeats`` times its source's size; the excess goes to the others by weight.

    With sources ordered by size per weight the capped ones come first: source i
    is capped exactly if max_repeats * size_i / weight_i is no more than the level that
    is left for it and all after it."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    ranked = prefix_sums(
        per.withColumn("_null", F.col("source").isNull().cast("int")).withColumn("_one", F.lit(1).cast("long")),
        ["_null", "source"], {"_one": "_rank"})
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = ranked.withColumn("weight", F.element_at(
        cycle, ((F.col("_rank") - 1) % len(weights) + 1).cast("int")).cast("long"))
    weighed = weighed.withColumn("_cap", F.col("source_size") * max_repeats).withColumn(
        "_level", F.col("_cap") / F.col("weight"))
    ordered = prefix_sums(weighed.drop("_one", "_rank"), ["_level", "_null", "source"],
                          {"_cap": "_caps", "weight": "_weights"})
    totals = ordered.agg(F.sum("source_size").alias("_total"), F.sum("weight").alias("_all_weights"))
    both = ordered.crossJoin(F.broadcast(totals))
    left_budget = F.col("_total") - (F.col("_caps") - F.col("_cap"))
    left_weight = F.col("_all_weights") - (F.col("_weights") - F.col("weight"))
    both = both.withColumn("_capped", F.col("_cap") * left_weight <= F.col("weight") * left_budget)
    rest = both.agg(F.coalesce(F.sum(F.when(F.col("_capped"), F.col("_cap"))), F.lit(0)).alias("_used"),
                    F.coalesce(F.sum(F.when(~F.col("_capped"), F.col("weight"))), F.lit(0)).alias("_open"))
    target = F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(
        (F.col("_total") - F.col("_used")).cast("double") * F.col("weight") / F.col("_open"))
    return both.crossJoin(F.broadcast(rest)).select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, size: Column | None = None, ident: str = "doc_id", source: str = "source",
        keep: Sequence[str] = (), seed: str = "mix", max_repeats: int = MAX_REPEATS,
        weights: Sequence[int] = WEIGHT_CYCLE) -> DataFrame:
    """One row per document: ident, ``keep``, source, size, source_size, target,
    mix_key, mix_start (words of its source before it in an epoch), taken.

    A kept column that has the name of another one here gets underscores after its own.
    ``taken`` counts repeats: whole epochs, plus the part of the last epoch up to the
    cut; the document on the cut is taken in part."""
    size = word_count(F.col("text")) if size is None else size
    rows = docs.select(F.col(ident).alias("_id"), F.struct(*keep).alias("_keep") if keep else F.lit(0).alias("_keep"),
                       F.col(source).alias("source"), size.alias("size"))
    rows = rows.withColumn("mix_key", mixing_key(F.col("_id"), seed)).withColumn(
        "_range", F.shiftright("mix_key", 60 - RANGE_BITS).cast("int"))
    ranges = rows.groupBy("source", "_range").agg(F.sum("size").alias("_size"))
    before = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    targets = source_targets(rows.select("source", "size"), max_repeats, weights)
    # at most 2^RANGE_BITS rows per source
    starts = ranges.withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    starts = starts.alias("a").join(targets.alias("t"), F.col("a.source").eqNullSafe(F.col("t.source"))).select(
        "a.source", "_range", "_start", "source_size", "target")
    inside = Window.partitionBy("source", "_range").orderBy("mix_key", "_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumn("_sum", F.sum("size").over(inside))
    placed = summed.alias("r").join(starts.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source"))
                                    & (F.col("r._range") == F.col("s._range"))).select(
        "r._id", "r._keep", "r.source", "r.size", "r.mix_key", "s.source_size", "s.target",
        (F.col("s._start") + F.col("r._sum") - F.col("r.size")).alias("mix_start"))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    cut = budget - epochs * F.col("source_size")
    part = F.least(F.col("size"), F.greatest(F.lit(0), cut - F.col("mix_start")))
    out = placed.withColumn("taken", (epochs * F.col("size") + part).cast("long"))
    own = ["source", "size", "source_size", "target", "mix_key", "mix_start", "taken"]
    result = out.select(F.col("_id").alias(ident), *own, "_keep")
    for c in keep:
        result = result.withColumn(free_name(result, c), F.col(f"_keep.{c}"))
    kept = result.columns[len(own) + 2:]
    return result.select(ident, *kept, *own)


def expand(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: a row per epoch in which a document occurs, with ``epoch`` and
    its text; the text on the cut holds its first words only."""
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(F.lit(0)).cast("int")
    rest = (F.col("taken") - whole * F.col("size")).cast("int")
    copies = F.when(F.col("taken") > 0, whole + (rest > 0).cast("int")).otherwise(F.lit(0))
    rows = mixed.withColumn("_whole", whole).withColumn("_rest", rest).where(copies > 0).withColumn(
        "epoch", F.explode(F.sequence(F.lit(1), copies)))
    words = F.array_remove(F.split(F.col(text), SPACES), "")
    cut = F.when(F.col("epoch") <= F.col("_whole"), F.col(text)).otherwise(
        F.array_join(F.slice(words, 1, F.col("_rest")), " "))
    return rows.withColumn(text, cut).drop("_whole", "_rest")
