"""License scan by diagonal voting.

Every word k-gram of every text is hashed and Spark-joined to the positions of the
same k-gram in a fixed table of license templates.  A hit votes for the diagonal
(word position less template position) of its template; neighbouring diagonals are
merged, which absorbs inserted or missing words, and a span is reported if the template
k-grams found on it cover enough of the template.  A phrase stands in the text
exactly where one diagonal holds all of its k-grams.

The template table is fixed (a few hundred rows), hence broadcast.  Texts are read and exploded
in one stage, which writes the hits; only hits are shuffled.

Defined results: a null text is empty; a text without words has counts 0, null
positions, empty labels and score 0; repeated rows give repeated result rows; null ids are kept;
an empty table gives no rows; further columns are not read.  Equal 64-bit hashes
of k-grams are taken as equal k-grams.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recflow.llm.common import let, lower_ascii
from recflow.session import cut_lineage

#: bytes of the text that separate words, before lower-casing
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SLACK = 3
MIN_COVERAGE = 0.6
PHRASE_K, TEXT_K = 2, 4


@dataclass(frozen=True)
class Template:
    """``base`` phrases must stand word for word; the others may be covered in part."""

    label: str
    text: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def k(self) -> int:
        return TEXT_K if len(self.words) > TEXT_K and not self.base else PHRASE_K


TEMPLATES: tuple[Template, ...] = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
    Template("apache", "licensed under the apache license version 2 0 the license you may not use this file "
                       "except in compliance with the license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
                    "and associated documentation files the software to deal in the software without restriction"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the "
                    "gnu general public license as published by the free software foundation"),
    Template("lgpl", "gnu lesser general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or "
                    "neighboring rights to this work"),
    Template("all-rights-reserved", "all rights reserved"),
)


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _kgrams(hashes: Column, k: int) -> Column:
    """Array of (hash, position) of each run of k words, from the words' own hashes."""
    each = F.transform(hashes, lambda w, i: F.struct(
        F.xxhash64(F.lit(k), w, *[F.get(hashes, i + j) for j in range(1, k)]).alias("h"), i.alias("p")))
    return F.slice(each, 1, F.greatest(F.size(hashes) - (k - 1), F.lit(0)))


def _lower(text: Column) -> Column:
    """Lower case by ``lower`` where that cannot change which ASCII words there are: two
    non-ASCII letters have a lower case with ASCII letters in it, and take the slower way."""
    odd = F.contains(text, F.lit("\u0130")) | F.contains(text, F.lit("\u212A"))
    return F.when(odd, lower_ascii(text)).otherwise(F.lower(text))


def license_words(text: Column) -> Column:
    parts = F.split(F.coalesce(text, F.lit("")), SEPARATORS)
    return F.array_remove(F.split(_lower(F.array_join(F.array_remove(parts, ""), " ")), " "), "")


def template_grams(spark: SparkSession, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(h, template, label, base, grams, t): the positions of every template k-gram."""
    rows = [(i, t.label, t.base, t.k, len(t.words) - t.k + 1, t.words) for i, t in enumerate(templates)]
    df = spark.createDataFrame(rows, "template int, label string, base boolean, k int, grams int, words array<string>")
    df = df.withColumn("hashes", _word_hashes(F.col("words")))
    parts = [df.where(F.col("k") == k).withColumn("g", F.explode(_kgrams(F.col("hashes"), k)))
             for k in sorted({t.k for t in templates})]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.col("g.h").alias("h"), "template", "label", "base", "grams", F.col("g.p").alias("t"))


def hits(docs: DataFrame, templates: DataFrame, text: str = "text") -> DataFrame:
    """(_row, _id, n_words, place, p and the columns of ``templates``), written: the template positions of every
    k-gram of every text, and the first k-gram of each text (place 0, or null without one) whether found or not.

    One pass over the texts gives the words' number and the hits, so no later step reads a text again."""
    grams = let(license_words(F.col(text)), lambda words: let(_word_hashes(words), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), F.concat(*[_kgrams(w, k) for k in (PHRASE_K, TEXT_K)]).alias("grams"))))
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "_id", grams.alias("s"))
    each = rows.select("_row", "_id", F.col("s.n").alias("n_words"), F.posexplode_outer("s.grams").alias("place", "g"))
    found = each.select("_row", "_id", "n_words", "place", F.col("g.h").alias("h"), F.col("g.p").alias("p")).join(
        F.broadcast(templates), "h", "left")
    return cut_lineage(found.where(F.col("template").isNotNull() | (F.coalesce("place", F.lit(0)) == 0)))


def vote(found: DataFrame) -> DataFrame:
    """One row per (row, template, diagonal): the set of template positions found."""
    return found.where(F.col("template").isNotNull()).groupBy(
        "_row", "template", "label", "base", "grams", (F.col("p") - F.col("t")).alias("diagonal")).agg(
        F.collect_set("t").alias("found"))


def spans(votes: DataFrame, slack: int = SLACK, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """Merge neighbouring diagonals and keep spans whose coverage is enough:
    (_row, template, label, base, start, coverage)."""
    whole = votes.where(F.col("base") & (F.size("found") == F.col("grams"))).select(
        "_row", "template", "label", "base", F.col("diagonal").alias("start"), F.lit(1.0).alias("coverage"))
    order = Window.partitionBy("_row", "template").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > slack, F.lit(True)).cast("int")
    runs = votes.where(~F.col("base")).withColumn("_new", new).withColumn("run", F.sum("_new").over(order))
    merged = runs.groupBy("_row", "template", "label", "base", "grams", "run").agg(
        F.min("diagonal").alias("start"),
        F.size(F.array_distinct(F.flatten(F.collect_list("found")))).alias("covered"))
    part = merged.withColumn("coverage", F.col("covered") / F.col("grams")).where(F.col("coverage") >= min_coverage)
    return whole.unionByName(part.select(*whole.columns))


def scan(docs: DataFrame, ident: str = "doc_id", text: str = "text",
         templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Per document: ident, n_words, n_base, first_word, last_word, base_labels, labels
    (comma-joined), score (the best coverage) and ``spans`` (label, start, coverage)."""
    keyed = docs.select(F.col(ident).alias("_id"), F.col(text).alias("text"))
    found = hits(keyed, template_grams(docs.sparkSession, templates))
    kept = spans(vote(found))
    start = F.when(F.col("base"), F.col("start"))
    per = kept.groupBy("_row").agg(
        F.count(start).alias("n_base"), F.min(start).cast("long").alias("first_word"),
        F.max(start).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("coverage").alias("score"),
        F.sort_array(F.collect_list(F.struct("label", "start", "coverage"))).alias("spans"))
    docs_once = found.where(F.coalesce("place", F.lit(0)) == 0).select("_row", "_id", "n_words").dropDuplicates(["_row"])
    both = docs_once.join(per, "_row", "left")
    return both.select(
        F.col("_id").alias(ident), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"), "spans")
