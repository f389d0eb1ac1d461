"""Quality rules: a threshold table compiled into one Spark projection.

``RULES`` is a table of (name, metric, least, most).  ``measure`` adds one struct of
per-text metrics, built from Spark expressions only; ``apply_rules`` turns the
table into boolean columns and one ``kept`` column.  Neither shuffles.

Defined results: a null text is an empty text (no words, no lines, zero counts,
ratios 0, not kept); repeated rows and repeated ids give one result row each; an
empty table gives no rows; further columns pass through untouched; a column
named like a metric is safe because the metrics sit in a struct column, ``metrics``
(a column of that name is replaced).
Three-word windows are compared by a 64-bit hash within one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import let, whitespace_words

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: frequent function words of the languages of the corpus (lower case)
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he are this or from "
    "de la le et les des en un une du que qui dans pour par sur au pas plus avec "
    "der die und den von zu das mit sich des auf ist im dem nicht ein eine als "
    "el los las y se del por con una su para es al lo"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes if least <= metric <= most (None: no bound)."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None


RULES: tuple[Rule, ...] = (
    Rule("word_length", "mean_word_chars", 2.0, 15.0),
    Rule("symbols", "symbols_per_word", None, 0.25),
    Rule("stop_words", "stop_word_share", 0.02, None),
    Rule("duplicate_lines", "dup_line_share", None, 0.5),
    Rule("short_lines", "chars_per_line", 5.0, None),
)


def _repeat_words(words: Column) -> Column:
    """Number of words inside three-word windows that occur twice or more."""
    windows = F.slice(
        F.transform(words, lambda w, i: F.struct(
            F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("p"))),
        1, F.greatest(F.size(words) - 2, F.lit(0)))

    def covered(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda x, i: F.coalesce(
            (x["h"] == F.get(ordered, i + 1)["h"]), F.lit(False)) | F.coalesce(
            (x["h"] == F.get(ordered, i - 1)["h"]), F.lit(False)))
        places = F.flatten(F.transform(twice, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))
        return F.size(F.array_distinct(places))

    return let(F.sort_array(windows), covered)


def metrics_of(text: Column) -> Column:
    """Struct of the metrics of one text column."""
    text = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
            _repeat_words(words).cast("long").alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \x09-\x0D]"))
    return F.struct(
        let(whitespace_words(text), of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the struct column ``metrics``."""
    raw = df.withColumn("metrics", metrics_of(F.col(text)))
    w, lines, symbols = F.col("metrics.w"), F.col("metrics.l"), F.col("metrics.n_symbols")
    return raw.withColumn("metrics", F.struct(
        w["n_words"].alias("n_words"), w["word_chars"].alias("word_chars"), symbols.alias("n_symbols"),
        lines["n_lines"].alias("n_lines"), lines["n_dup_lines"].alias("n_dup_lines"),
        w["n_repeat_words"].alias("n_repeat_words"), w["n_stop_words"].alias("n_stop_words"),
        _share(w["word_chars"], w["n_words"]).alias("mean_word_chars"),
        _share(symbols, w["n_words"]).alias("symbols_per_word"),
        _share(w["n_stop_words"], w["n_words"]).alias("stop_word_share"),
        _share(lines["n_dup_lines"], lines["n_lines"]).alias("dup_line_share"),
        _share(w["word_chars"], lines["n_lines"]).alias("chars_per_line")))


def compile_rules(rules: tuple[Rule, ...], metrics: str = "metrics") -> dict[str, Column]:
    """One boolean column (passes) per rule of the table."""
    out = {}
    for r in rules:
        value, ok = F.col(f"{metrics}.{r.metric}"), F.lit(True)
        if r.least is not None:
            ok = ok & (value >= r.least)
        if r.most is not None:
            ok = ok & (value <= r.most)
        out[r.name] = ok
    return out


def apply_rules(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``metrics``, ``base_failed``, ``failed_rules`` (names, in table order)
    and ``kept``."""
    passes = compile_rules(rules)
    m = measure(df, text)
    failed = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in passes.items()]))
    base = (F.col("metrics.n_words") < MIN_WORDS) | (
        F.col("metrics.n_repeat_words") * 100 > F.col("metrics.n_words") * MAX_REPEAT_PERCENT)
    return m.withColumns({"base_failed": base, "failed_rules": failed}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
