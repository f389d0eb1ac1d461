"""URL filter: host/path rules, and a character language-model ratio for the rest.

Two variable-order Markov models over the characters of the whole URL (with its host in
lower case, as in the rules) are counted, one on the URLs that the rules allow and one on those they block.
Orders 0 to ``MAX_ORDER`` are interpolated (each order is smoothed by the one below);
a URL's score is its log-likelihood difference per character, and the threshold
is calibrated on decided URLs that the models have not seen.

The difference at the longest known context telescopes into one weight per
n-gram (its difference less that of its suffix), so scoring is a join of the
URL's n-grams with a table of weights and a sum.  Counts cover all decided URLs and
every n-gram has its weight, so the table grows with the input and is joined by a
shuffle.  Only the n-grams that make up ``HOT_SHARE`` or more of the occurrences to
score (1 / HOT_SHARE rows at most) are looked up in a broadcast part of it instead, so
no n-gram brings more than that share of the rows to one task.

Defined results: a null URL or one without "://" has empty host and path and no rule; a null
or empty URL has a score of 0; repeated rows give repeated result rows; an empty table gives no
rows; without decided URLs all differences and the threshold are 0, so the verdict is
allow; very long URLs are read whole; further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recflow.llm.common import let, lower_ascii
from recflow.session import cut_lineage

MAX_ORDER = 4
HOT_SHARE = 5e-5
STRENGTH = 4.0
CALIBRATION_FOLDS = 5
BIN = 0.01
BIN_LIMIT = 1000
START, END = "\x02", "\x03"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES: tuple[Rule, ...] = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) columns."""
    url = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return lower_ascii(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)


def whole_url(url: Column) -> Column:
    """What the models read: all of the URL, the host in lower case (null: empty)."""
    url = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^(.*?://)([^/?#]*)(.*)$"
    scheme, host, rest = (F.regexp_extract(url, pattern, i) for i in (1, 2, 3))
    return F.when(F.contains(url, F.lit("://")), F.concat(scheme, lower_ascii(host), rest)).otherwise(url)


def decide(df: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``rule`` and ``rule_verdict`` from the columns ``host`` and ``path`` (longest rule)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda x: len(x.name)):
        fits = ((F.col("host") == r.host) | F.endswith(F.col("host"), F.lit("." + r.host))) \
            & F.startswith(F.col("path"), F.lit(r.path))
        rule, verdict = F.when(fits, r.name).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return df.withColumns({"rule": rule, "rule_verdict": verdict})


def grams(text: Column, max_order: int = MAX_ORDER) -> Column:
    """Array of the n-grams of 1 to max_order + 1 characters, one per order and
    predicted character (the start mark is never predicted)."""
    def of_order(chars: Column, order: int) -> Column:
        ends = F.sequence(F.lit(max(order, 1) + 1), F.size(chars))
        each = F.transform(ends, lambda i: F.array_join(F.slice(chars, i - order, order + 1), ""))
        return F.when(F.size(chars) >= max(order, 1) + 1, each).otherwise(F.array().cast("array<string>"))

    def of(chars: Column) -> Column:
        return F.concat(*[of_order(chars, o) for o in range(max_order + 1)])

    return let(F.split(F.concat(F.lit(START), text, F.lit(END)), ""), of)


def fit_weights(texts: DataFrame, max_order: int = MAX_ORDER, support: float = 0.0,
                strength: float = STRENGTH) -> DataFrame:
    """(gram, weight) from ``texts`` (text, rule_verdict): all n-grams, or with ``support``
    those that make up at least this share of the counted characters."""
    hit = F.col("rule_verdict") == "allow"
    counts = cut_lineage(texts.select(F.explode(grams(F.col("text"), max_order)).alias("gram"), hit.alias("ok"))
                         .groupBy("gram").agg(F.count_if("ok").alias("a"), F.count_if(~F.col("ok")).alias("r"))
                         .withColumn("order", F.char_length("gram") - 1))
    base = counts.where("order = 0")
    total = base.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("ta"), F.coalesce(F.sum("r"), F.lit(0)).alias("tr"),
                     F.count(F.lit(1)).alias("v"))
    kept = counts.crossJoin(F.broadcast(total)).where(
        F.col("a") + F.col("r") >= support * (F.col("ta") + F.col("tr")))
    level = kept.where("order = 0").select(
        "gram", *[((F.col(c) + 1.0) / (F.col(f"t{c}") + F.col("v"))).alias(f"p{c}") for c in "ar"])
    level = level.withColumn("diff", F.log(F.col("pa") / F.col("pr"))).withColumn("weight", F.col("diff"))
    levels = [level]
    for order in range(1, max_order + 1):
        of_context = counts.where(F.col("order") == order).groupBy(
            F.expr(f"substring(gram, 1, {order})").alias("context")).agg(F.sum("a").alias("na"), F.sum("r").alias("nr"))
        below = level.select(F.col("gram").alias("suffix"), F.col("pa").alias("qa"), F.col("pr").alias("qr"),
                             F.col("diff").alias("below"))
        level = kept.where(F.col("order") == order) \
            .withColumn("suffix", F.expr("substring(gram, 2)")) \
            .withColumn("context", F.expr(f"substring(gram, 1, {order})")) \
            .join(below, "suffix").join(of_context, "context") \
            .select("gram", "below", *[((F.col(c) + strength * F.col(f"q{c}")) / (F.col(f"n{c}") + strength)).alias(f"p{c}")
                                       for c in "ar"])
        level = level.withColumn("diff", F.log(F.col("pa") / F.col("pr"))) \
            .withColumn("weight", F.col("diff") - F.col("below")).drop("below")
        level = cut_lineage(level)
        levels.append(level)
    out = levels[0].select("gram", "weight")
    for lv in levels[1:]:
        out = out.unionByName(lv.select("gram", "weight"))
    return cut_lineage(out)


def score_texts(texts: DataFrame, weights: DataFrame, max_order: int = MAX_ORDER) -> DataFrame:
    """(text, score) for distinct texts: summed weights per character, rounded so that the
    order of summation cannot show."""
    numbered = cut_lineage(texts.select("text", F.monotonically_increasing_id().alias("_at")))
    parts = numbered.select("_at", F.explode(grams(F.col("text"), max_order)).alias("gram"))
    uses = cut_lineage(parts.groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
    every = uses.agg(F.sum("n").alias("every"))
    hot = uses.crossJoin(F.broadcast(every)).where(F.col("n") >= HOT_SHARE * F.col("every")) \
        .join(weights, "gram", "left").select("gram", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    hot = cut_lineage(hot)  # at most 1 / HOT_SHARE rows; n-grams without a weight are in it too
    found = parts.join(F.broadcast(hot), "gram").select("_at", "weight").unionByName(
        parts.join(F.broadcast(hot.select("gram")), "gram", "left_anti").join(weights, "gram").select("_at", "weight"))
    total = found.groupBy("_at").agg(F.sum("weight").alias("total"))
    return numbered.join(total, "_at").select(
        "text", F.round(F.col("total") / (F.char_length("text") + 1), 9).alias("score"))


def threshold_of(scored: DataFrame) -> DataFrame:
    """One row ``threshold``: the cut with the best balanced accuracy on (score, rule_verdict)
    rows, in the middle between two score bins; 0 if there are none of one kind."""
    at = F.greatest(F.lit(-BIN_LIMIT), F.least(F.lit(BIN_LIMIT), F.floor(F.col("score") / BIN))).cast("int")
    bins = scored.groupBy(at.alias("bin")).agg(F.count_if(F.col("rule_verdict") == "allow").alias("a"),
                                               F.count_if(F.col("rule_verdict") == "block").alias("r"))
    every = Window.partitionBy(F.lit(0))  # at most 2 * BIN_LIMIT + 1 rows
    below = every.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    rated = bins.select(
        "bin", F.coalesce(F.lag("bin").over(every.orderBy("bin")) + 1, F.col("bin")).alias("free"),
        F.sum("a").over(every).alias("ta"), F.sum("r").over(every).alias("tr"),
        F.coalesce(F.sum("a").over(below), F.lit(0)).alias("la"), F.coalesce(F.sum("r").over(below), F.lit(0)).alias("lr"))
    rated = rated.where("ta > 0 and tr > 0").withColumn(
        "quality", F.round((F.col("ta") - F.col("la")) / F.col("ta") + F.col("lr") / F.col("tr"), 9))
    middle = (F.col("bin") + F.col("free")) / 2 * BIN
    best = rated.agg(F.max_by(middle, F.struct("quality", -F.abs("bin"), "bin")).alias("middle"))
    return best.select(F.coalesce("middle", F.lit(0.0)).alias("threshold"))


def judge(pages: DataFrame, url: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add host, path, rule, rule_verdict, score, threshold and verdict to ``pages``."""
    host, path = split_url(F.col(url))
    named = decide(pages.withColumns({"host": host, "path": path}), rules) \
        .withColumn("_text", whole_url(F.col(url)))
    # a url has about a hundred n-grams: the texts go to as many tasks as a shuffle has before they are exploded
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = cut_lineage(named.groupBy(F.col("_text").alias("text")).agg(
        F.min("rule_verdict").alias("rule_verdict")).repartition(tasks))
    decided = texts.where(F.col("rule_verdict").isNotNull())
    held_out = F.crc32(F.encode("text", "UTF-8")) % CALIBRATION_FOLDS == 0
    weights = fit_weights(decided.where(~held_out))
    scores = cut_lineage(texts.join(score_texts(texts.where("text != ''"), weights), "text", "left").na.fill({"score": 0.0}))
    threshold = threshold_of(scores.where(F.col("rule_verdict").isNotNull() & held_out))
    by_text = scores.select(F.col("text").alias("_scored"), "score")
    out = named.join(by_text, F.col("_text") == F.col("_scored"), "left").crossJoin(F.broadcast(threshold))
    method = F.when(F.col("score") >= F.col("threshold"), "allow").otherwise("block")
    return out.withColumn("verdict", F.coalesce("rule_verdict", method)).drop("_text", "_scored")
