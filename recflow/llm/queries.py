"""The registered queries of this package: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.llm import (decontam, langid, licenses, mixing, near_dup, periodic, quality, secrets, simhash, toxicity,
                         urls, variants, warc)
from recflow.llm.common import let, read_table, whitespace_words


def op1_source_mixing(spark: SparkSession, d: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, d, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


def op2_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    return secrets.digest_columns(secrets.find_secrets(docs)).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


def op3_arc_to_warc(spark: SparkSession, d: str) -> DataFrame:
    records = warc.archive(read_table(spark, d, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_toxicity_mil(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    labels = read_table(spark, d, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.train(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    scored = toxicity.score_texts(docs, model)
    return scored.select(
        "doc_id", F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("toxicity.score").alias("score"), (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
        F.col("toxicity.worst_sentence").alias("worst_sentence"), F.col("toxicity.n_offending").alias("n_offending"))


def op5_benchmark_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontam.contaminated_pairs(read_table(spark, d, "documents"), read_table(spark, d, "benchmark"))


def op6_url_filter(spark: SparkSession, d: str) -> DataFrame:
    judged = urls.judge(read_table(spark, d, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op7_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, d, "documents"), k=4, percent=80)


def op8_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents")
    learn = docs.where(~langid.held_out(F.col("doc_id"))).select("text", "lang")
    named = langid.identify(docs.select("doc_id", "text"), langid.train(learn))
    return named.select(
        "doc_id", F.coalesce(langid.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"),
        F.array_join("language.languages", ",").alias("languages"))


def op9_license_scan(spark: SparkSession, d: str) -> DataFrame:
    found = licenses.scan(read_table(spark, d, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op10_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    judged = quality.apply_rules(read_table(spark, d, "documents").select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *[F.col(f"metrics.{n}").alias(n) for n in names], "base_failed", "kept")


def _planted(doc_id: Column, text: Column) -> Column:
    """The text with the periodic tail that op11's contract gives to every tenth document."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        return F.array_join(F.transform(
            words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, a + (i - a) % p))), " ")

    changed = let(whitespace_words(text), lambda words: F.when(F.size(words) > 0, planted(words)))
    return F.when((h % 10 == 0) & text.isNotNull(), changed).otherwise(text)


def op11_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents")
    found = periodic.periodic_runs(docs.select("doc_id", _planted(F.col("doc_id"), F.col("text")).alias("text")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    best = found.withColumn("best", periodic.strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"),
        "collapsed_sha256")


def op12_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    runs = read_table(spark, d, "documents").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(variants.letter_runs(F.col("text"))).alias("run"))
    hashed = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return variants.spelling_variants(hashed.select(F.when(F.col("h") % 199 == 0, cut).otherwise(F.col("run")).alias("word")))


def op13_simhash_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    linked = simhash.near_duplicates(read_table(spark, d, "documents"), k=3, radius=2)
    return linked.select("doc_id", "fingerprint", "component_id")


QUERIES = {f.__name__: f for f in (
    op1_source_mixing, op2_secret_scan, op3_arc_to_warc, op4_toxicity_mil, op5_benchmark_decontamination,
    op6_url_filter, op7_near_duplicates, op8_language_id, op9_license_scan, op10_quality_rules, op11_periodic_runs, op12_spelling_variants,
    op13_simhash_near_duplicates)}
