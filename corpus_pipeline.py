"""From raw documents to a training mix: STAGES, applied in order by ``run``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``.  Between stages the documents are written to shared storage, so a
lost executor costs a read, not the stages before.

Defined results: texts without a letter (null and empty ones too) go in the first stage; a document without an id is
never dropped as a copy; rows that repeat an id are one document; further columns pass through all stages but the
last; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.llm import decontam, langid, mixing, near_dup, secrets
from recflow.llm.common import arrow_rows, free_name, read_table
from recflow.session import cut_lineage, ship_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; ``lang`` is only read to learn.  Written here, because the size of the
    batches sent to Python counts when the plan runs."""
    ship_package(spark)
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))).select("text", "lang"))
    name = free_name(docs, "language")
    with arrow_rows(spark, langid.ARROW_ROWS):
        named = langid.identify(docs, model, name=name)
        return cut_lineage(named.where(langid.accepted(F.col(name))).drop(name))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    ship_package(spark)
    return near_dup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.  Written here, as in ``language_id``."""
    ship_package(spark)
    with arrow_rows(spark, decontam.ARROW_ROWS):
        return cut_lineage(decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark")))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with every secret replaced by a mark; n_chars follows the text.  Written here, as in
    ``language_id``."""
    ship_package(spark)
    with arrow_rows(spark, secrets.ARROW_ROWS):
        clean = cut_lineage(secrets.redact(docs))
    return clean.withColumn("n_chars", F.char_length("text").cast("long"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per document and epoch, its text cut at the source's budget."""
    ship_package(spark)
    mixed = mixing.mix(docs, keep=("text", "lang", "n_chars"))
    return mixing.expand(mixed).select("doc_id", "epoch", "text", "lang", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", source_mixing),
]

#: SQL cannot express the language model, the battery or the redaction: tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
