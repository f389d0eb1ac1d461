import random

import pandas as pd
from pyspark.sql import functions as F

import corpus_pipeline
from recflow.llm import decontam, langid, secrets
from tests.llm.fixtures import SCHEMA, awkward_rows
from tests.llm.test_langid import text
from tests.llm.test_near_dup import brute as brute_classes
from tests.llm.test_secrets import brute_base

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SECRET = "token = 0123456789abcdef0123456789abcdef01234567"


def tables(spark, folder):
    rng = random.Random(7)
    items = [(i, text(rng, "xx", 25)) for i in range(4)]
    rows, leaks, secret = [], set(), set()
    for i in range(150):
        lang = rng.choice(["xx", "yy", "zz"])
        body = text(rng, lang, rng.randrange(30, 120))
        if i % 10 == 0:
            leaks.add(i)
            body += " " + items[i % 4][1] + " " + text(rng, lang, 5)
        if i % 10 == 5:
            secret.add(i)
            body += " " + SECRET
        rows.append((i, body, lang, f"s{i % 4}", len(body)))
    rows += [(1000 + i, rows[i][1] + (" " + text(rng, "xx", 1) if i % 2 else ""), "xx", "s0", 1) for i in range(1, 30, 3)]
    rows += [(2000, "123 456 ###", "xx", "s1", 9), (2001, "", None, "s1", 0), (2002, None, "xx", None, 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, leaks, secret


def test_stages_against_brute_force(spark, tmp_path):
    d = str(tmp_path)
    rows, leaks, secret = tables(spark, d)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, d)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == COLUMNS, name
        out.write.parquet(f"{d}/out{i}")
        docs = spark.read.parquet(f"{d}/out{i}")
        kept.append({r["doc_id"]: r for r in docs.collect()})
    with_letters = {r[0] for r in rows if r[1] and any(c.isalpha() for c in r[1])}
    assert set(kept[0]) == with_letters
    classes = brute_classes([(r[0], r[1]) for r in rows if r[0] in with_letters], 5)
    assert set(kept[1]) == {i for i, c in classes.items() if c[2]}
    assert set(kept[2]) == {i for i in kept[1] if i % 1000 not in leaks or i in (2000, 2001, 2002)}
    assert set(kept[3]) == set(kept[2])
    for i, r in kept[3].items():
        assert r["n_chars"] == len(r["text"]) and not brute_base(r["text"])
        assert ("[SECRET]" in r["text"]) == (i in secret)
        if i not in secret:
            assert r["text"] == kept[2][i]["text"]
    words = {r["source"]: [0, 0.0] for r in kept[4].values()}
    for r in spark.read.parquet(f"{d}/out4").collect():
        words[r["source"]][0] += len(r["text"].split())
        words[r["source"]][1] = r["target"]
    assert all(abs(n - t) <= 0.5 for n, t in words.values())
    assert corpus_pipeline.run(spark, d).count() == spark.read.parquet(f"{d}/out4").count()


def test_awkward_and_empty_tables(spark, tmp_path):
    d = str(tmp_path / "empty")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0
    # rows of one source and language, repeated so that the language is learned and nothing else stands out
    d = str(tmp_path / "awkward")
    rng = random.Random(9)
    body = [text(rng, "xx", 60) for _ in range(24)]
    rows = [(100 + i, t, "xx", "a", 1) for i, t in enumerate(body)] + [r for r in awkward_rows() if r[0] in (1, 2, 3, 13)]
    rows += [(200, body[0].upper(), "xx", "a", 1), (None, body[1], None, "a", 1), (103, body[3], "xx", "a", 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(7, " ".join(body[5].split()[10:40])), (8, None)], "item_id long, text string").write.parquet(
        f"{d}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{d}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, d).write.parquet(f"{d}/out{i}")
        docs = spark.read.parquet(f"{d}/out{i}")
        kept.append(sorted((r["doc_id"] for r in docs.select("doc_id").collect()), key=lambda x: (x is None, x)))
    everybody = sorted([100 + i for i in range(24)] + [200, 103])
    assert kept[0] == everybody + [None]  # texts without a letter go
    # the copy in capitals goes; rows that repeat an id are one document; a row without an id stays
    assert kept[1] == [i for i in everybody if i != 200] + [None]
    assert kept[2] == [i for i in kept[1] if i != 105]
    assert kept[3] == kept[2]
    # one source takes all of its words once
    assert kept[4] == kept[3]


def test_unlabelled_corpus_goes(spark):
    model = langid.train(spark.createDataFrame([], SCHEMA))
    assert model.languages == ()


def test_language_stage_sends_bounded_batches(spark, monkeypatch):
    """Whole texts go to Python at most ARROW_ROWS rows at once; the session's own setting stays."""
    own = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")

    def stub(model):
        @F.pandas_udf("lang string, score double, bits double")
        def rows_at_once(texts: pd.Series) -> pd.DataFrame:
            return pd.DataFrame({"lang": "en", "score": float(len(texts)), "bits": 0.0}, index=range(len(texts)))
        return rows_at_once

    monkeypatch.setattr(langid, "identify_udf", stub)
    monkeypatch.setattr(langid, "accepted", lambda language: language["score"] <= langid.ARROW_ROWS)
    docs = spark.range(0, 3500, 1, 1).selectExpr("id as doc_id", "'some words' as text", "'en' as lang")
    assert corpus_pipeline.language_id(spark, docs, "").count() == 3500
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == own


def test_later_stages_send_bounded_batches(spark, monkeypatch, tmp_path):
    """Decontamination and both passes of the secret scan bound what a Python worker holds; the setting stays."""
    own = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    limit = 100
    monkeypatch.setattr(decontam, "ARROW_ROWS", limit)
    monkeypatch.setattr(secrets, "ARROW_ROWS", limit)

    def stub(shared, kind):
        @F.pandas_udf("array<int>")
        def many(texts: pd.Series) -> pd.Series:
            return pd.Series([[1] if len(texts) > limit else [] for _ in texts], dtype=object)
        return many

    monkeypatch.setattr(decontam, "match_udf", stub)
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.range(0, 350, 1, 1).selectExpr("id as doc_id", "'some words' as text", "'en' as lang")
    assert corpus_pipeline.decontamination(spark, docs, str(tmp_path)).count() == 350

    seen = []
    thresholds = secrets.corpus_thresholds

    def asked(rows, *args):
        out = thresholds(rows, *args)
        seen.append(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
        return out

    monkeypatch.setattr(secrets, "corpus_thresholds", asked)
    cut = corpus_pipeline.secret_scan(spark, docs.selectExpr("doc_id", f"concat(text, ' {SECRET}') as text", "lang"), "")
    assert seen == [str(limit)]
    assert {r["text"] for r in cut.collect()} == {"some words [SECRET]"}
    plan = secrets.redact(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # one Python worker a task
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == own
