import re
from collections import Counter

from pyspark.sql import functions as F

from recflow.llm import quality
from tests.llm.fixtures import awkward, awkward_rows, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_metrics_match_brute_force(spark):
    texts = [r[1] for r in awkward_rows()] + [
        "a b c a b c", "a b c d a b c", "l1\nl1\n\nl1\nl2\n \n", "a a a a", "a a a", "x y z " * 40, "<b># | a</b>\n- x\n- x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality.apply_rules(df).select(
        "doc_id", *[F.col(f"metrics.{n}").alias(n) for n in NAMES], "base_failed", "kept").collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = brute(t)
        assert tuple(got[i][n] for n in NAMES) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert got[i]["base_failed"] == failed
        assert not (failed and got[i]["kept"])


def test_awkward_rows_and_clashing_columns(spark):
    out = quality.apply_rules(awkward(spark))
    assert out.count() == len(awkward_rows()) and "score" in out.columns
    assert quality.apply_rules(empty(spark)).count() == 0


def test_rules_compile_to_the_table(spark):
    rules = (quality.Rule("long", "n_words", 2, None), quality.Rule("few_symbols", "n_symbols", None, 1))
    df = spark.createDataFrame([(1, "a b"), (2, "a"), (3, "# # a")], "doc_id long, text string")
    got = {r["doc_id"]: r["failed_rules"] for r in quality.apply_rules(df, rules=rules).collect()}
    assert got == {1: [], 2: ["long"], 3: ["few_symbols"]}


def test_no_shuffle_and_no_python(spark):
    plan = quality.apply_rules(empty(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_prose_is_kept(spark):
    line = "the house of the old man is in the town and he was there with a dog that is not his"
    text = "\n".join(f"{line} number {i} and {i * 7} for year {i * 13}" for i in range(6))
    df = spark.createDataFrame([(1, text.replace("number", "no")), (2, " ".join(f"w{i}" for i in range(99)))], "doc_id long, text string")
    got = {r["doc_id"]: r["failed_rules"] for r in quality.apply_rules(df).collect()}
    assert got[1] == [] and got[2] == ["stop_words"]
