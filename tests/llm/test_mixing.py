import hashlib
import re

from recflow.llm import mixing
from tests.llm.fixtures import awkward, awkward_rows, empty, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(table):
    """{(doc_id, text): taken} lists and targets, by water filling and a sorted walk."""
    sized = [(i, s, len(WORD.findall(t or ""))) for i, t, _, s, _ in table]
    total = sum(n for _, _, n in sized)
    sources = sorted({s for _, s, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    own = {s: sum(n for _, x, n in sized if x == s) for s in sources}
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sources)}
    target, open_, budget = {}, list(sources), float(total)
    while open_:
        share = {s: budget * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= 3 * own[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 3.0 * own[s]
            budget -= target[s]
            open_.remove(s)
    out = []
    for s in sources:
        key = lambda r: (int(hashlib.md5(("mix:" + ("null" if r[0] is None else str(r[0]))).encode()).hexdigest()[:15], 16),
                         r[0] is not None, r[0] or 0, r[2])
        goal, at = round(target[s]), 0
        epochs = goal // own[s] if own[s] else 0
        for i, _, n in sorted((r for r in sized if r[1] == s), key=key):
            part = min(n, max(0, goal - epochs * own[s] - at))
            out.append((i, s, n, own[s], round(target[s], 6), epochs * n + part))
            at += n
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_matches_brute_force(spark):
    from pyspark.sql import functions as F
    got = mixing.mix(awkward(spark)).select("doc_id", "source", "size", "source_size", F.round("target", 6).alias("target"), "taken")
    assert rows(got) == brute(awkward_rows())


def test_caps_and_budget(spark):
    table = [(i, "w " * (5 + i % 7), "en", f"s{i % 5}" if i % 3 else "big", 1) for i in range(300)]
    table += [(1000 + i, "w w", "en", "tiny", 1) for i in range(3)]
    df = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mix(df).collect()
    total = sum(r["size"] for r in got)
    by = {}
    for r in got:
        assert r["taken"] <= 3 * r["size"]
        by.setdefault(r["source"], [0, r["target"], r["source_size"]])[0] += r["taken"]
    assert abs(sum(t for _, t, _ in by.values()) - total) < 1e-6
    for taken, target, size in by.values():
        assert abs(taken - target) <= 0.5 and target <= 3 * size
    assert by["tiny"][1] == 18
    again = mixing.mix(df.repartition(7)).select("doc_id", "taken")
    assert rows(again) == sorted(((r["doc_id"], r["taken"]) for r in got), key=lambda r: tuple((v is None, str(v)) for v in r))


def test_expand_writes_the_mix(spark):
    df = awkward(spark, clashes=False)
    mixed = mixing.mix(df, keep=("text",))
    whole = mixing.expand(mixed).collect()
    words = {}
    for r in whole:
        words[r["source"]] = words.get(r["source"], 0) + len(WORD.findall(r["text"]))
    for r in mixed.groupBy("source").sum("taken").collect():
        assert words.get(r["source"], 0) == r["sum(taken)"]


def test_empty_table(spark):
    assert mixing.mix(empty(spark)).count() == 0


def test_plan_has_no_python(spark):
    plan = mixing.mix(empty(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
