import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from recflow.llm import queries, variants
from tests.llm.fixtures import SCHEMA, awkward, awkward_rows, empty


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=5):
    out = {}
    for w, n in counts.items():
        found = [v for v in counts if near(w, v)]
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        out[w] = [w, form, None, n, len(found), counts[form] if form else None]
    for w, row in out.items():
        root = w
        while out[root][1]:
            root = out[root][1]
        row[2] = root
    return sorted(map(tuple, out.values()))


def occurrences(docs):
    """The runs of op12 as its contract words them."""
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def vocabulary(seed, n):
    rng = random.Random(seed)
    words = set()
    while len(words) < n:
        w = "".join(rng.choice("abé") for _ in range(rng.randrange(6, 9)))
        words.add(w)
        for _ in range(3):
            i = rng.randrange(len(w))
            words.add(rng.choice([w[:i] + w[i + 1:], w[:i] + "c" + w[i:], w[:i] + "à" + w[i + 1:], w + "z", "z" + w]))
    return sorted(words)


def test_rank_index_is_an_fm_index():
    words = ["banana", "bandana", "ananas", "band", "an"]
    index = variants.RankIndex([np.array([ord(c) for c in w]) for w in words])
    for pattern in ("an", "ana", "band", "nas", "x", "anan"):
        lo, hi = np.array([0]), np.array([len(words)])
        # from the delimiters the interval holds the words that end in the pattern
        for c in reversed(pattern):
            code = np.array([ord(c)])
            lo, hi = index.extend(code, lo), index.extend(code, hi)
        assert (hi - lo)[0] == sum(w.endswith(pattern) for w in words)
        _, word = index.starts(lo, hi)
        assert [words[i] for i in word] == [w for w in words if w == pattern]


@pytest.mark.parametrize("narrow", [0, 4, 10_000])
def test_search_scheme_finds_every_near_word(monkeypatch, narrow):
    monkeypatch.setattr(variants, "NARROW", narrow)
    words = vocabulary(narrow, 150)
    found = set()
    for side in ("left", "right"):
        pairs = variants.near_in_block(words, words, side)
        assert len(pairs) == len(set(pairs))
        found |= {(words[a], words[b]) for a, b in pairs}
    assert found == {(a, b) for a in words for b in words if near(a, b)}


@pytest.mark.parametrize("block_chars", [60, 400_000])
def test_hot_halves_are_split(spark, monkeypatch, block_chars):
    monkeypatch.setattr(variants, "BLOCK_CHARS", block_chars)
    rng = random.Random(block_chars)
    words = sorted({"common" + "".join(rng.choice("ab") for _ in range(6)) for _ in range(60)} | set(vocabulary(3, 60)))
    got = variants.near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a in words for b in words if near(a, b)}


def test_whole_result(spark):
    rng = random.Random(5)
    words = vocabulary(9, 60)
    runs = [(w,) for w in words for _ in range(rng.choice([4, 5, 7, 30, 40, 200, 1000]))] + [("short",)] * 9
    counts = {w: n for w, n in Counter(w for w, in runs).items() if n >= 5 and len(w) >= 6}
    got = sorted(map(tuple, variants.spelling_variants(spark.createDataFrame(runs, "word string")).collect()))
    assert got == brute(counts) and any(r[1] and r[2] != r[1] for r in got)


def test_chain_of_forms(spark):
    chain = ["abcdefg" + "x" * i for i in range(7)]
    formed = spark.createDataFrame([(w, chain[i + 1] if i < 6 else None) for i, w in enumerate(chain)],
                                   "word string, form string")
    assert {r["root"] for r in variants.with_roots(formed).collect()} == {chain[-1]}


def test_query_on_awkward_documents(spark, tmp_path):
    rng = random.Random(2)
    base = vocabulary(4, 40)
    docs = [(100 + i, " ".join(rng.choice(base[:20] if rng.random() < 0.8 else base).title() for _ in range(80)))
            for i in range(40)] + [(r[0], r[1]) for r in awkward_rows()] + [(900, "Überall überall Àbcdef àbcdef " * 9)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in docs], SCHEMA)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op12_spelling_variants(spark, str(tmp_path)).collect()))
    assert got == brute(occurrences(docs))


def test_empty_and_clashing_tables(spark, tmp_path):
    for name, df in (("empty", empty(spark)), ("clash", awkward(spark))):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = queries.op12_spelling_variants(spark, f"{tmp_path}/{name}").collect()
        want = {} if name == "empty" else occurrences([(r[0], r[1]) for r in awkward_rows()])
        assert sorted(map(tuple, got)) == brute(want)
