import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from recflow.llm import periodic, queries
from tests.llm.fixtures import SCHEMA, awkward, awkward_rows, empty, prose


def brute_runs(words, min_length=6, min_exponent=4):
    """[(start, length, period)]"""
    n, best = len(words), {}
    for q in range(1, n // min_exponent + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end > at and end + q - at >= max(min_length, min_exponent * q):
                best.setdefault((at, end + q - at), q)
            at = end + 1
    return sorted((s, length, q) for (s, length), q in best.items())


def plant(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def digest(parts):
    return hashlib.sha256(b" ".join(parts)).hexdigest()


def op11_row(doc_id, text):
    words = plant(doc_id, (text or "").encode().split())
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(),
            digest([w for i, w in enumerate(words) if i not in gone]))


def texts(seed, n=60):
    """Texts with nested, adjacent, overlapping and whole-text runs."""
    rng = random.Random(seed)
    out = ["a " * 500, "a b " * 300, "a a b " * 200 + "a", "x " * 5, "x " * 6, "x y " * 3, "x y " * 4,
           ("a b a b a b a b c " * 8) * 3, "a b " * 4 + "b a " * 4, "p q r " * 5 + "q r p " * 5]
    for _ in range(n):
        words = []
        while len(words) < rng.choice([10, 200, 1500]):
            unit = [rng.choice("abcd") for _ in range(rng.choice([1, 2, 3, 5, 8, 17, 33, 100]))]
            words += unit * rng.choice([1, 1, 3, 4, 5, 9])
            words += unit[:rng.randrange(len(unit) + 1)]
            words += [rng.choice("abcdefgh") for _ in range(rng.randrange(4))]
        out.append(" ".join(words))
    return out


def local_runs(words):
    number = {}
    codes = np.array([number.setdefault(w, len(number)) for w in words] + [len(words)], dtype=np.int64)
    found = []
    for s in periodic.strips(codes, np.array([0, len(codes)]))[0]:
        part = periodic.strip_words(s["codes"], s["size"])
        found += [(q, s["base"] + a, s["base"] + b)
                  for boundary in s["boundaries"] for q, a, b in periodic.solve_tile(part, boundary, s["octave"])]
    whole = {}
    for q, a, b in periodic.stitched(found):
        if b - a >= max(6, 4 * q):
            whole[a, b - a] = min(q, whole.get((a, b - a), q))
    return sorted((s, length, q) for (s, length), q in whole.items())


@pytest.mark.parametrize("strip_words", [1, 1 << 15])
def test_tiles_and_stitching_find_all_runs(monkeypatch, strip_words):
    monkeypatch.setattr(periodic, "STRIP_WORDS", strip_words)
    for seed in range(6):
        for t in texts(seed, 25):
            words = t.split()
            assert local_runs(words) == brute_runs(words), t[:200]


def test_all_short_texts_over_two_letters():
    for n in range(1, 13):
        for bits in range(1 << n):
            words = [bits >> i & 1 for i in range(n)]
            assert local_runs(words) == brute_runs(words)


def test_z_function():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randrange(1, 40))]
        z = periodic.z_function(s, len(s))
        for i in range(1, len(s)):
            k = 0
            while i + k < len(s) and s[k] == s[i + k]:
                k += 1
            assert z[i] == k


def test_equal_texts_side_by_side_need_no_tiles():
    words = random.Random(4).sample(range(10**6), 300)
    codes, bounds = [], [0]
    for i in range(40):
        codes += [*words, 10**6 + i]
        bounds.append(len(codes))
    assert not any(periodic.strips(np.array(codes), np.array(bounds)))


def key(row):
    return tuple((v is None, str(v)) for v in row)


def test_query_matches_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(periodic, "BATCH_WORDS", 5_000)
    rng = random.Random(8)
    docs = [(i, t) for i, t in enumerate(texts(11, 50))] + [(1000 + i, prose(rng, rng.randrange(1, 400))) for i in range(60)]
    docs += [(r[0], r[1]) for r in awkward_rows()] + [(5000, ("u v w " * 40).upper() + "\x0b  u v w " * 9)]
    spark.createDataFrame([(i, t, None, None, None) for i, t in docs], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()), key=key)
    assert got == sorted((op11_row(*d) for d in docs), key=key)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs if i is not None) > 5


def test_awkward_and_empty_tables(spark):
    out = {r["doc_id"]: r for r in periodic.periodic_runs(awkward(spark)).collect()}
    assert out[1]["runs"] == [] and out[1]["n_words"] == 0 and out[6]["n_words"] == 30_000
    assert len(periodic.periodic_runs(awkward(spark)).collect()) == len(awkward_rows())
    assert periodic.periodic_runs(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        periodic.periodic_runs(empty(spark), min_exponent=3)
