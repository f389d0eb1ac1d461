import hashlib
import random
import re
import string

from recflow.llm import secrets
from tests.llm.fixtures import awkward, awkward_rows, empty, prose


def brute_base(text):
    text = text or ""
    out = []
    for m in re.finditer(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|"""
                         r"""(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 8:
            out.append((m.start(), 0, "assign", m.end()))
    for i, (name, pattern, least) in enumerate((("access", r"AKIA[A-Z0-9]+", 16), ("hex", r"[0-9a-f]+", 32)), 1):
        out += [(m.start(), i, name, m.end()) for m in re.finditer(pattern, text) if len(m.group()) >= least]
    return sorted(out)


RNG = random.Random(4)
HEX40 = "".join(RNG.choice("0123456789abcdef") for _ in range(40))
B64 = "".join(RNG.choice(string.ascii_letters + string.digits) for _ in range(40))
TEXTS = [
    f'x token = "{HEX40}" y', "password: hunter2", "PASSWORD='longenough1'", "api_key=abcdefgh apikey : 12345678", "token: secret:abcdefgh12",
    "password=secret=abcdefghij", f"AKIA{'A1' * 8} AKIAX AKIA12345678901", HEX40 + "g" + HEX40[:31], f"é {B64} ü", "toKen = abcdefghijk",
    "secretſ=abcdefghijk", "ſecret=abcdefghijk", f"data {B64}", "AnOrdinaryCamelCaseIdentifierName and_snake_case_identifier_name",
    "https/path/to/some/long/directory/name", "2024-05-12T10:20:30-2024-05-13", "a" * 100, "ABCDEFGHIJKLMNOPQRSTUVWXYZ012345", "0" * 64,
]


def test_base_spans_match_brute_force(spark):
    texts = TEXTS + [r[1] for r in awkward_rows()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in secrets.digest_columns(secrets.find_secrets(df)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = brute_base(t)
        joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in want)
        assert [got[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(x[2] == k for x in want) for k in ("assign", "access", "hex")]
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(filter(None, got[i]["spans"].split(",")))


def test_random_tokens_are_found_and_words_are_not(spark):
    rng = random.Random(8)
    rows, planted = [], set()
    for i in range(200):
        text = prose(rng, 50) + " SomeOrdinaryIdentifierName2 another_ordinary_name_12 2024-05-12T10:20:30Z-a path/to/file/number12 "
        if i % 4 == 0:
            token = "".join(rng.choice(string.ascii_letters + string.digits + "+/") for _ in range(40))
            text += token
            planted.add((i, len(text) - 40, len(text)))
        rows.append((i, text))
    got = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {(r["doc_id"], s["start"], s["end"]) for r in got for s in r["secret_spans"] if s["kind"] == 3}
    assert len(found & planted) >= 0.95 * len(planted)
    assert len(found - planted) <= 0.02 * len(rows)


def test_battery_p_values_are_uniform_for_random_tokens():
    import numpy as np
    rng = np.random.default_rng(1)
    p = np.array([secrets.battery(rng.integers(0, 16, 64), 16) for _ in range(2000)])
    assert ((p < 0.05).mean(axis=0) < 0.09).all() and ((p < 0.5).mean(axis=0) > 0.35).all()
    assert min(secrets.battery(np.arange(64) % 16, 16)) < 1e-4
    assert min(secrets.battery(np.zeros(40, dtype=int), 16)) < 1e-6


def test_every_alphabet_passes_the_battery():
    rng = random.Random(12)
    for name, alphabet in secrets.ALPHABETS:
        for size in (24, 64, 200):
            tokens = ["".join(rng.choices(alphabet, k=size)) for _ in range(200)]
            got = [secrets.token_evidence(t) for t in tokens]
            assert sum(g is not None and g[1] > 0 for g in got) >= 194, (name, size)


def test_every_alphabet_is_found_and_redacted(spark):
    rng = random.Random(13)
    rows, planted = [], {}
    for i in range(8):
        for name, alphabet in secrets.ALPHABETS:
            for size in (24, 64, 200):
                token = "".join(rng.choices(alphabet, k=size))
                planted[len(rows)] = (name, size, token)
                rows.append((len(rows), f"{prose(rng, 20)} {token} Internationalization2 another_ordinary_name_12 antidisestablishmentarianism"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lost = {}
    for r in secrets.redact(df).collect():
        name, size, token = planted[r["doc_id"]]
        assert r["text"].endswith(" Internationalization2 another_ordinary_name_12 antidisestablishmentarianism")
        lost[name, size] = lost.get((name, size), 0) + (token in r["text"])
    # random digits differ from an ordinary number by little, so short ones are no discoveries
    assert all(n <= 1 for (name, size), n in lost.items() if (name, size) != ("digits", 24)), lost


def test_redaction(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS + [None, ""])), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    assert got[0] == 'x [SECRET]" y' and got[len(TEXTS)] is None and got[len(TEXTS) + 1] == "" and got[1] == TEXTS[1]
    assert not any(brute_base(t) for t in got.values() if t)


def test_awkward(spark):
    out = secrets.find_secrets(awkward(spark).drop("spans"))
    assert out.count() == len(awkward_rows()) and "score" in out.columns
    assert secrets.find_secrets(empty(spark)).count() == 0
