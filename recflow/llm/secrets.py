"""Secret scan: key patterns, and a randomness test battery under false-discovery control.

Base patterns find assignments, access keys and long hex strings.  Further
tokens of ``MIN_TOKEN`` characters or more get the smallest encoding that holds all their
characters (digits, hex, one letter case, base32, base36, letters, base58, base62, base64,
base64url; lower and upper case where they differ) and are tested in two ways:

* the battery, under "drawn uniformly from the encoding's alphabet": chi-squared
  on the symbol counts, a runs test around the middle of the alphabet and the
  lag-1 serial correlation.  A token is random-like if the smallest of the three
  p-values, times three, is at least ``ALPHA``;
* evidence against "ordinary text" (a class-switching letter model): the
  log-likelihood ratio e of uniform over ordinary.  Under the ordinary model a ratio
  of exp(e) or more has probability at most exp(-e), which is the p-value.

Tokens are discoveries by the Benjamini-Hochberg rule at level ``FDR``, applied per length
class over all candidate tokens of the corpus outside base spans, so short tokens need more
evidence than long ones.  The first pass reduces candidates to a histogram (length
class, evidence bin) of fixed size; the second pass applies the thresholds.
Texts are never shuffled and rows need no key.

Defined results: a null text is empty and has no spans (the digest is that of the
empty string); repeated rows and null ids are scanned like any other; an
empty table gives no rows; further columns pass through; texts are scanned whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import arrow_rows

MIN_TOKEN = 20
ALPHA = 0.001
FDR = 0.01
BIN = 0.25
MAX_BIN = 2000
LENGTH_CLASSES = 24
#: texts that are sent to Python at once
ARROW_ROWS = 1_000

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_TOKEN)
ASSIGN_HINT = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)
KINDS = ("assign", "access", "hex", "random")

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
#: (name, symbols in order), smallest first
ALPHABETS = (
    ("digits", _DIGITS), ("hex", _DIGITS + "abcdef"), ("HEX", _DIGITS + "ABCDEF"), ("lower", _LOWER), ("upper", _UPPER),
    ("base32", _UPPER + "234567"), ("base32_lower", _LOWER + "234567"), ("base36", _DIGITS + _LOWER),
    ("base36_upper", _DIGITS + _UPPER), ("letters", _UPPER + _LOWER),
    ("base58", "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"), ("base62", _UPPER + _LOWER + _DIGITS),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/"), ("base64url", _UPPER + _LOWER + _DIGITS + "-_"),
)
_SETS = tuple((name, alphabet, frozenset(alphabet)) for name, alphabet in ALPHABETS)
#: letters of ordinary text by frequency: each is about 0.9 times as frequent as the one before
_LETTERS = "etaoinsrhldcumfpgwybvkxjqz"
_SWITCH = math.log(0.04)
_STAY = math.log(0.88)


def _ordinary_letters() -> dict[str, float]:
    weights = [0.9 ** i for i in range(26)]
    return {c: math.log(w / sum(weights)) for c, w in zip(_LETTERS, weights)}


_LETTER_LOG = _ordinary_letters()
_CLASS = {**{c: 0 for c in _LETTERS}, **{c.upper(): 1 for c in _LETTERS}, **{c: 2 for c in "0123456789"}}
_SIGNS = frozenset("+/_-=")
_CHAR_LOG = {**_LETTER_LOG, **{c.upper(): v for c, v in _LETTER_LOG.items()},
             **{c: math.log(0.1) for c in "0123456789"}, **{c: math.log(0.2) for c in "+/_-="}}


def _normal_p(z: float) -> float:
    """Two-sided p-value of a standard normal."""
    return math.erfc(abs(z) / math.sqrt(2))


def _chi_squared_p(x: float, df: int) -> float:
    """Upper tail by the Wilson-Hilferty approximation."""
    if x <= 0:
        return 1.0
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(values: np.ndarray, size: int) -> tuple[float, float, float]:
    """p-values (uniformity, runs, serial correlation) of symbol numbers under "uniform"."""
    n = len(values)
    counts = np.bincount(values, minlength=size)
    uniform = _chi_squared_p(float(((counts - n / size) ** 2).sum() * size / n), size - 1)
    high = values >= size // 2
    a = int(high.sum())
    b = n - a
    if a and b:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * a * b / n
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        runs_p = _normal_p((runs - mean) / math.sqrt(var))
    else:
        runs_p = 2.0 ** (1 - n)
    centred = values - values.mean()
    power = float((centred ** 2).sum())
    serial_p = _normal_p(float((centred[1:] * centred[:-1]).sum()) / power * math.sqrt(n)) if power else 0.0
    return uniform, runs_p, serial_p


def encoding_of(token: str) -> tuple[str, str] | None:
    """(name, alphabet) of the smallest encoding that fits, or none for words of one letter case, or
    numbers, with signs between (random strings with signs have more than one kind of character)."""
    body = token.rstrip("=")
    used = set(body)
    if len(body) < MIN_TOKEN - 2:
        return None
    if used & _SIGNS and len({_CLASS.get(c, 3) for c in body[1:]} & {0, 1, 2}) < 2:
        return None
    for name, alphabet, symbols in _SETS:
        if used <= symbols:
            return name, alphabet
    return None


def evidence(body: str, size: int) -> float:
    """Log-likelihood ratio of "uniform over size symbols" over "ordinary text"."""
    ordinary, last = 0.0, None
    for c in body:
        kind = _CLASS.get(c, 3)
        ordinary += _CHAR_LOG.get(c, math.log(0.2))
        if last is not None:
            ordinary += _STAY if kind == last else _SWITCH
        last = kind
    return -len(body) * math.log(size) - ordinary


def length_class(n: int) -> int:
    return min(int(2 * math.log2(max(n, 1))), LENGTH_CLASSES - 1)


def token_evidence(token: str) -> tuple[int, int] | None:
    """(length class, evidence bin) of a candidate token; bin 0 if the battery
    rejects randomness or there is no evidence."""
    enc = encoding_of(token)
    if enc is None:
        return None
    body = token.rstrip("=")
    alphabet = enc[1]
    place = {c: i for i, c in enumerate(alphabet)}
    p = battery(np.array([place[c] for c in body]), len(alphabet))
    if min(p) * 3 < ALPHA:
        return length_class(len(body)), 0
    return length_class(len(body)), max(0, min(MAX_BIN, int(evidence(body, len(alphabet)) / BIN)))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, leftmost and non-overlapping per kind."""
    out = []
    if ASSIGN_HINT.search(text):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def random_tokens(text: str) -> Iterator[tuple[int, int, int, int]]:
    """(start, end, length class, evidence bin) of the candidate tokens."""
    for m in TOKEN.finditer(text):
        got = token_evidence(m.group())
        if got is not None:
            yield m.start(), m.end(), *got


def further_tokens(text: str) -> Iterator[tuple[int, int, int, int]]:
    """The candidate tokens that touch no base span: the only ones that the method may add, hence the
    only tests that its false-discovery rule counts."""
    taken = [(s, e) for s, _, e in base_spans(text)]
    for s, e, cls, at in random_tokens(text):
        if not any(s < b and a < e for a, b in taken):
            yield s, e, cls, at


def corpus_thresholds(docs: DataFrame, text: str = "text", fdr: float = FDR) -> dict[int, int]:
    """Smallest evidence bin that is a discovery, by length class (at most
    ``LENGTH_CLASSES`` entries reach the driver)."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[int, int], int] = {}
        for frame in frames:
            for t in frame["t"]:
                for _, _, cls, at in further_tokens(t or ""):
                    seen[cls, at] = seen.get((cls, at), 0) + 1
        yield pd.DataFrame([(c, b, n) for (c, b), n in seen.items()], columns=["cls", "bin", "n"])

    counts = docs.select(F.col(text).alias("t")).mapInPandas(count, "cls int, bin int, n long") \
        .groupBy("cls", "bin").agg(F.sum("n").alias("n"))
    with arrow_rows(docs.sparkSession, ARROW_ROWS):
        rows = counts.collect()  # at most LENGTH_CLASSES * MAX_BIN rows
    out: dict[int, int] = {}
    for cls in {r["cls"] for r in rows}:
        own = sorted(((r["bin"], r["n"]) for r in rows if r["cls"] == cls), reverse=True)
        tests, found = sum(n for _, n in own), 0
        for at, n in own:
            found += n
            if at > 0 and tests * math.exp(-at * BIN) <= fdr * found:
                out[cls] = at
    return out


def _spans_of(text: str, thresholds: dict[int, int]) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted; tokens that touch a base span are left out."""
    added = [(s, 3, e) for s, e, cls, at in further_tokens(text) if at >= thresholds.get(cls, MAX_BIN + 1)]
    return sorted(base_spans(text) + added)


def span_udf(thresholds: dict[int, int]):
    """Pandas UDF: text -> array of (start, kind number, end), sorted."""

    @F.pandas_udf("array<struct<start:int,kind:int,end:int>>")
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": s, "kind": k, "end": e} for s, k, e in _spans_of(t or "", thresholds)] for t in texts],
                         dtype=object)

    return spans


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, text: str = "text", fdr: float = FDR, name: str = "secret_spans") -> DataFrame:
    """Add ``name`` (array of start, kind number, end); a column of that name is replaced."""
    return docs.withColumn(name, span_udf(corpus_thresholds(docs, text, fdr))(F.col(text)))


def digest_columns(found: DataFrame, name: str = "secret_spans") -> DataFrame:
    """n_assign, n_access, n_hex, n_random, base_sha256 and spans from the spans in ``name``."""
    spans = F.col(name)
    kinds = F.transform(spans, lambda s: s["kind"])
    counts = {f"n_{k}": (F.size(spans) - F.size(F.array_remove(kinds, i))).cast("long") for i, k in enumerate(KINDS)}
    base = F.filter(spans, lambda s: s["kind"] < 3)
    return found.withColumns({**counts, "base_sha256": F.sha2(_joined(base).cast("binary"), 256), "spans": _joined(spans)})


def _cut(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """The text with every span replaced by ``mark``, overlapping ones by one."""
    parts, at = [], 0
    for start, _, end in sorted(spans, key=lambda x: (x[0], -x[2])):
        if end <= at:
            continue
        parts += [text[at:max(start, at)], mark if start >= at else ""]
        at = end
    return "".join(parts) + text[at:]


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", fdr: float = FDR) -> DataFrame:
    """Replace every span by ``mark``; texts without spans stay as they are (null stays null).  Spans are found and cut in
    one call, so a task keeps one Python worker."""
    thresholds = corpus_thresholds(docs, text, fdr)

    @F.pandas_udf("string")
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([t if t is None else _cut(t, _spans_of(t, thresholds), mark) for t in texts], dtype=object)

    return docs.withColumn(text, cut(F.col(text)))
