"""Language identification by mixture inference.

Each language has a letter model: counts of letter-byte trigrams inside words, with word
boundaries, hashed to ``SLOTS``, over all labelled texts.  A word's likelihood in a language
is the product of its bytes' probabilities given the two bytes before.  A text is a mixture:
expectation-maximisation over its words estimates the language proportions, then
languages are dropped one by one, smallest first, while that costs less likelihood than
``PENALTY`` * log(number of words); what is left is the language set.

Counting is one pass with a sum per (language, slot), scoring one pass with the
table of SLOTS x languages logarithms in each task; neither moves texts.

Defined results: a null text or one without a letter gives "und", score 0 and no
languages; rows with a null language or text do not train; if nothing trains, every text is "und";
repeated rows give equal results; an empty table gives no rows; further columns pass through;
texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import arrow_rows
from recflow.llm.kernels import batches

SLOTS = 1 << 16
STRENGTH = 2.0
ROUNDS = 8
PENALTY = 2.0
UNKNOWN_BITS = 6.0
#: rows per batch sent to Python while counting, and in the pipeline
ARROW_ROWS = 1_000
_LETTER = re.compile(r"[^\W\d_]")
#: letters (ASCII, lower-cased by the caller) and bytes of non-ASCII characters
_IS_LETTER = np.zeros(256, dtype=bool)
_IS_LETTER[0x61:0x7B] = True
_IS_LETTER[0x80:] = True


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: bytes  # float32 [2, SLOTS, languages]: trigram and context counts



def _trigrams(buf: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every letter byte and every byte that ends a word: (position, slot of the
    trigram, slot of its context, whether a word starts here)."""
    raw = np.frombuffer(buf, dtype=np.uint8)
    inside = _IS_LETTER[raw]
    codes = np.where(inside, raw, 0).astype(np.uint32)
    before = np.zeros_like(codes)
    before[1:] = codes[:-1]
    before2 = np.zeros_like(codes)
    before2[2:] = np.where(before[2:] > 0, codes[:-2], 0)
    last = np.zeros(len(raw), dtype=bool)
    last[1:] = inside[:-1] & ~inside[1:]
    at = np.flatnonzero(inside | last)
    context = before2[at] << np.uint32(8) | before[at]
    full = context << np.uint32(8) | codes[at]
    slot = (full * np.uint32(0x9E3779B1)) >> np.uint32(16)
    start = inside[at] & (before[at] == 0)
    return at, slot.astype(np.int64), context.astype(np.int64), start


def count_ngrams(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, kind, slot, n): trigram counts (kind 3) and context counts (kind 2) over all rows."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables: dict[str, np.ndarray] = {}
        for frame in frames:
            for name, part in frame.groupby("lang"):
                own = tables.setdefault(name, np.zeros((2, SLOTS), dtype=np.int64))
                for _, _, buf, _ in batches(list(part["text"])):
                    _, slot, context, _ = _trigrams(buf)
                    own[0] += np.bincount(slot, minlength=SLOTS)
                    own[1] += np.bincount(context, minlength=SLOTS)
        for name, own in tables.items():
            kind, slot = np.nonzero(own)
            yield pd.DataFrame({"lang": name, "kind": 3 - kind, "slot": slot, "n": own[kind, slot]})

    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    return rows.mapInPandas(count, "lang string, kind int, slot int, n long") \
        .groupBy("lang", "kind", "slot").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """The model; at most 2 * SLOTS counts per language reach the driver."""
    with arrow_rows(labelled.sparkSession, ARROW_ROWS):
        counts = count_ngrams(labelled, text, lang).toPandas()
    names = tuple(sorted(counts["lang"].unique()))
    table = np.zeros((SLOTS, len(names)), dtype=np.float64)
    context = np.zeros((SLOTS, len(names)), dtype=np.float64)
    for i, name in enumerate(names):
        own = counts[counts["lang"] == name]
        for kind, into in ((3, table), (2, context)):
            part = own[own["kind"] == kind]
            into[part["slot"].to_numpy(), i] = part["n"].to_numpy()
    return Model(names, np.stack([table, context]).astype(np.float32).tobytes()) if names else Model((), b"")


def _logs(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """log of the smoothed trigram and context counts, each [languages, SLOTS]."""
    both = np.frombuffer(model.table, dtype=np.float32).reshape(2, SLOTS, len(model.languages))
    logs = np.log(both + np.array([STRENGTH / 64, STRENGTH], dtype=np.float32)[:, None, None])
    return np.ascontiguousarray(logs[0].T), np.ascontiguousarray(logs[1].T)


def infer(buf: bytes, offsets: np.ndarray, logs: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: proportions [texts, languages] (0: not in the set), number of words, and
    log-likelihood per byte under the mixture.  Arrays are [languages, words]."""
    n, k = len(offsets) - 1, logs[0].shape[0]
    at, slot, context, start = _trigrams(buf)
    if len(at) == 0:
        return np.zeros((n, k)), np.zeros(n, dtype=np.int64), np.zeros(n)
    words = np.flatnonzero(start)
    per_word = np.stack([np.add.reduceat(t[slot] - c[context], words) for t, c in zip(*logs)])
    owner = np.searchsorted(offsets, at[words], side="right") - 1
    count = np.bincount(owner, minlength=n)
    # only texts with words, numbered in order
    has = np.flatnonzero(count)
    first = np.concatenate([[0], np.cumsum(count[has])[:-1]])
    number = np.repeat(np.arange(len(has)), count[has])
    top = per_word.max(axis=0)
    like = np.exp(per_word - top)
    share = np.full((k, len(has)), 1.0 / k, dtype=np.float32)

    def mixed(share: np.ndarray) -> np.ndarray:
        return np.maximum(np.einsum("kw,kw->w", like, share[:, number]), np.float32(1e-30))

    def value(share: np.ndarray) -> np.ndarray:
        return np.add.reduceat(np.log(mixed(share)), first, dtype=np.float64)

    for _ in range(ROUNDS):
        scale = 1 / mixed(share)
        share = np.stack([np.add.reduceat(like[j] * scale, first) for j in range(k)]) * share / count[has]
    best = value(share)
    for _ in range(k - 1):
        drop = np.where(share > 0, share, np.inf).argmin(axis=0)
        trial = share.copy()
        trial[drop, np.arange(len(has))] = 0
        total = trial.sum(axis=0)
        possible = total > 0
        trial[:, possible] /= total[possible]
        less = value(trial)
        better = possible & (best - less <= PENALTY * np.log(np.maximum(count[has], 2)))
        share[:, better], best[better] = trial[:, better], less[better]
    size = np.bincount(np.searchsorted(offsets, at, side="right") - 1, minlength=n)[has]
    shares, level = np.zeros((n, k)), np.zeros(n)
    shares[has] = share.T
    level[has] = (best + np.add.reduceat(top, first, dtype=np.float64)) / size
    return shares, count, level


def identify_udf(model: Model):
    """Pandas UDF: text -> struct(lang, score, languages, proportions, bits): ``bits`` is the
    code length per letter byte under the mixture."""

    @F.pandas_udf("lang string, score double, languages array<string>, proportions array<double>, bits double")
    def identify(texts: pd.Series) -> pd.DataFrame:
        values, names = list(texts), model.languages
        out = []
        logs = _logs(model) if names else None
        for first, last, buf, offsets in batches(values):
            if names:
                share, _, level = infer(buf, offsets, logs)
            for i in range(last - first):
                t = values[first + i]
                if not names or t is None or not _LETTER.search(t):
                    out.append(("und", 0.0, [], [], None))
                    continue
                order = [j for j in np.argsort(-share[i], kind="stable") if share[i, j] > 0] or [0]
                out.append((names[order[0]], float(share[i, order[0]]), [names[j] for j in order],
                            [float(share[i, j]) for j in order], float(-level[i] / np.log(2))))
        return pd.DataFrame(out, columns=["lang", "score", "languages", "proportions", "bits"])

    return identify


def identify(docs: DataFrame, model: Model, text: str = "text", name: str = "language") -> DataFrame:
    """Add the struct column ``name``."""
    return docs.withColumn(name, identify_udf(model)(F.col(text)))


def accepted(language: Column) -> Column:
    """A text is in a learned language: one was found, and its letters cost fewer than
    ``UNKNOWN_BITS`` bits each, which letters drawn at random exceed under any language model here."""
    return (language["lang"] != "und") & (language["bits"] < UNKNOWN_BITS)


def held_out(ident: Column, parts: int = 4, part: int = 2) -> Column:
    return F.crc32(ident.cast("string").cast("binary")) % parts == part
