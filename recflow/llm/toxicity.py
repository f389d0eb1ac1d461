"""Toxicity by multiple-instance learning.

A text is a bag of sentences.  A sentence scores p = sigmoid(bias + sum of the weights of its
words and word beginnings, hashed to ``SLOTS``), and a text scores by noisy-or, 1 - prod(1 - p).
Only text labels are given; the gradient of the text's likelihood shares each
label out among its sentences, so the model also says which sentences offend.

Training takes at most ``MAX_TRAIN_ROWS`` labelled rows of at most ``MAX_TRAIN_CHARS``
characters, chosen by a hash of the id; it runs in one task on that bounded sample and returns
``SLOTS`` weights.  Scoring is one pass over all texts without a shuffle; each is
read whole, and every sentence counts.

Defined results: a null or empty text has no sentences and scores the score of one empty
sentence, with null span; rows with a null label or id do not train; without labelled rows of
both kinds every score is 0; repeated rows are scored alike; an empty table gives
no rows; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.llm.kernels import NOT_WORD, batches, hash_words, mix64

SLOTS = 1 << 18
PREFIXES = (5, 6, 7, 8)
MAX_TRAIN_ROWS = 10_000
MAX_TRAIN_CHARS = 20_000
MIN_ROWS_PER_FEATURE = 3
#: sentences of fewer words join the next
SHORT = 8
STEPS = 200
RATE = 0.15
RIDGE = 1e-5
#: standard deviations from the overall share of toxic texts
MIN_SURPRISE = 4.0
_SENTENCE_END = np.zeros(256, dtype=bool)
_SENTENCE_END[[0x21, 0x2E, 0x3F, 0x0A]] = True
_NONE = SLOTS  # slot of a missing feature


@dataclass(frozen=True)
class Model:
    weights: bytes  # float32, SLOTS + 1 (the last is 0)
    bias: float
    known: bool = True


def _slots(hashes: np.ndarray) -> np.ndarray:
    return np.where(hashes == 0, _NONE, (mix64(hashes) >> np.uint64(64 - 18)).astype(np.int64))


def _features(buf: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(slots per word, word starts, word ends, first word of each sentence)."""
    words, starts, ends, heads = hash_words(buf, NOT_WORD, PREFIXES)
    stops = np.flatnonzero(_SENTENCE_END[np.frombuffer(buf, dtype=np.uint8)])
    begin = np.flatnonzero(np.diff(np.searchsorted(stops, starts), prepend=-1))
    # a sentence that starts within the same SHORT words of its text as the one before joins it
    text = np.searchsorted(offsets, starts[begin], side="right") - 1
    step = (begin - np.searchsorted(starts, offsets[text])) // SHORT
    new = np.ones(len(begin), dtype=bool)
    new[1:] = (np.diff(text) != 0) | (np.diff(step) != 0)
    return _slots(np.vstack([words[None, :], heads])), starts, ends, begin[new]


def _bag(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots [features, words], first word of each sentence, text of each sentence)."""
    slots, firsts, owners, base = [], [], [], 0
    for first, _, buf, offsets in batches(texts):
        s, starts, _, begin = _features(buf, offsets)
        if len(starts) == 0:
            continue
        slots.append(s.astype(np.int32))
        firsts.append(begin + base)
        owners.append(np.searchsorted(offsets, starts[begin], side="right") - 1 + first)
        base += len(starts)
    if not slots:
        return np.zeros((1 + len(PREFIXES), 0), np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(slots, axis=1), np.concatenate(firsts), np.concatenate(owners)


def fit_bags(texts: list[str], labels: np.ndarray) -> Model:
    """Full-batch Adam on the noisy-or likelihood."""
    zero = np.zeros(SLOTS + 1, dtype=np.float32)
    if len(labels) == 0 or labels.min() == labels.max():
        return Model(zero.tobytes(), 0.0, False)
    slots, firsts, owners = _bag(texts)
    n_words = slots.shape[1]
    lengths = np.diff(np.append(firsts, n_words))
    sentence = np.repeat(np.arange(len(firsts)), lengths)
    text = owners[sentence]
    # features that occur in enough texts and whose share of toxic texts is not chance, numbered compactly
    flat_slot, flat_text = slots.ravel(), np.tile(text, slots.shape[0])
    pairs = np.unique(flat_slot.astype(np.int64) * len(labels) + flat_text)
    rows = np.bincount(pairs // len(labels), minlength=SLOTS + 1)
    toxic_rows = np.bincount(pairs // len(labels), labels[pairs % len(labels)], minlength=SLOTS + 1)
    rows[_NONE] = 0
    rate = labels.mean()
    surprise = (toxic_rows - rows * rate) / np.sqrt(np.maximum(rows * rate * (1 - rate), 1e-9))
    used = np.flatnonzero((rows >= MIN_ROWS_PER_FEATURE) & (np.abs(surprise) >= MIN_SURPRISE))
    number = np.full(SLOTS + 1, -1, dtype=np.int64)
    number[used] = np.arange(len(used))
    column = number[flat_slot]
    ok = column >= 0
    column, in_sentence = column[ok], np.tile(sentence, slots.shape[0])[ok]
    n_sent, n_text = len(firsts), len(labels)
    w, b = np.zeros(len(used)), -4.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, STEPS + 1):
        z = b + np.bincount(in_sentence, w[column], minlength=n_sent)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        log_clean = np.bincount(owners, np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=n_text)
        clean = np.exp(log_clean)
        toxic = np.maximum(-np.expm1(log_clean), 1e-9)
        pull = np.where(labels == 1, clean / toxic, -1.0) / n_text
        dz = p * pull[owners]
        gw = np.bincount(column, dz[in_sentence], minlength=len(used)) - RIDGE * w
        gb = dz.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9 ** step, 1 - 0.999 ** step
        w += RATE * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b += RATE * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    zero[used] = w
    return Model(zero.tobytes(), float(b))


def train(docs: DataFrame, labels: DataFrame | None = None, text: str = "text", label: str = "label",
          ident: str = "doc_id", max_rows: int = MAX_TRAIN_ROWS, max_chars: int = MAX_TRAIN_CHARS) -> Model:
    """Fit on a bounded sample of ``labels`` (ident, label; by default columns of ``docs``).  The sample is
    drawn from the labels alone; its at most ``max_rows`` ids are sent to the texts, which stay where they are."""
    marked = docs if labels is None else labels
    drawn = marked.where(F.col(label).isNotNull()).select(
        F.xxhash64(F.col(ident), F.lit(17)).alias("h"), F.col(ident).alias("i"), F.col(label).cast("int").alias("y")) \
        .orderBy("h", "i").limit(max_rows).dropDuplicates(["i"])
    texts = docs.select(F.col(ident).alias("_i"), F.col(text).alias("t")).where(F.char_length("t") <= max_chars)
    sample = texts.join(F.broadcast(drawn), F.col("_i") == F.col("i")).select("h", "i", "t", "y")

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(frames)
        all_rows = pd.concat(parts).sort_values(["h", "i"]) if parts else pd.DataFrame({"t": [], "y": []})
        model = fit_bags(list(all_rows["t"]), all_rows["y"].to_numpy(dtype=np.int64))
        yield pd.DataFrame([(model.weights, model.bias, model.known)], columns=["weights", "bias", "known"])

    got = sample.repartition(1).mapInPandas(fit, "weights binary, bias double, known boolean").collect()
    return Model(bytes(got[0]["weights"]), got[0]["bias"], got[0]["known"]) if got else fit_bags([], np.zeros(0))


def _score(texts: list[str | None], model: Model, weights: np.ndarray) -> tuple:
    """Per text: score, span (byte start, end) and probability of its worst sentence, sentences with p >= 0.5."""
    n = len(texts)
    empty = 1 / (1 + np.exp(-model.bias))
    score, best, many = np.full(n, empty), np.zeros(n), np.zeros(n, dtype=np.int64)
    lo, hi = np.full(n, -1), np.full(n, -1)
    for first, last, buf, offsets in batches(texts):
        slots, starts, ends, begin = _features(buf, offsets)
        if len(starts) == 0:
            continue
        z = model.bias + np.add.reduceat(weights[slots].sum(axis=0), begin)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        owner = np.searchsorted(offsets, starts[begin], side="right") - 1
        log_clean = np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=last - first)
        has = np.bincount(owner, minlength=last - first) > 0
        score[first:last][has] = -np.expm1(log_clean[has])
        many[first:last] = np.bincount(owner, p >= 0.5, minlength=last - first)
        order = np.lexsort((-begin, p, owner))
        top = order[np.flatnonzero(np.diff(owner[order], append=last - first + 1))]
        at = owner[top]
        best[first + at] = p[top]
        lo[first + at] = starts[begin[top]] - offsets[at]
        final = np.append(begin[1:], len(starts)) - 1
        hi[first + at] = ends[final[top]] - offsets[at]
    return score, lo, hi, best, many


def score_udf(model: Model):
    """Pandas UDF: text -> struct(score, worst_sentence, worst_score, n_offending)."""

    @F.pandas_udf("score double, worst_sentence string, worst_score double, n_offending long")
    def score(texts: pd.Series) -> pd.DataFrame:
        weights = np.frombuffer(model.weights, dtype=np.float32).astype(np.float64)
        values = list(texts)
        s, lo, hi, best, many = _score(values, model, weights)
        if not model.known:
            s = np.zeros(len(values))
        parts = [None if a < 0 else t.encode("utf-8", "surrogatepass")[a:b].decode("utf-8", "replace")
                 for t, a, b in zip(values, lo, hi)]
        return pd.DataFrame({"score": s, "worst_sentence": parts, "worst_score": best, "n_offending": many})

    return score


def score_texts(docs: DataFrame, model: Model, text: str = "text", name: str = "toxicity") -> DataFrame:
    """Add the struct column ``name``."""
    return docs.withColumn(name, score_udf(model)(F.col(text)))


def held_out(ident: Column, parts: int = 5, part: int = 0) -> Column:
    return F.crc32(ident.cast("string").cast("binary")) % parts == part
