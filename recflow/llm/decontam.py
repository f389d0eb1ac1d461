"""Benchmark decontamination: find benchmark items in texts up to word edits.

Texts and items become sequences of words (letters, digits, non-ASCII; lower case).  A match needs
1 - edits / item words >= the similarity.

Windows are sized to the item: the largest of ``WINDOWS`` that fits three times into it (short items: below), and
embedded by the CGK random walk.  At step j the symbol under the pointer is written, and the pointer moves on by a random
bit that depends on j and the symbol; past the window's end it writes an end mark.  Two windows a few
edits apart have embeddings that differ in few places, so they agree on a sample of ``SAMPLED`` steps with good
probability, and equal windows always agree.  Every item window is indexed; texts are read every half window, which meets
some window of each place where the item stands.

The search is repeated with other walk bits and other samples.  How often follows from ``TARGET_RECALL``: for each window size
random items of the lengths that use it get all edits that the similarity allows, and tables are added until that share
of them is met (``tables``; seeded, so reruns agree).  Items of up to 11 words have windows of at most 3 words,
read at every word; the edits that a similarity of 0.8 allows always leave one of them untouched.

Candidates are verified by the exact edit distance of the whole item to the best matching stretch of the text, so every
result is a match, and word-for-word copies are always found.

Items are read in blocks of at most ``BLOCK_CHARS`` characters (one longer item is a block of its
own).  Each block is a pass of its own over the texts, whose index is the only thing sent to tasks.

Defined results: null and empty texts and items without words match nothing; an item that occurs several times in a
text is one result with its best place; repeated rows give repeated results, repeated items count
each; ids of items may have any type; an empty table on either side gives no matches; further columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import free_name
from recflow.llm.kernels import NOT_WORD, batches, hash_words, mix64, word_offsets

SIMILARITY = 0.8
TARGET_RECALL = 0.995
WINDOWS = (4, 8, 16, 32)
SAMPLED = 4
#: random items per length that measure the recall, and the most tables of a window size
TRIALS, MAX_TABLES = 600, 40
BLOCK_CHARS = 4 << 20
#: texts to send to Python at once where whole texts are searched
ARROW_ROWS = 1_000
_LUT_BITS = 20
_PAD = WINDOWS[-1] + 4


def words_of(text: str | None) -> np.ndarray:
    return hash_words(text.lower().encode("utf-8", "surrogatepass"), NOT_WORD)[0] if text else np.zeros(0, np.uint64)


def edit_limit(n_words: int, similarity: float) -> int:
    return math.floor((1 - similarity) * n_words + 1e-9)


def window_size(n_words: int, similarity: float = SIMILARITY) -> int:
    """Words of the windows of an item."""
    small = min(n_words, 3) if edit_limit(n_words, similarity) == 0 or n_words > 5 else 2
    return max([small, *(w for w in WINDOWS if 3 * w <= n_words)])


def stride(window: int) -> int:
    """Text windows start at every so many words."""
    return max(1, window // 2) if window >= WINDOWS[0] else 1


def steps(window: int, table: int) -> list[int]:
    """The sampled steps of the walk; step 0 is among them."""
    last = window + window // 2
    if window < WINDOWS[0]:
        return list(range(last + 1))
    rest = np.random.default_rng(20240607 + 1000 * table + window).choice(np.arange(1, last + 1), SAMPLED - 1, replace=False)
    return [0, *sorted(rest.tolist())]


def embed(symbols: np.ndarray, starts: np.ndarray, window: int, table: int) -> np.ndarray:
    """Keys of the windows at ``starts`` of mixed word hashes; ``symbols`` must go on for ``window`` after each start."""
    sampled = steps(window, table)
    at, end = starts.copy(), starts + window
    keys = np.full(len(starts), np.uint64(window * 1000 + table))
    for j in range(sampled[-1] + 1):
        seen = np.where(at < end, symbols[at], np.uint64(0))
        if j in sampled:
            keys *= np.uint64(0x9FB21C651E98DF25)
            keys += seen
        # every table reads other bits of a symbol; the end mark moves nothing
        at += ((seen >> np.uint64((j + 17 * table) % 64)) & np.uint64(1)).astype(np.int64)
    return mix64(keys)


_SALT = np.uint64(0x632BE59BD9B4E019)


def symbols_of(words: np.ndarray) -> np.ndarray:
    return mix64(words ^ _SALT)


def _edited(rng: np.random.Generator, words: np.ndarray, edits: int) -> np.ndarray:
    out = words.tolist()
    for kind in rng.integers(0, 3, edits):
        place, new = int(rng.integers(0, len(out))), int(rng.integers(1, 1 << 62))
        if kind == 0:
            out[place] = new
        elif kind == 1 and len(out) > 1:
            del out[place]
        else:
            out.insert(place, new)
    return np.array(out, dtype=np.uint64)


class Trials:
    """TRIALS random items of ``n`` words, each with ``edits`` random edits in a text, and which of them are met."""

    def __init__(self, window: int, n: int, edits: int, seed: int = 3):
        rng = np.random.default_rng(seed + n)
        pad = np.zeros(_PAD, np.uint64)
        own, other, own_at, other_at = [], [], [], []
        a = b = 0
        for _ in range(TRIALS):
            item = rng.integers(1, 1 << 62, n).astype(np.uint64)
            text = np.concatenate([rng.integers(1, 1 << 62, int(rng.integers(0, window))).astype(np.uint64), _edited(rng, item, edits)])
            own += [item, pad]
            other += [text, pad]
            own_at.append(a + np.arange(n - window + 1))
            other_at.append(b + np.arange(0, len(text), stride(window)))
            a, b = a + n + len(pad), b + len(text) + len(pad)
        self.window, self.met = window, np.zeros(TRIALS, bool)
        self.sides = [(symbols_of(np.concatenate(x)), np.concatenate(at), np.repeat(np.arange(TRIALS), [len(y) for y in at]))
                      for x, at in ((own, own_at), (other, other_at))]

    def add_table(self, table: int) -> float:
        """Share of items met so far."""
        # the number of the trial is part of what has to agree
        keys = [embed(symbols, at, self.window, table) ^ mix64(trial.astype(np.uint64) + np.uint64(1))
                for symbols, at, trial in self.sides]
        self.met[self.sides[1][2][np.isin(keys[1], keys[0])]] = True
        return float(self.met.mean())


@lru_cache(maxsize=None)
def tables(window: int, similarity: float = SIMILARITY, target: float = TARGET_RECALL) -> int:
    """Tables that meet the target share of random items of the lengths that use the window."""
    if window < WINDOWS[0] or similarity >= 1:
        return 1
    # longer items have more windows: the hardest are the shortest, and the first that allow one edit more
    first = 3 * window
    more = next((n for n in range(first + 1, 2 * first) if edit_limit(n, similarity) > edit_limit(first, similarity)), first)
    trials = [Trials(window, n, edit_limit(n, similarity)) for n in {first, more} if window_size(n, similarity) == window]
    for t in range(MAX_TABLES):
        if min(x.add_table(t) for x in trials) >= target:
            return t + 1
    return MAX_TABLES


@dataclass
class Index:
    """Items of one block: words, and the sorted window keys with their item and offset."""

    ids: list[int | None]
    words: list[np.ndarray]
    keys: np.ndarray
    items: np.ndarray
    offsets: np.ndarray
    #: (window, number of tables)
    windows: tuple[tuple[int, int], ...]
    #: edits allowed per item
    limits: np.ndarray
    ranked: list[np.ndarray] = field(init=False)

    def __post_init__(self) -> None:
        self.ranked = [np.sort(w) for w in self.words]

    def lut(self) -> np.ndarray:
        table = np.zeros(1 << _LUT_BITS, dtype=bool)
        table[(self.keys >> np.uint64(64 - _LUT_BITS)).astype(np.int64)] = True
        return table


def build_index(ids: list, texts: list[str | None], similarity: float = SIMILARITY,
                target: float = TARGET_RECALL) -> Index:
    words = [words_of(t) for t in texts]
    keys, items, offsets = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    limits = np.array([edit_limit(len(w), similarity) for w in words], dtype=np.int64)
    windows = {}
    pad = np.zeros(_PAD, dtype=np.uint64)
    for i, w in enumerate(words):
        if not len(w):
            continue
        c = window_size(len(w), similarity)
        windows[c] = tables(c, similarity, target)
        starts = np.arange(len(w) - c + 1)
        symbols = symbols_of(np.concatenate([w, pad]))
        for t in range(windows[c]):
            keys.append(embed(symbols, starts, c, t))
            items.append(np.full(len(starts), i))
            offsets.append(starts)
    key, item, offset = np.concatenate(keys), np.concatenate(items), np.concatenate(offsets)
    order = np.argsort(key, kind="stable")
    return Index(list(ids), words, key[order], item[order], offset[order], tuple(sorted(windows.items())), limits)


def best_stretch(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the stretch of ``region`` closest to ``item`` (words, unit costs)."""
    m = len(region)
    grid = np.arange(m + 1)
    row, origin = np.zeros(m + 1, dtype=np.int64), grid.copy()
    for i, w in enumerate(item, 1):
        swap = row[:-1] + (region != w)
        up = row[1:] + 1
        take = swap <= up
        new = np.concatenate([[i], np.where(take, swap, up)])
        src = np.concatenate([[0], np.where(take, origin[:-1], origin[1:])])
        # words of the region left over: cheapest place to the left plus the distance
        low = np.minimum.accumulate(new - grid)
        place = np.maximum.accumulate(np.where(new - grid == low, grid, 0))
        row, origin = low + grid, src[place]
    end = int(row.argmin())
    return int(row[end]), int(origin[end]), end


def search(texts: list[str | None], index: Index, lut: np.ndarray) -> list[list[tuple]]:
    """Matches of every text."""
    out: list[list[tuple]] = [[] for _ in texts]
    if not index.windows:
        return out
    lowered = [t.lower() if t else t for t in texts]
    for first, last, buf, offsets in batches(lowered, lower=False):
        words, starts, _ = hash_words(buf, NOT_WORD)
        bounds = word_offsets(starts, offsets)
        run = [(first + i, words[bounds[i]:bounds[i + 1]]) for i in range(last - first)
               if bounds[i + 1] > bounds[i]]
        if run:
            _search_run(run, index, lut, out)
    return out


def _candidates(symbols: np.ndarray, starts: np.ndarray, which: np.ndarray, places: np.ndarray, index: Index,
                lut: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(text, item, place of the item's first word) of every window met."""
    for window, n_tables in index.windows:
        asked = np.flatnonzero(places % stride(window) == 0)
        begin = starts[asked]
        for table in range(n_tables):
            keys = embed(symbols, begin, window, table)
            maybe = np.flatnonzero(lut[(keys >> np.uint64(64 - _LUT_BITS)).astype(np.int64)])
            lo = np.searchsorted(index.keys, keys[maybe], side="left")
            n = np.searchsorted(index.keys, keys[maybe], side="right") - lo
            entry = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            own = asked[np.repeat(maybe, n)]
            yield from zip(which[own].tolist(), index.items[entry].tolist(), (places[own] - index.offsets[entry]).tolist())


def _search_run(run: list[tuple[int, np.ndarray]], index: Index, lut: np.ndarray, out: list[list[tuple]]) -> None:
    pad = np.zeros(_PAD, dtype=np.uint64)
    tokens = np.concatenate([x for _, w in run for x in (w, pad)])
    begins = np.concatenate([[0], np.cumsum([len(w) + len(pad) for _, w in run])[:-1]])
    counts = np.array([len(w) for _, w in run])
    which = np.repeat(np.arange(len(run)), counts)
    places = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    found = sorted(set(_candidates(symbols_of(tokens), begins[which] + places, which, places, index, lut)))
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for d, item, at in found:  # word-for-word copies need no alignment
        words = index.words[item]
        if (d, item) not in best and at >= 0 and np.array_equal(words, run[d][1][at:at + len(words)]):
            best[d, item] = (0, at, at + len(words) - 1)
    last: dict[tuple[int, int], int] = {}
    for d, item, at in found:
        words, own = index.words[item], run[d][1]
        n = len(words)
        place = best.get((d, item), (n, 0, 0))
        if place[0] == 0 or ((d, item) in last and at - last[d, item] <= 2):
            continue  # found without edits, or the same place again
        limit = int(index.limits[item])
        lo, hi = max(0, at - limit - 2), min(len(own), at + n + limit + 2)
        region = own[lo:hi]
        ranked = index.ranked[item]
        near = np.minimum(np.searchsorted(ranked, region), n - 1)
        if np.count_nonzero(ranked[near] == region) < n - limit:  # too few words in common for so few edits
            continue
        edits, start, end = best_stretch(words, region)
        if edits <= limit:
            last[d, item] = at
            best[d, item] = min(place, (edits, lo + start, lo + end - 1))
    for (d, item), (edits, start, end) in sorted(best.items()):
        n = len(index.words[item])
        out[run[d][0]].append((index.ids[item], edits, n, 1 - edits / n, start, end))


def match_type(items: DataFrame, ident: str) -> str:
    kind = items.schema[ident].dataType.simpleString()
    return f"array<struct<item_id:{kind},edits:int,item_words:int,similarity:double,first_word:long,last_word:long>>"


def match_udf(shared: Broadcast, kind: str):
    """Pandas UDF: text -> matches with the items of a broadcast index."""
    names = ("item_id", "edits", "item_words", "similarity", "first_word", "last_word")

    @F.pandas_udf(kind)
    def find(texts: pd.Series) -> pd.Series:
        index = shared.value
        found = search(list(texts), index, index.lut())
        return pd.Series([[dict(zip(names, m)) for m in own] for own in found], dtype=object)

    return find


def item_blocks(items: DataFrame, ident: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS):
    """The items in blocks, one (ids, texts) at a time."""
    total = items.agg(F.sum(F.char_length(text))).first()[0] or 0
    n = max(1, math.ceil(total / block_chars))
    own = items.select(F.col(ident).alias("i"), F.col(text).alias("t"))
    for b in range(n):
        part = own if n == 1 else own.where(F.pmod(F.xxhash64("t"), F.lit(n)) == b)
        rows = part.orderBy("i", "t").collect()  # about block_chars characters
        yield [r["i"] for r in rows], [r["t"] for r in rows]


def _passes(docs: DataFrame, items: DataFrame, ident: str, item_text: str, similarity: float, block_chars: int) -> list:
    """One match UDF per block of items."""
    sc, kind = docs.sparkSession.sparkContext, match_type(items, ident)
    return [match_udf(sc.broadcast(build_index(ids, texts, similarity)), kind)
            for ids, texts in item_blocks(items, ident, item_text, block_chars)]


def _text_key(text: str) -> Column:
    """128 bits of the text, on which all matches depend (null: a key of its own)."""
    return F.concat_ws("/", F.xxhash64(F.col(text)).cast("string"), F.xxhash64(F.lit(1), F.col(text)).cast("string"),
                       F.col(text).isNull().cast("string"))


def _matches_by_text(docs: DataFrame, passes: list, text: str) -> DataFrame:
    """(key, item): one row per different text and match; each block is a job of its own, written before the next."""
    from recflow.session import cut_lineage
    out = None
    for find in passes:
        hits = docs.select(_text_key(text).alias("key"), F.explode(find(F.col(text))).alias("m")).distinct()
        out = cut_lineage(hits) if out is None else out.unionByName(cut_lineage(hits))
    return out


def contaminated_pairs(docs: DataFrame, items: DataFrame, ident: str = "doc_id", text: str = "text",
                       item_ident: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY,
                       block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per (document, item): ident, item_id, edits, item_words, similarity, first_word, last_word."""
    passes = _passes(docs, items, item_ident, item_text, similarity, block_chars)
    own = docs.select(F.col(ident).alias("id"), F.col(text).alias("t"))
    out = None
    for find in passes:
        hits = own.select("id", F.explode(find(F.col("t"))).alias("m"))
        out = hits if out is None else out.unionByName(hits)
    return out.select(F.col("id").alias(ident), "m.*")


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_ident: str = "item_id",
                      item_text: str = "text", similarity: float = SIMILARITY, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents without a match, columns unchanged."""
    passes = _passes(docs, items, item_ident, item_text, similarity, block_chars)
    if len(passes) == 1:
        return docs.where(F.size(passes[0](F.col(text))) == 0)
    gone = _matches_by_text(docs, passes, text).select("key").distinct()
    name = free_name(docs, "key")
    return docs.withColumn(name, _text_key(text)).join(gone.withColumnRenamed("key", name), name, "left_anti").select(*docs.columns)
