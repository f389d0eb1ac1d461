"""Spelling variants by search schemes on a bidirectional FM-index.

The vocabulary is counted from all texts.  Two words are near if they differ by one inserted, deleted or
replaced code point.  Whatever the edit, one half of a word stands in the other unchanged, so a search scheme of two
searches finds all near words: match the left half exactly from the left and extend across the
right half with at most one error, and the mirror image of it.

The index of a block of words is the Burrows-Wheeler transform of the delimited vocabulary and that of its
mirror image.  A state of a search is an interval of suffix ranks; one step extends all states of
a block by one code point, and an interval dies as soon as no word of the block has the text matched so far.  The
work per word does not depend on the number of words in the block.

On Spark: each word is sent as an index entry to the keys (length, text) of the halves that a word
of its length, one less or one more can have, at both ends, and as a pattern to the two keys of its own halves.  Keys
are dealt into blocks of about ``BLOCK_CHARS`` code points.  A key with more entries than a block holds
is split into parts, its patterns as well, and every part of the patterns meets every part of the entries in a
block of its own, so no task gets a whole hot key.

Defined results: null and empty texts have no words; a document without an id counts like one whose id is the
empty text; repeated rows count each time; ties of counts go to the smallest word in code-point order; an empty table
gives no rows; further columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import lower_ascii
from recflow.session import cut_lineage

#: code points of words: ASCII letters and U+00C0 to U+00FF
LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
BLOCK_CHARS = 400_000
#: intervals up to this many ranks are read letter by letter, wider ones are asked for every letter
NARROW = 32


def letter_runs(text: Column, min_length: int = MIN_LENGTH) -> Column:
    """Array of the maximal runs of letters with at least ``min_length`` code points, A-Z lower-cased."""
    return F.regexp_extract_all(lower_ascii(text), F.lit(f"([{LETTERS}]{{{min_length},}})"), 1)


def vocabulary(runs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the column ``word`` of ``runs``."""
    return runs.where(F.length("word") >= min_length).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


class RankIndex:
    """Suffix ranks of ``$w1$w2...$``: words of code points over 0, each ended by its own delimiter 0."""

    def __init__(self, words: list[np.ndarray]):
        lengths = np.array([len(w) for w in words])
        self.ends = np.cumsum(lengths + 1) - 1
        text = np.zeros(int(self.ends[-1]) + 1, dtype=np.int64)
        text[np.setdiff1d(np.arange(len(text)), self.ends, assume_unique=True)] = np.concatenate(words)
        self.n = n = len(text)
        # delimiters differ and keep the order of the words, so log2(longest word) doublings make all ranks differ
        rank = text + len(words)
        rank[self.ends] = np.arange(len(words))
        step = 1
        while step <= lengths.max():
            # a suffix whose first ``step`` code points hold its delimiter is already alone in its rank
            behind = np.concatenate([rank[step:], np.zeros(min(step, n), np.int64)])
            order = np.argsort(rank * (max(n, int(rank.max())) + 1) + behind, kind="stable")
            key = np.stack([rank[order], behind[order]])
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum((key[:, 1:] != key[:, :-1]).any(axis=0))])
            step *= 2
        self.suffix = np.argsort(rank)
        self.bwt = text[self.suffix - 1]  # the code point before each suffix; a word's start has a delimiter before it
        # (code point, rank) in order: the place of a pair is the rank after extending by that code point
        self.letters = np.unique(text[text > 0])
        self._keys = np.sort(self.bwt * (n + 1) + np.arange(n))

    def extend(self, code: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks after extending to the left: C[code] + Occ(code, at)."""
        return np.searchsorted(self._keys, code * (self.n + 1) + at)

    def starts(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, word) of the suffixes in [lo, hi) that begin a word."""
        first, last = np.searchsorted(self._keys, lo), np.searchsorted(self._keys, hi)
        state = np.repeat(np.arange(len(lo)), last - first)
        rank = self._keys[np.arange(len(state)) - np.repeat(np.cumsum(last - first) - (last - first), last - first)
                          + np.repeat(first, last - first)]
        return state, np.searchsorted(self.ends, self.suffix[rank])

    def successors(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, code) of every letter that stands before a suffix in [lo, hi)."""
        narrow = np.flatnonzero(hi - lo <= NARROW)
        size = (hi - lo)[narrow]
        state = np.repeat(narrow, size)
        rank = np.arange(len(state)) - np.repeat(np.cumsum(size) - size, size) + lo[state]
        top = int(self.letters[-1]) + 1
        seen = np.unique(state * top + self.bwt[rank])
        seen = seen[seen % top > 0]
        wide = np.flatnonzero(hi - lo > NARROW)
        return (np.concatenate([seen // top, np.repeat(wide, len(self.letters))]),
                np.concatenate([seen % top, np.tile(self.letters, len(wide))]))


def search(index: RankIndex, patterns: list[np.ndarray], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pattern, word) pairs with at most one error: the last ``exact`` code points of each pattern stand unchanged at
    the word's end, and the error is before them.  A pair may come more than once."""
    lengths = np.array([len(p) for p in patterns])
    offsets = np.cumsum(lengths) - lengths
    flat = np.concatenate(patterns)
    # state: pattern, code points left to match, errors, rank interval; it starts at the delimiters
    who, left, wrong = np.arange(len(patterns)), lengths.copy(), np.zeros(len(patterns), np.int64)
    lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), len(index.ends))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(int(lengths.max()) + 2):
        done = left == 0
        state, word = index.starts(lo[done], hi[done])
        found.append((who[done][state], word))
        # the next code point as it is
        go = np.flatnonzero(~done)
        code = flat[offsets[who[go]] + left[go] - 1]
        nexts = [(who[go], left[go] - 1, wrong[go], index.extend(code, lo[go]), index.extend(code, hi[go]))]
        # one error, once the exact part is matched
        free = np.flatnonzero((wrong == 0) & (lengths[who] - left >= exact[who]))
        if len(free):
            state, letter = index.successors(lo[free], hi[free])
            state = free[state]
            a, b = index.extend(letter, lo[state]), index.extend(letter, hi[state])
            ones = np.ones(len(state), np.int64)
            nexts.append((who[state], left[state], ones, a, b))  # the word has a further code point
            more = left[state] > 0
            more[more] = flat[offsets[who[state[more]]] + left[state[more]] - 1] != letter[more]
            nexts.append((who[state[more]], left[state[more]] - 1, ones[more], a[more], b[more]))  # another one
            skip = free[left[free] > 0]
            nexts.append((who[skip], left[skip] - 1, np.ones(len(skip), np.int64), lo[skip], hi[skip]))  # none
        who, left, wrong, lo, hi = (np.concatenate(x) for x in zip(*nexts))
        alive = lo < hi
        if not alive.any():
            break
        # different errors may lead to the same state
        same = np.unique(np.stack([who[alive], left[alive], wrong[alive], lo[alive], hi[alive]]), axis=1)
        who, left, wrong, lo, hi = same
    return tuple(np.concatenate(x) for x in zip(*found))


def near_in_block(words: list[str], patterns: list[str], side: str) -> list[tuple[int, int]]:
    """Distinct (pattern, word) pairs one edit apart, by the search that matches the half on ``side`` exactly."""
    turn = slice(None, None, -1) if side == "left" else slice(None)
    codes = [np.array([ord(c) for c in w[turn]], dtype=np.int64) for w in words]
    asked = [np.array([ord(c) for c in p[turn]], dtype=np.int64) for p in patterns]
    halves = np.array([len(p) // 2 if side == "left" else len(p) - len(p) // 2 for p in patterns])
    who, word = search(RankIndex(codes), asked, halves)
    pairs = np.unique(np.stack([who, word]), axis=1).T.tolist() if len(who) else []
    return [(p, w) for p, w in pairs if patterns[p] != words[w]]


def _keys(word: Column, length: Column) -> dict[str, Column]:
    """Keys of the two halves that a word of this length has."""
    half = F.floor(length / 2).cast("int")
    rest = (length - half).cast("int")
    return {"left": F.concat(F.lit("<"), half.cast("string"), F.lit(":"), F.substring(word, F.lit(1), half)),
            "right": F.concat(F.lit(">"), rest.cast("string"), F.lit(":"),
                              F.substring(word, F.length(word) - rest + 1, rest))}


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): all ordered pairs of different words of the column ``word`` that are one edit apart."""
    length = F.length("word")
    sides = []
    for side in ("left", "right"):
        as_entry = F.array_distinct(F.array(*[_keys(F.col("word"), length + d)[side] for d in (-1, 0, 1)]))
        sides.append(words.select("word", F.lit(side).alias("side"), F.lit(True).alias("entry"),
                                  F.explode(as_entry).alias("key")))
        sides.append(words.select("word", F.lit(side).alias("side"), F.lit(False).alias("entry"),
                                  _keys(F.col("word"), length)[side].alias("key")))
    sent = sides[0]
    for s in sides[1:]:
        sent = sent.unionByName(s)
    # keys with one word only need no search
    sizes = cut_lineage(sent.groupBy("key").agg(
        F.sum(F.when(F.col("entry"), length + 1)).alias("chars"), F.min("word").alias("a"), F.max("word").alias("b"),
        F.max(~F.col("entry")).alias("asked")).where((F.col("a") < F.col("b")) & F.col("asked")).select("key", "chars"))
    parts = F.ceil(F.col("chars") / BLOCK_CHARS).cast("int")
    sizes = sizes.withColumn("parts", parts)
    total = sizes.agg(F.coalesce(F.sum(F.col("chars") * F.col("parts")), F.lit(0))).first()[0]
    workers = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_blocks = max(1, math.ceil(total / BLOCK_CHARS), min(workers, math.ceil(total / (BLOCK_CHARS / 20))))
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    placed = sent.join(sizes, "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    entry_part, pattern_part = (F.when(F.col("entry"), own).otherwise(F.col("other")),
                                F.when(F.col("entry"), F.col("other")).otherwise(own))
    placed = placed.select(
        "side", F.pmod(F.xxhash64("key", entry_part, pattern_part), F.lit(n_blocks)).alias("block"), "word", "entry")
    # a word is once an entry and once a pattern of a block, whatever keys brought it there
    placed = placed.groupBy("side", "block", "word").agg(F.max("entry").alias("entry"), F.max(~F.col("entry")).alias("asked"))

    def find(rows: pd.DataFrame) -> pd.DataFrame:
        entries = rows.loc[rows["entry"], "word"].tolist()
        patterns = rows.loc[rows["asked"], "word"].tolist()
        pairs = near_in_block(entries, patterns, rows["side"].iloc[0]) if entries and patterns else []
        return pd.DataFrame([(patterns[p], entries[w]) for p, w in pairs], columns=["word", "near"])

    blocks = placed.repartition(max(n_blocks, 1), "side", "block")
    return blocks.groupBy("side", "block").applyInPandas(find, "word string, near string").distinct()


def forms(counted: DataFrame, near: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, n, n_near, form_n): the near word of largest count, if that is ``ratio`` times the word's."""
    of_near = counted.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = near.join(of_near, "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best"))
    out = counted.join(best, "word", "left")
    is_form = -F.col("best.less") >= ratio * F.col("n")
    return out.select("word", F.when(is_form, F.col("best.near")).alias("form"), "n",
                      F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                      F.when(is_form, -F.col("best.less")).alias("form_n"))


def with_roots(formed: DataFrame) -> DataFrame:
    """Adds ``root``: the last word reached by following forms (the word itself if it has none).

    Every round doubles how far words have followed; counts grow by the ratio at each form, so the
    number of rounds is the logarithm of a logarithm of the largest count."""
    steps = formed.where("form is not null").select("word", F.col("form").alias("at"))
    while True:
        jump = steps.select(F.col("word").alias("at"), F.col("at").alias("on"))
        new = cut_lineage(steps.join(jump, "at", "left").select("word", F.coalesce("on", "at").alias("at"),
                                                                F.col("on").isNotNull().alias("moved")))
        steps = new.select("word", "at")
        if not new.where("moved").limit(1).count():
            break
    return formed.join(steps, "word", "left").withColumn("root", F.coalesce("at", "word")).drop("at")


def spelling_variants(runs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                      ratio: int = RATIO) -> DataFrame:
    """One row per vocabulary word of ``runs`` (column ``word``, one row per occurrence): word, form, root, n,
    n_near, form_n."""
    counted = cut_lineage(vocabulary(runs, min_length, min_count))
    formed = cut_lineage(forms(counted, near_words(counted.select("word")), ratio))
    return with_roots(formed).select("word", "form", "root", "n", "n_near", "form_n")
