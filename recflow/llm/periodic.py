"""Periodic runs of words, found on scale tiles.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and length of at
least max(``min_length``, ``min_exponent`` * q) that no neighbouring word extends keeping period q.

For the octave of periods Q/2 <= q < Q the boundaries are the multiples of Q, and the tile of boundary b is
the words from b - 2Q to b + 3Q: neighbouring tiles overlap in four fifths.  A run of an octave is at least 2Q long,
so some boundary b of it has Q/2 words that stand again q words later.  That test of the words at b against those at b + q
is one comparison of window hashes for each pair of a boundary and a period, and tells which tiles to solve:

1. one pass over the texts writes the number of words, the digest of the words without changes, and the tiles that pass
   the test, neighbouring ones of a document as one strip of at most ``STRIP_WORDS`` words (or eight times the octave);
   a document is known by a 128-bit hash of its text, on which all results depend;
2. strips are shuffled and solved one by one: the Z-function of the words from b on, and that of the words before b read
   backwards, give for every period how far it holds to the right and to the left of b, hence the fragment
   of the run in the tile.  Fragments with a smaller period are dropped: words with period q and
   another period that divides it have both on the same fragment;
3. fragments are shuffled by document and period, and stitched where they share q words or more;
4. equal stretches keep their smallest period, runs are gathered by document, and the texts that have runs are joined to
   them and collapsed.  Texts cross that shuffle compressed; those with very many copies are joined by broadcast.

Everything is exact: window hashes only choose tiles, and a false hit costs time, never a row.

Defined results: null and empty texts have no words and no runs; documents without an id and repeated rows or ids
give one result row each; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recflow.llm.common import arrow_rows, join_hot
from recflow.llm.kernels import mix64
from recflow.session import cut_lineage

MIN_LENGTH, MIN_EXPONENT = 6, 4
STRIP_WORDS = 1 << 15
#: words of consecutive texts that are tested together
BATCH_WORDS = 1 << 16
ARROW_ROWS = 500
STRIP = "struct<octave:int, base:int, boundaries:array<int>, codes:binary, size:int>"
SCANNED = f"key string, id string, n_words long, plain_sha256 string, strips array<{STRIP}>"


def octaves(longest: int, min_exponent: int = MIN_EXPONENT) -> Iterator[int]:
    """Q of the octaves [Q/2, Q) whose periods fit ``min_exponent`` times into ``longest`` words."""
    q = 2
    while min_exponent * (q // 2) <= longest:
        yield q
        q *= 2


def boundaries_to_solve(codes: np.ndarray, bounds: np.ndarray, octave: int, window: np.ndarray) -> np.ndarray:
    """Boundaries b with Q/2 words that stand again q words later in the same text, Q/2 <= q < Q; ``window`` has the
    hash of the Q/2 words from each position on."""
    half = octave // 2
    whole = np.zeros(-(-len(codes) // octave) * octave + octave, dtype=np.uint64)
    whole[:len(window)] = window
    # positions without a full window never match: their value is that of no position
    whole[len(window):] = mix64(np.arange(len(whole) - len(window), dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))
    grid = whole.reshape(-1, octave)
    at, later = np.nonzero(grid[:, half:] == grid[:, :1])
    at *= octave
    same = np.searchsorted(bounds, at, side="right") == np.searchsorted(bounds, at + later + half, side="right")
    return np.unique(at[same])


def strips(codes: np.ndarray, bounds: np.ndarray, min_exponent: int = MIN_EXPONENT) -> list[list[dict]]:
    """Strips of tiles to solve of each text; ``codes`` are the words of all texts, equal codes for equal words, with
    one code of its own after each text; ``bounds`` the first word of each text and the end."""
    out: list[list[dict]] = [[] for _ in range(len(bounds) - 1)]
    window = mix64(codes.astype(np.uint64) + np.uint64(1))
    longest = int(np.diff(bounds).max(initial=1)) - 1
    for octave in octaves(longest, min_exponent):
        if octave > 2:  # windows double with the octave
            step = octave // 4
            window = mix64(window[:-step] * np.uint64(0x9E3779B97F4A7C15) + window[step:]) if len(window) > step else window[:0]
        at = boundaries_to_solve(codes, bounds, octave, window)
        if not len(at):
            continue
        of = np.searchsorted(bounds, at, side="right") - 1
        limit = max(STRIP_WORDS, 8 * octave)
        first = 0
        for i in range(1, len(at) + 1):
            if i < len(at) and of[i] == of[first] and at[i] - at[i - 1] <= 5 * octave and at[i] - at[first] <= limit:
                continue
            lo = max(int(bounds[of[first]]), int(at[first]) - 2 * octave)
            hi = min(int(bounds[of[first] + 1]) - 1, int(at[i - 1]) + 3 * octave)
            names, words = np.unique(codes[lo:hi], return_inverse=True)
            words = words.astype(np.uint16 if len(names) <= 1 << 16 else np.int32)
            out[of[first]].append({"octave": octave, "base": lo - int(bounds[of[first]]), "size": words.itemsize,
                                   "boundaries": (at[first:i] - lo).tolist(), "codes": words.tobytes()})
            first = i
    return out


def strip_words(codes: bytes, size: int) -> list[int]:
    return np.frombuffer(codes, dtype=np.uint16 if size == 2 else np.int32).tolist()


def z_function(s: list[int], upto: int) -> list[int]:
    """z[i]: length of the longest common prefix of ``s`` and ``s[i:]``, for 0 < i < upto (z[0] = 0)."""
    n = len(s)
    upto = min(upto, n)
    z = [0] * upto
    left = right = 0
    for i in range(1, upto):
        k = min(right - i, z[i - left]) if i < right else 0
        if i + k >= right:
            while i + k < n and s[k] == s[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def solve_tile(s: list[int], b: int, octave: int) -> list[tuple[int, int, int]]:
    """(period, start, end) of the stretches of the tile of boundary ``b`` that hold b and the word a period later,
    at least twice as long as their smallest period, which is in the octave."""
    lo, hi = max(0, b - 2 * octave), min(len(s), b + 3 * octave)
    right = z_function(s[b:hi], octave)
    back = s[lo:b][::-1]
    top = min(b + octave, hi)
    # the words before b backwards, a mark, then the words before b + Q backwards
    turned = z_function(back + [-1] + s[lo:top][::-1], len(back) + 1 + top - b)
    found, seen = [], set()
    for q in range(1, min(octave, hi - b)):
        reach = b + q
        to_left = turned[len(back) + 1 + top - reach] if reach <= top else 0
        if to_left + right[q] >= q:
            stretch = (b - to_left, reach + right[q])
            if stretch not in seen:
                seen.add(stretch)
                if 2 * q >= octave:
                    found.append((q, *stretch))
    return found


def stitched(fragments: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Fragments of one document joined where two of a period share at least that many words."""
    out: list[list[int]] = []
    for q, start, end in sorted(fragments):
        if out and out[-1][0] == q and start <= out[-1][2] - q:
            out[-1][2] = max(out[-1][2], end)
        else:
            out.append([q, start, end])
    return [tuple(x) for x in out]


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keys, ids, texts = batch["key"].tolist(), batch["id"].tolist(), batch["text"].tolist()
        at = 0
        while at < len(keys):
            first, total, parts = at, 0, []
            while at < len(keys) and (total < BATCH_WORDS or at == first):
                words = texts[at].encode("utf-8", "surrogatepass").split() if texts[at] else []
                parts.append(words)
                total += len(words)
                at += 1
            number: dict[bytes, int] = {}
            codes = np.empty(total + len(parts), dtype=np.int64)
            bounds = np.concatenate([[0], np.cumsum([len(w) + 1 for w in parts])])
            for i, words in enumerate(parts):
                codes[bounds[i]:bounds[i + 1] - 1] = [number.setdefault(w, len(number)) for w in words]
                codes[bounds[i + 1] - 1] = -1
            codes[bounds[1:] - 1] = len(number) + np.arange(len(parts))
            yield pd.DataFrame({
                "key": keys[first:at], "id": ids[first:at], "n_words": [len(w) for w in parts],
                "plain_sha256": [hashlib.sha256(b" ".join(w)).hexdigest() for w in parts],
                "strips": strips(codes, bounds)})


def _solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for key, octave, base, boundaries, codes, size in batch.itertuples(index=False):
            s = strip_words(codes, size)
            fragments = [f for b in boundaries for f in solve_tile(s, int(b), octave)]
            out += [(key, q, base + start, base + end) for q, start, end in stitched(fragments)]
        yield pd.DataFrame(out, columns=["key", "period", "start", "end"])


def packed_udf():
    """Pandas UDF: compressed UTF-8 of a text."""

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        return pd.Series([zlib.compress((t or "").encode("utf-8", "surrogatepass"), 1) for t in texts])

    return packed


def collapsed_udf():
    """Pandas UDF: (number of words, digest of the words without those that any run contains after its first period)."""

    @F.pandas_udf("n_words long, sha256 string")
    def collapsed(texts: pd.Series, starts: pd.Series, lengths: pd.Series, periods: pd.Series) -> pd.DataFrame:
        sizes, digests = [], []
        for text, start, length, period in zip(texts, starts, lengths, periods):
            parts = zlib.decompress(text).split()
            edge = np.zeros(len(parts) + 1, dtype=np.int64)
            np.add.at(edge, np.asarray(start) + np.asarray(period), 1)
            np.add.at(edge, np.asarray(start) + np.asarray(length), -1)
            kept = np.cumsum(edge)[:-1] == 0
            sizes.append(len(parts))
            digests.append(hashlib.sha256(b" ".join(w for w, k in zip(parts, kept) if k)).hexdigest())
        return pd.DataFrame({"n_words": sizes, "sha256": digests})

    return collapsed


def find_runs(scanned: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """(key, start, length, period) of every run of the scanned texts."""
    tiles = scanned.select("key", F.explode("strips").alias("s")).select("key", "s.octave", "s.base", "s.boundaries", "s.codes", "s.size")
    # solving is the costly part: strips go evenly to as many tasks as a shuffle has, copies of a text as well
    tasks = int(scanned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fragments = tiles.repartition(tasks).mapInPandas(_solve, "key string, period long, start long, end long").distinct()
    order = Window.partitionBy("key", "period").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") > reached - F.col("period"), F.lit(True)).cast("int")
    numbered = fragments.withColumn("opens", opens).withColumn("piece", F.sum("opens").over(order))
    whole = numbered.groupBy("key", "period", "piece").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    long_enough = whole.withColumn("length", F.col("end") - F.col("start")).where(
        (F.col("length") >= min_length) & (F.col("length") >= min_exponent * F.col("period")))
    return long_enough.groupBy("key", "start", "length").agg(F.min("period").alias("period"))


def periodic_runs(docs: DataFrame, ident: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """One row per document: ident, n_words, runs (array of start, length, period, in order), collapsed_sha256 of the words
    joined by one space if each run keeps one period only."""
    if min_exponent < MIN_EXPONENT:
        raise ValueError(f"tiles find runs of at least {MIN_EXPONENT} periods")
    kind = docs.schema[ident].dataType
    body = F.col(text)
    key = F.concat_ws("/", F.xxhash64(body).cast("string"), F.xxhash64(F.lit(1), body).cast("string"))
    source = docs.select(key.alias("key"), F.col(ident).cast("string").alias("id"), body.alias("text"))
    with arrow_rows(docs.sparkSession, ARROW_ROWS):
        scanned = cut_lineage(source.mapInPandas(_scan, SCANNED))
        runs = cut_lineage(find_runs(scanned, min_length, min_exponent).groupBy("key").agg(
            F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs")))
        texts = source.select("key", "id", packed_udf()("text").alias("text"))
        periodic = join_hot(texts, runs, "key", keys=scanned.where(F.size("strips") > 0).select("key"))
        kept = cut_lineage(periodic.select("id", "runs", collapsed_udf()(
            "text", F.col("runs.start"), F.col("runs.length"), F.col("runs.period")).alias("c")))
    none = F.array().cast("array<struct<start:bigint,length:bigint,period:bigint>>")
    plain = scanned.join(runs.select("key"), "key", "left_anti").select(
        "id", "n_words", none.alias("runs"), F.col("plain_sha256").alias("collapsed_sha256"))
    out = kept.select("id", "c.n_words", "runs", F.col("c.sha256").alias("collapsed_sha256")).unionByName(plain)
    return out.select(F.col("id").cast(kind).alias(ident), "n_words", "runs", "collapsed_sha256")


def strongest(runs: Column) -> Column:
    """The run of greatest length / period (ties: smallest start, then period).  The quotient of two numbers whose
    product is below 2^52 is another double for another fraction, so no ties arise by rounding."""
    return F.array_min(F.transform(runs, lambda r: F.struct(
        (-(r["length"] / r["period"])).alias("less"), r["start"].alias("start"), r["period"].alias("period"),
        r["length"].alias("length"))))
