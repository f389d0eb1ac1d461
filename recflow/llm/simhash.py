"""Near-duplicates by SimHash and meet-in-the-middle ball hashing.

A text's fingerprint has the bits that are set in over half of the XXH64 hashes of its word
shingles, repeats included.  Two fingerprints at Hamming distance r or less have a fingerprint half way
between them, so each emits every variant within half the radius (65 variants for r = 2) and a
shuffle on the variants brings the two together:

1. one pass over the texts writes the fingerprints; equal ones become one row, so copies are
   never expanded into pairs;
2. variants are shuffled.  A variant has at most as many members as its ball has fingerprints (65 for
   r = 2), so no variant is hot;
3. at an even radius any two members of a ball are within the radius of each other, so linking each member to the
   next one keeps a ball connected; at an odd radius, or if every link is wanted, all pairs of a
   ball collide.  Collisions are deduplicated and verified by their differing bits;
4. connected components of the links; each document takes the smallest id of its component.

Defined results: a null or empty text, or one without words, has fingerprint zero and is linked like any
other; fewer words than a shingle make one shingle of the whole sequence; repeated rows and ids give one result row
each; a document without an id takes part and gets its component's smallest id (null if there
is none); an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recflow.llm.common import arrow_rows, join_hot
from recflow.llm.graph import components
from recflow.session import cut_lineage

WORDS = 5
RADIUS = 2
SEED = 42
#: a ball of half the radius has 65 variants at radius 2 and 2,081 at 4
MAX_RADIUS = 4
#: hashes held at once while their bits are counted
SEGMENT_HASHES = 1 << 15
ARROW_ROWS = 1_000


def shingle_hashes(text: str | None, k: int) -> Iterator[list[int]]:
    """XXH64 hashes of the k-word shingles of a text, in lists of at most SEGMENT_HASHES."""
    import xxhash
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    first, last = (starts[:len(words) - k + 1], ends[k - 1:]) if len(words) >= k else (starts[:1], ends[-1:])
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), SEGMENT_HASHES):
        cut = slice(at, at + SEGMENT_HASHES)
        yield [digest(joined[a:b], SEED) for a, b in zip(first[cut].tolist(), last[cut].tolist())]


def fingerprints(texts: list[str | None], k: int) -> np.ndarray:
    """uint64 fingerprint of each text."""
    counts, total = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    held: list[int] = []
    owner: list[int] = []
    begin: list[int] = []

    def flush() -> None:
        if held:
            bits = np.unpackbits(np.array(held, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts[owner] += np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
        for part in (held, owner, begin):
            part.clear()

    for i, text in enumerate(texts):
        for hashes in shingle_hashes(text, k):
            owner.append(i)
            begin.append(len(held))
            held += hashes
            total[i] += len(hashes)
            if len(held) >= SEGMENT_HASHES:
                flush()
    flush()
    return ((2 * counts > total[:, None]) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def fingerprint_udf(k: int):
    """Pandas UDF: text -> fingerprint (signed long of the same 64 bits)."""

    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series(fingerprints(list(texts), k).view(np.int64))

    return fingerprint


def ball(fingerprint: Column, half: int) -> Column:
    """Array of all fingerprints that differ from this one in at most ``half`` bits."""
    masks = [sum(1 << b for b in bits) for n in range(half + 1) for bits in combinations(range(64), n)]
    signed = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in masks])
    return F.transform(signed, lambda m: fingerprint.bitwiseXOR(m))


def links(prints: DataFrame, radius: int = RADIUS, every_pair: bool = False) -> DataFrame:
    """(a, b), a < b, of distinct fingerprints ``prints`` (column ``fp``): pairs within ``radius``.  With
    ``every_pair`` all of them, else enough at an even radius to connect whatever they connect."""
    if not 0 <= radius <= MAX_RADIUS:
        raise ValueError(f"radius must be 0 to {MAX_RADIUS}")
    met = prints.select("fp", F.explode(ball(F.col("fp"), (radius + 1) // 2)).alias("variant"))
    if every_pair or radius % 2:
        collide = met.select("variant", F.col("fp").alias("a")).join(
            met.select("variant", F.col("fp").alias("b")), "variant").where("a < b")
    else:
        before = F.lag("fp").over(Window.partitionBy("variant").orderBy("fp"))
        collide = met.select(before.alias("a"), F.col("fp").alias("b")).where("a is not null")
    return collide.select("a", "b").distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(docs: DataFrame, k: int = WORDS, radius: int = RADIUS, ident: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document: ident, fp (signed long), fingerprint (16 hexadecimal digits), component_id."""
    with arrow_rows(docs.sparkSession, ARROW_ROWS):
        printed = cut_lineage(docs.select(F.col(ident).alias("id"), fingerprint_udf(k)(F.col(text)).alias("fp")))
    prints = cut_lineage(printed.groupBy("fp").agg(F.min("id").alias("least")))
    labels = components(cut_lineage(links(prints.select("fp"), radius)))
    classes = cut_lineage(prints.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("class")))
    smallest = classes.groupBy("class").agg(F.min("least").alias("component_id"))
    of_print = cut_lineage(join_hot(classes.select("fp", "class"), smallest, "class").select("fp", "component_id"))
    return join_hot(printed, of_print, "fp").select(
        F.col("id").alias(ident), "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, k: int = WORDS, radius: int = RADIUS, ident: str = "doc_id",
                         text: str = "text") -> DataFrame:
    """The documents with the smallest id of their component, all columns unchanged; documents without
    an id are kept."""
    found = near_duplicates(docs, k, radius, ident, text)
    gone = found.where(F.col(ident) > F.col("component_id")).select(F.col(ident)).distinct()
    return docs.join(gone, ident, "left_anti").select(*docs.columns)
