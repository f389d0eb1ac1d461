"""Near-duplicates by HyperMinHash.

A text's set is its distinct word k-shingles.  Shingle hashes are split over
``BUCKETS`` buckets by their first bits; a bucket keeps the smallest remainder as a register:
the count of its leading zeros and ``MANTISSA_BITS`` bits after them.  Buckets that
a short text leaves empty borrow from another bucket in a fixed order.  Bands of
``ROWS`` registers are hashed; texts that share a band are candidates, and every link
is confirmed on the full sets.

Steps, all Spark jobs between written tables:
1. one pass over the texts: set size, 128-bit set digest, band keys;
2. texts with equal sets become one node (copies are never expanded into pairs);
3. nodes that share a band key are grouped: a node's home is the smallest node that
   the smallest nodes it meets have met, and homes are dealt into blocks of about ``BLOCK_SHINGLES`` shingles;
4. pairs of blocks that share a band key are tiles.  A first round takes each block against itself and
   its home's first block, which costs in proportion to the group and links most of a
   large group of copies.  The second round takes the remaining tiles, with blocks formed
   anew within the linked classes, and pairs blocks across classes only;
5. a tile compares its candidates on full sets, after a collision-corrected
   Jaccard estimate from the registers has ruled out far pairs, and returns a spanning forest of the
   links it confirms (at most one link per node);
6. connected components give each node its class, and each document its smallest id.

With 64 bands of 8 registers a pair at similarity 0.8 is missed with probability 8e-6, at 0.85 with 1e-9.

Defined results: null or empty texts and texts without words have n_shingles 0, link
with nothing and stay; fewer words than k make one shingle; a document without an id takes
part in linking, its class's id is the smallest id there is (null if none); rows that repeat an
id are one document and share its fate; an empty table gives no rows; further columns are not read
(``drop_near_duplicates`` keeps them).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import arrow_rows, free_name, join_hot
from recflow.llm.graph import components
from recflow.llm.kernels import batches, hash_words, mix64, shingle_hashes, word_offsets
from recflow.session import cut_lineage

WORDS = 5
SIMILARITY_PERCENT = 80
BANDS, ROWS = 64, 8
BUCKETS = BANDS * ROWS
_BUCKET_BITS = 9
MANTISSA_BITS = 10
BLOCK_SHINGLES = 40_000
#: about as many texts are in a block of short ones
BLOCK_NODES = 400
#: rows per batch sent to Python: a batch holds whole texts or sets
ARROW_ROWS = 1_000
_STRIDES = np.random.default_rng(11).integers(0, BUCKETS // 2, BUCKETS) * 2 + 1
#: pairs are compared in full unless the estimate is this many standard errors under the threshold
SAFETY = 6.0


def text_sets(texts: list[str | None], k: int):
    """(text numbers, sorted distinct shingle hashes of all texts, first hash of each text and the end),
    for runs of texts that have words."""
    for first, last, buf, offsets in batches(texts):
        words, starts, _ = hash_words(buf)
        bounds = word_offsets(starts, offsets)
        which = [i for i in range(last - first) if bounds[i + 1] > bounds[i]]
        sets = [np.unique(shingle_hashes(words[bounds[i]:bounds[i + 1]], k)) for i in which]
        if sets:
            yield first + np.array(which), np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])


def registers(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """[texts, BUCKETS] registers of sorted hash sets; every text has at least one hash."""
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    bucket = (hashes >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
    first = np.ones(len(hashes), dtype=bool)
    first[1:] = (owner[1:] != owner[:-1]) | (bucket[1:] != bucket[:-1])
    rest = (hashes[first] & np.uint64((1 << (64 - _BUCKET_BITS)) - 1)) >> np.uint64(2)  # 53 bits
    fraction, exponent = np.frexp(rest.astype(np.float64) + 1)
    mantissa = ((fraction * 2 - 1) * (1 << MANTISSA_BITS)).astype(np.int64)
    own = np.full((n, BUCKETS), -1, dtype=np.int32)
    own[owner[first], bucket[first]] = (54 - exponent) << MANTISSA_BITS | mantissa
    full = own.copy()
    row, col = np.nonzero(own < 0)
    step = 1
    while len(row):
        got = own[row, (col + step * _STRIDES[col]) % BUCKETS]
        full[row, col] = got
        open_ = got < 0
        row, col, step = row[open_], col[open_], step + 1
    return full


def band_keys(regs: np.ndarray) -> np.ndarray:
    """[texts, BANDS] hashes of the bands."""
    parts = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for j in range(ROWS):
        key = mix64(key * np.uint64(0x9FB21C651E98DF25) + parts[:, :, j])
    return key


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of one register row against many: the share of equal registers, less
    the share expected equal by chance (equal zeros and equal mantissa bits)."""
    chance = 2.0 ** -MANTISSA_BITS / 3  # sum over zero counts z of 4^-z, times 2^-mantissa bits
    return np.maximum(((b == a).mean(axis=1) - chance) / (1 - chance), 0)


def sketch_udf(k: int):
    """Pandas UDF: text -> struct(n, d1, d2, keys)."""

    @F.pandas_udf("n long, d1 long, d2 long, keys array<long>")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        total = len(texts)
        n, d1, d2 = np.zeros(total, np.int64), np.zeros(total, np.int64), np.zeros(total, np.int64)
        keys: list = [None] * total
        for which, hashes, bounds in text_sets(list(texts), k):
            n[which] = np.diff(bounds)
            d1[which] = np.add.reduceat(mix64(hashes ^ np.uint64(0x51ED270B)), bounds[:-1]).view(np.int64)
            d2[which] = np.add.reduceat(mix64(hashes ^ np.uint64(0xC2B2AE3D27D4EB4F)), bounds[:-1]).view(np.int64)
            for i, row in zip(which, band_keys(registers(hashes, bounds)).view(np.int64)):
                keys[i] = row
        return pd.DataFrame({"n": n, "d1": d1, "d2": d2, "keys": pd.Series(keys, dtype=object)})

    return sketch


def set_udf(k: int):
    """Pandas UDF: text -> sorted shingle hashes."""

    @F.pandas_udf("array<long>")
    def full_set(texts: pd.Series) -> pd.Series:
        out: list = [np.zeros(0, np.int64)] * len(texts)
        for which, hashes, bounds in text_sets(list(texts), k):
            for i, a, b in zip(which, bounds[:-1], bounds[1:]):
                out[i] = hashes[a:b].view(np.int64)
        return pd.Series(out, dtype=object)

    return full_set


def confirm(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between ``left`` and ``right`` (positions in ``sets``): pairs with
    100 * intersection >= percent * union.  Pairs that are already connected are not compared."""
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sizes = np.array([len(s) for s in sets])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    regs = registers(np.concatenate(sets), bounds)
    ratio = percent / 100
    floor = ratio - SAFETY * np.sqrt(ratio * (1 - ratio) / np.minimum(BUCKETS, sizes))
    links, within = [], left is right
    for p, i in enumerate(left):
        rest = right[p + 1:] if within else right
        if len(rest) == 0:
            continue
        small, large = np.minimum(sizes[rest], sizes[i]), np.maximum(sizes[rest], sizes[i])
        rest = rest[100 * small >= percent * large]
        if len(rest):
            rest = rest[estimate(regs[i], regs[rest]) >= np.minimum(floor[rest], floor[i])]
        for j in rest:
            a, b = root(int(i)), root(int(j))
            if a == b:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                parent[max(a, b)] = min(a, b)
                links.append((int(i), int(j)))
    return links


def _verify(sets: DataFrame, tiles: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of all tiles; ``sets``: (block, node, shingles), ``tiles``: (left, right)."""
    sides = tiles.withColumn("side", F.explode(F.array_distinct(F.array("left", "right"))))
    members = sides.join(sets, F.col("side") == F.col("block")).select("left", "right", "block", "node", "shingles")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["block", "node"]).sort_values(["block", "node"])
        sets = [np.asarray(s, dtype=np.int64).view(np.uint64) for s in rows["shingles"]]
        nodes, block = rows["node"].to_numpy(), rows["block"].to_numpy()
        lo, hi = np.flatnonzero(block == rows["left"].iloc[0]), np.flatnonzero(block == rows["right"].iloc[0])
        same = rows["left"].iloc[0] == rows["right"].iloc[0]
        links = confirm(sets, lo, lo if same else hi, percent)
        return pd.DataFrame([(nodes[i], nodes[j]) for i, j in links], columns=["a", "b"]).astype("int64")

    return members.groupBy("left", "right").applyInPandas(compare, "a long, b long")


def _dealt(nodes: DataFrame, group: str) -> DataFrame:
    """(node, group, block): each group's nodes (written) dealt into blocks of about BLOCK_SHINGLES shingles, in which
    a node counts for at least BLOCK_SHINGLES / BLOCK_NODES of them."""
    weight = F.greatest(F.col("n"), F.lit(BLOCK_SHINGLES // BLOCK_NODES))
    sizes = nodes.groupBy(group).agg(F.ceil(F.sum(weight) / BLOCK_SHINGLES).alias("blocks"))
    dealt = join_hot(nodes, sizes, group).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("blocks")))
    return dealt.withColumn("block", F.concat_ws("/", F.col(group).cast("string"), F.col("chunk").cast("string")))


def _open_tiles(seen: DataFrame) -> DataFrame:
    """Tiles (left, right) of blocks that share a band key and are not inside one class; ``seen`` (written): (key, block,
    lo, hi) with the smallest and largest class that a block has under a key.

    Under a key the blocks of its most frequent class (its host) meet the other blocks only, never each other, so a
    group that the first round has linked costs its blocks and not their pairs."""
    several = seen.groupBy("key").agg(F.min("lo").alias("low"), F.max("hi").alias("high")).where("low < high").select("key")
    seen = cut_lineage(seen.join(several, "key", "left_semi"))
    hosts = seen.where("lo = hi").groupBy("key", F.col("lo").alias("host")).count().groupBy("key").agg(
        F.max_by("host", F.struct("count", "host")).alias("host"))
    rows = seen.join(hosts, "key", "left").withColumn("guest", F.coalesce(
        (F.col("lo") < F.col("hi")) | (F.col("lo") != F.col("host")), F.lit(True)))
    pairs = rows.where("guest").alias("x").join(rows.alias("y"), (F.col("x.key") == F.col("y.key")) & (
        ~F.col("y.guest") | (F.col("x.block") <= F.col("y.block"))) & (F.least("x.lo", "y.lo") < F.greatest("x.hi", "y.hi")))
    return pairs.select(F.least("x.block", "y.block").alias("left"), F.greatest("x.block", "y.block").alias("right")).distinct()


def _linked(src: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with their set's size and digest, nodes, classes of the linked nodes) of (id, text), all written."""
    sketched = cut_lineage(src.select("id", F.xxhash64("text").alias("hash"), sketch_udf(k)("text").alias("s"))
                           .select("id", "hash", "s.*"))
    # the row whose text stands for the set: the smallest id
    row = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("hash").alias("hash"))
    nodes = cut_lineage(
        sketched.where("n > 0").groupBy("d1", "d2").agg(F.min(row).alias("first"), F.first("n").alias("n"),
                                                        F.first("keys").alias("keys"))
        .withColumn("node", F.monotonically_increasing_id()))

    bands = nodes.select("node", "n", F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most")
    met = cut_lineage(bands.join(shared, "key").select("key", "node", "n", "least"))
    nearest = cut_lineage(met.groupBy("node").agg(F.min("least").alias("home"), F.first("n").alias("n")))
    # one step further: the smallest home of the nodes met, so small groups that touch share blocks
    further = met.join(nearest.select(F.col("node").alias("least"), F.col("home").alias("beyond")), "least")
    homes = cut_lineage(further.groupBy("node").agg(F.min("beyond").alias("home"), F.first("n").alias("n")))

    # round 1: every block with itself and with its home's first block
    blocks = cut_lineage(_dealt(homes, "home").select("node", "n", "home", "block"))
    wanted = homes.select("node").join(nodes.select("node", "first"), "node").select("node", "first.id", "first.hash").alias("w")
    full = src.withColumn("hash", F.xxhash64("text")).alias("s").join(
        wanted, F.col("s.id").eqNullSafe(F.col("w.id")) & (F.col("s.hash") == F.col("w.hash")))
    sets = cut_lineage(full.select("node", set_udf(k)("text").alias("shingles")))
    first = F.concat_ws("/", F.col("home").cast("string"), F.lit("0"))
    tiles = blocks.select(F.col("block").alias("right"), F.explode(F.array_distinct(
        F.array(F.col("block"), first))).alias("left")).distinct()
    links = cut_lineage(_verify(sets.join(blocks.select("node", "block"), "node"), tiles, percent))
    classes = components(links)

    # round 2: tiles with a shared band key that are not inside one class
    again = cut_lineage(blocks.select("node", "n", "home").join(classes, "node", "left").withColumn(
        "class", F.coalesce("component", "node")))
    big = again.groupBy("class").agg(F.sum("n").alias("size")).where(F.col("size") >= BLOCK_SHINGLES).select("class")
    grouped = cut_lineage(join_hot(again, big.withColumn("big", F.lit(True)), "class", how="left").withColumn(
        "group", F.when(F.col("big"), F.col("class")).otherwise(-1 - F.col("home"))))
    placed = cut_lineage(_dealt(grouped, "group").select("node", "class", "block"))
    seen = met.select("key", "node").join(placed, "node").groupBy("key", "block").agg(
        F.min("class").alias("lo"), F.max("class").alias("hi"))
    open_ = _open_tiles(cut_lineage(seen))
    more = cut_lineage(_verify(sets.join(placed.select("node", "block"), "node"), open_, percent))
    labels = components(links.unionByName(more))
    return sketched, nodes, labels


def near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = SIMILARITY_PERCENT, ident: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document: ident, n_shingles, component_id, kept."""
    with arrow_rows(docs.sparkSession, ARROW_ROWS):
        sketched, nodes, labels = _linked(docs.select(F.col(ident).alias("id"), F.col(text).alias("text")), k, percent)
    named = cut_lineage(nodes.select("node", "d1", "d2", "first.id").join(labels, "node", "left").select(
        "d1", "d2", "id", F.coalesce("component", "node").alias("class")))
    smallest = named.groupBy("class").agg(F.min("id").alias("component_id"))
    of_set = cut_lineage(join_hot(named, smallest, "class").select("d1", "d2", "component_id"))
    out = sketched.select("id", "n", "d1", "d2").where("n > 0").join(of_set, ["d1", "d2"]).select("id", "n", "component_id")
    alone = sketched.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return out.unionByName(alone).select(
        F.col("id").alias(ident), F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = SIMILARITY_PERCENT, ident: str = "doc_id",
                         text: str = "text") -> DataFrame:
    """The documents that represent their class, all columns unchanged.  Documents
    without an id are kept: no other document can stand for them by name."""
    name = free_name(docs, "gone")
    gone = near_duplicates(docs, k, percent, ident, text).where(
        ~F.col("kept") & F.col(ident).isNotNull()).select(F.col(ident).alias(name)).distinct()
    return docs.join(gone, F.col(ident) == F.col(name), "left_anti")
