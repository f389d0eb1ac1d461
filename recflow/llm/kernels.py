"""NumPy kernels on UTF-8 bytes, shared by the Python-side operators.

A batch of texts is laid out as one byte buffer; words are found with a
256-entry separator table and hashed with a polynomial prefix sum modulo 2^64,
so no Python loop runs over words.  Long texts are cut into segments at word
boundaries: memory follows ``SEGMENT_BYTES``, not the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SEGMENT_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

#: bytes between words: space and \t \n \v \f \r
WHITESPACE = np.zeros(256, dtype=bool)
WHITESPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: bytes that are neither ASCII letters, ASCII digits nor part of a non-ASCII character
NOT_WORD = np.ones(256, dtype=bool)
NOT_WORD[0x30:0x3A] = False
NOT_WORD[0x41:0x5B] = False
NOT_WORD[0x61:0x7B] = False
NOT_WORD[0x80:] = False


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i < n, grown on demand."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, SEGMENT_BYTES + 4096)
        up = np.full(size, _BASE, dtype=np.uint64)
        down = np.full(size, _BASE_INV, dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS["up"], _POWERS["down"] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _segments(buf: bytes, separators: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about SEGMENT_BYTES that end at a separator (or at the end)."""
    n, at = len(buf), 0
    while at < n:
        end = min(n, at + SEGMENT_BYTES)
        while end < n and not separators[buf[end]]:
            end += 1
        yield at, end
        at = end


def hash_words(buf: bytes, separators: np.ndarray = WHITESPACE,
               prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """(hash, byte start, byte end) of every word of the buffer, in order; with
    ``prefixes`` also a matrix of the hashes of that many first bytes (0: word is not longer)."""
    hashes, starts, ends, heads = [], [], [], []
    for at, to in _segments(buf, separators):
        arr = np.frombuffer(buf, dtype=np.uint8, count=to - at, offset=at)
        inside = np.zeros(len(arr) + 2, dtype=np.int8)
        inside[1:-1] = ~separators[arr]
        edge = np.diff(inside)
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(s) == 0:
            continue
        up, down = _powers(len(arr))
        total = np.zeros(len(arr) + 1, dtype=np.uint64)
        np.cumsum((arr.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64, out=total[1:])
        h = (total[e] - total[s]) * down[s]
        hashes.append(mix64(h + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        starts.append(s + at)
        ends.append(e + at)
        if prefixes:
            cut = np.stack([np.minimum(s + n, e) for n in prefixes])
            longer = np.stack([e - s > n for n in prefixes])
            lengths = np.array(prefixes, dtype=np.uint64)[:, None]
            heads.append(mix64((total[cut] - total[s]) * down[s] + lengths * np.uint64(0xA24BAED4963EE407)) * longer)
    if not hashes:
        none = np.zeros(0, dtype=np.int64)
        out = (none.astype(np.uint64), none, none)
        return (*out, np.zeros((len(prefixes), 0), dtype=np.uint64)) if prefixes else out
    out = (np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends))
    return (*out, np.concatenate(heads, axis=1)) if prefixes else out


def lower_ascii(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z lower-cased and nothing else changed (null: empty)."""
    return text.encode("utf-8", "surrogatepass").lower() if text else b""


def batches(texts: list[str | None], lower: bool = True,
            limit: int = SEGMENT_BYTES) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first, last + 1, buffer, byte offset of each text and the end) for runs
    of texts of about ``limit`` bytes; texts are followed by one newline."""
    first, parts, sizes = 0, [], []
    total = 0
    for i, t in enumerate(texts):
        b = lower_ascii(t) if lower else (t.encode("utf-8", "surrogatepass") if t else b"")
        parts.append(b)
        sizes.append(len(b) + 1)
        total += len(b) + 1
        if total >= limit or i == len(texts) - 1:
            yield first, i + 1, b"\n".join(parts) + b"\n", np.concatenate([[0], np.cumsum(sizes)])
            first, parts, sizes, total = i + 1, [], [], 0


def word_offsets(starts: np.ndarray, text_offsets: np.ndarray) -> np.ndarray:
    """Index of the first word of every text, and the number of words."""
    return np.searchsorted(starts, text_offsets)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive words (fewer words: the whole run)."""
    n = len(words)
    if n == 0:
        return words
    if n < k:
        acc = np.uint64(n)
        for w in words:
            acc = mix64(np.array([acc ^ w], dtype=np.uint64))[0]
        return np.array([acc], dtype=np.uint64)
    acc = np.zeros(n - k + 1, dtype=np.uint64)
    for j in range(k):
        acc = acc * np.uint64(0x9FB21C651E98DF25) + words[j:n - k + 1 + j]
    return mix64(acc)
