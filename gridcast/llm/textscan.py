"""Vectorised word scanning over UTF-8 bytes, shared by the text operators.

Texts are joined into buffers of half a MB with a separator byte, so the cost per text is small and
memory stays bounded however long a text is. All word classes used here are unions of ASCII bytes
and "everything above 0x7F", so working on bytes gives the same words as working on characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK = 1 << 21          # bytes of one text handled at once
PIECE = 1 << 19          # bytes of texts laid side by side: their arrays take many times as much
SEPARATOR = b"\n"        # outside every word class below
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


def word_table(non_words: str) -> np.ndarray:
    """A 256-entry table that is true for bytes of words; ``non_words`` lists the ASCII bytes that are not."""
    table = np.ones(256, dtype=bool)
    table[np.frombuffer(non_words.encode("latin-1"), np.uint8)] = False
    return table


#: Letters, digits and all bytes above 0x7F (texts are lower-cased first, so A-Z never separate words).
ALNUM = word_table("".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])))
#: Everything but the six ASCII white-space bytes.
SPACED = word_table(" \t\n\x0b\x0c\r")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@lru_cache(maxsize=4)
def _byte_values(lower: bool) -> np.ndarray:
    values = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
    return values[_LOWER] if lower else values


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        p = np.empty(n, U64)
        p[0] = 1
        done = 1
        while done < n:
            take = min(done, n - done)
            p[done:done + take] = p[:take] * U64(pow(base, done, 1 << 64))
            done += take
        out.append(p)
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def lower_ascii(b: np.ndarray) -> np.ndarray:
    return _LOWER[b]


def spans_of(b: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the maximal runs of word bytes."""
    inside = np.empty(len(b) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = table[b]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def hash_spans(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of the bytes of every span, from one running sum over the buffer."""
    if not len(starts):
        return np.empty(0, U64)
    power, inverse = _powers(1 << max(16, int(len(b)).bit_length()))
    total = np.empty(len(b) + 1, U64)
    total[0] = 0
    np.cumsum(_byte_values(lower)[b] * power[:len(b)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U64))


def distinct(a: np.ndarray) -> np.ndarray:
    """The sorted distinct values; by sorting, which is faster here than numpy's hash table."""
    a = np.sort(a)
    return a[np.concatenate(([True], a[1:] != a[:-1]))] if len(a) else a


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of ``k`` consecutive word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    out = np.zeros(n, U64)
    for j in range(k):
        out = out * U64(0xD6E8FEB86659FD93) + words[j:j + n]
    return mix(out + U64(k))


class Chunk:
    """Some whole texts side by side: their bytes, and the words' offsets, hashes and text numbers."""

    def __init__(self, texts: list[bytes], first: int, table: np.ndarray):
        joined = SEPARATOR.join(texts)
        self.first, self.count = first, len(texts)
        self.bytes = np.frombuffer(joined, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        self.raw = joined
        self.starts, self.ends, self.words = words_of(self.bytes, table)
        self.text_of = np.searchsorted(self.text_starts, self.starts, side="right") - 1
        #: words of text i are words[bounds[i]:bounds[i + 1]]
        self.bounds = np.searchsorted(self.text_of, np.arange(len(texts) + 1))

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of k-word runs that stay within one text, and the positions of their first words."""
        g = grams(self.words, k)
        inside = np.flatnonzero(self.text_of[:len(g)] == self.text_of[k - 1:]) if len(g) else np.empty(0, np.int64)
        return g[inside], inside


def words_of(b: np.ndarray, table: np.ndarray, piece: int = CHUNK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word offsets and hashes of a buffer of any length, in pieces that end between words."""
    if len(b) <= 2 * piece:
        s, e = spans_of(b, table)
        return s, e, hash_spans(b, s, e)
    parts, at = [], 0
    while at < len(b):
        stop = min(len(b), at + piece)
        while stop < len(b):  # move to the next byte that is in no word
            gap = np.flatnonzero(~table[b[stop:stop + 65536]])
            if len(gap):
                stop += int(gap[0])
                break
            stop = min(len(b), stop + 65536)
        s, e = spans_of(b[at:stop], table)
        parts.append((s + at, e + at, hash_spans(b[at:stop], s, e) if stop - at <= 8 * CHUNK else _long_words(b[at:stop], s, e)))
        at = stop
    return tuple(np.concatenate(x) for x in zip(*parts))


def _long_words(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes where one word is many MB long: word by word, a long one by its digest."""
    out = [hash_spans(b[s:e], np.array([0]), np.array([e - s])) if e - s <= CHUNK else np.frombuffer(
        hashlib.blake2b(lower_ascii(b[s:e]).tobytes(), digest_size=8).digest(), U64) for s, e in zip(starts, ends)]
    return np.concatenate(out) if out else np.empty(0, U64)


def as_bytes(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as bytes; null becomes empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return [x or b"" for x in column.to_pylist()]


def chunks(texts: list[bytes], table: np.ndarray, size: int = PIECE) -> Iterator[Chunk]:
    """The texts of a batch, half a MB at a time; a text is never cut."""
    at = 0
    while at < len(texts):
        stop, total = at, 0
        while stop < len(texts) and (stop == at or total + len(texts[stop]) <= size):
            total += len(texts[stop]) + 1
            stop += 1
        yield Chunk(texts[at:stop], at, table)
        at = stop
