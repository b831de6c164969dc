"""Byte-level BPE of many texts at once, from a public vocabulary file.

The split pattern of these vocabularies always ends a piece in front of a blank that is followed by
an ASCII graph character, so a text can be cut there. The distinct cut-outs of a few MB, told apart
by a 64-bit hash and their length, are encoded by one call, and numpy puts their ids in place.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np

from gridcast.llm.textscan import CHUNK, distinct, hash_spans

#: The vocabulary file, its end-of-text id, and the split pattern that belongs to it.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END_OF_TEXT = 50256
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

GROUP = 8 << 20  # bytes of text whose cut-outs are encoded together


class Encoder:
    """Encodes lists of UTF-8 texts; built in each worker from the broadcast bytes of a vocabulary."""

    def __init__(self, vocabulary: bytes, dtype: str):
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
        self.bpe = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.dtype = np.dtype(dtype)
        if max(ranks.values()) >= 1 << (8 * self.dtype.itemsize):
            raise ValueError(f"the ids do not fit {dtype}")
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.sizes[list(ranks.values())] = list(map(len, ranks))

    def _ids(self, raw: bytes) -> np.ndarray:
        return np.array(self.bpe.encode_ordinary(raw.decode("utf-8", "replace")), np.int64)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text."""
        ids, counts, at = [], [], 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= GROUP):
                size += len(texts[stop])
                stop += 1
            x, n = self._some(texts[at:stop])
            ids.append(x)
            counts.append(n)
            at = stop
        if not ids:
            return np.empty(0, self.dtype), np.empty(0, np.int64)
        return np.concatenate(ids), np.concatenate(counts)

    def _some(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(texts) == 1 and len(texts[0]) > 2 * GROUP:  # one very long text, in parts that end at a cut
            text, parts, at = texts[0], [], 0
            while at < len(text):
                stop = _cut_after(text, at + GROUP)
                parts.append(self._some([text[at:stop]])[0])
                at = stop
            return np.concatenate(parts), np.array([sum(map(len, parts))])
        raw = b"\n".join(texts)
        b = np.frombuffer(raw, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        first = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        cuts = np.flatnonzero((b[:-1] == 32) & (b[1:] > 32) & (b[1:] < 127)) if len(b) > 1 else np.empty(0, np.int64)
        starts = distinct(np.concatenate((first[sizes > 0], cuts)))
        if not len(starts):
            return np.empty(0, self.dtype), np.zeros(len(texts), np.int64)
        owner = np.searchsorted(first, starts, side="right") - 1
        ends = np.minimum(np.append(starts[1:], len(b)), (first + sizes)[owner])
        at_cut = np.zeros(len(b), bool)
        at_cut[cuts] = True
        at_cut = at_cut[starts]
        _, where, which = np.unique(_names(b, starts, ends), return_index=True, return_inverse=True)
        flat, lengths = self._units(raw, b, starts[where], ends[where], at_cut[where])
        begins = np.cumsum(lengths) - lengths
        n = lengths[which]
        shift = begins[which] - (np.cumsum(n) - n)
        ids = flat[np.repeat(shift, n) + np.arange(int(n.sum()))]
        return ids, np.bincount(owner, weights=n, minlength=len(texts)).astype(np.int64)

    def _units(self, raw: bytes, b: np.ndarray, starts: np.ndarray, ends: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the given cut-outs and how many each has. Those that begin at a cut can be
        encoded side by side, since the ids' lengths tell where each ends; the others stand alone."""
        size = (ends - starts)[cut]
        stop = np.cumsum(size)
        joined = b[np.repeat(starts[cut] - (stop - size), size) + np.arange(int(size.sum()))].tobytes()
        together = self._ids(joined)
        last = np.searchsorted(np.cumsum(self.sizes[together]), stop) + 1 if len(stop) else stop
        lengths = np.zeros(len(starts), np.int64)
        lengths[cut] = np.diff(last, prepend=0)
        alone = [self._ids(raw[s:e]) for s, e in zip(starts[~cut].tolist(), ends[~cut].tolist())]
        lengths[~cut] = list(map(len, alone))
        out = np.empty(int(lengths.sum()), self.dtype)
        mine = np.repeat(cut, lengths)
        out[mine] = together
        if alone:
            out[~mine] = np.concatenate(alone)
        return out, lengths


def _names(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of cut-outs, a few MB at a time."""
    out, i = [], 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + CHUNK)))
        lo, hi = starts[i], ends[j - 1]
        if hi - lo > 4 * CHUNK:  # ends with a very long one
            j = max(i + 1, j - 1)
            hi = ends[j - 1]
        if hi - lo > 4 * CHUNK:
            name = int.from_bytes(hashlib.blake2b(b[lo:hi].tobytes(), digest_size=8).digest(), "little")
            out.append(np.array([name], np.uint64))
        else:
            out.append(hash_spans(b[lo:hi], starts[i:j] - lo, ends[i:j] - lo, lower=False))
        i = j
    return np.concatenate(out)


def _cut_after(text: bytes, at: int) -> int:
    """The first cut at or after ``at``, or the end."""
    while True:
        at = text.find(b" ", at)
        if at < 0 or at + 1 >= len(text):
            return len(text)
        if 32 < text[at + 1] < 127:
            return at
        at += 1


@lru_cache(maxsize=2)
def encoder(vocabulary: bytes, dtype: str) -> Encoder:
    return Encoder(vocabulary, dtype)


def read_vocabulary(path: str = VOCABULARY, limit: int = 64 << 20) -> bytes:
    """The file's bytes, which tasks get as a broadcast; refuses files over ``limit``."""
    with open(path, "rb") as f:
        data = f.read(limit + 1)
    if len(data) > limit:
        raise ValueError(f"{path} is larger than {limit} bytes")
    return data
