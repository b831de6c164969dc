"""Benchmark decontamination: word windows of test items, searched in training texts.

The windows of the items form a hash set that every task holds; texts are scanned once, candidate
windows are confirmed word by word, and the covered words are marked. Items are loaded in slices of
bounded size: a benchmark within ``max_chars`` needs one pass and no shuffle, a larger one several
passes over the texts, so what is broadcast never grows with either table.

Defined cases: a null or empty text has no words and no hits; an item without words has no windows;
an item of fewer words than ``width`` is one window; repeated items count once per id; an item
without id marks words and is listed as the empty string; repeated texts are judged alike. An empty
benchmark leaves every text clean. Input columns named like an output column are
replaced by :func:`scan`; :func:`decontaminate` returns all input columns untouched.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.bitmaps import Bitmap, bitmap, where
from gridcast.llm.common import add_columns, fresh, materialize
from gridcast.llm.textscan import ALNUM, U64, Chunk, chunks, grams, hash_spans, spans_of

FIELDS = [("n_words", "bigint"), ("n_hit", "bigint"), ("items", "array<string>"),
          ("spans", "array<struct<start:int,end:int>>"), ("clean_text", "string")]
_BITS = 22
AT_ONCE = 1 << 22  # bytes of text


class Windows:
    """The distinct windows of some items: by length, their hashes and what they must equal."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        self.exact: dict[int, dict[int, list[tuple[tuple[bytes, ...], set[str]]]]] = defaultdict(dict)
        for item, text in items:
            b = np.frombuffer(text.lower(), np.uint8)
            starts, ends = spans_of(b, ALNUM)
            words = [bytes(b[s:e]) for s, e in zip(starts, ends)]
            size = min(width, len(words))
            if size:
                for i, h in enumerate(grams(hash_spans(b, starts, ends), size).tolist()):
                    same = self.exact[size].setdefault(h, [])
                    wanted = tuple(words[i:i + size])
                    for known, ids in same:
                        if known == wanted:
                            ids.add(item)
                            break
                    else:
                        same.append((wanted, {item}))
        self.maybe = {}
        for size, found in self.exact.items():
            self.maybe[size] = Bitmap(_BITS, {})
            self.maybe[size].add(np.fromiter(found, U64, len(found)))

    def search(self, chunk: Chunk) -> tuple[np.ndarray, dict[int, set[str]]]:
        """Which words of the chunk lie in a window, and the items found in each text."""
        edge = np.zeros(len(chunk.words) + 1, np.int64)
        items: dict[int, set[str]] = defaultdict(set)
        for size, found in self.exact.items():
            hashes, at = chunk.runs(size)
            likely = np.flatnonzero(self.maybe[size].has(hashes))
            for h, i in zip(hashes[likely].tolist(), at[likely].tolist()):
                same = found.get(h)
                if same is None:
                    continue
                words = tuple(chunk.raw[s:e].lower() for s, e in zip(
                    chunk.starts[i:i + size].tolist(), chunk.ends[i:i + size].tolist()))
                for wanted, ids in same:
                    if wanted == words:
                        edge[i] += 1
                        edge[i + size] -= 1
                        items[int(chunk.text_of[i])] |= ids
        return np.cumsum(edge[:-1]) > 0, items


def _slices(bench: DataFrame, item_id: str, text: str, max_chars: int):
    """The items as (id, bytes), ``max_chars`` of text at a time."""
    size = bench.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = max(1, -(-size // max_chars))
    rows = bench.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t")).where("t is not null")
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield [(r.i, r.t.encode()) for r in part.toLocalIterator()]


def scan(docs: DataFrame, bench: DataFrame, width: int = 10, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", max_chars: int = 8_000_000, only: list[str] | None = None,
         clean: bool = True, prefix: str = "") -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside any window), ``items`` (sorted ids found),
    ``spans`` (UTF-8 byte ranges of hit runs) and ``clean_text`` (the text without those ranges; null
    where nothing was hit or ``clean`` is off). ``only`` limits the input columns carried over; ``prefix`` is put before the new names."""
    names = {prefix + n for n, _ in FIELDS}
    carried = [c for c in (docs.columns if only is None else only) if c.lower() not in names]
    spark, out = docs.sparkSession, None
    for items in _slices(bench, item_id, item_text, max_chars):
        windows = spark.sparkContext.broadcast(Windows(items, width))
        if out is not None:  # a further slice goes over the texts and what was found so far
            out = materialize(out)
        out = _pass(docs if out is None else out, text, windows, clean, out is not None, prefix)
    return out.select(*[F.col(f"`{c}`") for c in carried], *[prefix + n for n, _ in FIELDS])


def _pass(docs: DataFrame, text: str, windows, clean: bool, again: bool, prefix: str) -> DataFrame:
    """One scan; with ``again`` the columns of an earlier one are taken into account."""

    def rows(texts: list[bytes], before: list[list] | None) -> list[list]:
        out: list[list] = [[], [], [], [], []]
        for chunk in chunks(texts, ALNUM):
            hit, items = windows.value.search(chunk)
            if before:
                for i in range(chunk.count):
                    for span in before[1][chunk.first + i] or ():
                        lo, hi = np.searchsorted(chunk.starts, chunk.text_starts[i] + np.array([span["start"], span["end"]]))
                        hit[lo:hi] = True
            words = np.diff(chunk.bounds)
            hits = np.bincount(chunk.text_of, weights=hit, minlength=chunk.count).astype(np.int64)
            out[0] += words.tolist()
            out[1] += hits.tolist()
            for i in range(chunk.count):
                found = set(items.get(i, ())) | set((before[0][chunk.first + i] or ()) if before else ())
                spans = _runs(chunk, hit, i) if hits[i] else []
                out[2].append(sorted(found))
                out[3].append([{"start": s, "end": e} for s, e in spans])
                out[4].append(_without(texts[chunk.first + i], spans) if clean and spans else None)
        return out

    fields = [(prefix + n, t) for n, t in FIELDS]
    return add_columns(docs, text, fields, rows, before=[prefix + "items", prefix + "spans"] if again else None, at_once=AT_ONCE)


def _runs(chunk: Chunk, hit: np.ndarray, i: int) -> list[tuple[int, int]]:
    """Byte ranges, within text ``i``, of its runs of hit words."""
    lo, hi = chunk.bounds[i], chunk.bounds[i + 1]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], hit[lo:hi], [False])).astype(np.int8)))
    first = chunk.text_starts[i]
    return list(zip((chunk.starts[lo + edges[0::2]] - first).tolist(), (chunk.ends[lo + edges[1::2] - 1] - first).tolist()))


def _without(text: bytes, spans: list[tuple[int, int]]) -> str:
    kept, at = [], 0
    for s, e in spans:
        kept.append(text[at:s])
        at = e
    return b"".join([*kept, text[at:]]).decode("utf-8", "replace")


def decontaminate(docs: DataFrame, bench: DataFrame, remove: str = "documents", text: str = "text", **options) -> DataFrame:
    """``docs``, same columns: without contaminated documents, or (``remove="spans"``) without the hit runs."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    new = fresh(docs, "found_")
    if remove == "documents":
        return _without_hits(docs, bench, text, new, **options)
    scanned = scan(docs, bench, text=text, prefix=new, **options)
    return scanned.select(*[
        F.coalesce(F.col(new + "clean_text"), F.col(f"`{c}`")).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def _without_hits(docs: DataFrame, bench: DataFrame, text: str, new: str, **options) -> DataFrame:
    """The rows without a hit word. A scan in small batches writes 128-bit names of the texts that are hit; whole rows
    stay out of Python then, and only those whose name may be among these meet them in a join."""
    name = F.unhex(F.md5(F.col(f"`{text}`").cast("string").cast("binary")))
    named = docs.select(F.col(f"`{text}`"), name.alias(f"{new}name"))
    scanned = scan(named, bench, text=text, only=[f"{new}name"], clean=False, prefix=new, **options)
    dirty = materialize(scanned.where(F.col(f"{new}n_hit") > 0).select(f"{new}name").distinct())
    held = bitmap(dirty.select(F.xxhash64(f"{new}name")))
    plain, maybe = where(docs, F.xxhash64(name), held, hit=False), where(docs, F.xxhash64(name), held)
    return plain.union(maybe.join(dirty, name == F.col(f"{new}name"), "left_anti"))


def report(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """One row per document: words, hit words, items found, a digest of their ids, and the verdict."""
    found = scan(docs, bench, only=["doc_id"], clean=False)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


REPORT_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM (SELECT *, least(10, len(w)) AS size FROM items WHERE len(w) > 0))),
runs AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
hits AS (SELECT doc_id, i, r.size, item_id FROM runs r JOIN windows USING (size, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""
