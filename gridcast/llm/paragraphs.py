"""Repeated paragraphs and passages across documents.

Three kinds of units. A *paragraph* is a line of at least ``MIN_WORDS`` words; its set are its 5-word
shingles. A *short line* has fewer words but at least one shingle, and repeats word for word. A *passage* is a run of ``RUN`` words anywhere in a text, picked where its hash is the
smallest among ``WINDOW`` consecutive runs, so any stretch of ``RUN + WINDOW - 1`` words that two
documents share word for word leaves the same pick in both, wherever it stands. Picks are candidates
only: each is laid beside its hash's first occurrence and grown word by word to the whole stretch
that the two texts share, and that stretch is the passage.

A first scan leaves a few keys per unit: for paragraphs their ``LEAST`` smallest shingle hashes (of the
first so many hashes of two paragraphs' union, each is in both with a chance as large as their similarity,
so a pair at the threshold has fewer than ``NEED`` keys in common with a chance of about 4e-7), for passages and
short lines a hash of their words. Only the keys are shuffled, and counted. Those met in several rows go
to a second scan as a bitmap of bounded size, and paragraphs with fewer than ``NEED`` such keys, or other units
without one, are done; false hits cost time only. Of the others, passages and short lines are grouped by a 128-bit digest, paragraphs go through
signatures, bands, pruning, exact Jaccard on full shingle sets, and connected components. In
every group the first occurrence (smallest key, then place) is kept and the others are removals.

Defined cases: a text that is null, empty or shorter than a unit has none; rows without key take no
part; rows that repeat a key are one document, so they do not repeat each other; repetition inside
one document alone does not count; extra columns are not read, and :func:`remove_repeats` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.bitmaps import Bitmap, bitmap, first_bits, where
from gridcast.llm.common import add_columns, fresh, materialize, parts, release
from gridcast.llm.minhash import linked, signature
from gridcast.llm.textscan import SPACED, U64, Chunk, as_bytes, chunks, grams, mix

SHINGLE, MIN_WORDS = 5, 20
RUN, WINDOW = 18, 32  # a shared stretch of 49 words is always found
RECALL_MISS, HASHES = 1e-6, 160
LEAST, NEED = 20, 5  # of 20 keys fewer than 5 are shared at the threshold with a chance of 4e-7
PASSAGE, PARAGRAPH, LINE = 0, 1, 2
SENT = 1 << 20  # paragraphs a task remembers having sent
ASKS = 256  # requests to a first text in one row
TEXTS = 1 << 22  # bytes of text taken out of a batch at once
PLACES = 1 << 18  # words of two texts laid side by side at once


def _sliding(a: np.ndarray, least: bool) -> np.ndarray:
    """Minimum (or maximum) over every ``WINDOW`` neighbours, a power of two, by doubling."""
    pick, step = (np.minimum if least else np.maximum), 1
    while step < WINDOW:
        a = pick(a[:-step], a[step:])
        step *= 2
    return a


def picked(runs: np.ndarray) -> np.ndarray:
    """Places of the runs that are the smallest of some window, ties and repeats included."""
    if not len(runs):
        return np.empty(0, np.int64)
    if len(runs) <= WINDOW:
        return np.flatnonzero(runs == runs.min())
    low = _sliding(runs, True)
    edge = np.zeros(WINDOW - 1, U64)
    return np.flatnonzero(runs == _sliding(np.concatenate((edge, low, edge)), False))


class Units:
    """The units of one chunk of texts."""

    def __init__(self, chunk: Chunk):
        self.chunk = chunk
        self.runs, self.run_at = chunk.runs(RUN)
        self.cut = np.searchsorted(chunk.text_of[self.run_at], np.arange(chunk.count + 1))
        line = np.searchsorted(np.flatnonzero(chunk.bytes == 10), chunk.starts)
        first = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1]))) if len(line) else np.empty(0, np.int64)
        size = np.diff(np.append(first, len(line)))
        long = size >= MIN_WORDS
        self.lines, self.sizes = first[long], size[long]
        self.of_text = np.searchsorted(chunk.text_of[self.lines], np.arange(chunk.count + 1))
        short = (size >= SHINGLE) & ~long
        self.short, self.short_sizes = first[short], size[short]
        self.short_of_text = np.searchsorted(chunk.text_of[self.short], np.arange(chunk.count + 1))

    def keys(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(kind, text, first word within the chunk, key) of the units' keys, units of a kind in order."""
        words, text_of = self.chunk.words, self.chunk.text_of
        picks = [self.cut[i] + picked(self.runs[self.cut[i]:self.cut[i + 1]]) for i in range(self.chunk.count)]
        picks = np.concatenate(picks) if picks else np.empty(0, np.int64)
        at, key, kind = [self.run_at[picks]], [self.runs[picks]], [np.full(len(picks), PASSAGE)]
        # the smallest distinct shingle hashes of every long line
        n = np.maximum(self.sizes - SHINGLE + 1, 0)
        place = np.repeat(self.lines - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        line, h = np.repeat(np.arange(len(n)), n), mix(grams(words, SHINGLE)[place] + U64(PARAGRAPH)) if len(place) else np.empty(0, U64)
        order = np.lexsort((h, line))
        line, h = line[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (line[1:] != line[:-1]) | (h[1:] != h[:-1])
        line, h = line[new], h[new]
        rank = np.arange(len(line)) - np.searchsorted(line, line)
        line, h = line[rank < least], h[rank < least]
        at.append(self.lines[line])
        key.append(h)
        kind.append(np.full(len(h), PARAGRAPH))
        for size in np.unique(self.short_sizes).tolist():
            lo = self.short[self.short_sizes == size]
            total = np.full(len(lo), size, U64)
            for j in range(size):
                total = total * U64(0xD6E8FEB86659FD93) + words[lo + j]
            at.append(lo)
            key.append(mix(total + U64(LINE)))
            kind.append(np.full(len(lo), LINE))
        at = np.concatenate(at)
        return np.concatenate(kind), text_of[at] if len(at) else at, at, np.concatenate(key)


def pieces(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, Chunk]]:
    """The texts of batches in small chunks, each with the part of the batch that it counts in; a unit needs
    many times its text's bytes, so the chunk's size decides what a scan takes of memory."""
    for batch in (part for whole in batches for part in parts(whole, column, TEXTS)):
        for chunk in chunks(as_bytes(batch.column(column)), SPACED):
            yield batch, chunk


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").cast("string").alias("text")).where("doc is not null")


def _repeated_keys(rows: DataFrame, least: int) -> DataFrame:
    """(key): the keys of units that several rows hold. A row's key is sent once, and sorted keys are counted as
    they pass, so that no task holds more than a batch of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, chunk in pieces(batches, 0):
            _, text, _, key = Units(chunk).keys(least)
            order = np.lexsort((text, key))
            text, key = text[order], key[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
            key = key[new]
            new = np.ones(len(key), bool)
            new[2:] = key[2:] != key[:-2]  # a key twice says as much as more often
            yield pa.RecordBatch.from_arrays([pa.array(key[new].view(np.int64))], ["key"])

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty(0, np.int64)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(second(held, batch.column(0).to_numpy()))], ["key"])
            held = np.concatenate((held, batch.column(0).to_numpy()))[-2:]

    return rows.select("text").mapInArrow(run, "key long").repartition("key").sortWithinPartitions("key").mapInArrow(repeated, "key long")


def second(before: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Of sorted keys, those that are the second of their kind; ``before`` are the last two keys ahead of them."""
    keys = np.concatenate((before, keys))
    found = np.zeros(len(keys), bool)
    found[1:] = keys[1:] == keys[:-1]
    found[2:] &= keys[2:] != keys[:-2]
    found[:len(before)] = False
    return keys[found]


def _digests(flat: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """The digests (see ``minhash.digest``) of runs of ``flat`` with the given positive sizes."""
    if not len(sizes):
        return []
    first = np.cumsum(sizes) - sizes
    place = (np.arange(len(flat)) - np.repeat(first, sizes) + 1).astype(U64)
    a = np.bitwise_xor.reduceat(mix(flat + place * U64(0x9E3779B97F4A7C15)), first)
    b = np.add.reduceat(mix(flat * U64(0xD6E8FEB86659FD93) + place), first)
    raw = np.column_stack((a, b)).astype(">u8").tobytes()
    return [raw[i:i + 16] for i in range(0, len(raw), 16)]


def _runs_of(at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places at, at + 1, ... of runs of the given sizes, one after the other."""
    return np.repeat(at - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _line_sets(words: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of lines, one line after the other, and how many each has."""
    n = sizes - SHINGLE + 1
    line, h = np.repeat(np.arange(len(at)), n), grams(words, SHINGLE)[_runs_of(at, n)]
    order = np.lexsort((h, line))
    line, h = line[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (line[1:] != line[:-1]) | (h[1:] != h[:-1])
    return h[new], np.bincount(line[new], minlength=len(at))


def keys_of(threshold: float) -> int:
    """How many keys a paragraph leaves, so that a pair at the threshold shares ``NEED`` but for ``RECALL_MISS``."""
    n = LEAST
    while sum(comb(n, i) * threshold ** i * (1 - threshold) ** (n - i) for i in range(NEED)) > RECALL_MISS:
        n += 1
    return n


def likely(lines: np.ndarray, hit: np.ndarray, percent: int) -> np.ndarray:
    """The places, sorted, of the lines with enough keys hit; ``lines`` has a line's place once per key. A line
    with few distinct shingles leaves all as keys, of which a similar one shares that part."""
    place, of, n = np.unique(lines, return_inverse=True, return_counts=True)
    hits = np.bincount(of[hit], minlength=len(place))
    return place[hits >= np.maximum(1, np.minimum(NEED, -(-percent * n // 100)))]


def _described(rows: DataFrame, live: Bitmap, least: int, percent: int) -> DataFrame:
    """(doc, kind, start, words, digest, n) of the units with a live key, or for paragraphs enough of them."""
    shared = rows.sparkSession.sparkContext.broadcast(live)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, chunk in pieces(batches, 1):
            units = Units(chunk)
            kind, _, at, key = units.keys(least)
            hit = shared.value.has(key)
            found = [likely(at[kind == k], hit[kind == k], percent) if k == PARAGRAPH else np.unique(at[hit & (kind == k)])
                     for k in (PASSAGE, PARAGRAPH, LINE)]
            sizes = [np.full(len(found[0]), RUN), units.sizes[np.searchsorted(units.lines, found[1])],
                     units.short_sizes[np.searchsorted(units.short, found[2])]]
            names, n = [], [np.zeros(len(x), np.int64) for x in found]
            for k in (PASSAGE, PARAGRAPH, LINE):
                if k == PARAGRAPH and len(found[k]):
                    flat, n[k] = _line_sets(chunk.words, found[k], sizes[k])
                    names += _digests(flat, n[k])
                elif len(found[k]):
                    names += _digests(mix(chunk.words[_runs_of(found[k], sizes[k])]), sizes[k])
            place, text = np.concatenate(found), chunk.text_of[np.concatenate(found)] if len(names) else np.empty(0, np.int64)
            kinds = np.repeat((PASSAGE, PARAGRAPH, LINE), list(map(len, found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(chunk.first + text)), pa.array(kinds.astype(np.int8)),
                 pa.array((place - chunk.bounds[text]).astype(np.int32)), pa.array(np.concatenate(sizes).astype(np.int32)),
                 pa.array(names, pa.binary()), pa.array(np.concatenate(n))], ["doc", "kind", "start", "words", "digest", "n"])

    doc = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {doc}, kind byte, start int, words int, digest binary, n long")


def _sets(rows: DataFrame, named: DataFrame) -> DataFrame:
    """(node, set) of the paragraphs ``named(node, digest)``, made from the texts again; a task sends each once."""
    held = rows.sparkSession.sparkContext.broadcast(bitmap(named.select(first_bits(F.col("digest")))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for _, chunk in pieces(batches, 0):
            units = Units(chunk)
            if not len(units.lines):
                continue
            flat, n = _line_sets(chunk.words, units.lines, units.sizes)
            names = _digests(flat, n)
            likely = held.value.has(np.frombuffer(b"".join(x[:8] for x in names), ">u8").astype(U64))
            first, out = np.cumsum(n) - n, {}
            for i in np.flatnonzero(likely).tolist():
                if names[i] not in sent:
                    out[names[i]] = flat[first[i]:first[i] + n[i]].tobytes()
            if len(sent) > SENT:
                sent.clear()
            sent |= out.keys()
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.binary()), pa.array(list(out.values()), pa.binary())], ["digest", "set"])

    found = rows.select("text").mapInArrow(run, "digest binary, set binary")
    return found.groupBy("digest").agg(F.first("set").alias("set")).join(named, "digest").select("node", "set")


def _signed(sets: DataFrame) -> DataFrame:
    """(node, n, sig) of (node, set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            sets = [np.frombuffer(s.as_buffer(), U64) for s in x.column(1)]
            sig = [signature(s, HASHES).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([x.column(0), pa.array(list(map(len, sets)), pa.int64()), pa.array(sig, pa.binary())], ["node", "n", "sig"])

    return sets.mapInArrow(run, "node long, n long, sig binary")


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75, miss: float = 1e-6) -> DataFrame:
    """(doc, kind, start, words, first_doc, first_start, kept) for every unit repeated in another
    document: where it stands, in words from the text's begin, and its group's first occurrence."""
    rows = _keyed(docs, key, text)
    least = keys_of(percent / 100)
    live = materialize(_repeated_keys(rows, least))
    units = materialize(_described(rows, bitmap(live), least, percent))
    release(live)
    place = F.struct("doc", "start")
    classes = materialize(units.groupBy("kind", "digest").agg(
        F.min(place).alias("least"), F.max("doc").alias("most")).withColumn(
        "node", F.monotonically_increasing_id()))
    lines = classes.where(F.col("kind") == PARAGRAPH).select("node", "digest")
    sets = materialize(_sets(rows, lines))
    signed = materialize(_signed(sets))
    node = F.xxhash64("node")
    roots = linked(signed, lambda nodes: where(sets, node, bitmap(nodes.select(node))), percent, miss, HASHES)
    release(sets, signed)
    placed = classes.select("kind", "digest", "node", "least", "most").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = placed.groupBy("root").agg(F.min("least").alias("least"), F.max("most").alias("most")).where("least.doc <> most")
    named = materialize(placed.select("kind", "digest", "root").join(groups, "root").select("kind", "digest", F.col("least").alias("lead")))
    found = materialize(units.select("doc", "kind", "start", "words", "digest").distinct().join(named, ["kind", "digest"]).select(
        "doc", "kind", "start", "words", F.col("lead.doc").alias("first_doc"), F.col("lead.start").alias("first_start"),
        (place == F.col("lead")).alias("kept")))
    picks = found.where(F.col("kind") == PASSAGE).where("not kept").select("doc", "start", "first_doc", "first_start")
    grown = materialize(_grown(picks, rows))
    copies = grown.select("doc", F.lit(PASSAGE).cast("byte").alias("kind"), "start", "words", "first_doc", "first_start", F.lit(False).alias("kept"))
    # one kept stretch per place of the first text, however many copies of unlike length it has
    firsts = grown.groupBy("first_doc", "pick").agg(F.min("first_start").alias("start"), F.max(F.col("first_start") + F.col("words")).alias("end"))
    firsts = firsts.select(F.col("first_doc").alias("doc"), F.lit(PASSAGE).cast("byte").alias("kind"), "start", (F.col("end") - F.col("start")).alias("words"),
                           "first_doc", F.col("start").alias("first_start"), F.lit(True).alias("kept"))
    return found.where(F.col("kind") != PASSAGE).unionByName(copies.distinct()).unionByName(firsts.distinct())


def _grown(picks: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc, start, words, first_doc, first_start, pick): the whole stretches around
    ``picks(doc, start, first_doc, first_start)`` that both texts share.

    The first text's words travel to the copy, no more of them than the copy's length allows. Requests
    to one first text are dealt into rows of about ``ASKS``, each with a copy of that text, however many
    there are. Texts that neither ask nor are asked stay where they are.
    """
    kind = rows.schema["doc"].dataType.simpleString()
    picks = materialize(picks)
    texts = _only(rows, picks.select("doc").distinct())
    pairs = picks.groupBy("doc", "first_doc").agg(F.collect_list(F.struct("start", "first_start")).alias("at"))
    sized = texts.mapInArrow(_sizes, f"doc {kind}, size int").groupBy("doc").agg(F.max("size").alias("size"))
    asked = pairs.groupBy("first_doc").agg(F.ceil(F.count("*") / ASKS).alias("rows"))
    asks = pairs.join(sized, "doc").join(asked, "first_doc").groupBy("first_doc", F.pmod(F.xxhash64("doc"), F.col("rows")).alias("dealt")).agg(
        F.collect_list(F.struct("doc", "size", "at")).alias("asks"))

    names = ["doc", "first_doc", "at", "lo", "cut"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for k, words in _words(as_bytes(batch.column(1))):
                doc, length, at = batch.column(2)[k].values.flatten()
                start, first, of = _places(at)
                lo = np.maximum(0, np.minimum.reduceat(first - start, of[:-1]))
                hi = np.minimum(len(words), np.maximum.reduceat(first - start, of[:-1]) + length.to_numpy())
                cuts = [words[x:y].tobytes() for x, y in zip(lo.tolist(), hi.tolist())]
                out.append(pa.RecordBatch.from_arrays([doc, batch.column(0).take(pa.array([k] * len(cuts))), at, pa.array(lo, pa.int32()),
                                                       pa.array(cuts, pa.binary())], names))
                size += sum(map(len, cuts))
                if size > TEXTS:
                    yield pa.concat_batches(out)
                    out, size = [], 0
            if out:
                yield pa.concat_batches(out)

    leads = _only(rows, picks.select("first_doc").distinct().toDF("doc"))
    cuts = asks.join(leads.select(F.col("doc").alias("first_doc"), "text"), "first_doc").select("first_doc", "text", "asks").mapInArrow(
        cut, f"doc {kind}, first_doc {kind}, at array<struct<start:int,first_start:int>>, lo int, cut binary")

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, out = [np.empty(0, np.int64)], [np.empty((0, 4), np.int64)]
            start, first, of = _places(batch.column(3))
            lo = batch.column(4).to_pylist()
            for k, words in _words(as_bytes(batch.column(2))):
                other = np.frombuffer(batch.column(5)[k].as_buffer(), U64)
                same = batch.column(0)[k] == batch.column(1)[k]
                out.append(stretches(words, other, lo[k], start[of[k]:of[k + 1]], first[of[k]:of[k + 1]], same))
                where.append(np.full(len(out[-1]), k))
            take, columns = pa.array(np.concatenate(where)), np.concatenate(out).T
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), *[pa.array(c, pa.int32()) for c in columns]],
                                             ["doc", "first_doc", "start", "words", "first_start", "pick"])

    return cuts.join(texts, "doc").select("doc", "first_doc", "text", "at", "lo", "cut").mapInArrow(
        grow, f"doc {kind}, first_doc {kind}, start int, words int, first_start int, pick int")


def _only(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of the wanted documents. Most others are passed over in the scan, before any exchange."""
    wanted = materialize(wanted)
    return where(rows, F.xxhash64("doc"), bitmap(wanted.select(F.xxhash64("doc")))).join(wanted, "doc", "left_semi")


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [int(b) for chunk in chunks(as_bytes(batch.column(1)), SPACED) for b in np.diff(chunk.bounds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int32())], ["doc", "size"])


def _words(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(number, word hashes) of each text; equal neighbours are looked at once."""
    new = [k for k, t in enumerate(texts) if not k or t != texts[k - 1]]
    ends = [*new[1:], len(texts)]
    for chunk in chunks([texts[k] for k in new], SPACED):
        for i in range(chunk.count):
            words = chunk.words[chunk.bounds[i]:chunk.bounds[i + 1]]
            for k in range(new[chunk.first + i], ends[chunk.first + i]):
                yield k, words


def _places(at: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The starts and first starts of lists of places, one list after the other, and where each list begins."""
    start, first = (x.to_numpy().astype(np.int64) for x in at.flatten().flatten())
    return start, first, np.concatenate(([0], np.cumsum(at.value_lengths().to_numpy())))


def stretches(words: np.ndarray, other: np.ndarray, lo: int, start: np.ndarray, first: np.ndarray, same: bool) -> np.ndarray:
    """Rows of (start, words, first_start, pick): the maximal common stretches through the places
    ``start`` and, in the first text, ``first``; ``other`` are the first text's words from number ``lo`` on.
    In one and the same text the first occurrence itself is left whole."""
    order = np.lexsort((start, start - first))
    start, shift = start[order], (start - first)[order]
    begin, end = np.maximum(0, lo + shift), np.minimum(len(words), lo + shift + len(other))
    inside = (begin <= start) & (start < end)
    if same:
        inside &= shift >= RUN
    start, shift, begin, end = (x[inside] for x in (start, shift, begin, end))
    of = np.cumsum(np.diff(shift, prepend=shift[:1]) != 0)
    heads = np.searchsorted(of, np.arange(of[-1] + 1 if len(of) else 0))  # a place of each shift
    out = [np.empty((0, 4), np.int64)]
    # the texts are laid beside each other at many shifts at once, with an edge behind each
    for some in np.split(heads, np.flatnonzero(np.diff(np.cumsum((end - begin + 1)[heads]) // PLACES)) + 1) if len(heads) else ():
        size = (end - begin)[some]
        zero = np.cumsum(size + 1) - (size + 1)
        at = _runs_of(begin[some], size)
        apart = np.ones(int(size.sum()) + len(some), bool)
        apart[_runs_of(zero, size)] = words[at] != other[at - np.repeat(shift[some] + lo, size)]
        edges = np.flatnonzero(apart)
        mine = slice(*np.searchsorted(of, (of[some[0]], of[some[-1]] + 1)))
        move = (begin[some] - zero)[of[mine] - of[some[0]]]
        k = np.searchsorted(edges, start[mine] - move)
        ok = np.flatnonzero(edges[k] + move - start[mine] >= RUN)  # rows that repeat a key hold unlike texts
        ok = ok[np.diff(k[ok], prepend=-1) != 0]
        move, k, pick = move[ok], k[ok], start[mine][ok]
        gap = shift[mine][ok]
        s, e = np.concatenate(([-1], edges))[k] + 1 + move, edges[k] + move
        if same:
            s = np.maximum(s, pick - gap + RUN)
        out.append(np.column_stack((s, e - s, s - gap, pick - gap)))
    return np.concatenate(out)


def _merged(spans: str) -> str:
    """SQL for the word ranges of sorted (start, end) structs with overlaps joined."""
    return f"""aggregate({spans}, cast(array() as array<struct<start:int,end:int>>), (done, x) ->
      case when size(done) = 0 or element_at(done, -1).end < x.start then concat(done, array(x))
           else concat(slice(done, 1, size(done) - 1), array(named_struct('start', element_at(done, -1).start,
                'end', greatest(element_at(done, -1).end, x.end)))) end)"""


def spans(found: DataFrame) -> DataFrame:
    """One row per document with repeated units: the word ranges of these and of the removals among
    them, their sizes, the smallest document they lead to, the number of other documents they lead
    to, and every unit with its group's first occurrence."""
    per_doc = found.groupBy("doc").agg(F.min("first_doc").alias("first_doc"), F.sort_array(F.collect_set(
        F.struct("start", (F.col("start") + F.col("words")).alias("end"), "first_doc", "first_start", "kept"))).alias("units"))
    # units are in the order of their words; that a stretch may stand there several times is nothing to a merge
    span = "transform({}, x -> named_struct('start', x.start, 'end', x.end))"
    per_doc = per_doc.select(
        "doc", "first_doc", "units", F.expr(span.format("units")).alias("a"), F.expr(span.format("filter(units, x -> not x.kept)")).alias("b"),
        F.expr("size(array_distinct(transform(filter(units, x -> x.first_doc <> doc), x -> x.first_doc)))").cast("long").alias("n_links"))
    size = "aggregate({}, 0L, (n, x) -> n + x.end - x.start)"
    return per_doc.select("doc", "first_doc", "n_links", "units", F.expr(_merged("a")).alias("repeated"), F.expr(_merged("b")).alias("removed")).select(
        "doc", "first_doc", F.expr(size.format("repeated")).alias("n_repeated"),
        F.expr(size.format("removed")).alias("n_removed"), "repeated", "removed", "n_links", "units")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs``, same columns, without the words of repeated units that are not first occurrences."""
    name = fresh(docs, "__cut")
    cuts = spans(repeats(docs, key, text, **options)).select(F.col("doc").alias(f"{name}k"), F.col("removed").alias(f"{name}r"))
    rows = docs.join(cuts, F.col(f"`{key}`") == F.col(f"{name}k"), "left")

    def cut(texts: list[bytes], before: list[list]) -> list[list]:
        out = []
        for chunk in chunks(texts, SPACED):
            for i in range(chunk.count):
                source, kept, at = texts[chunk.first + i], [], 0
                lo, zero = chunk.bounds[i], chunk.text_starts[i]
                for x in before[0][chunk.first + i] or ():
                    kept.append(source[at:chunk.starts[lo + x["start"]] - zero])
                    at = chunk.ends[lo + x["end"] - 1] - zero
                out.append(b"".join([*kept, source[at:]]).decode("utf-8", "replace"))
        return [out]

    new = add_columns(rows, text, [(f"{name}t", "string")], cut, before=[f"{name}r"])
    changed = F.when(F.col(f"`{text}`").isNotNull(), F.col(f"{name}t")).alias(text)
    return new.select(*[changed if c == text else F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """The documents that share a paragraph or passage with another document."""
    return spans(repeats(docs)).withColumnRenamed("doc", "doc_id")
