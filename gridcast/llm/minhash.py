"""MinHash signatures, banded candidates, and sequential Bayesian verification of candidate pairs.

Works on classes: rows with the same set are one class, told apart by a 128-bit digest of the set and
numbered, so exact copies never meet each other. Candidate pairs come in rounds, none of which lists the pairs
of a bucket: every member against the bucket's smallest and largest class, then against the one with
the most links so far. A bucket whose members are now all in one component is done. In the buckets
that are left, all members outside the largest component are compared with all others, block
by block inside tasks, which is what makes the result complete. Every link is confirmed on full sets.

Bands are made of whole hashes; pairs are pruned by the last eight bits of each, which equal hashes share,
so that no pair is lost by it. Full sets go only to blocks, and within them to members, that a signature
leaves a pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.bitmaps import Bitmap, bitmap
from gridcast.llm.common import materialize, release
from gridcast.llm.components import components
from gridcast.llm.textscan import U64, mix

ROWS, BATCH = 4, 32
BLOCK = 256  # members of a bucket compared at once in the last round
PAIRS = 1 << 17  # pairs of signatures compared at once


def tune_bands(threshold: float, miss: float, rows: int = ROWS) -> int:
    """The fewest bands of ``rows`` hashes for which a pair at the threshold is missed with chance ``miss``."""
    bands = 1
    while (1 - threshold ** rows) ** bands > miss:
        bands += 1
    return -(-bands * rows // BATCH) * BATCH // rows


@lru_cache(maxsize=4)
def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(7)
    return r.integers(0, 1 << 32, n, dtype=np.uint32), r.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def signature(elements: np.ndarray, n: int) -> np.ndarray:
    """``n`` minimum hashes of a non-empty array of 64-bit elements."""
    x = (elements >> U64(32)).astype(np.uint32)[None, :]
    add, times = _seeds(n)
    least = None
    for at in range(0, x.shape[1], 512):
        h = (x[:, at:at + 512] ^ add[:, None]) * times[:, None]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(12)
        m = h.min(axis=1)
        least = m if least is None else np.minimum(least, m)
    return least


def digest(elements: np.ndarray) -> bytes:
    """A 128-bit name of a sorted set of 64-bit elements."""
    place = np.arange(1, len(elements) + 1, dtype=U64)
    a = np.bitwise_xor.reduce(mix(elements + place * U64(0x9E3779B97F4A7C15)))
    b = mix(elements * U64(0xD6E8FEB86659FD93) + place).sum(dtype=U64)
    return np.array([a, b], dtype=">u8").tobytes()


@lru_cache(maxsize=8)
def least_matches(threshold: float, miss: float, n: int) -> list[tuple[int, int]]:
    """(hashes compared, matches needed to go on): below that, the posterior chance that the
    similarity reaches the threshold is under ``miss``, starting from a uniform prior."""
    out = []
    for k in range(BATCH, n + 1, BATCH):
        tail, m = 0.0, -1
        while True:  # P(similarity >= t | m of k) = P(Binomial(k + 1, t) <= m)
            tail += comb(k + 1, m + 1) * threshold ** (m + 1) * (1 - threshold) ** (k - m)
            m += 1
            if tail >= miss:
                break
        out.append((k, m))
    return out


def _alike(sig: np.ndarray, left: np.ndarray, right: np.ndarray, needs: list[tuple[int, int]]) -> np.ndarray:
    """Numbers of the pairs of rows of ``sig`` that survive batch by batch."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    done = 0
    for k, need in needs:
        part = np.ascontiguousarray(sig[:, done:k])
        same = (part[left[alive]] == part[right[alive]]).view(U64).sum(axis=1, dtype=U64)  # a count of up to BATCH / 8 in each byte
        matches = matches + ((same * U64(0x0101010101010101)) >> U64(56)).astype(np.int64)
        keep = matches >= need
        alive, matches, done = alive[keep], matches[keep], k
    return alive


def _signatures(column: pa.Array, kind: type = np.uint8) -> np.ndarray:
    flat = column.to_pylist()
    return np.frombuffer(b"".join(flat), kind).reshape(len(flat), -1)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A hash for every ``ROWS`` hashes of each signature and their place in it."""
    bands = sig.shape[1] // ROWS
    part = sig[:, :bands * ROWS].reshape(len(sig), bands, ROWS)
    total = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=U64)), (len(sig), bands))
    for j in range(ROWS):
        total = mix(total * U64(0xD6E8FEB86659FD93) + part[:, :, j])
    return total


def _bands(classes: DataFrame, held: Bitmap | None = None) -> DataFrame:
    """(node, key) of every band of every class, or of those whose key is in the bitmap."""
    shared = held and classes.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if x.num_rows:
                key = band_keys(_signatures(x.column(1), np.uint32))
                node, key = np.repeat(x.column(0).to_numpy(), key.shape[1]), key.ravel()
                if shared:
                    hit = shared.value.has(key)
                    node, key = node[hit], key[hit]
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(key.view(np.int64))], ["node", "key"])

    return classes.select("node", "sig").mapInArrow(run, "node long, key long")


def _brief(classes: DataFrame, held: Bitmap) -> DataFrame:
    """(node, n, sig) of the classes with a band in the bitmap, the last eight bits of each hash."""
    shared = classes.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if x.num_rows:
                sig = _signatures(x.column(2), np.uint32)
                keep = np.flatnonzero(shared.value.has(band_keys(sig).ravel()).reshape(len(sig), -1).any(axis=1))
                low = pa.array([y.tobytes() for y in sig[keep].astype(np.uint8)], pa.binary())
                yield pa.RecordBatch.from_arrays([x.column(0).take(pa.array(keep)), x.column(1).take(pa.array(keep)), low], ["node", "n", "sig"])

    return classes.select("node", "n", "sig").mapInArrow(run, "node long, n long, sig binary")


def _prune(pairs: DataFrame, brief: DataFrame, threshold: float, miss: float, hashes: int) -> DataFrame:
    """The pairs that size and signature leave possible."""
    needs = least_matches(threshold, miss, hashes)
    rows = (pairs.join(brief.toDF("a", "na", "sa"), "a").join(brief.toDF("b", "nb", "sb"), "b")
            .where(F.least("na", "nb") >= F.greatest("na", "nb") * threshold).select("a", "b", "sa", "sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if x.num_rows:
                sig, at = np.concatenate([_signatures(x.column(2)), _signatures(x.column(3))]), np.arange(x.num_rows)
                keep = pa.array(_alike(sig, at, at + x.num_rows, needs))
                yield pa.RecordBatch.from_arrays([x.column(0).take(keep), x.column(1).take(keep)], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union on the full sets."""
    rows = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = (np.frombuffer(v.as_buffer(), U64) for v in (x, y))
                both = int(_shared(x, [y])[0])
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(keep, pa.int64())) for k in (0, 1)], ["a", "b"])

    return rows.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Whole blocks of rows sorted by (key, i, j), many of them at once, with the block's number for each row."""
    held: list[pa.RecordBatch] = []
    for batch in chain((x for x in batches if x.num_rows), (None,)):
        if batch is None and not held:
            return
        rows = pa.concat_batches(held if batch is None else [*held, batch])
        ids = np.column_stack([rows.column(c).to_numpy() for c in ("key", "i", "j")])
        block = np.cumsum(np.concatenate(([0], (ids[1:] != ids[:-1]).any(axis=1))))
        whole = len(block) if batch is None else int(np.searchsorted(block, block[-1]))
        if whole:
            yield rows.slice(0, whole), block[:whole]
        held = [rows.slice(whole)]


def _possible(rows: pa.RecordBatch, block: np.ndarray, threshold: float, needs: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(line's rows, column's rows): the pairs within blocks that root, size and signature leave possible, those
    of one line together. The columns of a block stand before its lines."""
    small, root, n = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("small", "root", "n"))
    sig = _signatures(rows.column("sig"))
    line = np.flatnonzero(small)
    first = np.searchsorted(block, block[line])
    count = np.bincount(block[~small], minlength=int(block[-1]) + 1)[block[line]]
    for at in np.split(np.arange(len(line)), np.flatnonzero(np.diff(np.cumsum(count) // PAIRS)) + 1):
        left = np.repeat(line[at], count[at])
        right = np.repeat(first[at] - (np.cumsum(count[at]) - count[at]), count[at]) + np.arange(len(left))
        keep = (root[left] != root[right]) & (np.minimum(n[left], n[right]) >= np.maximum(n[left], n[right]) * threshold)
        left, right = left[keep], right[keep]
        keep = _alike(sig, left, right, needs)
        yield left[keep], right[keep]


def _rest(open_: DataFrame, brief: DataFrame, sets: DataFrame, percent: int, miss: float, hashes: int) -> DataFrame:
    """Links between different components in ``open_(key, node, root)``: in every bucket, the members
    outside its largest component against all others, block by block. Signatures are compared first, and only
    the members with a possible partner come again with their sets. Of the links of one class into
    one component a block leaves only one, since more would not change any component."""
    threshold = percent / 100
    needs = least_matches(threshold, miss, hashes)
    parts = open_.groupBy("key", "root").agg(F.count("*").alias("m")).groupBy("key").agg(
        F.max(F.struct("m", "root")).alias("bulk"), F.sum("m").alias("m"))
    parts = parts.select("key", F.col("bulk.root").alias("bulk"), F.ceil(F.col("m") / BLOCK).cast("int").alias("columns"),
                         F.ceil((F.col("m") - F.col("bulk.m")) / BLOCK).cast("int").alias("lines"))
    member = open_.join(parts, "key")
    column = member.select("key", F.explode(F.expr("sequence(0, lines - 1)")).alias("i"),
                           F.pmod(F.xxhash64("node"), F.col("columns")).alias("j"), F.lit(False).alias("small"), "node", "root")
    line = member.where("root <> bulk").select(
        "key", F.pmod(F.xxhash64(F.lit(1), "node"), F.col("lines")).alias("i"),
        F.explode(F.expr("sequence(0, columns - 1)")).alias("j"), F.lit(True).alias("small"), "node", "root")
    column, line = (x.withColumn("i", F.col("i").cast("long")).withColumn("j", F.col("j").cast("long")) for x in (column, line))
    place = ["key", "i", "j"]

    def in_blocks(rows: DataFrame) -> DataFrame:
        return rows.repartition(*place).sortWithinPartitions(*place, "small")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, block in blocks(batches):
            met = np.zeros(rows.num_rows, bool)
            for left, right in _possible(rows, block, threshold, needs):
                met[left] = met[right] = True
            yield rows.filter(pa.array(met))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, block in blocks(batches):
            node, root, n = (rows.column(c).to_numpy() for c in ("node", "root", "n"))
            out: tuple[list, list] = ([], [])
            for left, right in _possible(rows, block, threshold, needs):
                cut = np.flatnonzero(np.diff(left)) + 1
                for at in np.split(np.arange(len(left)), cut) if len(left) else ():
                    k, others = left[at[0]], right[at]
                    shared = _shared(_set(rows, k), [_set(rows, m) for m in others])
                    met = set()
                    for m in others[100 * shared >= percent * (n[others] + n[k] - shared)]:
                        if root[m] not in met:
                            met.add(root[m])
                            a, b = sorted((node[k], node[m]))
                            out[0].append(a)
                            out[1].append(b)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], ["a", "b"])

    dealt = in_blocks(column.unionByName(line).join(brief, "node").select(*place, "small", "node", "root", "n", "sig"))
    left = materialize(dealt.mapInArrow(near, dealt.schema))
    found = in_blocks(left.join(sets, "node").select(*place, "small", "node", "root", "n", "sig", "set"))
    return found.mapInArrow(links, "a long, b long").distinct()


def _set(rows: pa.RecordBatch, k: int) -> np.ndarray:
    return np.frombuffer(rows.column("set")[int(k)].as_buffer(), U64)


def _shared(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of a sorted set with non-empty ones."""
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    first = np.cumsum([0, *map(len, others[:-1])])
    return np.add.reduceat((one[at] == flat).astype(np.int64), first)


def linked(classes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int = 75, miss: float = 1e-6,
           hashes: int = 128) -> DataFrame:
    """(node, root) for every class linked with another one.

    ``classes(node, n, sig)`` is a written table of numbered distinct sets; ``sets_of(nodes)`` returns
    (node, set) for a table of nodes. A pair at the threshold is lost with a chance of about ``miss``
    in the banding and again in the pruning; all others are decided on their full sets.
    """
    threshold = percent / 100
    hubs = materialize(_bands(classes).groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first <> last"))
    held = bitmap(hubs.select("key"))
    live = materialize(_bands(classes, held).join(hubs, "key"))
    release(hubs)
    brief = materialize(_brief(classes, held))
    sets = materialize(sets_of(live.select("node").distinct()))
    links = None
    for step in ("ends", "central"):
        maybe = _prune(_star(live, step, links), brief, threshold, miss, hashes)
        new = materialize(_confirm(maybe, sets, percent))
        links = new if links is None else links.unionByName(new)
    roots = components(links)
    placed = live.select("key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    apart = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    placed = materialize(placed.join(apart.select("key"), "key", "left_semi"))
    if placed.isEmpty():
        return roots
    new = materialize(_rest(placed, brief, sets, percent, miss, hashes))
    if new.isEmpty():
        return roots
    return components(new.unionByName(roots.where("node <> root").toDF("a", "b")))


def _star(live: DataFrame, step: str, links: DataFrame | None) -> DataFrame:
    """Every member of a bucket with the bucket's hubs: the smallest and the largest class, or the
    one with the most links so far, where there is one."""
    if step == "ends":
        pairs = live.select("node", F.explode(F.array("first", "last")).alias("hub"))
    else:
        degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
        hubs = live.join(degree, "node").groupBy("key").agg(F.max(F.struct("degree", "node")).alias("hub"))
        pairs = live.join(hubs.select("key", F.col("hub.node").alias("hub")), "key").where("hub <> first and hub <> last")
    return pairs.where("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
