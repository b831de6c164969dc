"""Language-model scoring by context-tree weighting over bytes.

A text is its words, A-Z lower-cased, joined by single blanks and closed by an end byte. Each byte
is eight binary decisions; each of the 255 decision places has a context tree over the preceding
bytes, up to ``depth``. A tree node holds how often its decision was 0 and 1, gives the
Krichevsky-Trofimov estimate of these counts, and mixes it half and half with the product of its
children. Unrolled from the root, the weights of that mixture give one probability per decision from
the estimates of all depths. A context that training never met is no node: the deepest known one
then acts as a leaf.

Because the estimate depends on the counts only, the trees are built by aggregation: one scan leaves
counts of (depth + 1)-byte strings, nodes of each depth are sums over those one deeper, weights run
up and predictions down the tree by joins. Every distinct string of the corpus gets its code length
once, so a text is scored by looking its strings up. The most frequent strings and words are looked
up in tables of at most ``known_rows`` rows that every task holds; all others are joined.

Defined cases: a null or empty text is its end alone; a null key is training; repeated rows count
each; an empty training part leaves uniform bits and words unseen; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import materialize, release, remainder
from gridcast.llm.textscan import CHUNK, SPACED, as_bytes, chunks, distinct

DEPTH = 5
END = 10  # a newline, which is never inside a normal text
END_WORD = -7046029254386353131  # the key under which the end is counted as a token
STRING, TOKEN = 0, 1
KNOWN_STRINGS, KNOWN_WORDS = 4_000_000, 250_000
FLUSH = 1_500_000  # distinct keys a task holds before it hands on what it has counted


def normal(text: bytes) -> bytes:
    return b" ".join(text.lower().split())


def strings(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """A key for every byte of the normal texts and their ends: the byte in the lowest eight bits,
    the one before it in the next eight and so on; and the number of keys of each text."""
    pad = bytes([END]) * depth
    b = np.frombuffer(pad + (bytes([END]) + pad).join(texts) + bytes([END]), np.uint8)
    n = len(b) - depth
    key = np.zeros(n, np.int64)
    for back in range(depth + 1):
        key |= b[depth - back:depth - back + n].astype(np.int64) << (8 * back)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    firsts = np.cumsum(sizes + depth) - sizes - depth
    at = np.arange(int(sizes.sum())) + np.repeat(firsts - (np.cumsum(sizes) - sizes), sizes)
    return key[at], sizes


def _groups(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= CHUNK):
            size += len(texts[stop])
            stop += 1
        yield at, texts[at:stop]
        at = stop


def count(docs: DataFrame, depth: int) -> DataFrame:
    """(kind, key, n): how often training texts hold each string (also those only held-out texts
    have, with 0) and each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]

        def put(kind: int, keys: np.ndarray, n: np.ndarray) -> None:
            held[kind].append((keys, n))

        def merged(kind: int) -> tuple[np.ndarray, np.ndarray]:
            keys = np.concatenate([k for k, _ in held[kind]])
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], np.concatenate([x for _, x in held[kind]])[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            return keys[first], np.add.reduceat(n, first)

        def table(kind: int) -> pa.RecordBatch:
            keys, n = merged(kind)
            held[kind].clear()
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(n)],
                                              ["kind", "key", "n"])

        for batch in batches:
            texts, train = as_bytes(batch.column(1)), np.array(batch.column(0).to_pylist(), bool)
            for at, some in _groups(texts):
                key, sizes = strings([normal(t) for t in some], depth)
                learn = np.repeat(train[at:at + len(some)], sizes)
                keys, n = np.unique(key[learn], return_counts=True)
                put(STRING, keys, n)
                other = distinct(key[~learn])
                put(STRING, other, np.zeros(len(other), np.int64))
                for chunk in chunks([t for t, known in zip(some, train[at:at + len(some)]) if known], SPACED):
                    put(TOKEN, *np.unique(chunk.words.view(np.int64), return_counts=True))
                    put(TOKEN, np.array([END_WORD]), np.array([chunk.count]))
            for kind in (STRING, TOKEN):
                if sum(len(k) for k, _ in held[kind]) > 4 * FLUSH:
                    keys, n = merged(kind)
                    held[kind][:] = [(keys, n)]
                    if len(keys) > FLUSH:
                        yield table(kind)
        for kind in (STRING, TOKEN):
            if held[kind]:
                yield table(kind)

    found = docs.select("train", "text").mapInArrow(run, "kind int, key long, n long")
    return found.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _log_gamma(x: Column) -> Column:
    """Stirling's series behind seven steps of the recurrence; right to about 1e-12 for x >= 0.5."""
    z, product = x + 7, x
    for k in range(1, 7):
        product = product * (x + k)
    return ((z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z)
            + 1 / (1260 * z * z * z * z * z) - F.log(product))


def _estimate(a: Column, b: Column) -> Column:
    """Log of the Krichevsky-Trofimov probability of a sequence of ``a`` zeros and ``b`` ones."""
    a, b = a.cast("double"), b.cast("double")
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - math.log(math.pi) - _log_gamma(a + b + 1)


def _mask(depth: int) -> int:
    return (1 << (8 * (depth + 1))) - 1


_DECISIONS = """transform(sequence(0, 7), k -> named_struct(
    'node', shiftleft(shiftright(key, 8), 8) | shiftleft(1L, k) | shiftright(key & 255L, 8 - k),
    'bit', cast(shiftright(key, 7 - k) & 1L as int)))"""


def trees(counted: DataFrame, depth: int) -> list[DataFrame]:
    """For each depth, a written table of (node, zero, one, ...): the probability of either decision where
    this depth is the deepest known one. A node's number is its context above eight bits for the decision
    place. The tables of the way up are deleted as the way down has taken them in."""
    rows = counted.where("n > 0").select("n", F.explode(F.expr(_DECISIONS)).alias("d")).select(
        F.col("d.node").alias("node"), F.when(F.col("d.bit") == 0, F.col("n")).otherwise(0).alias("a"),
        F.when(F.col("d.bit") == 1, F.col("n")).otherwise(0).alias("b"))
    level = rows.groupBy("node").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    level = materialize(level.withColumn("weighted", _estimate(F.col("a"), F.col("b"))).withColumn("odds", F.lit(float("inf"))))
    levels = [level]
    for d in range(depth - 1, -1, -1):
        up = level.groupBy(F.col("node").bitwiseAND(F.lit(_mask(d))).alias("node")).agg(
            F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("weighted").alias("below"))
        own = up.withColumn("own", _estimate(F.col("a"), F.col("b"))).withColumn("odds", F.col("own") - F.col("below"))
        level = materialize(own.select("node", "a", "b", (
            math.log(0.5) + F.greatest("own", "below") + F.log1p(F.exp(-F.abs("odds")))).alias("weighted"), "odds"))
        levels.insert(0, level)
    out, above = [], None
    for d, level in enumerate(levels):
        if above is None:
            start = level.withColumns({"zero0": F.lit(0.0), "one0": F.lit(0.0), "left": F.lit(1.0)})
        else:
            start = level.withColumn("up", F.col("node").bitwiseAND(F.lit(_mask(d - 1)))).join(above, "up")
        total = (F.col("a") + F.col("b") + 1).cast("double")
        p0, p1 = (F.col("a") + 0.5) / total, (F.col("b") + 0.5) / total
        share = 1 / (1 + F.exp(-F.col("odds")))  # the weight of this depth among it and all deeper ones
        placed = materialize(start.select(
            "node", (F.col("zero0") + F.col("left") * p0).alias("zero"), (F.col("one0") + F.col("left") * p1).alias("one"),
            (F.col("zero0") + F.col("left") * share * p0).alias("zero0"), (F.col("one0") + F.col("left") * share * p1).alias("one0"),
            (F.col("left") * (1 - share)).alias("left")))
        release(level)
        out.append(placed)
        above = placed.select(F.col("node").alias("up"), "zero0", "one0", "left")
    return out


def code_lengths(counted: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(key, value), written: log10 of the probability of a string's last byte behind the others. The
    tables of ``levels`` are deleted."""
    depth, met_before = len(levels) - 1, []
    open_ = counted.select("key", F.explode(F.expr(_DECISIONS)).alias("d")).select("key", F.col("d.node").alias("node"), F.col("d.bit").alias("bit"))
    done = None
    p = F.when(F.col("bit") == 0, F.col("zero")).otherwise(F.col("one"))
    for d in range(depth, -1, -1):
        level = levels[d].select(F.col("node").alias("at"), "zero", "one")
        at = F.col("node") if d == depth else F.col("node").bitwiseAND(F.lit(_mask(d)))
        met = materialize(open_.withColumn("at", at).join(level, "at", "left").select("key", "node", "bit", F.log10(p).alias("value")))
        release(levels[d], *met_before)
        known = materialize(met.where("value is not null").groupBy("key").agg(F.sum("value").alias("value")))
        done = [known] if done is None else [*done, known]
        open_, met_before = met.where("value is null").select("key", "node", "bit"), [met]
    parts = open_.select("key", F.lit(math.log10(0.5)).alias("value"))
    for known in done:
        parts = parts.unionByName(known)
    out = materialize(parts.groupBy("key").agg(F.sum("value").alias("value")))
    release(*done, *met_before)
    return out


def _frequent(rows: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys, sorted, and values of the most frequent rows, as many whole frequencies as ``limit`` holds."""
    levels = rows.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator()
    held, least = 0, None
    for x in levels:
        held += x["count"]
        if held > limit:
            break
        least = x.n
    if least is None:
        return np.empty(0, np.int64), np.empty(0)
    table = rows.where(F.col("n") >= least).select("key", "value").toArrow()
    keys, values = table.column(0).to_numpy(), table.column(1).to_numpy()
    order = np.argsort(keys)
    return keys[order], values[order]


def score(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", depth: int = DEPTH,
          known_strings: int = KNOWN_STRINGS, known_words: int = KNOWN_WORDS) -> DataFrame:
    """(key, train, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte) for every text.

    ``score`` is log10 of the trees' probability of the text, learnt from the rows where ``train`` is
    true; ``base_score`` is that of words drawn independently, 0.5 added to every count.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(train, F.lit(True)).alias("train"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    counted = materialize(count(rows, depth))
    grams, words = counted.where(F.col("kind") == STRING).drop("kind"), counted.where(F.col("kind") == TOKEN).drop("kind")
    lengths_ = code_lengths(grams, trees(grams, depth))
    lengths = lengths_.join(grams, "key")
    values = materialize(lengths.select(F.lit(STRING).alias("kind"), "key", "n", "value").unionByName(
        words.select(F.lit(TOKEN).alias("kind"), "key", "n", F.log10(F.col("n") + 0.5).alias("value"))))
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    release(counted, lengths_)
    known = spark.sparkContext.broadcast([
        _frequent(values.where(F.col("kind") == kind).drop("kind"), limit)
        for kind, limit in ((STRING, known_strings), (TOKEN, known_words))])
    kind_of_key = rows.schema["key"].dataType.simpleString()

    def look_up(kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of keys, and which of them are in the table."""
        have, value = known.value[kind]
        distinct, which = np.unique(keys, return_inverse=True)
        at = np.minimum(np.searchsorted(have, distinct), max(0, len(have) - 1))
        there = have[at] == distinct if len(have) else np.zeros(len(distinct), bool)
        found = np.where(there, value[at] if len(have) else 0.0, 0.0)
        return found[which], there[which]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at, some in _groups(as_bytes(batch.column(2))):
                plain = [normal(t) for t in some]
                keys, sizes = strings(plain, depth)
                value, there = look_up(STRING, keys)
                cut = np.cumsum(sizes) - sizes
                gram_sum = np.add.reduceat(value, cut)
                rare: list[list] = [[] for _ in some]
                owner = np.repeat(np.arange(len(some)), sizes)
                for k, i in zip(keys[~there].tolist(), owner[~there].tolist()):
                    rare[i].append((STRING, k))
                n_words, n_known, word_sum = np.zeros(len(some), np.int64), np.zeros(len(some), np.int64), np.zeros(len(some))
                for chunk in chunks(plain, SPACED):
                    mine = np.concatenate([chunk.words.view(np.int64), np.full(chunk.count, END_WORD)])
                    of = np.concatenate([chunk.text_of, np.arange(chunk.count)]) + chunk.first
                    value, there = look_up(TOKEN, mine)
                    n_words += np.bincount(of, minlength=len(some))
                    n_known += np.bincount(of, weights=there, minlength=len(some)).astype(np.int64)
                    word_sum += np.bincount(of, weights=value, minlength=len(some))
                    for k, i in zip(mine[~there].tolist(), of[~there].tolist()):
                        rare[i].append((TOKEN, k))
                flat = [x for r in rare for x in r]
                ends = np.concatenate(([0], np.cumsum([len(r) for r in rare])))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(made, made + len(some))), batch.column(0).slice(at, len(some)),
                    batch.column(1).slice(at, len(some)), pa.array(n_words), pa.array(n_known), pa.array(word_sum),
                    pa.array(gram_sum), pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                        [pa.array([k for k, _ in flat], pa.int32()), pa.array([x for _, x in flat], pa.int64())], ["kind", "key"]))],
                    ["row", "key", "train", "n_tokens", "n_known", "words", "strings", "n_bytes", "rare"])
                made += len(some)

    scanned = materialize(rows.mapInArrow(
        run, f"row long, key {kind_of_key}, train boolean, n_tokens long, n_known long, words double, strings double, "
             "n_bytes long, rare array<struct<kind:int,key:long>>"))
    rare = scanned.select("row", F.inline("rare")).groupBy("row", "kind", "key").agg(F.count("*").alias("times"))
    met = rare.join(values, ["kind", "key"], "left").groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0) * (F.col("kind") == TOKEN).cast("int")).alias("more"),
        F.sum(F.when(F.col("kind") == TOKEN, F.col("times") * F.coalesce("value", F.lit(math.log10(0.5))))).alias("more_words"),
        F.sum(F.when(F.col("kind") == STRING, F.col("times") * F.col("value"))).alias("more_strings"))
    zero = F.lit(0.0)
    total = F.col("strings") + F.coalesce("more_strings", zero)
    norm = math.log10(n + 0.5 * (v + 1))
    return scanned.drop("rare").join(met, "row", "left").select(
        "key", "train", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("words") + F.coalesce("more_words", zero) - F.col("n_tokens") * norm).alias("base_score"),
        total.alias("score"), "n_bytes", (-total * math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"))


def report(docs: DataFrame) -> DataFrame:
    """Every document scored by what the documents whose crc32 of the id modulo 5 is not 1 teach."""
    return score(docs, remainder("doc_id") != 1).select(
        F.col("key").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score", "n_bytes", "bits_per_byte")
