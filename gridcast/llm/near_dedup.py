"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact confirmation, components.

Two documents are linked when the Jaccard similarity of their sets of five-word shingles is 0.75 or
more. Sets are compared by 64-bit shingle hashes.

Defined cases: a null or empty text, or one without words, has an empty set and no links; a text of
fewer than five words is one shingle; equal sets form one class; every row is judged by itself, also
where ids repeat or are missing: of a component the row with the smallest ``doc_id`` stays (rows
without one come last), of several such rows the first. Extra columns are carried along untouched by
:func:`keep_one`; of rows equal in id and text any one stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.bitmaps import bitmap, where
from gridcast.llm.common import fresh, materialize, parts
from gridcast.llm.minhash import digest, linked, signature, tune_bands, ROWS
from gridcast.llm.textscan import CHUNK, SPACED, U64, Chunk, as_bytes, chunks, distinct, grams

SHINGLE = 5
SENT = 1 << 20  # digests a task remembers
AT_ONCE = 1 << 22  # bytes of text


def shingle_sets(texts: list[bytes], k: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for chunk in chunks(texts, SPACED):
        hashes, at = chunk.runs(k)
        cut = np.searchsorted(chunk.text_of[at], np.arange(chunk.count + 1))
        for i in range(chunk.count):
            lo, hi = chunk.bounds[i], chunk.bounds[i + 1]
            if 0 < hi - lo < k:
                yield grams(chunk.words[lo:hi], int(hi - lo))
            else:
                yield distinct(hashes[cut[i]:cut[i + 1]])


def _describe(docs: DataFrame, key: str, text: str, what: str, hashes: int = 0, also: dict[str, Column] | None = None) -> DataFrame:
    """(key, digest, n), by ``what`` the signature ("sig") or the set ("set"), and the columns of
    ``also``, per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in parts(whole, 1, AT_ONCE)):
            node, n, extra = [], [], []
            for s in shingle_sets(as_bytes(batch.column(1))):
                n.append(len(s))
                node.append(digest(s) if len(s) else None)
                extra.append(None if not len(s) else s.tobytes() if what == "set" else signature(s, hashes).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(node, pa.binary()), pa.array(n, pa.int64()), pa.array(extra, pa.binary()), *batch.columns[2:]],
                ["key", "digest", "n", what, *batch.schema.names[2:]])

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"),
                       *[c.alias(name) for name, c in (also or {}).items()])
    kind = rows.schema["key"].dataType.simpleString()
    rest = "".join(f", {f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    return rows.mapInArrow(run, f"key {kind}, digest binary, n long, {what} binary{rest}")


def _first_bits(digests: Column) -> Column:
    """The first 64 bits of binary names as a number."""
    return F.conv(F.hex(F.substring(digests, 1, 8)), 16, -10).cast("long")


def _sets(docs: DataFrame, text: str, named: DataFrame) -> DataFrame:
    """(node, set) of the classes ``named(node, digest)``, each sent once by a task."""
    held = docs.sparkSession.sparkContext.broadcast(bitmap(named.select(_first_bits(F.col("digest")))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in (part for whole in batches for part in parts(whole, 0, AT_ONCE)):
            names, sets, size = [], [], 0
            for s in shingle_sets(as_bytes(batch.column(0))):
                if not len(s):
                    continue
                name = digest(s)
                if name in sent or not held.value.has(np.frombuffer(name[:8], ">u8").astype(U64))[0]:
                    continue
                if len(sent) >= SENT:
                    sent.clear()
                sent.add(name)
                names.append(name)
                sets.append(s.tobytes())
                size += len(sets[-1])
                if size > CHUNK:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(sets, pa.binary())], ["digest", "set"])
                    names, sets, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(sets, pa.binary())], ["digest", "set"])

    found = docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, "digest binary, set binary")
    return found.groupBy("digest").agg(F.first("set").alias("set")).join(named, "digest").select("node", "set")


def _name(text: str) -> Column:
    """A 128-bit name of a text."""
    return F.unhex(F.md5(F.col(f"`{text}`").cast("string").cast("binary")))


def _judged(docs: DataFrame, key: str, text: str, percent: int, miss: float, also: dict[str, Column] | None = None) -> DataFrame:
    """(key, row, n, component, stays) and the columns of ``also``, for every row; ``row`` is a number
    written with the signatures, and in every component exactly one row stays."""
    hashes = tune_bands(percent / 100, miss) * ROWS
    rows = materialize(_describe(docs, key, text, "sig", hashes, {"row": F.monotonically_increasing_id(), **(also or {})}))
    place = F.struct(F.col("key").isNull().alias("no_key"), "key", "row")  # null keys last
    classes = materialize(rows.where("digest is not null").groupBy("digest").agg(
        F.min(place).alias("least"), F.first("n").alias("n"), F.first("sig").alias("sig")).withColumn(
        "node", F.monotonically_increasing_id()))

    def sets_of(wanted: DataFrame) -> DataFrame:
        """Recomputed from the texts; the digests wanted are known to the scan, so no text is shuffled."""
        named = classes.join(wanted, "node").select("node", "digest")
        return _sets(docs, text, materialize(named))

    roots = linked(classes.select("node", "n", "sig"), sets_of, percent, miss, hashes)
    placed = roots.join(classes.select("node", "least"), "node")
    first = placed.groupBy("root").agg(F.min("least").alias("first"))
    named = classes.select("node", "digest", "least").join(placed.join(first, "root").select("node", "first"), "node", "left").select(
        "digest", F.coalesce("first", "least").alias("first"))
    alone = F.col("digest").isNull()
    return rows.drop("sig").join(named, "digest", "left").select(
        "key", "row", "n", F.when(alone, F.col("key")).otherwise(F.col("first.key")).alias("component"),
        (alone | (F.col("row") == F.col("first.row"))).alias("stays"), *(also or ()))


def classify(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75, miss: float = 1e-6) -> DataFrame:
    """(key, n, component, stays): for every row its set's size, the smallest key of its component, and
    whether it is the row of its component that stays."""
    return _judged(docs, key, text, percent, miss).drop("row")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: set size, component (its smallest ``doc_id``) and whether it is kept."""
    return classify(docs).select(
        F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("stays").alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, same columns, with one row of each component.

    Rows are told apart by key and text, so ``docs`` need not be written with row numbers: a pair of
    these stays or goes as a whole, but for the pair that stays and has several rows, which leaves one.
    """
    name = fresh(docs, "__gone")
    judged = _judged(docs, key, text, 75, 1e-6, {"name": _name(text)})
    pairs = materialize(judged.where("n > 0").groupBy("key", "name").agg(
        F.max("stays").alias("stays"), F.count("*").alias("m")).where("not stays or m > 1").select(
        F.col("key").alias(f"{name}k"), F.col("name").alias(f"{name}t"), F.col("stays").alias(f"{name}s")))
    # rows whose pair is not among these for certain stay without any exchange of texts
    mark = F.xxhash64(F.col(f"`{key}`"), _name(text))
    held = bitmap(pairs.select(F.xxhash64(F.col(f"{name}k"), F.col(f"{name}t"))))
    plain, maybe = where(docs, mark, held, hit=False), where(docs, mark, held)
    same = F.col(f"`{key}`").eqNullSafe(F.col(f"{name}k")) & (_name(text) == F.col(f"{name}t"))
    left = plain.union(maybe.join(pairs, same, "left_anti"))
    several = pairs.where(f"{name}s")
    if several.isEmpty():
        return left
    columns = [F.col(f"`{c}`") for c in docs.columns]
    one = maybe.join(several, same).groupBy(f"{name}k", f"{name}t").agg(F.first(F.struct(*columns)).alias(f"{name}r"))
    return left.union(one.select(*[F.col(f"{name}r.`{c}`") for c in docs.columns]))


REPORT_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + size - 1], ' ') AS s
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM (SELECT *, least(5, len(w)) AS size FROM words WHERE len(w) > 0))),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_common
           FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
          WHERE 100 * n_common >= 75 * (p.n + q.n - n_common)),
reach(doc_id, other) AS (
  SELECT x, y FROM links UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.other = links.x),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce(other, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(other, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""
