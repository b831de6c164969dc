"""Nearest vectors by inner product: inverted lists with an adaptive scan over dimensions.

Vectors get one more dimension, sqrt(M^2 - |x|^2) with M the largest norm, which turns the largest
inner product into the smallest distance, and are rotated at random. Lists are the cells of k-means
centres. Inside a probed list, vectors stand in column blocks: a query adds up the distance one block
of dimensions at a time, and after each block a hypothesis test abandons the candidates whose
partial distance is too large for the best ``k`` so far (what is left follows a normal law, as the
rotation spreads every vector evenly over the dimensions). Survivors are scored in double precision
on the original vectors.

The index is fitted on at most about ``sample_rows`` vectors drawn by a hash of their id (a
documented bound): the rotation, the centres, and how many lists to probe so that the sample's own
nearest neighbours are found with ``recall``. Every vector is indexed. Lists are cut into blocks of
about ``BLOCK`` vectors by a hash of the row, so a list of many equal vectors, or an id that repeats
without end, is many tasks' work.

Defined cases: a vector that is null, empty, all zero, or holds a null or non-finite component takes
no part, nor does one whose length is not the most frequent one (the longer, on a tie), nor a row
without id; rows that repeat an id are candidates each; a query is a distinct pair of id and vector,
which has all rows but one of its own as candidates, and ``query_hash``, a hash of the vector, tells
queries of one id apart;
ties go to the smaller id, then the earlier row; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import materialize

BLOCK, QUERY_BLOCK, COLUMNS = 4096, 512, 8
ASKED = 128  # queries that meet a block together
AT_ONCE = 512  # vectors that all queries of a block meet at once
SPARSE = 8  # pairs are followed one by one when fewer than one in so many is left
SCORED = 1 << 14  # pairs scored at once
HELD = 400_000  # finds a task gathers before it cuts them down to the best of each query
EPSILON = 2.1  # standard deviations of the test: an abandoned candidate is wrong about once in fifty
RESULT = "query_id long, rank int, vec_id long, score double, query_hash long"


def valid(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, x) of the vectors that take part."""
    v = F.col(f"`{vector}`").cast("array<double>")
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("x", lambda c: c != 0)
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), v.alias("x")).where("id is not null and size(x) > 0").where(F.coalesce(fine, F.lit(False)))
    sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n")).agg(F.max(F.struct("n", "size")).alias("top")).first()
    return rows.where(F.size("x") == (sizes.top.size if sizes.top else 0))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class Index:
    """What tasks need to place a vector: the largest norm, the rotation, the centres."""

    largest: float
    rotation: np.ndarray
    centres: np.ndarray
    probes: int

    def place(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, self.largest ** 2 - (x * x).sum(axis=1)))
        return np.column_stack([x, rest]) @ self.rotation

    def distances(self, placed: np.ndarray) -> np.ndarray:
        return (placed * placed).sum(axis=1)[:, None] - 2 * placed @ self.centres.T + (self.centres * self.centres).sum(axis=1)


def _centres(points: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centres = points[rng.choice(len(points), k, replace=False)]
    for _ in range(rounds):
        d = (centres * centres).sum(axis=1) - 2 * points @ centres.T
        cell = d.argmin(axis=1)
        n = np.bincount(cell, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, points)
        centres = np.where(n[:, None] > 0, sums / np.maximum(1, n)[:, None], centres)
    return centres


def fit(rows: DataFrame, k: int = 20, recall: float = 0.97, lists: int | None = None, sample_rows: int = 20_000,
        seed: int = 3) -> Index | None:
    """An index for the vectors of ``rows(id, x)``; None if there are none."""
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c))
    n, largest = rows.agg(F.count("*"), F.max(norm)).first()
    if not n:
        return None
    parts = 1 << 30
    some = rows if n <= sample_rows else rows.where(
        F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(parts)) < int(parts * sample_rows / n))
    table = some.orderBy("id").toArrow()
    if not table.num_rows:
        table = rows.orderBy("id").limit(1).toArrow()
    x = _matrix(table.column("x"))
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.standard_normal((x.shape[1] + 1,) * 2))[0]
    index = Index(float(largest) * (1 + 1e-12), rotation, np.zeros((1, x.shape[1] + 1)), 1)
    points = index.place(x)
    wanted = lists or max(1, min(int(n ** 0.5), len(x) // 40))
    index.centres = _centres(points, min(wanted, len(x)), 8, rng)
    index.probes = _calibrate(index, x, points, k, recall, rng)
    return index


def _calibrate(index: Index, x: np.ndarray, points: np.ndarray, k: int, recall: float, rng: np.random.Generator) -> int:
    """The fewest lists that hold ``recall`` of the sample's true neighbours."""
    ask = rng.choice(len(x), min(400, len(x)), replace=False)
    scores = x[ask] @ x.T
    scores[np.arange(len(ask)), ask] = -np.inf
    near = np.argsort(-scores, axis=1, kind="stable")[:, :min(k, len(x) - 1)]
    if not near.size:
        return len(index.centres)
    cell = index.distances(points).argmin(axis=1)
    order = np.argsort(index.distances(index.place(x[ask], query=True)), axis=1)
    rank = np.argsort(order, axis=1)
    needed = np.sort(np.take_along_axis(rank, cell[near], axis=1).ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1


def scan_all(blocks: np.ndarray, queries: np.ndarray, k: int, skip: np.ndarray, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) numbers of the pairs of a query and a vector of ``blocks`` (dimensions x vectors) that may be
    among the query's ``k`` nearest; ``skip`` (queries x vectors) marks pairs to leave out.

    All queries meet the next ``AT_ONCE`` vectors together. Partial distances grow a column block at a time, by
    matrix products while many pairs are left and pair by pair later; the test abandons pairs in between.
    """
    dims, n = blocks.shape
    best = np.full((len(queries), k), np.inf)
    found: list[list[np.ndarray]] = [[], [], []]
    for at in range(0, n, AT_ONCE):
        block = blocks[:, at:at + AT_ONCE]
        limit = best[:, k - 1]
        alive = ~skip[:, at:at + AT_ONCE]
        if not np.isfinite(limit).any():  # nothing to be abandoned yet
            part = np.where(alive, _squares(queries, block), np.inf)
        else:
            part = np.zeros(alive.shape)
            pairs = None
            for lo in range(0, dims, COLUMNS):
                hi = min(dims, lo + COLUMNS)
                wide = (1 + EPSILON / hi ** 0.5) ** 2 if hi < dims else 1.0
                bound = limit * (hi / dims) * wide + slack
                if pairs is None:
                    part += _squares(queries[:, lo:hi], block[lo:hi])
                    alive &= part <= bound[:, None]
                    if hi < dims and np.count_nonzero(alive) * SPARSE < alive.size:
                        pairs = np.nonzero(alive)
                        left = part[pairs]
                else:
                    q, v = pairs
                    step = block[lo:hi, v] - queries[q, lo:hi].T
                    left = left + (step * step).sum(axis=0)
                    keep = left <= bound[q]
                    pairs, left = (q[keep], v[keep]), left[keep]
            if pairs is None:
                part[~alive] = np.inf
            else:
                part = np.full(alive.shape, np.inf)
                part[pairs] = left
        q, v = np.nonzero(part < np.inf)
        for column, x in zip(found, (q, v + at, part[q, v])):
            column.append(x)
        both = np.concatenate((best, part), axis=1)
        both.partition(k - 1, axis=1)
        best = np.sort(both[:, :k], axis=1)
    q, v, part = (np.concatenate(x) for x in found)
    near = part <= best[q, k - 1] + slack  # later vectors were nearer than the others
    order = np.lexsort((v[near], q[near]))
    return q[near][order], v[near][order]


def scan(block: np.ndarray, query: np.ndarray, k: int, skip: np.ndarray, slack: float) -> np.ndarray:
    """Row numbers of ``block`` (dimensions x vectors) that may be among the ``k`` nearest of one query."""
    return scan_all(block, query[None], k, skip[None], slack)[1]


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The squared distances of the rows of ``a`` and the columns of ``b``."""
    return np.maximum(0.0, (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=0) - 2 * (a @ b))


def scores(vectors: np.ndarray, queries: np.ndarray, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The inner products of the given pairs, in double precision."""
    out = np.empty(len(q))
    for at in range(0, len(q), SCORED):
        out[at:at + SCORED] = (vectors[v[at:at + SCORED]] * queries[q[at:at + SCORED]]).sum(axis=1)
    return out


def _best(parts: list[tuple], k: int) -> tuple:
    """The ``k`` best (query row, id, row, score) of each query among some finds."""
    query, vector, row, score = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((row, vector, -score, query))
    query = query[order]
    first = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1]))) if len(query) else np.empty(0, np.int64)
    rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
    order = order[rank < k]
    return query[rank < k], vector[order], row[order], score[order]


def search(rows: DataFrame, is_query: Column, k: int = 20, index: Index | None = None, **options) -> DataFrame:
    """(query_id, rank, vec_id, score, query_hash) for the rows of ``rows(id, x)`` that ``is_query`` marks."""
    spark = rows.sparkSession
    rows = materialize(rows.select("id", "x", F.monotonically_increasing_id().alias("row")))
    index = index or fit(rows, k, **options)
    if index is None:
        return spark.createDataFrame([], RESULT)
    shared = spark.sparkContext.broadcast(index)
    listed_as = "id long, row long, x array<double>, list int"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = shared.value.distances(shared.value.place(_matrix(batch.column(2)))).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], ["id", "row", "x", "list"])

    listed = materialize(rows.select("id", "row", "x").mapInArrow(assign, listed_as))
    sizes = np.zeros(len(index.centres), np.int64)
    for r in listed.groupBy("list").count().collect():  # one row per list: bounded by the index
        sizes[r["list"]] = r["count"]
    held = spark.sparkContext.broadcast(sizes)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(shared.value.distances(shared.value.place(_matrix(batch.column(2)), query=True)), axis=1)
            enough = (np.cumsum(held.value[order], axis=1) > 4 * k).argmax(axis=1) + 1
            short = held.value.sum() <= 4 * k
            n = np.full(len(order), order.shape[1]) if short else np.maximum(shared.value.probes, enough)
            row = np.repeat(np.arange(len(order)), n)
            at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            cell, take = order[row, at], pa.array(row)
            yield pa.RecordBatch.from_arrays([*[c.take(take) for c in batch.columns], pa.array(cell, pa.int32())], ["id", "row", "x", "list"])

    # rows alike in id and vector ask once, for the first of them
    queries = materialize(rows.where(is_query).groupBy("id", "x").agg(F.min("row").alias("row")).select("id", "row", "x"))
    asked = queries.mapInArrow(probe, listed_as)
    # Spark sizes the asked blocks by the queries before ``probe`` repeats them, so it must not broadcast them
    blocks = _blocks(listed, BLOCK, "v").join(_blocks(asked, QUERY_BLOCK, "q").hint("merge"), "list").drop("list")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        names = ["row", "vec_id", "found", "score"]
        for batch in batches:
            for r in batch.to_pylist():
                ids, lines, vectors = np.frombuffer(r["v_ids"], np.int64), np.frombuffer(r["v_rows"], np.int64), np.frombuffer(r["v_x"]).reshape(r["v_n"], -1)
                own, queries = np.frombuffer(r["q_rows"], np.int64), np.frombuffer(r["q_x"]).reshape(r["q_n"], -1)
                columns = np.ascontiguousarray(shared.value.place(vectors).T)
                asks = shared.value.place(queries, query=True)
                for lo in range(0, len(own), ASKED):
                    some, asked = own[lo:lo + ASKED], queries[lo:lo + ASKED]
                    q, v = scan_all(columns, asks[lo:lo + ASKED], k, lines == some[:, None], 1e-9 * shared.value.largest ** 2)
                    held.append(_best([(some[q], ids[v], lines[v], scores(vectors, asked, q, v))], k))
                if sum(len(x[0]) for x in held) > HELD:
                    held = [_best(held, k)]
                    if len(held[0][0]) > HELD // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held.pop()], names)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _best(held, k)], names)

    found = blocks.mapInArrow(compare, "row long, vec_id long, found long, score double")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id", "found")
    asked_by = queries.select("row", F.col("id").alias("query_id"), F.xxhash64("x").alias("query_hash"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked_by, "row").select("query_id", "rank", "vec_id", "score", "query_hash")


def _blocks(rows: DataFrame, size: int, side: str) -> DataFrame:
    """(list, <side>_n, <side>_ids, <side>_rows, <side>_x): the rows of each list in blocks of about ``size``."""
    # a row per list, whereas Spark's size of ``rows`` may be too low by as many times as a query asks lists
    parts = rows.groupBy("list").agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    dealt = rows.join(F.broadcast(parts), "list").withColumn("part", F.pmod(F.xxhash64("row", "list"), F.col("parts")))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("row")
        ids, lines, x = group.column("id").to_numpy(), group.column("row").to_numpy(), _matrix(group.column("x"))
        return pa.table({"list": pa.array([group.column("list")[0].as_py()], pa.int32()), f"{side}_n": pa.array([len(ids)], pa.int32()),
                         f"{side}_ids": pa.array([ids.tobytes()], pa.binary()), f"{side}_rows": pa.array([lines.tobytes()], pa.binary()),
                         f"{side}_x": pa.array([x.tobytes()], pa.binary())})

    return dealt.groupBy("list", "part").applyInArrow(run, f"list int, {side}_n int, {side}_ids binary, {side}_rows binary, {side}_x binary")


def report(embeddings: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` nearest others of every vector whose id is divisible by 20."""
    return search(valid(embeddings, "vec_id", "embedding"), F.pmod(F.col("id"), F.lit(20)) == 0, k)
