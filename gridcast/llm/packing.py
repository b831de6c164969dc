"""Packing of tokenised documents into rows of a fixed number of ids.

Each task encodes its documents and packs them window by window (about ``window`` ids, so memory is
bounded and no row is shuffled). Inside a window, pieces are placed by best-fit decreasing: the
longest piece first, each into the row with the least room that still holds it. A segment tree over
the room sizes finds that row. Documents longer than a row are cut into full rows and a rest, without
losing an id; every piece remembers its document and its offset there.

Result rows: ``pack_id``; ``ids``, the row as little-endian binary, padded to full length;
``n_tokens`` without padding; ``cu_seqlens``, cumulative piece lengths from 0; ``position_resets``,
the offsets at which position ids start again at 0; ``doc_ids`` and ``doc_starts`` of the pieces.

Defined cases: a null or empty text is its end-of-text id alone; repeated rows are packed each;
an empty table gives no rows; extra columns are not read. ``pack_id`` depends on the partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.textscan import as_bytes
from gridcast.llm.tokens import END_OF_TEXT, VOCABULARY, encoder, read_vocabulary


class RoomTree:
    """Which room sizes 0..capacity are on offer; finds the smallest that is large enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.some = bytearray(2 * self.leaves)

    def set(self, size: int, on: bool) -> None:
        i = size + self.leaves
        self.some[i] = on
        i >>= 1
        while i:
            now = self.some[2 * i] | self.some[2 * i + 1]
            if self.some[i] == now:
                break
            self.some[i] = now
            i >>= 1

    def at_least(self, size: int) -> int | None:
        i = size + self.leaves
        if self.some[i]:
            return size
        while i > 1:  # climb until a right neighbour has something, then go down on its left
            if not i & 1 and self.some[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.some[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return None


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Piece numbers per row; no piece is longer than ``capacity``."""
    rows: list[list[int]] = []
    offers: dict[int, list[int]] = {}
    tree = RoomTree(capacity)
    for piece in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[piece])
        room = tree.at_least(size) if size < capacity else None
        if room is None:
            row, room = len(rows), capacity
            rows.append([])
        else:
            row = offers[room].pop()
            if not offers[room]:
                tree.set(room, False)
        rows[row].append(piece)
        left = room - size
        if left:
            offers.setdefault(left, []).append(row)
            if len(offers[left]) == 1:
                tree.set(left, True)
    return rows


def pack(docs: DataFrame, length: int = 2048, window: int = 1 << 21, key: str = "doc_id", text: str = "text",
         vocabulary: str = VOCABULARY, end: int = END_OF_TEXT, pad: int = END_OF_TEXT, dtype: str = "<u2") -> DataFrame:
    """``docs`` as packed rows of ``length`` ids; ``end`` closes every document."""
    files = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    itemsize = np.dtype(dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(files.value, dtype)
        task = TaskContext.get().partitionId() << 40
        made, held, keys, parts, sizes = 0, 0, [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal made, held, keys, parts, sizes
            out = _rows(pa.chunked_array(keys).combine_chunks(), np.concatenate(parts), np.concatenate(sizes), length, pad, task + made)
            made, held, keys, parts, sizes = made + out.num_rows, 0, [], [], []
            return out

        for batch in batches:
            at, texts = 0, as_bytes(batch.column(1))
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size < window):
                    size += len(texts[stop])
                    stop += 1
                ids, counts = bpe.encode(texts[at:stop])
                ends = np.cumsum(counts)
                parts.append(np.insert(ids, ends, end))
                sizes.append(counts + 1)
                keys.append(batch.column(0).slice(at, stop - at))
                held += len(parts[-1])
                at = stop
                if held >= window:
                    yield flush()
        if held:
            yield flush()

    def _rows(key: pa.Array, ids: np.ndarray, sizes: np.ndarray, length: int, pad: int, first: int) -> pa.RecordBatch:
        begins = np.cumsum(sizes) - sizes
        n = -(-sizes // length)
        owner = np.repeat(np.arange(len(sizes)), n)
        offset = (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * length
        lengths = np.minimum(length, sizes[owner] - offset)
        placed = best_fit(lengths, length)
        order = np.fromiter((p for row in placed for p in row), np.int64, len(owner))
        per_row = np.fromiter(map(len, placed), np.int64, len(placed))
        took = lengths[order]
        row_of = np.repeat(np.arange(len(placed)), per_row)
        ends = np.cumsum(took)
        used = np.bincount(row_of, weights=took, minlength=len(placed)).astype(np.int64)
        row_base = np.cumsum(used) - used
        in_row = ends - took - row_base[row_of]
        matrix = np.full((len(placed), length), pad, np.dtype(dtype))
        source = np.repeat(begins[owner[order]] + offset[order] - (ends - took), took) + np.arange(int(took.sum()))
        target = np.repeat(row_of * length + in_row - (ends - took), took) + np.arange(int(took.sum()))
        matrix.reshape(-1)[target] = ids[source]
        cuts = np.concatenate(([0], np.cumsum(per_row)))
        starts = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(in_row, pa.int32()))
        cu_cuts = np.concatenate(([0], np.cumsum(per_row + 1)))
        cu = np.insert(in_row, cuts[1:], used)
        return pa.RecordBatch.from_arrays([
            pa.array(np.arange(first, first + len(placed)), pa.int64()),
            pa.Array.from_buffers(pa.binary(), len(placed), [
                None, pa.py_buffer((np.arange(len(placed) + 1) * length * itemsize).astype(np.int32)), pa.py_buffer(matrix)]),
            pa.array(used, pa.int32()),
            pa.ListArray.from_arrays(pa.array(cu_cuts, pa.int32()), pa.array(cu, pa.int32())),
            starts,
            pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), key.take(pa.array(owner[order]))),
            pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(offset[order], pa.int64())),
        ], ["pack_id", "ids", "n_tokens", "cu_seqlens", "position_resets", "doc_ids", "doc_starts"])

    return rows.mapInArrow(run, "pack_id long, ids binary, n_tokens int, cu_seqlens array<int>, "
                                f"position_resets array<int>, doc_ids array<{kind}>, doc_starts array<long>")


def write_packed(packed: DataFrame, path: str) -> None:
    """One row of ids per record; ``ids`` does not compress well by dictionary, so none is tried."""
    packed.write.option("parquet.enable.dictionary", "false").parquet(path)


def id_matrix(ids: list[bytes], dtype: str = "<u2") -> np.ndarray:
    """The rows of a batch as one matrix."""
    return np.frombuffer(b"".join(ids), dtype).reshape(len(ids), -1)


def positions(cu_seqlens: list[int], length: int) -> np.ndarray:
    """The position ids of a row: counting from 0 in every piece, 0 in the padding."""
    out = np.zeros(length, np.int64)
    for s, e in zip(cu_seqlens, cu_seqlens[1:]):
        out[s:e] = np.arange(e - s)
    return out
