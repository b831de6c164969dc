"""Sets of hashes as bitmaps of bounded size, by which a scan can tell most rows that need no join.

A bitmap has false hits but no false misses. So rows it does not hold are done within their scan, and
only the others, false hits among them, go through an exact join. A set too large for its bitmap
costs time, never rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.textscan import U64

MOST_BITS = 28  # 32 MB
SLICES = 256
FEW = 4096


def _bits(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    bit = hashes >> U64(64 - bits)
    return (bit >> U64(3)).astype(np.int64), (bit & U64(7)).astype(np.uint8)


class Bitmap:
    """A set of 64-bit hashes by their first bits."""

    def __init__(self, bits: int, parts: dict[int, bytes]):
        self.bits, self.bytes = bits, np.zeros(1 << (bits - 3), np.uint8)
        size = len(self.bytes) // SLICES
        for k, x in parts.items():
            self.bytes[k * size:(k + 1) * size] = np.frombuffer(x, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        byte, bit = _bits(hashes, self.bits)
        np.bitwise_or.at(self.bytes, byte, np.left_shift(1, bit).astype(np.uint8))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        byte, bit = _bits(hashes, self.bits)
        return (self.bytes[byte] >> bit) & 1 > 0


def first_bits(names: Column) -> Column:
    """The first 64 bits of binary names as a number."""
    return F.conv(F.hex(F.substring(names, 1, 8)), 16, -10).cast("long")


def bitmap(hashes: DataFrame, count: int | None = None) -> Bitmap:
    """The bitmap of the only column of ``hashes``, 64-bit numbers. It is made in slices by tasks that
    stream over their rows; no more than ``2**MOST_BITS`` bits reach the driver."""
    n = hashes.count() if count is None else count
    bits = min(MOST_BITS, max(16, n.bit_length() + 4))
    low = 1 << (bits - 3 - 8)  # bytes of a slice
    name = hashes.columns[0]
    if n <= FEW:  # fewer bytes than the smallest bitmaps have; no need to deal them
        out = Bitmap(bits, {})
        out.add(hashes.toArrow().column(0).to_numpy().view(U64))
        return out

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            byte, bit = _bits(batch.column(0).to_numpy(zero_copy_only=False).view(U64), bits)
            which = byte // low
            for k in np.unique(which).tolist():
                part = parts.setdefault(k, np.zeros(low, np.uint8))
                mine = which == k
                np.bitwise_or.at(part, byte[mine] % low, np.left_shift(1, bit[mine]).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int64()), pa.array([x.tobytes() for x in parts.values()], pa.binary())],
                                         names=["slice", "bits"])

    dealt = hashes.repartition(F.shiftrightunsigned(F.col(name), 56))  # the first bits, so a slice is one task's work
    return Bitmap(bits, {r.slice: r.bits for r in dealt.mapInArrow(made, "slice bigint, bits binary").collect()})


def where(df: DataFrame, hashes: Column, held: Bitmap, hit: bool = True) -> DataFrame:
    """The rows of ``df`` whose hash is, or with ``hit`` off is not, in the bitmap; no exchange, and
    Python sees the hashes only."""
    shared = df.sparkSession.sparkContext.broadcast(held)

    @F.arrow_udf("boolean")
    def kept(hashes: pa.Array) -> pa.Array:
        return pa.array(shared.value.has(hashes.to_numpy(zero_copy_only=False).view(U64)) == hit)

    return df.where(kept(hashes))
