"""Small helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.session import materialize, release, shared_dir

__all__ = ["ascii_lower", "add_columns", "fresh", "materialize", "release", "parts", "remainder", "shared_dir", "table"]

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A to Z only, whatever the locale says about other letters."""
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` begins with it."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name += "_"
    return name


def remainder(key: str, of: int = 5) -> Column:
    """crc32 of the key written as text, modulo ``of``; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % of


def add_columns(df: DataFrame, text: str, fields: list[tuple[str, str]],
                rows: Callable[[list[bytes], list[list] | None], list], only: list[str] | None = None,
                before: list[str] | None = None, at_once: int | None = None) -> DataFrame:
    """``df`` with new columns computed batch by batch from the bytes of ``text``.

    ``rows`` gets the texts of one Arrow batch (null as empty) and returns one list per new column.
    Input columns whose name is also a new column are replaced. ``only`` limits what is carried over.
    With ``before``, ``rows`` gets the values of these input columns as a second argument. With
    ``at_once``, a batch is handled in parts of about so many bytes of text.
    """
    from gridcast.llm.textscan import as_bytes

    taken = {name.lower() for name, _ in fields}
    carried = [c for c in (only if only is not None else df.columns) if c.lower() not in taken]
    source = fresh(df, "__text")
    given = df.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text}`").cast("string").alias(source),
                      *[F.col(c).alias(source + c) for c in before or ()])
    added = T._parse_datatype_string(", ".join(f"`{n}` {t}" for n, t in fields))
    n = len(carried)
    schema = T.StructType([*given.schema.fields[:n], *added.fields])
    from pyspark.sql.pandas.types import to_arrow_schema
    kinds = [f.type for f in to_arrow_schema(added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in parts(whole, n, at_once)):
            texts = as_bytes(batch.column(n))
            new = rows(texts, [batch.column(i).to_pylist() for i in range(n + 1, batch.num_columns)] if before else None)
            columns = [batch.column(i) for i in range(n)] + [pa.array(v, k) for v, k in zip(new, kinds)]
            names = [batch.schema.field(i).name for i in range(n)] + [name for name, _ in fields]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return given.mapInArrow(run, schema)


def parts(batch: pa.RecordBatch, column: int, size: int | None) -> Iterator[pa.RecordBatch]:
    """The batch, or slices of it with at least one row and no more than ``size`` bytes of text beyond that."""
    if size is None or not batch.num_rows:
        yield batch
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    at = 0
    while at < len(lengths):
        stop, total = at, 0
        while stop < len(lengths) and (stop == at or total + lengths[stop] <= size):
            total += lengths[stop]
            stop += 1
        yield batch.slice(at, stop - at)
        at = stop
