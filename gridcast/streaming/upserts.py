"""Tables that streams write by key: small deltas on top of a base that is merged now and then.

``<path>/delta/batch=N`` holds what micro-batch N delivered; a repeated batch overwrites its folder.
``<path>/base`` holds the newest row of each key up to some batch, in partitions (``_part``) and versions
(``_v``). ``<path>/heads/upto=M`` is written last: it names the version of each partition that belongs to
the base of batch M, so a merge that breaks off leaves the table as it was.

A read takes the partitions that no open delta touches as they lie, without any exchange, and merges
the others with the open deltas. A merge rewrites the touched partitions only. So what a read or a merge
costs follows from the base and the open deltas, not from the number of deliveries ever made.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers N of the complete folders ``path/name=N``."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return []
    found = [s.getPath() for s in store.listStatus(folder) if s.getPath().getName().startswith(f"{name}=")]
    return sorted(int(p.getName().split("=")[1]) for p in found if store.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


class UpsertTable:
    """``schema`` of the rows, their ``keys``, the columns whose greatest value marks the newest row (the
    batch number comes as column ``batch``), and the partition a row lies in, an SQL expression of its
    keys that many of them share, such as the day. Partitions are listed on the driver; one may be of any size."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], part: str,
                 order: Sequence[str] = ("batch",), merge_every: int = 16):
        self.spark, self.path, self.keys, self.part, self.merge_every = spark, path, list(keys), F.expr(part).cast("string"), merge_every
        self.columns = T._parse_datatype_string(schema).fieldNames()
        self.schema = f"{schema}, batch bigint"
        self.values = [c for c in [*self.columns, "batch"] if c not in self.keys]
        self.order = [*order, *[c for c in self.values if c not in order]]  # a full order, so that ties do not depend on chance

    def _head(self) -> tuple[int, dict[str, int]]:
        """The last batch in the base, and the version of each partition."""
        heads = _folders(self.spark, f"{self.path}/heads", "upto")
        if not heads:
            return -1, {}
        rows = self.spark.read.schema("part string, v bigint").parquet(f"{self.path}/heads/upto={heads[-1]}").collect()
        return heads[-1], {r.part: r.v for r in rows}

    def open_batches(self) -> list[int]:
        upto, _ = self._head()
        return [n for n in _folders(self.spark, f"{self.path}/delta", "batch") if n > upto]

    def append(self, rows: DataFrame, batch: int) -> DataFrame:
        """Store what a micro-batch delivered, and give it back as stored. A batch that is in the base
        already is a repeated one and is not stored again."""
        path = f"{self.path}/delta/batch={batch}"
        if batch > self._head()[0]:
            given = rows.select(*self.columns, self.part.alias("_part"))
            given.hint("rebalance", "_part").write.mode("overwrite").partitionBy("_part").parquet(path)
            if len(self.open_batches()) >= self.merge_every:
                self.merge()
        return self._delta([batch])

    def _delta(self, batches: list[int]) -> DataFrame:
        empty = self.spark.createDataFrame([], f"{self.schema}, _part string")
        if not batches:
            return empty
        paths = [f"{self.path}/delta/batch={n}" for n in batches]
        rows = self.spark.read.option("basePath", f"{self.path}/delta").schema(f"{self.schema}, _part string").parquet(*paths)
        return rows.select(empty.columns)

    def _base(self, versions: dict[str, int]) -> DataFrame:
        empty = self.spark.createDataFrame([], f"{self.schema}, _part string")
        if not versions:
            return empty
        rows = self.spark.read.schema(f"{self.schema}, _v bigint, _part string").parquet(f"{self.path}/base")
        return rows.where(F.concat_ws("/", "_v", "_part").isin([f"{v}/{p}" for p, v in versions.items()])).select(empty.columns)

    def newest(self, rows: DataFrame) -> DataFrame:
        """One row per key. Rows are dealt out before they are sorted: a scan's task reads many more rows from
        well-packed files than a task of the exchange gets."""
        best = F.max(F.struct(*self.order)).alias("_n")  # the order has all values, so they travel once
        dealt = rows.repartition("_part", *self.keys)
        return dealt.groupBy("_part", *self.keys).agg(best).select(*self.keys, *[f"_n.{c}" for c in self.values], "_part").select(rows.columns)

    def _state(self, parts: Iterable[str] | None) -> tuple[DataFrame, DataFrame]:
        """Rows that stand alone, and rows to be merged."""
        upto, versions = self._head()
        delta = self._delta([n for n in _folders(self.spark, f"{self.path}/delta", "batch") if n > upto])
        if parts is not None:
            parts = set(parts)
            versions, delta = {p: v for p, v in versions.items() if p in parts}, delta.where(F.col("_part").isin(sorted(parts)))
        touched = {r[0] for r in delta.select("_part").distinct().collect()}
        return (self._base({p: v for p, v in versions.items() if p not in touched}),
                self._base({p: v for p, v in versions.items() if p in touched}).unionByName(delta))

    def read(self, parts: Iterable[str] | None = None) -> DataFrame:
        """The newest row of every key, or of those in the given partitions."""
        alone, mixed = self._state(parts)
        return alone.unionByName(self.newest(mixed)).select(*self.columns)

    def merge(self) -> None:
        """Move the open deltas into the base."""
        open_ = self.open_batches()
        if not open_:
            return
        _, versions = self._head()
        _, mixed = self._state(None)
        self.newest(mixed).hint("rebalance", "_part").write.mode("overwrite").partitionBy("_part").parquet(f"{self.path}/base/_v={open_[-1]}")
        touched = {r[0]: open_[-1] for r in self._delta(open_).select("_part").distinct().collect()}
        head = self.spark.createDataFrame(list((versions | touched).items()), "part string, v bigint")
        head.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/heads/upto={open_[-1]}")

    def vacuum(self) -> None:
        """Delete deltas and versions that the newest base has taken in. No reader may still be at work on
        an older one."""
        upto, versions = self._head()
        for n in _folders(self.spark, f"{self.path}/delta", "batch"):
            if n < upto:  # the last batch may be repeated
                _delete(self.spark, f"{self.path}/delta/batch={n}")
        for n in _folders(self.spark, f"{self.path}/heads", "upto"):
            if n < upto:
                _delete(self.spark, f"{self.path}/heads/upto={n}")
        live = set(versions.values())
        for n in _folders(self.spark, f"{self.path}/base", "_v"):
            if n < upto and n not in live:
                _delete(self.spark, f"{self.path}/base/_v={n}")
