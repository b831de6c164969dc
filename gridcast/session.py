"""Session set-up and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; nothing here is machine specific."""
    builder = SparkSession.builder.appName("gridcast")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
ROWS, BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", 4096
_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A path for one new table in the shared folder, which every executor can reach.

    The folder is ``spark.checkpoint.dir``; where that is unset, the session's warehouse, which is
    shared as well. Everything written there goes when the session's JVM ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
        folder = f"{root.rstrip('/')}/gridcast-{uuid.uuid4().hex}"
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        store.mkdirs(path)
        store.deleteOnExit(path)
        _FOLDERS[app] = folder
    return f"{_FOLDERS[app]}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, before an operator that passes over it
    several times. Losing an executor then costs a re-read, not the whole lineage. The shuffle files of
    the write go as soon as it is done, not when the driver next collects its garbage; Python gets no more
    than ``BATCH`` rows at once."""
    path = shared_dir(df.sparkSession)
    conf = df.sparkSession.conf
    rows = int(conf.get(ROWS))
    before = {CLEANUP: conf.get(CLEANUP, "false"), ROWS: str(rows)}
    try:
        conf.set(CLEANUP, "true")
        conf.set(ROWS, str(min(rows, BATCH) if rows > 0 else BATCH))
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            conf.set(key, value)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _WRITTEN[id(out)] = (out, path)
    return out


@contextmanager
def listing(spark: SparkSession) -> Iterator[None]:
    """Within, readers list folders in a few tasks per core with many folders each. By itself Spark takes a
    task for every folder, up to 10,000, and starting these takes longer than their work."""
    conf = spark.conf
    before = conf.get(LISTING)
    try:
        conf.set(LISTING, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
        yield
    finally:
        conf.set(LISTING, before)


_WRITTEN: dict[int, tuple[DataFrame, str]] = {}


def release(*tables: DataFrame) -> None:
    """Delete tables made by :func:`materialize` before the session ends.

    Only for tables whose readers have all been written themselves: what is computed from a released
    table cannot be computed again.
    """
    for table in tables:
        _, path = _WRITTEN.pop(id(table), (None, None))
        if path:
            folder = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
