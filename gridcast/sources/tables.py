"""Result tables and per-run snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def snapshot_run(df: DataFrame, root: str, run_ts: str) -> str:
    """An immutable copy of one run; a second write for the same stamp fails."""
    path = f"{root.rstrip('/')}/run_ts={run_ts}"
    df.write.mode("errorifexists").parquet(path)
    return path
