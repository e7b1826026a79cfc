"""Versioned snapshots of a table and restore with keys kept.

The source copies a fact or dimension into a temp table (joined to a dimension to rebuild
columns) and re-inserts it, which lets IDENTITY renumber the keys and orphans the facts. Here a
snapshot is a Parquet directory per version and a restore returns it unchanged, keys included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def snapshot_path(base: str, version: str) -> str:
    return f"{base.rstrip('/')}/snapshot={version}"


def snapshot(df: DataFrame, base: str, version: str, enrich: DataFrame | None = None,
             on: str | list[str] | None = None) -> str:
    """Write ``df`` (optionally left-joined to ``enrich`` on ``on``) as a snapshot."""
    out = df.join(enrich, on, "left") if enrich is not None else df
    path = snapshot_path(base, version)
    out.write.mode("overwrite").parquet(path)
    return path


def restore(spark: SparkSession, base: str, version: str) -> DataFrame:
    """The snapshot as stored, surrogate keys kept."""
    return spark.read.parquet(snapshot_path(base, version))
