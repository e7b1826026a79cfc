"""Surrogate keys and type-1 dimension merges on plain Parquet.

Surrogate keys behave like ``IDENTITY(1,1)``: a natural key keeps its key forever; new
natural keys get ``max(existing) + 1, + 2, ...`` in natural-key order. The numbering never
runs a global single-partition window: new keys are range-partitioned and sorted, each task
numbers its slice, and a table with one row per task (bounded by the partition count, so safe
to broadcast) supplies the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir, growing, working_partitions


def dense_numbering(keys: DataFrame, order: Sequence[str], alias: str, start: int | None = 0,
                    start_col=None, num_partitions: int | None = None) -> DataFrame:
    """Number the rows of ``keys`` 1..N in ``order`` (a total order), plus ``start``.

    ``start_col`` may be a one-row DataFrame column instead of a Python int.
    """
    spark = keys.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or working_partitions(spark)
    ranged = (keys.repartitionByRange(n, *order)
              .sortWithinPartitions(*order)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__mono", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    local = ranged.withColumn("__idx", F.col("__mono") - F.shiftleft(F.col("__pid").cast("long"), 33))
    per_task = local.groupBy("__pid").agg(F.count("*").alias("__n"))
    # One row per task: a bounded table, numbered with a single small window.
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    joined = local.join(F.broadcast(offsets), "__pid")
    base = F.lit(start or 0) if start_col is None else start_col
    number = (base + F.col("__off") + F.col("__idx") + F.lit(1)).cast("long")
    return joined.select(*keys.columns, number.alias(alias))


def assign_keys(df: DataFrame, natural_key: str, key_col: str,
                existing: DataFrame | None = None) -> DataFrame:
    """A (natural_key, key_col) map covering every natural key of ``df``.

    ``existing`` is the current map; its keys are kept. Returns the full map (existing plus
    new), one row per natural key.
    """
    nk = df.select(natural_key).where(F.col(natural_key).isNotNull()).distinct()
    if existing is None:
        return dense_numbering(nk, [natural_key], key_col, start=0)
    old = existing.select(natural_key, key_col)
    new_nk = nk.join(growing(old), natural_key, "left_anti")
    top = old.agg(F.coalesce(F.max(key_col), F.lit(0)).alias("__max")).first()["__max"]
    fresh = dense_numbering(new_nk, [natural_key], key_col, start=int(top))
    return old.unionByName(fresh.select(natural_key, key_col))


def merge_type1(target: DataFrame | None, source: DataFrame, natural_key: str, key_col: str | None,
                load_ts_col: str | None = None, load_ts=None) -> DataFrame:
    """D3: type-1 merge. Matched rows take the source row whole (a source NULL overwrites);
    unmatched source rows are inserted with new keys; target rows missing from the source are
    kept unchanged (discontinued members stay). ``key_col=None``: no surrogate key (the
    natural key is the primary key).

    Presence is decided per row with a marker column, not per value with ``coalesce``, so a
    NULL in the source still replaces a target value. A NULL natural key names nobody: such source
    rows are left out (the load reports them as rejects), and so are such target rows.
    """
    source = source.where(F.col(natural_key).isNotNull())
    target = None if target is None else target.where(F.col(natural_key).isNotNull())
    value_cols = [c for c in source.columns if c not in (natural_key, key_col, load_ts_col)]
    key_part = [key_col] if key_col else []
    tgt_cols = [*key_part, natural_key, *value_cols] + ([load_ts_col] if load_ts_col else [])
    if target is None:
        out = source
        if key_col:
            out = out.join(growing(assign_keys(source, natural_key, key_col)), natural_key, "left")
        if load_ts_col:
            out = out.withColumn(load_ts_col, F.lit(load_ts).cast("timestamp_ntz"))
        return out.select(*tgt_cols)
    src = source.select(natural_key, *value_cols).withColumn("__in_src", F.lit(True))
    tgt = target.select(*tgt_cols).withColumn("__in_tgt", F.lit(True))
    s = src.select(*[F.col(c).alias(f"s__{c}") for c in src.columns])
    t = tgt.select(*[F.col(c).alias(f"t__{c}") for c in tgt.columns])
    j = t.join(growing(s), t[f"t__{natural_key}"] == s[f"s__{natural_key}"], "full_outer")
    in_src = F.col("s____in_src").isNotNull()
    nk = F.coalesce(F.col(f"t__{natural_key}"), F.col(f"s__{natural_key}"))
    merged = j.select(
        *([F.col(f"t__{key_col}").alias(key_col)] if key_col else []),
        nk.alias(natural_key),
        *[F.when(in_src, F.col(f"s__{c}")).otherwise(F.col(f"t__{c}")).alias(c) for c in value_cols],
        *([F.when(in_src, F.lit(load_ts).cast("timestamp_ntz"))
           .otherwise(F.col(f"t__{load_ts_col}")).alias(load_ts_col)] if load_ts_col else []),
    )
    if not key_col:
        return merged.select(*tgt_cols)
    # Keys for inserted rows only; existing keys never change.
    top = target.agg(F.coalesce(F.max(key_col), F.lit(0)).alias("m")).first()["m"]
    # New members = source keys absent from the target (an anti-join, not a second full merge).
    inserts = (source.select(natural_key).where(F.col(natural_key).isNotNull()).distinct()
               .join(growing(target.select(natural_key)), natural_key, "left_anti"))
    fresh = dense_numbering(inserts, [natural_key], "__new_key", start=int(top))
    out = merged.join(growing(fresh), natural_key, "left").select(
        F.coalesce(F.col(key_col), F.col("__new_key")).cast("long").alias(key_col),
        *[c for c in merged.columns if c != key_col])
    return out.select(*tgt_cols)
