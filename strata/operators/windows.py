"""Per-group numbering, counting and best-row selection, written to survive hot keys.

Window functions put a whole partition-by group into one task. When a single key can hold a
third of all rows that task becomes the whole job, so these operators use aggregations with
map-side combine plus joins (which AQE can split on skew), or a range-partitioned numbering
whose groups span many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir, growing, working_partitions


def _cols(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def count_within(df: DataFrame, keys: str | Sequence[str], counted: str, alias: str) -> DataFrame:
    """``COUNT(counted) OVER (PARTITION BY keys)`` on every row, rows not collapsed.

    NULL keys form their own group; NULL ``counted`` values count 0. Computed as a partial
    aggregation joined back on the keys (null-safe), so a hot key is pre-aggregated map-side
    and the join-back can be split by AQE.
    """
    keys = _cols(keys)
    counts = df.groupBy(*keys).agg(F.count(F.col(counted)).alias(alias))
    c = counts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], alias)
    cond = None
    for i, k in enumerate(keys):
        e = df[k].eqNullSafe(c[f"__k{i}"])
        cond = e if cond is None else cond & e
    joined = df.join(growing(c), cond, "inner")
    return joined.select(*df.columns, alias)


def keep_lowest(df: DataFrame, keys: str | Sequence[str], order_col: str,
                nulls_first: bool = True) -> DataFrame:
    """Rows whose ``order_col`` ranks first within ``keys`` (ties kept).

    Equals ``RANK() OVER (PARTITION BY keys ORDER BY order_col) = 1``. With ``nulls_first``
    (ascending order in both the source database and Spark) a group holding a NULL keeps its NULL rows.
    """
    keys = _cols(keys)
    best = df.groupBy(*keys).agg(
        F.min(order_col).alias("__min"),
        F.max(F.col(order_col).isNull().cast("int")).alias("__has_null"))
    b = best.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__min", "__has_null")
    cond = None
    for i, k in enumerate(keys):
        e = df[k].eqNullSafe(b[f"__k{i}"])
        cond = e if cond is None else cond & e
    if nulls_first:
        pick = ((b["__has_null"] == 1) & df[order_col].isNull()) | \
               ((b["__has_null"] == 0) & (df[order_col] == b["__min"]))
    else:
        pick = (df[order_col] == b["__min"]) | (b["__min"].isNull() & df[order_col].isNull())
    return df.join(b, cond & pick, "inner").select(*df.columns)


def keep_one(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column | str],
             latest: bool = True) -> DataFrame:
    """One row per key, the greatest (``latest``) or least by ``order`` (a total order:
    pass tiebreak columns). ``max_by`` is a partial aggregate, so hot keys combine map-side.
    """
    keys = _cols(keys)
    others = [c for c in df.columns if c not in keys]
    order_struct = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    row = F.struct(*[F.col(c) for c in others])
    pick = F.max_by(row, order_struct) if latest else F.min_by(row, order_struct)
    out = df.groupBy(*keys).agg(pick.alias("__row"))
    return out.select(*keys, *[F.col("__row").getField(c).alias(c) for c in others]).select(*df.columns)


def number_within(df: DataFrame, keys: str | Sequence[str], order: Sequence[str],
                  alias: str = "row_number", num_partitions: int | None = None,
                  method: str = "range") -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order)``; ``order`` must end in a
    tiebreak that makes it total, so numbers do not depend on partitioning.

    ``method="range"`` (default) splits every group across tasks: rows are range-partitioned
    on (keys, order) and checkpointed, each task numbers its rows locally, and a small table of
    per-(task, key) counts gives each key's offset in earlier tasks. ``method="window"`` is the
    plain window, right when no key is hot.
    """
    keys = _cols(keys)
    order = list(order)
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(alias, F.row_number().over(w).cast("long"))
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or working_partitions(spark)
    # Range partitions are contiguous in (keys, order): partition p holds an ordered slice.
    sorted_df = (df.repartitionByRange(n, *keys, *order)
                 .sortWithinPartitions(*keys, *order)
                 .withColumn("__pid", F.spark_partition_id())
                 .withColumn("__mono", F.monotonically_increasing_id())
                 .checkpoint(eager=True))
    # Position within the task: the generated id is (task << 33) + index-in-task.
    local = sorted_df.withColumn("__idx", F.col("__mono") - F.shiftleft(F.col("__pid").cast("long"), 33))
    spans = local.groupBy("__pid", *keys).agg(F.min("__idx").alias("__first"), F.count("*").alias("__n"))
    # Rows of one key in earlier tasks: at most one spans-row per (task, key), so this window
    # handles at most num_partitions rows per key.
    prior = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("__before", F.coalesce(F.sum("__n").over(prior), F.lit(0)))
    on = ["__pid"] + keys
    s = spans.select(*[F.col(c).alias(f"__s{i}") for i, c in enumerate(on)], "__first", "__before")
    cond = None
    for i, c in enumerate(on):
        e = local[c].eqNullSafe(s[f"__s{i}"])
        cond = e if cond is None else cond & e
    joined = local.join(s, cond, "inner")
    # BIGINT, as ROW_NUMBER in the source: one hot key may exceed 2^31 rows at scale.
    number = (F.col("__before") + F.col("__idx") - F.col("__first") + F.lit(1)).cast("long")
    return joined.select(*df.columns, number.alias(alias))
