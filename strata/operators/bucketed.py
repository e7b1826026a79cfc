"""D3-D6 at scale: a type-1 dimension in hash buckets, of which a merge rewrites only those that change.

A row's bucket is a hash of its natural key. The layer's manifest names the folder of every bucket, so a
merge writes new folders for the buckets that hold a changed or a new row, in one job, and its commit
points these buckets to them; all others stay as they are (copy on write). Which rows have changed is
seen from a digest that is kept with each row: the comparison reads two narrow columns of the dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.dims import dense_numbering
from strata.sources.commits import BUCKET, LayerCommit
from strata.sources.tables import version_path

DIGEST, _BUCKET = "__digest", "__bucket"
_COUNT = ".buckets"


def _digest(columns: list[str]) -> Column:
    """128 bits of all values; a NULL differs from every value."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def _bucket(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(n)).cast("int")


def _folders(layer: LayerCommit, table: str) -> dict[int, str]:
    prefix = table + BUCKET
    return {int(name[len(prefix):]): f"{version_path(layer.path(table), versions[-1])}/{_BUCKET}={int(name[len(prefix):])}"
            for name, versions in layer.parts(prefix).items()}


def _read(layer: LayerCommit, table: str, folders: list[str]) -> DataFrame | None:
    if not folders:
        return None
    return layer.spark.read.option("basePath", layer.path(table)).parquet(*folders).drop("__version")


def read_bucketed(layer: LayerCommit, table: str) -> DataFrame | None:
    """All rows of the dimension; None before the first merge."""
    rows = _read(layer, table, list(_folders(layer, table).values()))
    return None if rows is None else rows.drop(_BUCKET, DIGEST)


def merge_bucketed(layer: LayerCommit, table: str, source: DataFrame, natural_key: str, key_col: str,
                   load_ts_col: str | None = None, load_ts=None, n_buckets: int = 256) -> list[int]:
    """D2/D3 into ``table`` of ``layer``, seen when that is committed; returns the buckets written anew.

    As ``merge_type1``: a matched row takes the source's values (a NULL too), an unmatched one is inserted with
    the next key in natural-key order, and rows missing from the source stay. But a row whose values
    are the same stays as it is, its ``load_ts_col`` too, and so do buckets without a change. ``source`` has
    one row per natural key; rows with a NULL key are left out. ``n_buckets`` is fixed by the first merge;
    a merge lists the buckets that change, so at most that many numbers, on the driver.
    """
    values = [c for c in source.columns if c not in (natural_key, key_col, load_ts_col)]
    folders = _folders(layer, table)
    known = layer.parts(table + _COUNT)
    n_buckets = known[table + _COUNT][-1] if known else n_buckets
    source = source.where(F.col(natural_key).isNotNull()).select(
        natural_key, *values, _digest(values).alias(DIGEST), _bucket(natural_key, n_buckets).alias(_BUCKET))
    stored = _read(layer, table, list(folders.values()))
    if stored is None:
        changed, top = source, 0
    else:
        old = stored.select(natural_key, F.col(DIGEST).alias("__old"))
        changed = source.join(old, natural_key, "left").where(~F.col("__old").eqNullSafe(F.col(DIGEST)))
        top = stored.agg(F.max(key_col)).first()[0] or 0
    buckets = sorted(r[0] for r in changed.select(_BUCKET).distinct().collect())
    if not buckets:
        return []
    rows = source.where(F.col(_BUCKET).isin(buckets))
    here = _read(layer, table, [folders[b] for b in buckets if b in folders])
    inserted = rows.select(natural_key) if here is None else rows.select(natural_key).join(here.select(natural_key), natural_key, "left_anti")
    keys = dense_numbering(inserted, [natural_key], "__new_key", start=int(top))
    stamp = F.lit(load_ts).cast("timestamp_ntz")
    if here is None:
        merged = rows.join(keys, natural_key).select(
            F.col("__new_key").alias(key_col), natural_key, *values, DIGEST, _BUCKET, *([stamp.alias(load_ts_col)] if load_ts_col else []))
    else:
        s = rows.select(F.col(natural_key).alias("__key"), *[F.col(c).alias(f"s__{c}") for c in [*values, DIGEST, _BUCKET]])
        j = here.join(s, F.col(natural_key) == F.col("__key"), "full_outer").withColumn(
            natural_key, F.coalesce(F.col(natural_key), F.col("__key"))).join(keys, natural_key, "left")
        new = F.col("__key").isNotNull() & ~F.col(DIGEST).eqNullSafe(F.col(f"s__{DIGEST}"))
        pick = lambda c: F.when(new, F.col(f"s__{c}")).otherwise(F.col(c)).alias(c)
        merged = j.select(F.coalesce(F.col(key_col), F.col("__new_key")).cast("long").alias(key_col), natural_key,
                          *[pick(c) for c in [*values, DIGEST, _BUCKET]],
                          *([F.when(new, stamp).otherwise(F.col(load_ts_col)).alias(load_ts_col)] if load_ts_col else []))
    version = layer.write(merged.hint("rebalance", _BUCKET), table, partition_by=[_BUCKET])
    for b in buckets:
        layer.point(f"{table}{BUCKET}{b:06d}", version)
    layer.point(table + _COUNT, n_buckets)
    return buckets
