"""D8/J5 and the source's indexes, as file layout: a clustered fact whose files can be skipped.

The source keeps an index on the key of its history. Here rows are laid out along a Morton (Z-order) curve
over some columns: each column is ranked by quantiles, the bits of the ranks are interleaved, and files hold
ranges of the result. A file then has a narrow range in every one of the columns, not only in the first.
The least and greatest values of each file are kept beside the table; a reader with conditions on any of
the columns opens only the files that can hold such rows. Within a file, Parquet drops row groups by their
statistics and, for single values, by Bloom filters.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_STATS = ".files"


def _number(col: str, dtype: str) -> Column:
    c = F.col(col)
    return F.unix_date(c).cast("double") if dtype == "date" else c.cast("double")


def morton(df: DataFrame, cols: Sequence[str], bits: int = 8, error: float = 0.001) -> Column:
    """The place of a row on the curve over ``cols`` (numbers or dates): ``bits`` bits of each column's rank.

    Ranks come from approximate quantiles, so skewed values are spread evenly; the driver sees
    2^bits - 1 numbers per column. NULL ranks first.
    """
    types = dict(df.dtypes)
    numbers = df.select(*[_number(c, types[c]).alias(c) for c in cols])
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    bounds = numbers.approxQuantile(list(cols), steps, error)
    place = F.lit(0).cast("long")
    for j, (c, b) in enumerate(zip(cols, bounds)):
        rank = _rank(_number(c, types[c]), sorted(set(b)))
        for i in range(bits):
            place = place + F.shiftleft(F.shiftright(rank, i).bitwiseAND(F.lit(1)).cast("long"), i * len(cols) + j)
    return place


def _rank(value: Column, bounds: list[float]) -> Column:
    """How many of ``bounds`` are below ``value``, by halving."""
    def part(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value > F.lit(bounds[mid]), part(mid + 1, hi)).otherwise(part(lo, mid))

    return F.when(value.isNull(), F.lit(0)).otherwise(part(0, len(bounds)))


def write_clustered(df: DataFrame, path: str, cols: Sequence[str], files: int, bloom: Sequence[str] = (), bits: int = 8,
                    distinct: int = 1_000_000) -> None:
    """``df`` in about ``files`` files along the curve over ``cols``, with the files' ranges beside it.

    bloom: columns with a Bloom filter for up to ``distinct`` values in each row group.
    """
    placed = df.withColumn("__place", morton(df, cols, bits))
    out = placed.repartitionByRange(files, "__place").sortWithinPartitions("__place", *cols).drop("__place").write
    for c in bloom:
        out = out.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", str(distinct))
    out.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    ranges = [f(c).alias(f"{name}_{c}") for c in cols for name, f in (("least", F.min), ("most", F.max))]
    (rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"), *ranges)
     .coalesce(1).write.parquet(path.rstrip("/") + _STATS))  # a row per file


def read_clustered(spark: SparkSession, path: str, **within) -> DataFrame:
    """Rows whose columns lie within bounds: ``card_key=7`` or ``date_id=(low, high)``, both ends counted, None open.

    Only files whose ranges meet all bounds on clustered columns are opened; the conditions are also pushed to the scan.
    """
    stats = spark.read.parquet(path.rstrip("/") + _STATS)
    pairs = {c: v if isinstance(v, tuple) else (v, v) for c, v in within.items()}
    known = [(c, lo, hi) for c, (lo, hi) in pairs.items() if f"least_{c}" in stats.columns]
    meets = [x for c, lo, hi in known for x in (
        *([F.col(f"most_{c}") >= F.lit(lo)] if lo is not None else []), *([F.col(f"least_{c}") <= F.lit(hi)] if hi is not None else []))]
    # The names of the files that are read anyway.
    files = [r.file for r in stats.where(reduce(lambda a, b: a & b, meets)).select("file").collect()] if meets else [path]
    schema = spark.read.parquet(path).schema
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for c, (lo, hi) in pairs.items():
        if lo is not None and lo == hi:
            rows = rows.where(F.col(c) == F.lit(lo))  # what Bloom filters answer
            continue
        rows = rows if lo is None else rows.where(F.col(c) >= F.lit(lo))
        rows = rows if hi is None else rows.where(F.col(c) <= F.lit(hi))
    return rows
