"""Q1-Q6: data-quality reports and the run audit.

Reports are DataFrames (distributed, lazy); only audit rows and counters reach the driver.
``strict`` variants raise inside the job with ``raise_error``, as a constraint violation in
the source database aborts the load.
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_violations(df: DataFrame, keys: Sequence[str], count_alias: str = "n_rows") -> DataFrame:
    """Q1: keys occurring more than once (partial aggregation, skew-safe)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_alias))
            .where(F.col(count_alias) > 1))


def null_violations(df: DataFrame, cols: Sequence[str], reason_alias: str = "null_columns") -> DataFrame:
    """Q2: rows with a NULL in any of ``cols``, with the offending column names."""
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]))
    cond = None
    for c in cols:
        e = F.col(c).isNull()
        cond = e if cond is None else cond | e
    return df.where(cond).withColumn(reason_alias, names)


def length_violations(df: DataFrame, limits: Mapping[str, int], reason_alias: str = "too_long") -> DataFrame:
    """Q3: rows with a text longer than its declared limit."""
    names = F.array_compact(F.array(*[F.when(F.length(F.col(c)) > n, F.lit(c)) for c, n in limits.items()]))
    cond = None
    for c, n in limits.items():
        e = F.length(F.col(c)) > n
        cond = e if cond is None else cond | e
    return df.where(cond).withColumn(reason_alias, names)


def cast_rejects(df: DataFrame, col: str | Column, dtype: str, converted: Column | None = None) -> DataFrame:
    """Q4: rows whose non-NULL source does not convert (``converted`` defaults to try_cast)."""
    src = F.col(col) if isinstance(col, str) else col
    conv = converted if converted is not None else src.try_cast(dtype)
    return df.where(src.isNotNull() & conv.isNull())


def enforce(df: DataFrame, violation: Column, message: str) -> DataFrame:
    """Strict mode: fail the job when any row violates (checked on the executors).

    The check is a filter predicate, so the optimizer cannot prune it away as it would an
    unused column.
    """
    return df.where(F.when(violation, F.raise_error(F.lit(message))).otherwise(F.lit(True)))


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q6: one row per column with row, NULL, untrimmed and blank counts, in one pass."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(cols):
        s = F.col(c).cast("string")
        aggs += [F.count_if(F.col(c).isNull()).alias(f"n{i}"),
                 F.count_if(F.trim(s) != s).alias(f"u{i}"),
                 F.count_if(F.trim(s) == F.lit("")).alias(f"b{i}")]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', n{i}, u{i}, b{i}" for i, c in enumerate(cols))
    return one.selectExpr(
        "n_rows", f"stack({len(cols)}, {stack}) as (column_name, n_null, n_untrimmed, n_blank)"
    ).select("column_name", "n_rows", "n_null", "n_untrimmed", "n_blank")


AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("step", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("ended_at", T.TimestampNTZType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("message", T.StringType()),
])


class RunAudit:
    """Q5: one audit row per step (start, end, seconds, status, row count).

    Row counts come from ``Observation`` metrics collected while the step's own write runs,
    so counting costs no extra job. Errors are recorded and re-raised (never swallowed).
    """

    def __init__(self, spark: SparkSession, run_id: str, table_dir: str | None = None):
        self.spark = spark
        self.run_id = run_id
        self.table_dir = table_dir
        self.rows: list[tuple] = []
        self._flushed = 0

    def observe(self, df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
        obs = Observation(name)
        return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs

    def step(self, name: str, fn, *args, _obs: Observation | None = None, **kwargs):
        start = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        t0 = time.perf_counter()
        try:
            result = fn(*args, **kwargs)
        except Exception as exc:  # recorded, then re-raised
            self._add(name, start, t0, "failed", None, str(exc))
            self.flush()
            raise
        rows, why = self._observed_rows(_obs)
        self._add(name, start, t0, "succeeded", rows, why)
        return result

    @staticmethod
    def _observed_rows(obs: Observation | None) -> tuple[int | None, str | None]:
        """(rows, None), or (None, why the count is missing). The count is audit metadata: a metric
        that cannot be read (jobs of one session may run concurrently) does not fail the load."""
        if obs is None:
            return None, None
        try:
            value = obs.get.get("rows")
        except Exception as exc:
            return None, f"row count not read: {exc}"
        return (int(value), None) if value is not None else (None, "row count not read: no metric arrived")

    def write(self, name: str, df: DataFrame, writer):
        """Run ``writer(df)`` as a step, counting the rows it writes as a side metric."""
        observed, obs = self.observe(df, name.replace(".", "_"))
        return self.step(name, writer, observed, _obs=obs)

    def _add(self, name, start, t0, status, rows, message):
        end = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        self.rows.append((self.run_id, name, start, end, time.perf_counter() - t0, status, rows, message))

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, AUDIT_SCHEMA)

    def flush(self) -> None:
        pending = self.rows[self._flushed:]
        if self.table_dir and pending:
            self.spark.createDataFrame(pending, AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(self.table_dir)
            self._flushed = len(self.rows)


# Sizes of the sketches: HLL with 2^12 registers (standard error 1.6 %), KLL with k = 200 (rank error 1.7 %).
HLL_BITS, KLL_K = 12, 200


def profile_day(df: DataFrame, cols: Sequence[str], day) -> DataFrame:
    """Q6/Q1 as a part of a run day's audit: per column the exact counts, lengths, and sketches of its values
    (``distinct``: HLL) and of its numbers, or of its text lengths (``spread``: KLL), in one pass.

    Rows of several days are merged by ``merge_profiles`` without a look at the data. A column of
    NULLs has empty sketches.
    """
    types = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(cols):
        s = F.col(c).cast("string")
        number = s.try_cast("double") if types[c] not in ("string", "date", "timestamp", "timestamp_ntz") else F.length(s).cast("double")
        aggs += [F.count_if(F.col(c).isNull()).alias(f"n_null{i}"), F.count_if(F.trim(s) != s).alias(f"n_untrimmed{i}"),
                 F.count_if(F.trim(s) == F.lit("")).alias(f"n_blank{i}"), F.max(F.length(s)).cast("long").alias(f"longest{i}"),
                 F.hll_sketch_agg(s, F.lit(HLL_BITS)).alias(f"distinct{i}"), F.kll_sketch_agg_double(number, F.lit(KLL_K)).alias(f"spread{i}")]
    names = ("n_null", "n_untrimmed", "n_blank", "longest", "distinct", "spread")
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), *[F.col(f"{n}{i}").alias(n) for n in names]) for i, c in enumerate(cols)])
    return one.select(F.lit(day).cast("date").alias("day"), "n_rows", F.explode(rows).alias("c")).select("day", "n_rows", "c.*")


def merge_profiles(profiles: DataFrame, first_day=None, last_day=None, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column over the days from ``first_day`` to ``last_day`` (both counted): counts are sums,
    ``n_distinct`` and the quantiles (``q25``, ...) are estimates from the merged sketches."""
    if first_day is not None:
        profiles = profiles.where(F.col("day") >= F.lit(first_day))
    if last_day is not None:
        profiles = profiles.where(F.col("day") <= F.lit(last_day))
    merged = profiles.groupBy("column_name").agg(
        *[F.sum(n).alias(n) for n in ("n_rows", "n_null", "n_untrimmed", "n_blank")], F.max("longest").alias("longest"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"), F.kll_merge_agg_double("spread").alias("__spread"))
    some = F.kll_sketch_get_n_double("__spread") > 0
    return merged.select("*", *[F.when(some, F.kll_sketch_get_quantile_double("__spread", F.lit(float(q)))).alias(f"q{round(100 * q)}")
                                for q in quantiles]).drop("__spread")
