"""The date dimension.

The source builds the day spine with a recursive CTE; here it is ``spark.range`` over the day
count, so the spine is generated in parallel across tasks rather than by one generator row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalars import date_key, is_month_end, is_weekend, month_name, weekday_name

# Span used by the source's date dimension.
DEFAULT_START = _dt.date(2000, 1, 1)
DEFAULT_END = _dt.date(2050, 12, 31)

DATE_DIM_COLUMNS = ["date_id", "full_date", "day_number", "month_number", "month_name", "quarter",
                    "year_number", "day_of_week_name", "is_weekend", "is_month_end"]


def day_spine(spark: SparkSession, start: _dt.date, end: _dt.date, alias: str = "full_date",
              num_partitions: int | None = None) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive."""
    days = (end - start).days + 1
    if days <= 0:
        return spark.range(0).select(F.lit(None).cast("date").alias(alias))
    parts = num_partitions or max(1, min(days // 4096 + 1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spark.range(0, days, 1, parts).select(
        F.date_add(F.lit(start.isoformat()).cast("date"), F.col("id").cast("int")).alias(alias))


def date_attributes(spine: DataFrame, col: str = "full_date") -> DataFrame:
    """The nine calendar attributes of each day."""
    d = F.col(col)
    return spine.select(
        date_key(d).alias("date_id"),
        d.alias("full_date"),
        F.dayofmonth(d).alias("day_number"),
        F.month(d).alias("month_number"),
        month_name(d).alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year_number"),
        weekday_name(d).alias("day_of_week_name"),
        is_weekend(d).alias("is_weekend"),
        is_month_end(d).alias("is_month_end"),
    )


def date_dimension(spark: SparkSession, start: _dt.date = DEFAULT_START,
                   end: _dt.date = DEFAULT_END) -> DataFrame:
    """H2 + D7: ``dim_dates`` for ``start``..``end``."""
    return date_attributes(day_spine(spark, start, end))


def date_dimension_covering(df: DataFrame, *cols: str) -> DataFrame:
    """The date dimension spanning the min..max of the given date/timestamp columns of ``df``.

    One aggregate row (two scalars) reaches the driver; the spine itself is generated on the
    executors.
    """
    mins = [F.min(F.to_date(F.col(c))) for c in cols]
    maxs = [F.max(F.to_date(F.col(c))) for c in cols]
    lo_hi = df.agg(F.least(*mins).alias("lo") if len(mins) > 1 else mins[0].alias("lo"),
                   F.greatest(*maxs).alias("hi") if len(maxs) > 1 else maxs[0].alias("hi")).first()
    if lo_hi is None or lo_hi["lo"] is None:
        return date_attributes(df.sparkSession.range(0).select(F.lit(None).cast("date").alias("full_date")))
    return date_dimension(df.sparkSession, lo_hi["lo"], lo_hi["hi"])
