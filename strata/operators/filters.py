"""Row filters that the source expresses with a clock or a child table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import days_before


def fresh_since(df: DataFrame, col: str, as_of, days: int) -> DataFrame:
    """Keep rows with ``col > as_of - days``; exactly ``days`` old and NULL are dropped.

    A DATE column is compared at midnight, as the source promotes DATE to DATETIME. ``as_of``
    is a literal, so the bound folds to a constant and reaches the Parquet scan as a pushed
    filter.
    """
    c = F.col(col)
    dtype = df.schema[col].dataType.typeName()
    if dtype == "date":
        c = c.cast("timestamp_ntz")
    return df.where(c > days_before(as_of, days))


def having_value(child: DataFrame, parent_key: str, value_col: str, value) -> DataFrame:
    """Parents with a given value in a child table (instead of value1/value2/... columns)."""
    return child.where(F.col(value_col) == F.lit(value)).select(parent_key).distinct()
