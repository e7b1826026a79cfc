"""S1/F19/K12/X1 on VARIANT: JSON text is parsed once, into a binary form that fields are read from.

Bronze keeps nested values as JSON text, and every query on it parses the text anew. A VARIANT column is
parsed when it is written; paths are then looked up in it (``variant_get``), and its objects and arrays
become rows by a lateral ``variant_explode``, whatever keys they have. Repeated keys of an object are
damaged JSON for ``parse_json``, which a map schema would hide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Holds the names of the columns whose text is no JSON, in ``as_variant``.
REJECTED = "_not_json"


def as_variant(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` with the JSON text of ``cols`` as VARIANT. Text that is no JSON gives NULL, and the column's
    name is listed in ``REJECTED`` (an empty list where all is well)."""
    parsed = df.select("*", *[F.try_parse_json(F.col(c)).alias(f"__v_{c}") for c in cols])
    bad = F.array_compact(F.array(*[F.when(F.col(c).isNotNull() & F.col(f"__v_{c}").isNull(), F.lit(c)) for c in cols]))
    return parsed.select(*[F.col(f"__v_{c}").alias(c) if c in cols else F.col(c) for c in df.columns], bad.alias(REJECTED))


def variant_field(col: str | Column, path: str, dtype: str = "string") -> Column:
    """the value at ``path`` (``$.a.b[0]``), NULL where it is missing, null or does not convert."""
    return F.try_variant_get(F.col(col) if isinstance(col, str) else col, path, dtype)


def variant_entries(df: DataFrame, col: str, keep: Sequence[str], fields: dict[str, tuple[str, str]], path: str = "$",
                    key_alias: str = "key", outer: bool = False) -> DataFrame:
    """A row per property of the object at ``path`` (or per element of an array, with a NULL key).

    ``fields``: output column -> (path in the property's value, type). A NULL, a missing object and one
    without properties give no rows (``outer``: one row with NULLs).
    """
    inner = df.select(*keep, F.try_variant_get(F.col(col), path, "variant").alias("__object"))
    explode = df.sparkSession.tvf.variant_explode_outer if outer else df.sparkSession.tvf.variant_explode
    rows = inner.lateralJoin(explode(F.col("__object").outer()))
    return rows.select(*keep, F.col("key").alias(key_alias),
                       *[variant_field("value", p, t).alias(name) for name, (p, t) in fields.items()])
