"""Dated JSON documents read with a declared schema.

A daily file is one JSON value: an array of objects (one row each) or a single object (one
row). ``multiLine`` reading handles both, but a multi-line file cannot be split, so one file is
one task; the load writes typed bronze once, so that every later stage reads a splittable,
column-pruned source. Text that is no JSON document is kept in ``CORRUPT_COLUMN`` (the rest of the
row is NULL), so that a load can tell a damaged file from an empty one.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# File naming of the daily source documents: <prefix><yyyyMMdd><suffix>.
DEFAULT_PREFIX = "card_data_"
DEFAULT_SUFFIX = ".json"


# Holds the text of a record that could not be parsed.
CORRUPT_COLUMN = "_corrupt_record"


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType(), True)])


def dated_name(as_of: _dt.date | _dt.datetime, prefix: str = DEFAULT_PREFIX, suffix: str = DEFAULT_SUFFIX) -> str:
    """The file name of the document for a run day."""
    return f"{prefix}{as_of.strftime('%Y%m%d')}{suffix}"


def dated_path(base: str, as_of, prefix: str = DEFAULT_PREFIX, suffix: str = DEFAULT_SUFFIX) -> str:
    return f"{base.rstrip('/')}/{dated_name(as_of, prefix, suffix)}"


def read_json_documents(spark: SparkSession, path: str | list[str], schema: T.StructType,
                        multi_line: bool = True, file_col: str | None = None,
                        day_col: str | None = None, day_pattern: str = r"(\d{8})",
                        keep_corrupt: bool = False) -> DataFrame:
    """JSON files -> DataFrame with the declared schema (never inferred).

    ``path`` may be any Hadoop URI, a glob, or a list. UTF-8 is the default encoding and
    ``\\u`` escapes are decoded. ``file_col`` adds the source file name; ``day_col`` adds the
    day parsed from the name (yyyyMMdd), so a multi-day read keeps each row's load day; it is NULL
    for a name without one, whatever the ANSI setting. ``keep_corrupt`` adds ``CORRUPT_COLUMN``;
    without it a damaged document raises when it is read.
    """
    reader = spark.read.option("multiLine", multi_line)
    if keep_corrupt:
        reader = (reader.schema(with_corrupt_column(schema)).option("mode", "PERMISSIVE")
                  .option("columnNameOfCorruptRecord", CORRUPT_COLUMN))
    else:
        reader = reader.schema(schema).option("mode", "FAILFAST")
    df = reader.json(path)
    if file_col or day_col:
        name = F.col("_metadata.file_name")
        if file_col:
            df = df.withColumn(file_col, name)
        if day_col:
            df = df.withColumn(day_col, F.try_to_date(F.regexp_extract(name, day_pattern, 1), "yyyyMMdd"))
    return df


def raw_json_columns(schema: T.StructType, as_text: set[str]) -> T.StructType:
    """Bronze as the source keeps it: the named nested fields as raw JSON text columns."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) if f.name in as_text else f
                         for f in schema.fields])
