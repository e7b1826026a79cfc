"""Landing paged API responses as a deduplicated, splittable table.

A paged extractor saves responses ``{"data": [...], ...}`` as files; after a resume the last
partial page is fetched again, so the same item can appear on two pages. This job reads every
page file with a declared schema, explodes ``data`` and keeps one row per item key (the one
from the latest page), then writes Parquet. Dedupe is a partial aggregate (``max_by``), so a key
repeated on many pages is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.windows import keep_one
from strata.sources.json_docs import CORRUPT_COLUMN


def page_schema(item_schema: T.StructType, items_field: str = "data") -> T.StructType:
    return T.StructType([
        T.StructField(items_field, T.ArrayType(item_schema)),
        T.StructField("page", T.LongType()),
        T.StructField(CORRUPT_COLUMN, T.StringType()),
    ])


# Timestamp text layout accepted in page files (microseconds optional).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def read_pages(spark: SparkSession, page_dir: str, item_schema: T.StructType,
               items_field: str = "data", multi_line: bool = False,
               ts_format: str = TS_FORMAT) -> DataFrame:
    """All items of all pages, with the page number (field ``page`` or from the file name) and the
    text of a page that is no JSON document (``CORRUPT_COLUMN``; such a page is one row)."""
    pages = (spark.read.schema(page_schema(item_schema, items_field))
             .option("multiLine", multi_line).option("columnNameOfCorruptRecord", CORRUPT_COLUMN).option("timestampNTZFormat", ts_format).json(page_dir))
    page_no = F.coalesce(F.col("page"),
                         F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)", 1).try_cast("long"))
    rows = pages.select(page_no.alias("__page"), F.col("_metadata.file_name").alias("__file"), CORRUPT_COLUMN,
                        F.posexplode_outer(items_field).alias("__pos", "__item"))
    return (rows.where(F.col("__pos").isNotNull() | F.col(CORRUPT_COLUMN).isNotNull())
            .select("__page", "__file", "__pos", CORRUPT_COLUMN, "__item.*"))


def land_pages(spark: SparkSession, page_dir: str, item_schema: T.StructType, key: str,
               out: str | None = None, items_field: str = "data", multi_line: bool = False,
               ts_format: str = TS_FORMAT, keep_corrupt: bool = False) -> DataFrame:
    """Items from page files, one per ``key`` (latest page, then latest position wins).

    A damaged page raises; with ``keep_corrupt`` it gives a row with its text in ``CORRUPT_COLUMN``.
    """
    items = read_pages(spark, page_dir, item_schema, items_field, multi_line, ts_format)
    text = F.col(CORRUPT_COLUMN)
    if not keep_corrupt:
        broken = F.raise_error(F.concat(F.lit("damaged page file "), F.col("__file"))).cast("string")
        items = items.withColumn(CORRUPT_COLUMN, F.when(text.isNotNull(), broken))
    one = keep_one(items, [key, CORRUPT_COLUMN], ["__page", "__file", "__pos"], latest=True)
    names = [f.name for f in item_schema.fields] + ([CORRUPT_COLUMN] if keep_corrupt else [])
    result = one.select(*names)
    if out:
        result.write.mode("overwrite").parquet(out)
        return spark.read.parquet(out)
    return result
