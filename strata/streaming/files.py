"""The daily batch as an available-now file stream.

The source runs once a day over one dated file. As a stream, the file source tracks which
files were processed in the checkpoint, ``trigger(availableNow=True)`` processes everything new
and stops, and ``foreachBatch`` runs the same batch operators (silver/gold loads) per
micro-batch. A retried micro-batch is safe because the fact load is an anti-join on the grain.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.sources.json_docs import CORRUPT_COLUMN

# Timestamp text layout accepted in JSON input (microseconds optional).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def file_stream(spark: SparkSession, in_dir: str, schema: T.StructType, fmt: str = "json",
                multi_line: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """New files as a stream. A JSON record that cannot be parsed raises, unless the schema has
    ``CORRUPT_COLUMN`` to keep its text."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "json":
        kept = CORRUPT_COLUMN in schema.names
        reader = reader.option("mode", "PERMISSIVE" if kept else "FAILFAST").option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        reader = reader.option("multiLine", multi_line).option("timestampNTZFormat", TS_FORMAT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(in_dir)


def run_stream(spark: SparkSession, in_dir: str, schema: T.StructType, checkpoint: str,
               batch_fn: Callable[[DataFrame, int], None], fmt: str = "json",
               multi_line: bool = True, max_files_per_trigger: int | None = None,
               transform: Callable[[DataFrame], DataFrame] | None = None,
               timeout_s: float | None = None) -> None:
    """Process every file not yet seen, then stop (exactly-once per file via the checkpoint)."""
    stream = file_stream(spark, in_dir, schema, fmt, multi_line, max_files_per_trigger)
    if transform is not None:
        stream = transform(stream)
    query = (stream.writeStream.foreachBatch(batch_fn)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError("stream did not finish in time")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def dedupe_late(stream: DataFrame, ts_col: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """T2 option: drop repeats of ``keys`` arriving within ``delay`` of each other (bounded state)."""
    return stream.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(list(keys))
