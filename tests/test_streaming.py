"""Available-now file stream into an idempotent append-only fact."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import functions as sf
from strata.operators import new_facts
from strata.sources import append_table, read_table
from strata.streaming import dedupe_late, file_stream, run_stream

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("day", T.StringType()),
                       T.StructField("price", T.DoubleType())])


def _write(path, rows):
    with open(path, "w") as fh:
        json.dump(rows, fh)


def test_available_now_idempotent(spark, tmp_root):
    src = os.path.join(tmp_root, "in")
    os.makedirs(src)
    sink = os.path.join(tmp_root, "fact")
    _write(os.path.join(src, "d1.json"), [{"id": "a", "day": "2026/01/08", "price": 1.0},
                                          {"id": "b", "day": "2026/01/08", "price": 2.0}])

    def load(batch, _epoch):
        rows = batch.select("id", sf.date_key(sf.parse_date("day")).alias("date_id"), "price")
        append_table(new_facts(rows, read_table(spark, sink), ["date_id", "id"], prune_col="date_id"), sink,
                     partition_by=["date_id"])

    ck = os.path.join(tmp_root, "ck")
    run_stream(spark, src, SCHEMA, ck, load)
    assert read_table(spark, sink).count() == 2
    # A new day's file: only it is processed (the checkpoint remembers d1.json).
    _write(os.path.join(src, "d2.json"), [{"id": "a", "day": "2026/01/09", "price": 1.5}])
    run_stream(spark, src, SCHEMA, ck, load)
    assert read_table(spark, sink).count() == 3
    # Replaying everything with a fresh checkpoint adds nothing: the load is an anti-join.
    run_stream(spark, src, SCHEMA, os.path.join(tmp_root, "ck2"), load)
    assert read_table(spark, sink).count() == 3


def test_dedupe_within_watermark(spark, tmp_root):
    src = os.path.join(tmp_root, "ev")
    os.makedirs(src)
    _write(os.path.join(src, "e.json"), [{"id": "x", "day": "2026-01-08 10:00:00", "price": 1.0},
                                         {"id": "x", "day": "2026-01-08 10:05:00", "price": 1.0},
                                         {"id": "y", "day": "2026-01-08 10:06:00", "price": 2.0}])
    stream = file_stream(spark, src, SCHEMA).withColumn("ts", F.to_timestamp("day"))
    q = (dedupe_late(stream, "ts", "1 hour", ["id"]).writeStream.format("memory").queryName("dedupe_out")
         .option("checkpointLocation", os.path.join(tmp_root, "ckm")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert sorted(r[0] for r in spark.sql("SELECT id FROM dedupe_out").collect()) == ["x", "y"]
