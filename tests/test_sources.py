"""Sources, sinks and the smaller helpers."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import functions as sf
from strata.operators import enforce, explode_chain
from strata.sources import (append_table, create_if_absent, current_version, dated_name, dated_path,
                            overwrite_partitions, read_json_documents, read_table, replace_table)

DOC = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.StringType())])


def test_dated_names():
    assert dated_name(dt.date(2026, 1, 8)) == "card_data_20260108.json"
    assert dated_path("/land", dt.datetime(2026, 1, 8, 3), prefix="x_") == "/land/x_20260108.json"


def test_json_documents_array_object_and_day(spark, tmp_root):
    d = os.path.join(tmp_root, "docs")
    os.makedirs(d)
    with open(os.path.join(d, "card_data_20260108.json"), "w") as fh:
        json.dump([{"id": "a", "n": "×1", "extra": 1}, {"id": "b"}], fh, ensure_ascii=True, indent=2)
    with open(os.path.join(d, "card_data_20260109.json"), "w") as fh:
        json.dump({"id": "c", "n": "3"}, fh)
    df = read_json_documents(spark, d, DOC, file_col="file", day_col="day")
    got = sorted((r["id"], r["n"], r["day"]) for r in df.collect())
    assert got == [("a", "×1", dt.date(2026, 1, 8)), ("b", None, dt.date(2026, 1, 8)), ("c", "3", dt.date(2026, 1, 9))]


def test_versioned_refresh_and_append(spark, tmp_root):
    t = os.path.join(tmp_root, "t")
    replace_table(spark.range(3), t)
    replace_table(read_table(spark, t).where("id > 0"), t)  # reads v1, writes v2: never the same files
    assert current_version(spark, t) == 2 and read_table(spark, t).count() == 2
    v3 = replace_table(spark.range(10), t, publish=False)
    assert v3 == 3 and read_table(spark, t).count() == 2  # unpublished version is invisible
    f = os.path.join(tmp_root, "f")
    append_table(spark.createDataFrame([(1, 2.0)], "d int, p double"), f, partition_by=["d"],
                 defaults={"log": F.lit("x")})
    append_table(spark.createDataFrame([(2, 3.0)], "d int, p double"), f, partition_by=["d"],
                 defaults={"log": F.lit("y")})
    overwrite_partitions(spark.createDataFrame([(5.0, "z", 2)], "p double, log string, d int"), f, ["d"])
    assert sorted((r["d"], r["p"], r["log"]) for r in read_table(spark, f).collect()) == [(1, 2.0, "x"), (2, 5.0, "z")]


def test_create_if_absent(spark, tmp_root):
    p = os.path.join(tmp_root, "empty")
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    create_if_absent(spark, p, schema)
    create_if_absent(spark, p, schema)
    assert read_table(spark, p).count() == 0 and read_table(spark, p).columns == ["a"]
    assert read_table(spark, os.path.join(tmp_root, "missing")) is None


def test_explode_chain(spark):
    df = spark.createDataFrame([(1, [{"name": "x", "cost": ["A", "B"]}, {"name": "y", "cost": []}])],
                               "id int, attacks array<struct<name:string, cost:array<string>>>")
    out = explode_chain(df, [("attacks", "attack"), ("cost", "energy")], keep=["id"])
    assert sorted((r["id"], r["name"], r["energy"]) for r in out.collect()) == [(1, "x", "A"), (1, "x", "B")]


def test_enforce_raises(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    with pytest.raises(Exception):
        enforce(df, F.col("k").isNull(), "k must not be NULL").collect()
    assert enforce(df.where("k is not null"), F.col("k").isNull(), "x").count() == 1


def test_zone_day_and_elapsed(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 7, 1, 3, 30), dt.datetime(2026, 7, 1, 3, 31, 5))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(sf.zone_day("a", "America/New_York").alias("z"), sf.elapsed_seconds("a", "b").alias("s")).first()
    assert r["z"] == dt.date(2026, 6, 30) and r["s"] == 65


def test_layer_publish_is_one_switch(spark, tmp_root):
    layer = os.path.join(tmp_root, "silver")
    a, b = os.path.join(layer, "a"), os.path.join(layer, "b")
    replace_table(spark.range(1), a)
    replace_table(spark.range(2), b)
    va = replace_table(spark.range(10), a, publish=False)
    vb = replace_table(spark.range(20), b, publish=False)
    assert read_table(spark, a).count() == 1 and read_table(spark, b).count() == 2   # nothing visible yet
    from strata.sources import publish_versions
    publish_versions(spark, {a: va, b: vb})
    assert read_table(spark, a).count() == 10 and read_table(spark, b).count() == 20
    latest = max(os.listdir(os.path.join(layer, "_manifests")))
    assert open(os.path.join(layer, "_manifests", latest)).read().split() == ["a=2", "b=2", "end"]


def test_empty_first_append_reads_as_no_table(spark, tmp_root):
    from strata.operators import new_facts
    f = os.path.join(tmp_root, "fact0")
    append_table(spark.createDataFrame([], "date_id int, k long"), f, partition_by=["date_id"])
    assert read_table(spark, f) is None  # only _SUCCESS so far
    batch = spark.createDataFrame([(20260101, 1)], "date_id int, k long")
    append_table(new_facts(batch, read_table(spark, f), ["date_id", "k"], prune_col="date_id"), f,
                 partition_by=["date_id"])
    assert read_table(spark, f).count() == 1
