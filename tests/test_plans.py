"""Physical-plan properties that matter at scale (checked on the executed plan text)."""

import datetime as dt
import os
import re


from strata.operators import explode_objects, flatten_struct, fresh_since, new_facts
from strata.plans import queries as Q
from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_json_parsed_once_in_explode(spark):
    df = spark.createDataFrame([(1, '[{"a":1},{"a":2}]')], "id int, j string").repartition(2)
    out = explode_objects(df, "j", "a int", keep=["id"])
    assert plan(out).count("from_json") == 1
    out2 = flatten_struct(df, "j", {"a": "a"}, keep=["id"], schema="a int")
    assert plan(out2).count("from_json") == 1


def test_freshness_filter_reaches_scan(spark, tmp_root):
    path = os.path.join(tmp_root, "prices")
    spark.createDataFrame([(dt.date(2026, 1, d), float(d)) for d in range(1, 28)], "d date, p double") \
        .write.parquet(path)
    out = fresh_since(spark.read.parquet(path), "d", dt.datetime(2026, 1, 28), 20)
    text = plan(out)
    assert "PushedFilters: [IsNotNull(d), GreaterThan(d," in text
    assert out.count() == 19


def test_history_partitions_pruned(spark, tmp_root):
    hist_path = os.path.join(tmp_root, "hist")
    spark.createDataFrame([(20260100 + d, d, "x") for d in range(1, 29)], "date_id int, k long, f string") \
        .write.partitionBy("date_id").parquet(hist_path)
    batch = spark.createDataFrame([(20260127, 27, "x"), (20260128, 99, "x")], "date_id int, k long, f string")
    out = new_facts(batch, spark.read.parquet(hist_path), ["date_id", "k", "f"], prune_col="date_id")
    text = plan(out)
    # Partitions are pruned at run time by the batch's days, however many there are.
    assert re.search(r"PartitionFilters: \[.*dynamicpruning", text)
    assert sorted(r["k"] for r in out.collect()) == [99]


def test_column_pruning_on_wide_text_table(spark):
    out = Q.presence_label(spark, SF_SMALL)
    text = plan(out)
    assert "ReadSchema: struct<doc_id:bigint>" in text  # the documents' text is never read


def test_bounded_date_dimension_is_broadcast(spark):
    text = plan(Q.incremental_fact(spark, SF_SMALL))
    assert "BroadcastHashJoin" in text
    assert "LeftAnti" in text


def test_hot_key_spread_over_tasks(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import Window
    from strata.operators import number_within
    rows = [(0 if i % 3 == 0 else i, i) for i in range(3000)]  # key 0 holds a third of the rows
    df = spark.createDataFrame(rows, "g int, t int")
    # The range partitioning that number_within uses splits the hot key over several tasks ...
    ranged = df.repartitionByRange(8, "g", "t").withColumn("pid", F.spark_partition_id())
    assert ranged.where("g = 0").select("pid").distinct().count() > 1
    # ... and the numbers still equal a single-group ROW_NUMBER.
    ours = number_within(df, "g", ["t"], alias="rn", num_partitions=8).where("g = 0")
    ref = df.where("g = 0").withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("t")))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, ref.collect()))
