"""Tables that grow with the input are merged, not collected on the driver to be broadcast."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import child_counts, count_within, flat_lists, hierarchy_tier, merge_type1, new_facts
from strata.operators.hierarchy_delta import hierarchy_delta


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A small table of files, which Spark would broadcast by its size."""
    path = str(tmp_path_factory.mktemp("growing") / "t")
    spark.range(200).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("v"),
                            F.when(F.col("id") > 0, F.floor(F.col("id") / 3).cast("string")).alias("p")).write.parquet(path)
    return spark.read.parquet(path)


def test_dimensions_and_lists(stored):
    base = stored.select("k")
    plans = [child_counts(base, "k", {"n": (stored, "v", True)}), flat_lists(base, "k", {"l": (stored, "p")}),
             count_within(stored, ["v"], "k", "n"), new_facts(stored, base, ["k"]),
             merge_type1(None, stored, "k", "key", "at", dt.datetime(2024, 1, 1)),
             merge_type1(stored.select("k", "v").withColumn("key", F.col("v") + 1), stored.where("v > 2").select("k", "v"), "k", None)]
    for df in plans:
        # A numbering's offsets are one row per task and may be broadcast.
        assert "BroadcastHashJoin [k" not in _plan(df) and "BroadcastHashJoin [v" not in _plan(df)
        assert "SortMergeJoin" in _plan(df)


def test_changed_edges(spark, stored):
    edges = stored.select("k", "p")
    tiers = hierarchy_tier(edges, "k", "p")
    assert "Broadcast" not in _plan(tiers)
    gone = edges.where("k = '5'")
    new, touched = hierarchy_delta(tiers, edges.where("k <> '5'"), edges.limit(0), gone, "k", "p")
    assert "Broadcast" not in _plan(new) and "Broadcast" not in _plan(touched)
    assert {r.k: r.tier for r in new.collect()} == {
        r.k: r.tier for r in hierarchy_tier(edges.where("k <> '5'"), "k", "p").collect()}
