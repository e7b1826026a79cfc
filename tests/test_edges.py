"""Empty and degenerate inputs."""

from strata.operators import (assign_keys, child_counts, dense_numbering, flat_lists, hierarchy_tier, merge_type1,
                              new_facts, number_within)


def test_empty_inputs(spark):
    empty_keys = spark.createDataFrame([], "nk string")
    assert dense_numbering(empty_keys, ["nk"], "sk").count() == 0
    old = spark.createDataFrame([("a", 1)], "nk string, sk long")
    got = assign_keys(spark.createDataFrame([("a",)], "nk string"), "nk", "sk", existing=old).collect()
    assert [tuple(r) for r in got] == [("a", 1)]  # no new keys
    assert number_within(spark.createDataFrame([], "g int, t int"), "g", ["t"]).count() == 0
    no_root = spark.createDataFrame([("a", "b"), ("b", "a")], "n string, p string")
    assert hierarchy_tier(no_root, "n", "p").count() == 0
    tgt = spark.createDataFrame([(1, "a", "x")], "sk long, nk string, v string")
    out = merge_type1(tgt, spark.createDataFrame([], "nk string, v string"), "nk", "sk")
    assert [tuple(r) for r in out.collect()] == [(1, "a", "x")]


def test_empty_batch_and_stale_days(spark):
    hist = spark.createDataFrame([(20260101, 1, "f")], "date_id int, k long, f string")
    empty = spark.createDataFrame([], "date_id int, k long, f string")
    assert new_facts(empty, hist, ["date_id", "k", "f"], prune_col="date_id").count() == 0
    base = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([], "id int, v string")
    assert sorted(map(tuple, flat_lists(base, "id", {"l": (child, "v")}).collect())) == [(1, "n/a"), (2, "n/a")]
    assert sorted(map(tuple, child_counts(base, "id", {"n": (child, "v", True)}).collect())) == [(1, 0), (2, 0)]


def test_prune_history_many_days_uses_semi_join(spark, tmp_root):
    import os
    hist_path = os.path.join(tmp_root, "h")
    spark.createDataFrame([(d, d, "x") for d in range(100)], "date_id int, k long, f string") \
        .write.partitionBy("date_id").parquet(hist_path)
    batch = spark.createDataFrame([(d, d if d % 2 else d + 1000, "x") for d in range(80)],
                                  "date_id int, k long, f string")
    out = new_facts(batch, spark.read.parquet(hist_path), ["date_id", "k", "f"], prune_col="date_id")
    assert sorted(r["k"] for r in out.collect()) == [d + 1000 for d in range(0, 80, 2)]
