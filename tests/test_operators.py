"""Operator semantics on small frames (edge cases from the fixture notes)."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata import functions as sf
from strata.operators import (HierarchyDepthError, assign_keys, count_within, date_dimension, explode_entries,
                              explode_objects, explode_scalars, flat_lists, flatten_struct, fresh_since,
                              hierarchy_tier, keep_lowest, keep_one, key_violations, list_per_key, merge_type1,
                              new_facts, null_violations, number_within, profile)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def test_digits_from_code(spark):
    df = spark.createDataFrame([("TG12",), ("H1",), ("!",), ("12a",), ("1a2",), (None,), ("1",)], "c string")
    got = dict(df.select("c", sf.digits_from_code("c").alias("n")).collect())
    assert got == {"TG12": 12, "H1": 1, "!": 0, "12a": 12, "1a2": None, None: None, "1": 1}


def test_repair_timestamp_and_dates(spark):
    df = spark.createDataFrame([("019/07/21 16:05:09",), ("2019/07/21 16:05:09",), (None,)], "t string")
    got = [r[0] for r in df.select(sf.repair_timestamp("t")).collect()]
    assert got[0] == dt.datetime(2019, 7, 21, 16, 5, 9) and got[1] == dt.datetime(2019, 7, 21, 16, 5, 9) and got[2] is None
    d = spark.createDataFrame([("2013/02/27",), ("bad",)], "t string").select(sf.parse_date("t")).collect()
    assert d[0][0] == dt.date(2013, 2, 27) and d[1][0] is None


def test_blank_and_labels(spark):
    df = spark.createDataFrame([("  ",), (None,), (" x ",)], "v string")
    assert [r[0] for r in df.select(sf.blank_to_default("v")).collect()] == ["n/a", "n/a", "x"]
    lg = spark.createDataFrame([("L", None, "L"), (None, "L", None), (None, None, None)], "s string, e string, u string")
    lab = [r[0] for r in lg.select(sf.first_present_label([("s", "Standard+"), ("e", "Expanded+"),
                                                            ("u", "Unlimited Only")])).collect()]
    assert lab == ["Standard+", "Expanded+", "n/a"]


def test_price_fallback_and_date_key(spark):
    df = spark.createDataFrame([(None, 3.0, 1.0), (None, None, 1.0), (4.0, None, None)], "m double, h double, l double")
    assert [r[0] for r in df.select(sf.price_fallback("m", "h", "l")).collect()] == [2.0, None, 4.0]
    d = spark.createDataFrame([(dt.date(2026, 1, 8),)], "d date").select(sf.date_key("d")).first()[0]
    assert d == 20260108


def test_local_day_shift(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 8, 3, 0),)], "t timestamp_ntz")
    assert df.select(sf.local_day("t", -5)).first()[0] == dt.date(2026, 1, 7)


def test_fresh_since_boundaries(spark):
    as_of = dt.datetime(2026, 1, 28, 0, 0)
    df = spark.createDataFrame([(dt.date(2026, 1, 8),), (dt.date(2026, 1, 9),), (None,)], "d date")
    assert rows(fresh_since(df, "d", as_of, 20)) == [(dt.date(2026, 1, 9),)]


def test_explode_objects_json_and_empty(spark):
    df = spark.createDataFrame([(1, '[{"type":"Fire","value":"x2"},{"type":"Water"}]'), (2, "[]"), (3, None),
                                (4, '{"type":"Grass","value":"-10"}')], "id int, j string")
    out = explode_objects(df, "j", "type string, value string", keep=["id"])
    assert rows(out) == [(1, "Fire", "x2"), (1, "Water", None), (4, "Grass", "-10")]
    outer = explode_objects(df, "j", "type string, value string", keep=["id"], outer=True)
    assert outer.count() == 5


def test_explode_scalars_keeps_duplicates_and_nulls(spark):
    df = spark.createDataFrame([(1, '["A","A",null]'), (2, "[]")], "id int, j string")
    out = explode_scalars(df, "j", keep=["id"], alias="v", lower=True, pos_alias="p")
    assert rows(out) == [(1, 0, "a"), (1, 1, "a"), (1, 2, None)]


def test_explode_entries_open_keys(spark):
    df = spark.createDataFrame([(1, '{"holo":{"low":1.0,"high":3.0},"newFinish":{"market":2.5}}'), (2, "{}")],
                               "id int, j string")
    out = explode_entries(df, "j", "low double, high double, market double", keep=["id"], key_alias="finish")
    assert rows(out) == [(1, "holo", 1.0, 3.0, None), (1, "newFinish", None, None, 2.5)]


def test_flatten_struct_presence(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":"x"},"c":1}'), (2, None), (3, "{}")], "id int, j string")
    out = flatten_struct(df, "j", {"a.b": "ab", "c": "c"}, keep=["id"], schema="a struct<b string>, c int")
    assert rows(out) == [(1, "x", 1), (3, None, None)]


def test_count_within_pools_and_null(spark):
    df = spark.createDataFrame([(1, "Bash", "Metal"), (1, "Bash", "Metal"), (1, "Bash", None), (1, "Bash", "Fire")],
                               "id int, a string, e string")
    out = count_within(df, ["id", "a", "e"], "e", "n")
    assert rows(out, "e", "n") == [("Fire", 1), ("Metal", 2), ("Metal", 2), (None, 0)]


def test_number_within_matches_window(spark):
    data = [(k % 3 if k % 5 else 0, k // 2, k) for k in range(200)]  # key 0 is hot
    df = spark.createDataFrame(data, "g int, t int, id int")
    ours = number_within(df, "g", ["t", "id"], alias="rn", num_partitions=7)
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("t", "id")))
    assert rows(ours, "g", "id", "rn") == rows(ref, "g", "id", "rn")


def test_keep_lowest_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", None), ("b", 3), ("c", 5)], "k string, v int")
    assert rows(keep_lowest(df, "k", "v")) == [("a", 1), ("a", 1), ("b", None), ("c", 5)]


def test_keep_one_latest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, p int, v string")
    assert rows(keep_one(df, "k", ["p"], latest=True)) == [("a", 2, "y"), ("b", 1, "z")]


def test_lists_and_flat_lists(spark):
    child = spark.createDataFrame([(1, 1, "b"), (1, 0, "a"), (2, 0, None)], "id int, pos int, v string")
    assert rows(list_per_key(child, "id", "v", "lst", order=["pos"])) == [(1, "a, b")]
    nums = spark.createDataFrame([(1, 0, 10), (1, 1, 9)], "id int, pos int, n int")
    base = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    out = flat_lists(base, "id", {"vs": (child, "v", ["pos"]), "ns": (nums, "n", ["pos"])})
    assert rows(out) == [(1, "a, b", "10, 9"), (2, "n/a", "n/a"), (3, "n/a", "n/a")]


def test_hierarchy(spark):
    edges = spark.createDataFrame([("A", None), ("B", "A"), ("B", None), ("C", "B"), ("O", "Missing"),
                                   ("X", "Y"), ("Y", "X"), ("D", "C")], "name string, parent string")
    got = dict(hierarchy_tier(edges, "name", "parent", tier_alias="t").collect())
    assert got == {"A": 1, "B": 1, "C": 2, "D": 3}
    chain = spark.createDataFrame([(str(i), str(i - 1) if i else None) for i in range(6)], "name string, parent string")
    with pytest.raises(HierarchyDepthError):
        hierarchy_tier(chain, "name", "parent", max_depth=3)


def test_date_dimension(spark):
    d = date_dimension(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    assert d.count() == 366
    r = d.where("date_id = 20240131").first()
    assert r["month_name"] == "January" and r["is_month_end"] and r["quarter"] == 1
    assert d.where("is_weekend").count() == 104
    assert date_dimension(spark).count() == 18628


def test_assign_keys_stable(spark):
    old = spark.createDataFrame([("b", 1), ("d", 2)], "nk string, sk long")
    src = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "nk string")
    got = dict(assign_keys(src, "nk", "sk", existing=old).collect())
    assert got == {"b": 1, "d": 2, "a": 3, "c": 4, "e": 5}


def test_merge_type1(spark):
    tgt = spark.createDataFrame([(1, "a", "x", 1.0), (2, "b", "y", 2.0), (3, "gone", "z", 3.0)],
                                "sk long, nk string, v string, w double")
    src = spark.createDataFrame([("a", None, 10.0), ("b", "y2", 20.0), ("c", "new", 30.0)],
                                "nk string, v string, w double")
    out = merge_type1(tgt, src, "nk", "sk")
    assert rows(out) == [(1, "a", None, 10.0), (2, "b", "y2", 20.0), (3, "gone", "z", 3.0), (4, "c", "new", 30.0)]


def test_new_facts_idempotent_and_null_grain(spark):
    batch = spark.createDataFrame([(20260108, 1, "holo", 1.0), (20260108, 2, "holo", 2.0), (None, 3, "holo", 3.0)],
                                  "date_id int, card_key long, finish string, p double")
    hist = spark.createDataFrame([(20260108, 1, "holo", 9.0)], "date_id int, card_key long, finish string, p double")
    new = new_facts(batch, hist, ["date_id", "card_key", "finish"], prune_col="date_id")
    assert rows(new, "card_key") == [(2,)]
    again = new_facts(batch, hist.unionByName(new), ["date_id", "card_key", "finish"], prune_col="date_id")
    assert again.count() == 0


def test_quality(spark):
    df = spark.createDataFrame([(1, "a "), (1, None), (2, "")], "k int, s string")
    assert rows(key_violations(df, ["k"])) == [(1, 2)]
    assert null_violations(df, ["s"]).count() == 1
    p = profile(df, ["s"]).first()
    assert (p["n_rows"], p["n_null"], p["n_untrimmed"], p["n_blank"]) == (3, 1, 1, 1)


def test_parse_keeps_wall_clock_in_any_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2026/03/08 02:30:00",), ("bad",)], "t string")
        got = [r[0] for r in df.select(sf.parse_timestamp("t")).collect()]
        assert got == [dt.datetime(2026, 3, 8, 2, 30), None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ci_key_lower_and_collation(spark):
    a = spark.createDataFrame([("Metal",), ("FIRE",)], "x string")
    b = spark.createDataFrame([("metal",), ("fire",), ("water",)], "y string")
    for collation in (None, "UTF8_LCASE"):
        j = a.join(b, sf.ci_key(a["x"], collation) == sf.ci_key(b["y"], collation))
        assert sorted((r["x"], r["y"]) for r in j.collect()) == [("FIRE", "fire"), ("Metal", "metal")]
    grouped = a.unionByName(b.withColumnRenamed("y", "x")).groupBy(sf.ci_key("x", "UTF8_LCASE").alias("k")).count()
    assert sorted(r["count"] for r in grouped.collect()) == [1, 2, 2]
