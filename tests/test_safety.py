"""Loads that must not publish, repeat or lose anything: damaged input, re-runs, crashes, limits."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

import strata.session as session
from conftest import AS_OF, card, kite_set, make_cards, price
from strata.operators import HierarchyDepthError, hierarchy_tier, hierarchy_tier_doubling, merge_type1
from strata.plans import loads
from strata.sources import current_version, land_pages, layer_path, publish_versions, read_json_documents, read_table, replace_table
from strata.sources.tables import _versions, version_path

DAY2 = AS_OF + dt.timedelta(days=1)


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def _gold(spark, root, name):
    return read_table(spark, layer_path(root, "gold", name))


def test_a_cut_file_raises_and_the_old_layers_stay(spark, tmp_root):
    landing, root = os.path.join(tmp_root, "in"), os.path.join(tmp_root, "lake")
    good = json.dumps(make_cards())
    _write(landing, "card_data_20260120.json", good)
    loads.run(spark, root, AS_OF, landing_dir=landing)
    main = layer_path(root, "silver", "card_main_info")
    before, rows = current_version(spark, main), read_table(spark, main).count()
    _write(landing, "card_data_20260121.json", good[:len(good) // 2])
    with pytest.raises(loads.MalformedInputError):
        loads.run(spark, root, DAY2, landing_dir=landing)
    assert current_version(spark, main) == before and read_table(spark, main).count() == rows == 4
    assert loads.read_bronze_table(spark, root).count() == 4
    kept = read_table(spark, layer_path(root, "audit", "bronze_rejects")).where(F.col("_corrupt_record").isNotNull()).collect()
    assert [r["run_day"] for r in kept] == [DAY2.date()]
    assert _gold(spark, root, "dim_cards").where("card_key is null or card_id is null").count() == 0


def test_cards_without_id_are_put_aside_and_reruns_repeat_nothing(spark, tmp_root):
    root = os.path.join(tmp_root, "lake")
    odd = card("k-7", "Odd", hp="many", tcgplayer=price("2051/06/01", plain={"market": 1.0}))  # no such day in dim_dates
    fresh = card("k-8", "Fresh", artist="a" * 300, set=kite_set(), tcgplayer=price("2026/01/19", plain={"market": 2.0}))
    path = _write(tmp_root, "card_data_20260120.json", json.dumps([{"name": "Nameless"}, odd, fresh]))
    counts = []
    for _ in range(2):
        loads.run(spark, root, AS_OF, source=path)
        counts.append({t: read_table(spark, layer_path(root, "audit", t)).count()
                       for t in ("bronze_rejects", "fact_rejects", "cast_rejects", "length_violations")})
        assert _gold(spark, root, "fact_hst_tcg_data").count() == 1
        assert sorted(r["card_id"] for r in _gold(spark, root, "dim_cards").collect()) == ["k-7", "k-8"]
    assert counts[0] == counts[1] == {"bronze_rejects": 1, "fact_rejects": 1, "cast_rejects": 1, "length_violations": 1}


def test_first_load_without_prices(spark, tmp_root):
    root = os.path.join(tmp_root, "lake")
    path = _write(tmp_root, "card_data_20260120.json", json.dumps([card("k-1", "Alone", set=kite_set())]))
    audit = loads.run(spark, root, AS_OF, source=path)
    assert {r["status"] for r in audit.frame().collect()} == {"succeeded"}
    assert os.path.isdir(layer_path(root, "gold", "fact_hst_tcg_data"))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_undated_files_are_put_aside_and_dated_ones_load(spark, tmp_root, ansi):
    landing, root = os.path.join(tmp_root, "in"), os.path.join(tmp_root, "lake")
    _write(landing, "card_data_20260120.json", json.dumps([card("k-1", "Dated", set=kite_set())]))
    _write(landing, "extra.json", json.dumps([card("k-2", "Undated")]))
    was = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        loads.stream_days(spark, root, landing, os.path.join(tmp_root, "ck"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", was)
    assert [r["card_id"] for r in _gold(spark, root, "dim_cards").collect()] == ["k-1"]
    aside = read_table(spark, layer_path(root, "audit", "undated_rejects")).collect()
    assert [(r["__file"], r["id"]) for r in aside] == [("extra.json", "k-2")]


def test_damaged_documents_and_pages_raise_unless_kept(spark, tmp_root):
    schema = "id string, n int"
    from pyspark.sql import types as T
    fields = T.StructType.fromDDL(schema) if hasattr(T.StructType, "fromDDL") else spark.createDataFrame([], schema).schema
    path = _write(tmp_root, "d.json", '{"id": "a", "n": 1}\n{"id": "b", "n"')
    with pytest.raises(Exception):
        read_json_documents(spark, path, fields, multi_line=False).collect()
    rows = read_json_documents(spark, path, fields, multi_line=False, keep_corrupt=True).collect()
    assert sorted(r["_corrupt_record"] or "" for r in rows) == ["", '{"id": "b", "n"']
    pages = os.path.join(tmp_root, "pages")
    _write(pages, "page_1.json", '{"page": 1, "data": [{"id": "a", "n": 1}]}\n')
    _write(pages, "page_2.json", '{"page": 2, "data": [{"id": "b", "n"')
    with pytest.raises(Exception):
        land_pages(spark, pages, fields, "id").collect()
    kept = land_pages(spark, pages, fields, "id", keep_corrupt=True).collect()
    assert sorted(str(r["id"]) for r in kept) == ["None", "a"]


def test_versions_are_never_reused_and_old_ones_go(spark, tmp_root):
    path = os.path.join(tmp_root, "layer", "t")
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "p int, v string")
    assert replace_table(frame, path, partition_by=["p"]) == 1
    assert replace_table(frame, path, partition_by=["p"], publish=False) == 2  # a run that failed before publishing
    assert replace_table(frame.where("p = 1"), path, partition_by=["p"]) == 3
    assert [r["v"] for r in read_table(spark, path).collect()] == ["a"]
    # Written over a used directory, a refresh drops partitions that it does not have.
    (frame.where("p = 2").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("p")
     .parquet(version_path(path, 3)))
    for _ in range(3):
        replace_table(frame, path)
    assert current_version(spark, path) == 6 and _versions(spark, path) == [5, 6]


def test_a_manifest_that_was_cut_off_does_not_count(spark, tmp_root):
    layer = os.path.join(tmp_root, "layer")
    path = os.path.join(layer, "t")
    replace_table(spark.range(3).toDF("x"), path)
    version = replace_table(spark.range(5).toDF("x"), path, publish=False)
    with open(os.path.join(layer, "_manifests", f"{9:012d}"), "w") as fh:
        fh.write(f"t={version}\n")  # the writer died here
    assert read_table(spark, path).count() == 3
    publish_versions(spark, {path: version})
    assert read_table(spark, path).count() == 5


def test_null_natural_keys_do_not_enter_a_dimension(spark):
    schema = "k long, id string, v string"
    target = spark.createDataFrame([(1, "a", "x"), (None, None, "old")], schema)
    source = spark.createDataFrame([("a", "y"), (None, "bad"), ("b", "z")], "id string, v string")
    rows = sorted(tuple(r) for r in merge_type1(target, source, "id", "k").collect())
    assert rows == [(1, "a", "y"), (2, "b", "z")]
    assert sorted(r["id"] for r in merge_type1(None, source, "id", "k").collect()) == ["a", "b"]


def _chain(spark, n):
    return spark.createDataFrame([(f"n{i}", f"n{i - 1}" if i else None) for i in range(n)], "name string, parent string")


@pytest.mark.parametrize("tiers", [1, 3, 40])
def test_depth_limit_counts_steps_alike_in_both(spark, tiers):
    chain = _chain(spark, tiers)
    want = {f"n{i}": i + 1 for i in range(tiers)}
    for tier_of in (hierarchy_tier, hierarchy_tier_doubling):
        assert dict(map(tuple, tier_of(chain, "name", "parent").collect())) == want
        assert dict(map(tuple, tier_of(chain, "name", "parent", max_depth=tiers - 1).collect())) == want
        if tiers > 1:
            with pytest.raises(HierarchyDepthError):
                tier_of(chain, "name", "parent", max_depth=tiers - 2).collect()


@pytest.mark.parametrize("tiers", [101, 150])
def test_deep_chains_need_no_limit(spark, tiers):
    got = dict(map(tuple, hierarchy_tier_doubling(_chain(spark, tiers), "name", "parent").collect()))
    assert got == {f"n{i}": i + 1 for i in range(tiers)}


def test_a_cluster_must_name_its_checkpoint_folder():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_spread_reads_sizes_only(spark, tmp_root):
    path = os.path.join(tmp_root, "one")
    spark.range(100).coalesce(1).write.parquet(path)
    scan = spark.read.parquet(path)
    assert session.spread(scan, 3).rdd.getNumPartitions() == 3
    assert session.spread(scan, 1) is scan
    grouped = spark.range(10).groupBy("id").count()  # no files: unchanged, and no job is run
    assert session.spread(grouped, 50) is grouped
