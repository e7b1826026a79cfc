"""Property checks from the test strategy, on small generated inputs (few examples: each runs Spark)."""

import json
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import explode_scalars, hierarchy_tier, keep_one, merge_type1, number_within
from strata.sources import restore, snapshot

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

arrays = st.lists(st.one_of(st.none(), st.lists(st.sampled_from(["A", "b", "C"]), max_size=4)), min_size=1, max_size=8)


@SETTINGS
@given(arrays)
def test_explode_count_is_sum_of_sizes(spark, arrs):
    df = spark.createDataFrame([(i, json.dumps(a) if a is not None else None) for i, a in enumerate(arrs)],
                               "id int, j string")
    assert explode_scalars(df, "j", keep=["id"]).count() == sum(len(a) for a in arrs if a)


keys = st.lists(st.integers(0, 30), min_size=1, max_size=15, unique=True)


@SETTINGS
@given(keys, keys)
def test_merge_keeps_every_target_row_and_key(spark, tgt_keys, src_keys):
    tgt = spark.createDataFrame([(i + 1, k, f"t{k}") for i, k in enumerate(sorted(tgt_keys))], "sk long, nk int, v string")
    src = spark.createDataFrame([(k, f"s{k}") for k in src_keys], "nk int, v string")
    out = {r["nk"]: (r["sk"], r["v"]) for r in merge_type1(tgt, src, "nk", "sk").collect()}
    assert set(out) == set(tgt_keys) | set(src_keys)
    for r in tgt.collect():
        assert out[r["nk"]][0] == r["sk"]                      # keys never change
        assert out[r["nk"]][1] == (f"s{r['nk']}" if r["nk"] in src_keys else r["v"])
    sks = [v[0] for v in out.values()]
    assert len(sks) == len(set(sks)) and max(sks) == len(sks)  # dense and unique


edges = st.lists(st.tuples(st.integers(0, 12), st.one_of(st.none(), st.integers(0, 12))), min_size=1, max_size=20)


@SETTINGS
@given(edges)
def test_hierarchy_tiers_consistent(spark, es):
    df = spark.createDataFrame([(str(a), None if b is None else str(b)) for a, b in es], "n string, p string")
    tier = dict(hierarchy_tier(df, "n", "p", tier_alias="t").collect())
    for a, b in es:
        a = str(a)
        if b is None:
            assert tier[a] == 1
        elif str(b) in tier:
            assert a in tier and tier[a] <= tier[str(b)] + 1
    for a, t in tier.items():  # every tier is justified by a root or a parent one level up
        assert t == 1 and any(str(x) == a and y is None for x, y in es) or \
            any(str(x) == a and y is not None and tier.get(str(y)) == t - 1 for x, y in es)


groups = st.lists(st.tuples(st.sampled_from([0, 0, 0, 1, 2]), st.integers(0, 5)), min_size=1, max_size=40)


@SETTINGS
@given(groups)
def test_number_within_and_keep_one_match_window(spark, rows):
    df = spark.createDataFrame([(g, t, i) for i, (g, t) in enumerate(rows)], "g int, t int, id int")
    w = Window.partitionBy("g").orderBy("t", "id")
    ref = df.withColumn("rn", F.row_number().over(w))
    ours = number_within(df, "g", ["t", "id"], alias="rn", num_partitions=3)
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, ref.collect()))
    first = sorted(map(tuple, ref.where("rn = 1").drop("rn").collect()))
    assert sorted(map(tuple, keep_one(df, "g", ["t", "id"], latest=False).collect())) == first


def test_restore_after_snapshot_is_identity(spark, tmp_root):
    df = spark.createDataFrame([(i, f"v{i}", float(i) / 3) for i in range(50)], "k long, v string, x double")
    base = os.path.join(tmp_root, "snaps")
    snapshot(df, base, "20260120")
    assert sorted(map(tuple, restore(spark, base, "20260120").collect())) == sorted(map(tuple, df.collect()))


children = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.one_of(st.none(), st.sampled_from("abc"))),
                    max_size=25)


@SETTINGS
@given(children, children)
def test_rollups_match_brute_force(spark, kids1, kids2):
    from strata.operators import child_counts, flat_lists, list_per_key
    base = spark.createDataFrame([(k,) for k in range(6)], "id int")
    c1 = spark.createDataFrame(kids1, "id int, pos int, v string") if kids1 else \
        spark.createDataFrame([], "id int, pos int, v string")
    c2 = spark.createDataFrame(kids2, "id int, pos int, v string") if kids2 else \
        spark.createDataFrame([], "id int, pos int, v string")

    def joined(kids, k):
        vals = sorted((p, v) for i, p, v in kids if i == k and v is not None)
        return ", ".join(v for _, v in vals) if vals else "n/a"

    got = {r["id"]: (r["l1"], r["l2"]) for r in
           flat_lists(base, "id", {"l1": (c1, "v", ["pos"]), "l2": (c2, "v", ["pos"])}).collect()}
    assert got == {k: (joined(kids1, k), joined(kids2, k)) for k in range(6)}
    counts = {r["id"]: (r["d"], r["n"]) for r in
              child_counts(base, "id", {"d": (c1, "v", True), "n": (c2, None, False)}).collect()}
    assert counts == {k: (len({v for i, _, v in kids1 if i == k and v is not None}),
                          sum(1 for i, _, _ in kids2 if i == k)) for k in range(6)}
    lists = {r["id"]: r["l"] for r in list_per_key(c1, "id", "v", "l", order=["pos"]).collect()}
    assert lists == {k: joined(kids1, k) for k in range(6) if joined(kids1, k) != "n/a"}


forests = st.lists(st.one_of(st.none(), st.integers(0, 30)), min_size=1, max_size=30)


@SETTINGS
@given(forests)
def test_doubling_matches_breadth_first_on_trees(spark, parents):
    from strata.operators import hierarchy_tier_doubling
    # node i has parent parents[i] (None = root; may point to a missing node or form a cycle)
    rows = [(str(i), None if p is None else str(p)) for i, p in enumerate(parents)]
    df = spark.createDataFrame(rows, "n string, p string")
    bfs = dict(hierarchy_tier(df, "n", "p", tier_alias="t").collect())
    dbl = dict(hierarchy_tier_doubling(df, "n", "p", tier_alias="t").collect())
    assert dbl == bfs


def test_doubling_deep_chain(spark):
    from strata.operators import hierarchy_tier_doubling
    chain = spark.createDataFrame([(str(i), str(i - 1) if i else None) for i in range(300)], "n string, p string")
    got = dict(hierarchy_tier_doubling(chain, "n", "p", max_depth=None).collect())
    assert got == {str(i): i + 1 for i in range(300)}
