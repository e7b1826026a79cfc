"""VARIANT columns and mergeable profiles."""

import datetime as dt
import random

from strata.operators import merge_profiles, profile_day
from strata.operators.variants import REJECTED, as_variant, variant_entries, variant_field


def test_entries_of_open_objects(spark, tmp_root):
    rows = [(1, '{"prices": {"plain": {"low": 1.5, "high": "2"}, "foil": {"low": null}}, "url": "u"}'), (2, '{"prices": {}}'), (3, None),
            (4, '{"prices": [{"low": 1}, {"low": 2.5}]}'), (5, '{"prices": 7}'), (6, '{"a": 1, "a": 2}'), (7, "{"), (8, "null")]
    path = tmp_root + "/bronze"
    as_variant(spark.createDataFrame(rows, "id int, doc string"), "doc").write.parquet(path)
    bronze = spark.read.parquet(path)
    assert dict(bronze.dtypes)["doc"] == "variant"
    assert {r.id: r[REJECTED] for r in bronze.collect() if r[REJECTED]} == {6: ["doc"], 7: ["doc"]}
    fields = {"low": ("$.low", "double"), "high": ("$.high", "int")}
    got = variant_entries(bronze, "doc", ["id"], fields, path="$.prices", key_alias="finish").collect()
    assert sorted(((r.id, r.finish, r.low, r.high) for r in got), key=str) == [
        (1, "foil", None, None), (1, "plain", 1.5, 2), (4, None, 1.0, None), (4, None, 2.5, None)]
    outer = variant_entries(bronze, "doc", ["id"], fields, path="$.prices", outer=True)
    assert {r.id for r in outer.collect()} == set(range(1, 9))
    assert [r.u for r in bronze.orderBy("id").select(variant_field("doc", "$.url").alias("u")).collect()][:2] == ["u", None]
    plan = outer._jdf.queryExecution().toString()
    assert "from_json" not in plan and "parse_json" not in plan


def test_profiles_of_days_merge(spark):
    r = random.Random(2)
    day0, parts, every = dt.date(2026, 1, 1), [], []
    for d in range(4):
        rows = [(r.choice([None, " ", f"w{r.randrange(3000)}", f" x{r.randrange(9)}"]), float(r.randrange(10_000))) for _ in range(4000)]
        parts.append(profile_day(spark.createDataFrame(rows, "t string, n double"), ["t", "n"], day0 + dt.timedelta(d)))
        every.append(rows)
    empty = profile_day(spark.createDataFrame([], "t string, n double"), ["t", "n"], day0 + dt.timedelta(9))
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).unionByName(empty)
    for a, b in ((0, 9), (1, 2), (3, 3)):
        rows = [x for d in range(a, min(b, 3) + 1) for x in every[d]]
        got = {x.column_name: x for x in merge_profiles(whole, day0 + dt.timedelta(a), day0 + dt.timedelta(b)).collect()}
        texts, numbers = [t for t, _ in rows], sorted(n for _, n in rows)
        t = got["t"]
        assert (t.n_rows, t.n_null, t.n_untrimmed, t.n_blank) == (
            len(rows), texts.count(None), sum(x is not None and x.strip() != x for x in texts), texts.count(" "))
        assert abs(t.n_distinct / len({x for x in texts if x is not None}) - 1) < 0.06
        assert t.longest == max(len(x) for x in texts if x is not None)
        for q in (25, 50, 75):
            rank = sum(n <= got["n"][f"q{q}"] for n in numbers) / len(numbers)
            assert abs(rank - q / 100) < 0.04
    one = merge_profiles(empty).collect()
    assert all(x.n_rows == 0 and x.n_distinct == 0 and x.q50 is None and x.longest is None for x in one)
