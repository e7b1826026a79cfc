"""Clustered facts: the same rows, from far fewer files and row groups."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.sources.layout import morton, read_clustered, write_clustered


def _scanned(df):
    """(files, rows) that the scan of ``df`` read, from its own metrics."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    files = rows = 0
    for i in range(leaves.size()):
        m = leaves.apply(i).metrics()
        files += m.apply("numFiles").value()
        rows += m.apply("numOutputRows").value()
    return files, rows


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    n = 40_000
    rows = spark.range(n).select(
        (F.col("id") * 7919 % 500).cast("int").alias("card_key"), F.date_add(F.lit(dt.date(2026, 1, 1)), (F.col("id") % 211).cast("int")).alias("day"),
        (F.xxhash64("id") % 100_000).alias("offer"), F.col("id").alias("price"))
    base = str(tmp_path_factory.mktemp("layout"))
    write_clustered(rows, base + "/clustered", ["day", "card_key"], files=256, bloom=["card_key"], bits=6)
    rows.repartitionByRange(256, "day").write.parquet(base + "/by_day")
    return spark, rows, base


def test_one_card_reads_a_tenth_of_the_files(fact):
    spark, rows, base = fact
    got = read_clustered(spark, base + "/clustered", card_key=123)
    assert sorted(r.price for r in got.collect()) == sorted(r.price for r in rows.where("card_key = 123").collect())
    files, scanned = _scanned(got)
    all_files, all_scanned = _scanned(spark.read.parquet(base + "/by_day").where("card_key = 123"))
    assert all_files >= 200 and all_scanned > 30_000
    assert files * 10 <= all_files and scanned * 10 <= all_scanned


def test_other_bounds(fact):
    spark, rows, base = fact
    day = dt.date(2026, 3, 3)
    for within, where in ((dict(day=day), "day = '2026-03-03'"), (dict(day=(day, dt.date(2026, 3, 9))), "day between '2026-03-03' and '2026-03-09'"),
                          (dict(card_key=(490, None), day=(None, day)), "card_key >= 490 and day <= '2026-03-03'"),
                          (dict(price=77), "price = 77"), (dict(card_key=100_000), "false"), ({}, "true")):
        got = read_clustered(spark, base + "/clustered", **within)
        assert sorted(r.price for r in got.collect()) == sorted(r.price for r in rows.where(where).collect())
    assert _scanned(read_clustered(spark, base + "/clustered", day=day))[0] <= 40


def test_the_curve_interleaves_ranks(spark):
    df = spark.createDataFrame([(x, y) for x in range(4) for y in range(4)] + [(None, None)], "x int, y int")
    got = {(r.x, r.y): r.z for r in df.select("x", "y", morton(df, ["x", "y"], bits=2, error=0.0).alias("z")).collect()}
    assert got.pop((None, None)) == 0
    assert len(set(got.values())) == 16
    assert {got[x, y] for x in (0, 1) for y in (0, 1)} == {0, 1, 2, 3}
