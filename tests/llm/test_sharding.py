import random
import zlib

import pytest

from strata.llm import queries, sharding
from tests.llm.helpers import awkward_texts, documents, prose

SF = "/root/testdata/sf0.001"


def least_capacity(sizes, shards):
    """The smallest capacity by trying: greedy filling from one size after another."""
    def fits(c):
        used, room = 1, c
        for s in sizes:
            if s > c:
                return False
            if s > room:
                used, room = used + 1, c
            room -= s
        return used <= shards
    low, high = 0, sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def brute(groups, shards):
    """{key: shard} of (key, bytes): large groups alone, the others by greedy filling in key order."""
    out, left, n = {}, sum(b for _, b in groups), shards
    rest = sorted(groups, key=lambda g: (-g[1], g[0]))
    while rest and n and rest[0][1] * n >= left:
        out[rest[0][0]] = len(out)
        left -= rest.pop(0)[1]
        n -= 1
    alone, rest = len(out), sorted(rest)
    capacity = least_capacity([b for _, b in rest], n) if rest else 0
    shard, room = alone, capacity
    for key, b in rest:
        if b > room:
            shard, room = shard + 1, capacity
        room -= b
        out[key] = shard
    return out, capacity


@pytest.mark.parametrize("seed, cells", [(1, 16), (2, 1 << 15), (3, 64), (5, 32)])
def test_partition_against_greedy_filling(spark, seed, cells):
    r = random.Random(seed)
    shape = [lambda: r.randrange(1, 50), lambda: int(r.paretovariate(0.8)), lambda: r.choice([1, 900])][seed % 3]
    top = 1 << (60 if seed != 5 else 12)  # seed 5: keys crowd in one cell
    groups = list({r.randrange(top): shape() for _ in range(700)}.items())
    df = spark.createDataFrame(groups, "key long, bytes long")
    for n in (1, 17):
        alone, first, capacity = sharding.partition(df, n, cells)
        want, c = brute(groups, n)
        got = {k: alone.index(k) if k in alone else len(alone) + sum(k >= f for f in first) for k, _ in groups}
        assert (got, capacity) == (want, c)


def test_awkward_rows_and_empty_tables(spark):
    texts = [*awkward_texts(), "x", "x"]
    ids = [5, 5, None, None, *range(4, len(texts))]
    rows = sharding.shards(documents(spark, texts, ids), 4, cells=16).collect()
    assert len(rows) == len(texts)
    sizes = {}
    for t in texts:
        sizes[t or ""] = sizes.get(t or "", 0) + len((t or "").encode()) + 16
    keys = {r.text_crc32: r.key for r in rows}
    want, _ = brute([(keys[zlib.crc32(t.encode())], b) for t, b in sizes.items()], 4)
    assert sorted((r.doc_id or -1, r.size, r.text_crc32, r.shard) for r in rows) == sorted(
        (i or -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), want[keys[zlib.crc32((t or "").encode())]])
        for i, t in zip(ids, texts))
    for s in {r.shard for r in rows}:
        own = sorted((r for r in rows if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        assert [r.doc_id or -1 for r in own] == sorted(r.doc_id or -1 for r in own)
    assert sharding.shards(documents(spark, [])).collect() == []
    assert [r.shard for r in sharding.shards(documents(spark, [prose(1, 9)])).collect()] == [0]


def test_a_large_group_of_copies_leaves_no_shard_empty(spark):
    texts = ["copy " * 200] * 60 + [prose(i, 40 + i % 9) for i in range(100)]
    rows = sharding.shards(documents(spark, texts), 10, cells=64).collect()
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r)
    assert sorted(by_shard) == list(range(10))
    assert len(by_shard[0]) == 60 and len({r.key for r in by_shard[0]}) == 1
    rest = [sum(r.size for r in by_shard[s]) for s in range(1, 10)]
    assert max(rest) < 1.2 * sum(rest) / 9


def test_native_plan(spark):
    plan = queries.QUERIES["op12_sharding"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
