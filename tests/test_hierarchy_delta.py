"""Tiers after changed edges equal the tiers worked out anew, and only what changes is touched."""

import random

from strata.operators import hierarchy_tier
from strata.operators.hierarchy_delta import hierarchy_delta

SCHEMA = "name string, parent string"


def _frame(spark, edges):
    return spark.createDataFrame(sorted(edges, key=str), SCHEMA)


def _tiers(edges):
    out, level = {c: 1 for c, p in edges if p is None}, 1
    while True:
        found = {c for c, p in edges if p in out and out[p] == level and c not in out}
        if not found:
            return out
        level += 1
        out |= {c: level for c in found}


def _delta(spark, before, after):
    tiers = spark.createDataFrame(sorted(_tiers(before).items()) or [], "name string, tier int")
    new, touched = hierarchy_delta(tiers, _frame(spark, after), _frame(spark, after - before), _frame(spark, before - after), "name", "parent")
    return {r.name: r.tier for r in new.collect()}, {r.name: (r.old_tier, r.new_tier) for r in touched.collect()}


def test_random_changes(spark):
    r = random.Random(5)
    for _ in range(3):
        names = [f"n{i}" for i in range(25)]
        pick = lambda: (r.choice(names), r.choice([None, *names, "gone"]) if r.random() < 0.2 else r.choice(names))
        before = {pick() for _ in range(40)} | {("n0", None)}
        after = {e for e in before if r.random() < 0.7} | {pick() for _ in range(8)}
        new, touched = _delta(spark, before, after)
        old, want = _tiers(before), _tiers(after)
        assert new == want
        assert touched == {n: (old.get(n), want.get(n)) for n in {*old, *want} if old.get(n) != want.get(n)}


def test_only_what_hangs_on_an_edge_is_touched(spark):
    # A chain under a root, with a second way to its third node, and a ring that loses its way in.
    chain = {("a", None), ("b", "a"), ("c", "b"), ("d", "c"), ("e", "d"), ("c", "x"), ("x", "y"), ("y", "a")}
    ring = {("r1", "a"), ("r2", "r1"), ("r1", "r2")}
    new, touched = _delta(spark, chain | ring, (chain | ring) - {("b", "a"), ("r1", "a")})
    assert new == {"a": 1, "y": 2, "x": 3, "c": 4, "d": 5, "e": 6}
    assert touched == {"b": (2, None), "c": (3, 4), "d": (4, 5), "e": (5, 6), "r1": (2, None), "r2": (3, None)}
    new, touched = _delta(spark, chain | ring, chain | ring | {("x", "a"), ("z", "e")})
    assert touched == {"x": (3, 2), "z": (None, 6)}
    assert _delta(spark, chain, chain)[1] == {}


def test_equals_the_breadth_first_operator(spark):
    edges = {("a", None), ("b", "a"), ("c", "b"), ("q", "none")}
    want = {r.name: r.tier for r in hierarchy_tier(_frame(spark, edges), "name", "parent").collect()}
    assert _delta(spark, set(), edges)[0] == want == {"a": 1, "b": 2, "c": 3}
    assert _delta(spark, edges, set())[0] == {}
