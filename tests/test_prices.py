"""Latest prices as stream state: order of days, late rows, expiry, bounded state."""

import datetime as dt
import json
import os
import random

from strata.streaming import file_stream, held_prices, run_latest_prices
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("card", T.StringType()), T.StructField("finish", T.StringType()),
                       T.StructField("day", T.DateType()), T.StructField("price", T.DoubleType())])
START = dt.date(2026, 1, 1)


def _day(folder, name, rows):
    with open(os.path.join(folder, f"{name:03d}.json"), "w") as f:
        f.writelines(json.dumps({"card": c, "finish": x, "day": d and str(d), "price": p}) + "\n" for c, x, d, p in rows)


def _run(spark, root):
    stream = file_stream(spark, os.path.join(root, "in"), SCHEMA, multi_line=False, max_files_per_trigger=1)
    return run_latest_prices(stream, ["card", "finish"], "day", "price", 5, os.path.join(root, "out"), os.path.join(root, "ckpt"))


def _held(spark, root):
    return {(r.card, r.finish): (dt.datetime.fromtimestamp(r.time_ms / 1000, dt.UTC).date(), r.price)
            for r in held_prices(spark, os.path.join(root, "out"), ["card", "finish"]).collect()}


def test_days_in_any_order(spark, tmp_root):
    os.makedirs(os.path.join(tmp_root, "in"))
    r = random.Random(3)
    days = list(range(12))
    r.shuffle(days)
    seen = []
    for i, d in enumerate(days):
        rows = [(f"c{c}", x, START + dt.timedelta(d), float(r.randrange(100))) for c in range(12) for x in ("plain", "foil")
                if r.random() < 0.3 and (c < 9 or d < 4)]
        rows += rows[:2] + [(None, "plain", START, 1.0), ("c1", "plain", None, 1.0), ("c1", "foil", START, None)]
        seen += [x for x in rows if None not in x]
        _day(os.path.join(tmp_root, "in"), i, rows)
    progress = _run(spark, tmp_root)
    newest = max(x[2] for x in seen)
    best = {}
    for c, x, d, p in seen:
        best[c, x] = max(best.get((c, x), (d, p)), (d, p))
    fresh = {k: v for k, v in best.items() if v[0] > newest - dt.timedelta(5)}
    assert _held(spark, tmp_root) == fresh and 0 < len(fresh) < len(best)
    # A second run has nothing to do; a late day after it changes nothing.
    assert _run(spark, tmp_root) == [] or _held(spark, tmp_root) == fresh
    late = next(iter(fresh))
    _day(os.path.join(tmp_root, "in"), 90, [(*late, newest - dt.timedelta(4), 1e9)] if fresh[late][0] > newest - dt.timedelta(4) else [])
    _run(spark, tmp_root)
    assert _held(spark, tmp_root) == fresh
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] <= 3 * len(best) + 3


def test_state_stays_bounded(spark, tmp_root):
    os.makedirs(os.path.join(tmp_root, "in"))
    for d in range(16):  # ever new cards
        _day(os.path.join(tmp_root, "in"), d, [(f"c{d}-{i}", "plain", START + dt.timedelta(d), 1.0) for i in range(10)])
    progress = _run(spark, tmp_root)
    states = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    held = _held(spark, tmp_root)
    assert len(held) == 50 and min(d for d, _ in held.values()) == START + dt.timedelta(11)
    per_key = max(states[:2]) / 10  # rows of state for one key: its price and its timers
    assert max(states) <= per_key * 10 * 7 and states[-1] <= per_key * 50
    changes = spark.read.parquet(os.path.join(tmp_root, "out")).groupBy("change").count().collect()
    assert {r["change"]: r["count"] for r in changes} == {"new": 160, "expired": 110}


def test_a_key_asks_the_state_store_once():
    """Each call is a round trip: whether a price is held and which one is asked in one."""
    from pyspark.sql import Row

    from strata.streaming.prices import _LatestPrice

    class Store:
        held, calls = None, []

        def __getattr__(self, name):
            def call(*args):
                self.calls.append(name)
                if name == "update":
                    Store.held = args[0]
                return {"get": Store.held, "exists": Store.held is not None, "getValueState": self}.get(name)
            return call

    store, p = Store(), _LatestPrice(["k"])
    p.init(store)
    rows = lambda *at: iter([Row(time_ms=t, price=x) for t, x in at])
    assert [(r.change, r.time_ms, r.n_rows) for r in p.handleInputRows((1,), rows((5, 1.0), (7, 2.0)), None)] == [("new", 7, 2)]
    assert [(r.change, r.time_ms, r.n_rows) for r in p.handleInputRows((1,), rows((6, 1.0), (9, 2.0)), None)] == [("new", 9, 1), ("late", None, 1)]
    assert store.calls == ["getValueState", "get", "update", "registerTimer", "get", "deleteTimer", "update", "registerTimer"]
