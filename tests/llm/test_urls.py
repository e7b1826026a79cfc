import datetime as dt
import random
import re

from strata.llm import urls

DAY = dt.date(2024, 1, 1)


def _entries(seed, n):
    r = random.Random(seed)
    patterns = ["a.example.org", ".example.org", ".org", "a.example.org/x", "a.example.org/x/y", "b.test", "b.test/x", ".none.at"]
    return [(r.choice(["l1", "l2"]), r.choice(patterns), r.choice(["block", "allow"]), DAY + dt.timedelta(r.randrange(-40, 400)))
            for _ in range(n)]


def _patterns(url):
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", url or "")
    if not m or not m[1]:
        return {}
    host = m[1].lower()
    parts = host.split(".")
    out = {"." + ".".join(parts[i:]): 0 for i in range(len(parts) - 1)}
    out[host] = 1
    path = re.match(r"[^:]+://[^/?#]*(/[^?#]*)", url)
    seg = [s for s in (path[1].split("/") if path else []) if s]
    return out | {host + "/" + "/".join(seg[:i]): 2 for i in range(1, len(seg) + 1)}


def _brute(url, day, entries):
    by_list, n = {}, 0
    log = {}
    for name, pattern, action, since in entries:
        if None not in (name, pattern, since) and action in ("block", "allow"):
            log.setdefault((name, pattern), []).append((since, action))
    for (name, pattern), own in log.items():
        ranks = _patterns(url)
        past = [x for x in own if day is not None and x[0] <= day]
        if pattern in ranks and past:
            n += 1
            by_list.setdefault(name, []).append((ranks[pattern], len(pattern), pattern, max(past)[1]))
    decided = {name: max(x)[3] for name, x in by_list.items()}
    return n, ",".join(sorted(k for k, a in decided.items() if a == "block")), max(decided.values(), default="none")


def _check(spark, captures, entries):
    df = spark.createDataFrame([(*c, "p", 1, "l") for c in captures],
                               "page_id long, url string, fetched timestamp, pattern string, rank int, list string")
    log = spark.createDataFrame([(*e, 1) for e in entries], "list string, pattern string, action string, day date, row int")
    got = sorted(str(tuple(r)) for r in urls.evaluate(df.repartition(3), log).collect())
    assert got == sorted(str((i, *_brute(u, t and t.date(), entries))) for i, u, t in captures)


def test_against_brute_force(spark):
    r = random.Random(1)
    all_urls = ["https://a.example.org/x/y?q#t", "http://A.Example.ORG:80/x", "https://a.example.org", "http://b.test/x/", "http://c.at/",
                "http://b.test//x//y", None, "", "no url", "http:///x", "https://a.example.org/" + "z/" * 300]
    captures = [(i, r.choice(all_urls), dt.datetime(2024, 1, 1) + dt.timedelta(hours=r.randrange(24 * 420))) for i in range(300)]
    captures += [(None, all_urls[0], dt.datetime(2024, 5, 5)), (7, all_urls[0], None), captures[0], captures[0]]
    entries = _entries(2, 120) + [(None, "b.test", "block", DAY), ("l1", None, "block", DAY), ("l1", "b.test", "block", None),
                                  ("l1", "b.test", "maybe", DAY), ("l1", "b.test", None, DAY)]
    _check(spark, captures, entries + entries[:30])


def test_empty_tables(spark):
    _check(spark, [], _entries(3, 5))
    _check(spark, [(1, "http://b.test/x", dt.datetime(2024, 1, 1))], [])
    _check(spark, [], [])
    _check(spark, [(1, "http://b.test/x", None)], _entries(3, 5))


def test_no_python_on_the_path(spark):
    df = spark.createDataFrame([(1, "http://b.test/x", dt.datetime(2024, 1, 1))], "page_id long, url string, fetched timestamp")
    log = spark.createDataFrame(_entries(3, 5), "list string, pattern string, action string, day date")
    plan = urls.evaluate(df, log)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
