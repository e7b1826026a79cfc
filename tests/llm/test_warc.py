import hashlib
import heapq
import random

from hypothesis import given
from hypothesis import strategies as st

from strata.llm import warc


@given(st.lists(st.lists(st.integers(0, 20)), max_size=9))
def test_loser_tree_merges(lists):
    lists = [sorted(x) for x in lists]
    got = [lists[a][i] for a, i in warc.LoserTree(lists)]
    assert got == list(heapq.merge(*lists))


def _pages():
    r = random.Random(5)
    big = "<html>" + "x" * 200
    rows = [(i, f"https://www.host{r.randrange(4)}.example.org:8080/p/{r.randrange(9)}?q={i}#top", f"<p>page {i}</p>" * 20)
            for i in range(60)]
    rows += [(100, "http://a.example/1", big), (101, "http://a.example/2", big), (99, "http://a.example/3", big),
             (102, None, big), (None, "http://a.example/4", big), (99, "http://a.example/3", big),
             (103, "http://b.example/", "short"), (104, "http://b.example/", "short"), (105, "http://b.example/\r\nX: y", None),
             (106, "", ""), (107, "no url at all", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 9),
             (108, "http://ü.example/ß", "Ünïcödé ✓ 🎉 " * 30), (109, "http://c.example/", "y" * 400_000), (None, None, None)]
    return rows


def _brute(rows):
    first = {}
    for i, _, html in rows:
        p = (html or "").encode()
        if len(p) >= 100 and i is not None:
            first[p] = min(first.get(p, i), i)
    seen = {}
    for _, _, html in rows:
        p = (html or "").encode()
        seen[p] = seen.get(p, 0) + 1
    out = []
    for i, _, html in rows:
        p = (html or "").encode()
        to = first.get(p) if seen[p] > 1 and first.get(p) != i else None
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(map(str, out))


def test_round_trip_against_brute_force(spark):
    rows = _pages()
    df = spark.createDataFrame([(*r, "d", "t") for r in rows], "page_id long, url string, html string, digest string, time string")
    out = warc.archive_and_index(df.repartition(4)).collect()
    got = sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in out)
    assert got == _brute(rows)


def test_index_is_in_global_order_and_small_ranges_merge(spark):
    rows = _pages()[:60]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    path = warc.scratch_path(spark, "warc-test")
    warc.write_archives(df, path, records_per_file=7)
    read = warc.read_archives(spark, path)
    index = warc.capture_index(read, rows_per_range=9).collect()
    keys = [(r.url_key, r.time, r.page_id) for r in index]
    assert keys == sorted(keys) and len(keys) == 60
    assert index[0].url_key.startswith("org,example,host0)/p/")


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_and_index(df).collect() == []
