"""The paged source: resumes where it broke off, and reads no item twice."""

import json
import os
import shutil

import pytest
from pyspark.sql import types as T

from strata.sources import land_paged, paged, read_paged

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType()),
                       T.StructField("o", T.MapType(T.StringType(), T.DoubleType()))])


def _page(folder, number, ids, text=None):
    with open(os.path.join(folder, f"page_{number}.json"), "w") as f:
        f.write(json.dumps({"data": [{"id": i, "s": f"× {i}", "o": {"x": i / 3}} for i in ids]}) if text is None else text)


def _ids(df):
    return sorted(r.id for r in df.collect())


def _landed(out):
    """(epoch, page, position) as stored."""
    import pyarrow.parquet as pq
    rows = []
    for epoch in sorted(os.listdir(out)):
        t = pq.read_table(os.path.join(out, epoch), partitioning=None)
        rows += [(epoch, r["page"], r["position"]) for r in t.to_pylist()]
    return rows


def test_batch(spark, tmp_root):
    for n in range(3):
        _page(tmp_root, n, range(n * 5, n * 5 + (5 if n < 2 else 2)))
    df = read_paged(spark, tmp_root, SCHEMA, page_size=5)
    assert df.rdd.getNumPartitions() == 3
    assert [(r.page, r.position, r.id, r.s, r.o["x"]) for r in df.orderBy("page", "position").collect()] == [
        (i // 5, i % 5, i, f"× {i}", i / 3) for i in range(12)]
    assert read_paged(spark, "file:" + tmp_root, SCHEMA, first_page=1).count() == 7
    assert read_paged(spark, tmp_root + "/none", SCHEMA).count() == 0


def test_resume(spark, tmp_root):
    pages, out, checkpoint = (os.path.join(tmp_root, n) for n in ("pages", "out", "checkpoint"))
    os.makedirs(pages)
    land = lambda: land_paged(spark, pages, SCHEMA, "id", out, checkpoint, page_size=5)
    _page(pages, 0, range(5))
    _page(pages, 1, [5, 6])
    assert _ids(land()) == list(range(7))
    # The last page is fetched again as it was: nothing is added. Then it has grown, and page 3 comes before page 2.
    _page(pages, 1, [5, 6])
    land()
    assert len(_landed(out)) == 7
    _page(pages, 1, range(5, 10))
    _page(pages, 3, range(15, 18))
    assert _ids(land()) == list(range(10))
    # Page 2 is damaged: nothing of this run lands. What has landed is not read again: its pages are gone.
    _page(pages, 2, [], text='{"data": [{"id": 10')
    with pytest.raises(Exception, match="damaged page file"):
        land()
    shutil.move(os.path.join(pages, "page_0.json"), os.path.join(tmp_root, "page_0.json"))
    _page(pages, 0, [])
    _page(pages, 2, [9, 10, 11, 12, 13])
    assert _ids(land()) == [*range(14), 15, 16, 17]
    landed = _landed(out)
    assert len(landed) == 18 and len({r[1:] for r in landed}) == 18


def test_an_item_that_is_no_record_raises(spark, tmp_root):
    _page(tmp_root, 0, [], text='{"data": [{"id": 1}, {"id": "one"}]}')
    with pytest.raises(Exception):
        read_paged(spark, tmp_root, SCHEMA).collect()
    _page(tmp_root, 0, [], text='{"items": []}')
    with pytest.raises(Exception, match="damaged page file"):
        read_paged(spark, tmp_root, SCHEMA).collect()


def test_offsets(tmp_root):
    reader = paged._StreamReader({"path": tmp_root, "pageSize": "5"})
    assert reader.latestOffset() == reader.initialOffset() == {"page": 0, "item": 0}
    _page(tmp_root, 0, range(5))
    assert reader.latestOffset() == {"page": 1, "item": 0}
    _page(tmp_root, 2, range(5))
    _page(tmp_root, 1, range(3))
    assert reader.latestOffset() == {"page": 3, "item": 0}  # a short page with pages after it is done
    _page(tmp_root, 3, range(3))
    assert reader.latestOffset() == {"page": 3, "item": 3}
    parts = reader.partitions({"page": 0, "item": 2}, {"page": 3, "item": 3})
    assert [(p.page, p.start, p.end) for p in parts] == [(0, 2, None), (1, 0, None), (2, 0, None), (3, 0, 3)]
    assert reader.partitions({"page": 3, "item": 3}, {"page": 3, "item": 3}) == []


def test_very_many_pages_share_tasks(spark, tmp_root):
    n = 3 * paged.SINGLE_PAGES
    for i in range(n):
        _page(tmp_root, i, [2 * i, 2 * i + 1])
    df = read_paged(spark, tmp_root, SCHEMA, page_size=2)
    assert df.rdd.getNumPartitions() == paged.SINGLE_PAGES and _ids(df) == list(range(2 * n))
    reader = paged._StreamReader({"path": tmp_root, "pageSize": "2"})
    parts = reader.partitions({"page": 1, "item": 1}, {"page": n - 1, "item": 1})
    assert len(parts) < n / 2
    assert [x[:2] for p in parts for x in reader.read(p)] == [(1, 1), *((i, j) for i in range(2, n - 1) for j in (0, 1)), (n - 1, 0)]
