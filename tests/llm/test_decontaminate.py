import hashlib

import pytest

from strata.llm import decontaminate
from tests.llm.helpers import awkward_texts, documents, prose, words

ITEMS = [(10, prose(100, 30)), (2, prose(101, 10)), (33, "river1 stone2 maple3"), (4, ""), (5, None), (None, prose(6, 80)),
         (10, prose(100, 30)), (7, prose(4, 12_000)), (8, "the " * 12), (9, prose(101, 9)), (11, "!!!")]


def brute(text, items):
    w = words(text)
    hit, found = set(), set()
    for i, t in items:
        v = words(t)
        if i is None or not v:
            continue
        n = min(10, len(v))
        grams = {tuple(v[j:j + n]) for j in range(len(v) - n + 1)}
        at = [p for p in range(len(w) - n + 1) if tuple(w[p:p + n]) in grams]
        if at:
            found.add(str(i))
        hit.update(x for p in at for x in range(p, p + n))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def _docs():
    long = prose(100, 30).split()
    return awkward_texts() + [
        prose(7, 40) + " " + " ".join(long[5:15]) + " " + prose(8, 40),   # ten words of an item: a hit
        prose(7, 40) + " " + " ".join(long[5:14]) + " " + prose(8, 40),   # nine: none
        "x " + " ".join(long[:17]).upper().replace(" ", ", ") + " y " + " ".join(long[17:]),
        prose(101, 10), prose(101, 9), "RIVER1, stone2-maple3?", prose(12, 30) + " river1 stone2 maple3 " + prose(101, 10)]


def test_against_brute_force(spark):
    texts = _docs()
    docs = documents(spark, [*texts, texts[0]], [*range(len(texts)), None])
    items = spark.createDataFrame([(i, t, "a", 1) for i, t in ITEMS], "item_id long, text string, hash string, n int")
    rows = decontaminate.contamination(docs, items).collect()
    assert len(rows) == len(texts) + 1
    got = {r.doc_id: tuple(r)[1:] for r in rows if r.doc_id is not None}
    assert got == {i: brute(t, ITEMS) for i, t in enumerate(texts)}
    assert sum(r.contaminated for r in rows) > 6
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    clean = {i for i, t in enumerate(texts) if not brute(t, ITEMS)[-1]}
    assert {r.doc_id for r in kept.collect()} == clean | {None}


def test_every_span_of_the_window_length_is_found(spark):
    item = prose(55, 40).split()
    texts = [f"{prose(i, 7)} {' '.join(item[i:i + 10])} {prose(i + 50, 5)}" for i in range(31)]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    rows = decontaminate.contamination(documents(spark, texts), items).collect()
    assert [r.n_hit >= 10 for r in rows] == [True] * 31


@pytest.mark.parametrize("n_docs,n_items", [(0, 1), (2, 0), (0, 0)])
def test_empty_tables(spark, n_docs, n_items):
    items = spark.createDataFrame(ITEMS[:n_items], "item_id long, text string")
    rows = decontaminate.contamination(documents(spark, ["a b", prose(100, 30)][:n_docs]), items).collect()
    assert len(rows) == n_docs and not any(r.contaminated for r in rows)
