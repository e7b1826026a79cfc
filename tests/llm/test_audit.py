import re
from collections import Counter
from itertools import permutations

from strata.llm import audit
from tests.llm.helpers import awkward_texts, documents, prose

COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def fails(doc_id, t, docs):
    t = t or ""
    w = words(t)
    return {name for name, bad in (
        ("A", len(w) < 200), ("B", 100 * len(set(w)) < 50 * len(w)), ("C", 100 * len(re.findall("[A-Z]", t)) > 3 * len(t)),
        ("D", re.search(r"[#$%&*|]", t)),
        ("E", doc_id is not None and any(i is not None and i < doc_id and (u or "") == t for i, u, _ in docs))) if bad}


def brute(docs, labels):
    rows = [(part or "", fails(i, t, docs), any(i is not None and i == d and q == 1 for d, q, _ in labels),
             any(i is not None and i == d and x == 1 for d, _, x in labels)) for i, t, part in docs]
    out, total = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            for s, f in enumerate(order):
                before = set(order[:s])
                removed = [r for r in rows if r[0] == part and f in r[1] and not r[1] & before]
                total[part, f] += len(removed)
                out[part, "".join(order), s + 1] = [
                    sum(r[0] == part and not r[1] & (before | {f}) for r in rows), len(removed),
                    sum(r[0] == part and f in r[1] and bool(r[1] & before) for r in rows),
                    sum(r[0] == part and r[1] == {f} for r in rows), sum(r[2] for r in removed), sum(r[3] for r in removed)]
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


LABELS = "doc_id long, quality int, toxic int, part string"


def test_audit_against_brute_force(spark):
    texts = [*awkward_texts(), prose(8, 250), prose(8, 250), "WORD word " * 150, "plain word " * 150, prose(9, 300) + " 5 % off",
             prose(9, 300).upper(), "é" * 33 + "A", "é" * 32 + "A"]
    ids = [7, 7, None, None, *range(4, len(texts) - 1), 4]
    df = documents(spark, texts, ids)
    docs = [(r.doc_id, r.text, r.lang) for r in df.collect()]
    labels = [(4, 1, 0), (4, 0, 1), (5, None, None), (None, 1, 1), (7, 1, 0), (20, 1, 1), (20, 1, 1), (22, 0, 1), (999, 1, 1)]
    got = audit.audit(df, spark.createDataFrame([(*x, "p") for x in labels], LABELS)).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in COLUMNS) for r in got} == brute(docs, labels)
    assert len(got) == 2 * 600


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert audit.audit(documents(spark, []), none).collect() == []
    assert len(audit.audit(documents(spark, ["", None]), none).collect()) == 2 * 600  # two languages


def test_matrix_is_the_count_of_words(spark):
    texts = awkward_texts()
    matrix, dictionary = audit.document_term_matrix(documents(spark, texts))
    names = {r.term: r.word for r in dictionary.collect()}
    everything = sorted({w for t in texts for w in words(t)}, key=lambda w: w.encode())
    assert [names[k] for k in sorted(names)] == everything and sorted(names) == list(range(1, len(names) + 1))
    got = {}
    for s in matrix.collect():
        for i, d in enumerate(s.doc_ids):
            a, b = s.row_starts[i], s.row_starts[i + 1]
            got[d] = dict(zip((names[c] for c in s.columns[a:b]), s.counts[a:b]))
    assert got == {i: dict(Counter(words(t))) for i, t in enumerate(texts)}
