import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from strata.llm import queries, repeats
from tests.llm.helpers import awkward_texts, documents, prose

SF = "/root/testdata/sf0.001"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(w, min_words=24, times=3):
    """Every lag's diagonal, in full; a stretch counts for its smallest period only."""
    out = set()
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i - s + q
            part = w[s:s + length]
            if length >= max(min_words, times * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.add((s, length, q))
    return sorted(out)


def kept(w, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def plant(doc_id, text):
    w = split(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is None or h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def _codes(docs):
    names = {}
    flat = [names.setdefault(x, len(names)) for w in docs for x in w]
    return np.array(flat, dtype=np.int64), np.cumsum([0] + [len(w) for w in docs])


def found(docs, **how):
    flat, first = _codes(docs)
    out = [[] for _ in docs]
    for d, *run in repeats.find_runs(flat, first, **how).tolist():
        out[d].append(tuple(run))
    return out


def test_random_periodic_documents():
    r = random.Random(7)
    docs = []
    for _ in range(250):
        w = []
        while len(w) < r.choice([10, 80, 400]):
            unit = [r.choice("abcdefgh"[:r.randrange(1, 9)]) for _ in range(r.choice([1, 2, 3, 8, 16, 17, 33, 60]))]
            w += unit * r.randrange(1, 6) + unit[:r.randrange(len(unit))]
            if r.random() < 0.3:  # an edit inside
                w[r.randrange(len(w))] = "z"
        docs.append(w)
    assert found(docs) == [brute(w) for w in docs]
    assert found(docs[:60], min_words=9, times=4) == [brute(w, 9, 4) for w in docs[:60]]


def test_runs_in_runs_and_grams_that_come_more_than_once_a_period():
    a, b = [f"a{i}" for i in range(20)], [f"b{i}" for i in range(20)]
    unit = a * 3 + b * 3 + a * 2 + b * 2  # every pair of blocks comes at least twice in a period
    inner = ["x"] * 30 + ["y"]
    docs = [unit * 4, inner * 5, (["p", "q"] * 12 + ["r"]) * 3, ["w"] * 24, ["w"] * 23, a * 3, a[:8] * 3, a[:7] * 3, []]
    got = found(docs)
    assert got == [brute(w) for w in docs]
    assert (0, 400, 200)[1:] not in {(x[1], x[2]) for x in got[0]} and any(x[2] == 200 for x in got[0])


def test_thue_morse_words_and_long_periods():
    t = [bin(i).count("1") % 2 for i in range(4096)]
    docs = [t * 3, t]
    assert found(docs)[0] == [(0, 12288, 4096)] and found(docs)[1] == []


def test_least_overlap():
    assert repeats.least_overlap(24, 3) == 16
    with pytest.raises(ValueError):
        repeats.find_runs(np.zeros(3, np.int64), np.array([0, 3]), times=2)


def test_awkward_rows(spark):
    texts = [*awkward_texts(), "ha " * 40, "Ha ha " * 12, "x y " * 30, "one two\n" * 9 + "three " + "one two\t" * 20, prose(1, 30) + " la" * 50]
    ids = [7, 7, None, None, *range(4, len(texts))]
    rows = repeats.periodic_runs(documents(spark, texts, ids)).collect()
    want = sorted(((i is None, i or 0, len(split(t)), brute(split(t)), kept(split(t), brute(split(t)))) for i, t in zip(ids, texts)), key=str)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in rows), key=str)
    assert got == want
    assert repeats.digests(repeats.periodic_runs(documents(spark, []))).collect() == []


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        w = plant(d.doc_id, d.text)
        if len(w) > 3000 and len(set(w)) < len(w) // 50:
            continue  # too slow by brute force
        runs = brute(w)
        some += len(runs)
        r = got[d.doc_id]
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(kept(w, runs).encode()).hexdigest()
    assert some > 10
