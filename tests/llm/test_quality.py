import math
import random

from pyspark.sql import functions as F

from strata.llm import quality
from tests.llm.helpers import awkward_texts, documents, prose


def _corpus(n=500):
    r = random.Random(9)
    texts, good = [], []
    for i in range(n):
        t = prose(i, 20 + r.randrange(60)) + "."
        if i % 5 == 0:
            t = " | ".join(t.split()) if i % 2 else " ".join(w + "%%%" for w in t.split())
        texts.append(t)
        good.append(int(i % 5 != 0))
    return texts, good


def test_held_out_accuracy_and_awkward_rows(spark):
    texts, good = _corpus()
    extra = awkward_texts()
    docs = documents(spark, texts + extra, [*range(500), *(None if t == "one" else 1000 + k for k, t in enumerate(extra))])
    labels = spark.createDataFrame([*((i, y, 0) for i, y in enumerate(good)), (None, 1, 1), (4, None, 0), (9, 1, 0)],
                                   "doc_id long, quality int, host int")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    rows = quality.score(docs, labels, train=fold).collect()
    assert len(rows) == len(texts) + len(extra)
    by_id = {r.doc_id: r for r in rows}
    import zlib
    held = [i for i in range(500) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(by_id[i].keep == (good[i] == 1) for i in held) >= 0.97 * len(held)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.keep)


def test_shrinkage_against_plain_arithmetic(spark):
    rows = [(h, p, 0.02 * k + 0.1 * (h == "a")) for h, p, n in (("a", "x", 9), ("a", "y", 1), ("b", "x", 20), (None, None, 3))
            for k in range(n)]
    groups = {}
    for h, p, v in rows:
        groups.setdefault((h, p), []).append(v)
    mean = sum(v for *_, v in rows) / len(rows)
    frame = spark.createDataFrame([(len(v), sum(v), sum(x * x for x in v)) for v in groups.values()], "n long, s double, q double")
    k, n = len(groups), len(rows)
    between = sum(len(v) * (sum(v) / len(v) - mean) ** 2 for v in groups.values())
    within = sum((x - sum(v) / len(v)) ** 2 for v in groups.values() for x in v)
    typical = (n - sum(len(v) ** 2 for v in groups.values()) / n) / (k - 1)
    spread = (between / (k - 1) - within / (n - k)) / typical
    want = 1e6 if spread <= 0 else min(max(mean * (1 - mean) / spread - 1, 1), 1e6)
    assert math.isclose(quality._strength(frame, mean), want, rel_tol=1e-9)


def test_sparse_sites_stay_near_their_prior(spark):
    texts, good = _corpus(400)
    bad = " ".join(w + "%%%" for w in prose(7, 40).split())
    rows = [(i, t, "en", "big", len(t)) for i, t in enumerate(texts)]
    rows += [(1000 + i, bad, "en", "farm", 9) for i in range(60)] + [(2000, prose(3, 40) + ".", "fr", "tiny", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame(list(enumerate(good)), "doc_id long, quality int")
    out = {r.doc_id: r for r in quality.score(docs, labels).collect()}
    total = sum(r.host_rate for r in out.values()) / len(out)
    assert out[1000].host_rate < 0.3 < out[0].host_rate
    assert out[2000].keep and abs(out[2000].path_rate - total) < 0.3
    assert all(not out[1000 + i].keep for i in range(60))


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.score(documents(spark, ["a b", None, ""]), none).collect()
    assert len(rows) == 3 and all(abs(r.evidence) < 1e-9 for r in rows)
    assert quality.score(documents(spark, []), none).collect() == []
    assert quality.keep_good(documents(spark, []), none).collect() == []
