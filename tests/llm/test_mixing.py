import hashlib
import re

import pytest

from strata.llm import mixing
from tests.llm.helpers import awkward_texts, documents, prose


def _topic(t):
    for name, p in mixing.TOPICS:
        if re.search(p, t or ""):
            return name
    return "prose"


def _u(i):
    return int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:13], 16) / 2 ** 52


def _texts():
    extra = ["Licensed under terms " + prose(1, 30), "mail a@b.example " + prose(2, 50), "see https://x.example " + prose(3, 9),
             "a | b | c | " + prose(4, 40)]
    return awkward_texts() + extra * 4 + [prose(i, 10 + 7 * i) for i in range(30)]


def test_against_plain_raking(spark):
    texts = _texts()
    ids = [None if t == "one" else i for i, t in enumerate(texts)]
    docs = documents(spark, texts, ids)
    rows = mixing.weigh(docs).collect()
    assert len(rows) == len(texts)
    source = {(r.doc_id, r.text): (r.source, r.lang) for r in docs.collect()}
    cell, tokens = {}, {}
    for i, t in zip(ids, texts):
        k = (*source[(i, t)], _topic(t))
        cell[i] = k
        tokens[k] = tokens.get(k, 0) + len(re.findall("[^ \t-\r]+", t or ""))
    total = sum(tokens.values())
    weight = dict.fromkeys(tokens, 1.0)
    for _ in range(40):
        for d in range(3):
            own = {}
            for k, n in tokens.items():
                own[k[d]] = own.get(k[d], 0) + n
            norm = sum(n ** 0.7 for n in own.values())
            margin = {v: sum(weight[k] * n for k, n in tokens.items() if k[d] == v) for v in own}
            for k in weight:
                if margin[k[d]] > 0:
                    weight[k] *= own[k[d]] ** 0.7 / norm * total / margin[k[d]]
    low, high = 0.0, 1e6
    for _ in range(200):  # the rate, by bisection
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(1, mid * weight[k]) * n for k, n in tokens.items()) < total / 2 else (low, mid)
    for r in rows:
        k = cell[r.doc_id]
        assert (r.source, r.lang, r.topic) == k
        assert r.weight == pytest.approx(weight[k], rel=1e-6)
        assert r.probability == pytest.approx(min(1, low * weight[k]), rel=1e-6)
        assert r.sampled == (_u(r.doc_id) < r.probability)
    kept = mixing.sample_documents(docs)
    assert kept.columns == [*docs.columns, "_topic", "_weight", "_probability"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.sampled)


def test_given_targets_are_met(spark):
    texts = [prose(i, 50) for i in range(40)]
    docs = documents(spark, texts).fillna({"lang": "de", "source": "src0"})
    targets = spark.createDataFrame([("source", "src0", 0.3), ("source", "src1", 0.7), ("lang", "en", 0.5), ("lang", "de", 0.5),
                                     ("topic", "prose", 1.0), ("topic", "unused", 0.4)], "dimension string, value string, share double")
    rows = mixing.weigh(docs, targets=targets).collect()
    total = sum(r.n_tokens for r in rows)
    for value, share in (("src0", 0.3), ("src1", 0.7)):
        assert sum(r.weight * r.n_tokens for r in rows if r.source == value) == pytest.approx(share * total, rel=1e-6)
    assert sum(r.probability * r.n_tokens for r in rows) == pytest.approx(total / 2, rel=1e-6)


def test_tied_cells_go_on_until_the_margins_hold(spark):
    """Each source has nearly all of its tokens in one language, so eight rounds leave the margins off."""
    cells = spark.createDataFrame([(f"s{i}", f"l{j}", "prose", 1000 if i == j else (600 if abs(i - j) == 1 else 50)) for i in range(4) for j in range(4)],
                                  "source string, lang string, topic string, tokens long")
    shares = {"source": [0.1, 0.2, 0.3, 0.4], "lang": [0.12, 0.18, 0.31, 0.39]}
    targets = spark.createDataFrame([(d, f"{d[0]}{i}", x) for d, xs in shares.items() for i, x in enumerate(xs)] + [("topic", "prose", 1.0)],
                                    "dimension string, value string, share double")
    rows = mixing.rake(cells, targets).collect()
    total = sum(r.tokens for r in rows)
    for d, xs in shares.items():
        for i, x in enumerate(xs):
            assert sum(r.weight * r.tokens for r in rows if r[d] == f"{d[0]}{i}") / total == pytest.approx(x, abs=1e-8)


def test_targets_that_contradict_each_other_raise(spark):
    cells = spark.createDataFrame([("s0", "l0", "prose", 10), ("s1", "l1", "prose", 10)], "source string, lang string, topic string, tokens long")
    targets = spark.createDataFrame([("source", "s0", 0.2), ("source", "s1", 0.8), ("lang", "l0", 0.5), ("lang", "l1", 0.5),
                                     ("topic", "prose", 1.0)], "dimension string, value string, share double")
    with pytest.raises(ValueError, match="a margin is off by 0"):
        mixing.rake(cells, targets)


def test_clashing_names(spark):
    docs = documents(spark, [prose(i, 20) for i in range(20)])
    for name in ("_topic", "_cell", "_source", "_LANG"):
        docs = docs.withColumn(name, docs.n)
    kept = mixing.sample_documents(docs)
    assert kept.columns == [*docs.columns, "__topic", "_weight", "_probability"]
    assert {(r._topic, r["__topic"]) for r in kept.collect()} == {("w", "prose")}


def test_empty_tables_and_texts(spark):
    assert mixing.weigh(documents(spark, [])).collect() == []
    assert mixing.sample_documents(documents(spark, [])).collect() == []
    rows = mixing.weigh(documents(spark, [None, "", " "])).collect()
    assert [(r.n_tokens, r.weight) for r in rows] == [(0, 1.0)] * 3
