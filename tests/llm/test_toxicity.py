import itertools
import zlib

import numpy as np

from strata.llm import toxicity
from tests.llm.helpers import awkward_texts, documents, prose


def _enumerated(model, codes):
    """Marginals by summing over all tag sequences."""
    total, toxic = 0.0, np.zeros(len(codes))
    for tags in itertools.product((0, 1), repeat=len(codes)):
        s = model.start[tags[0]] + sum(model.emit[c, t] for c, t in zip(codes, tags))
        s += sum(model.step[a, b] for a, b in zip(tags, tags[1:]))
        total += np.exp(s)
        toxic += np.exp(s) * np.array(tags)
    return toxic / total


def test_marginals_over_gaps_equal_enumeration():
    r = np.random.default_rng(2)
    model = toxicity.Model()
    model.start, model.step, model.emit = r.normal(size=2), r.normal(size=(2, 2)), r.normal(size=model.emit.shape)
    sequences = [np.array(s) for s in ([3], [0, 0, 2, 0, 0, 0], [1, 1, 0, 0, 0, 4, 0, 2], [0, 5, 0], [2, 0, 0, 0, 0, 0, 0, 0, 0, 1])]
    at = [np.flatnonzero(s) for s in sequences]
    got = toxicity.marginals(model, [s[p] for s, p in zip(sequences, at)], [np.diff(p, prepend=-1) - 1 for p in at],
                             np.array([len(s) - 1 - p[-1] for s, p in zip(sequences, at)]))
    for s, p, m in zip(sequences, at, got):
        assert np.allclose(m, _enumerated(model, s)[p])


def _corpus():
    insults = ["blargo", "blargoness", "blargoly", "zerk", "vumpish"]
    texts, toxic = [], []
    for i in range(700):
        t = prose(i, 30 + i % 50)
        if i % 6 == 0:
            w = t.split()
            for k in range(3):
                w.insert((7 * k + i) % len(w), insults[(i + k) % 5])
            t = " ".join(w)
        texts.append(t)
        toxic.append(int(i % 6 == 0))
    return texts, toxic


def test_held_out_accuracy_spans_and_awkward_rows(spark):
    texts, toxic = _corpus()
    extra = awkward_texts() + ["You BLARGOFUL zerk."]
    docs = documents(spark, texts + extra, [*range(700), *(None if t == "one" else 1000 + k for k, t in enumerate(extra))])
    labels = [(i, 1, y) for i, y in enumerate(toxic)] + [(None, 1, 1), (3, None, None), (5000, 1, 1), (6, 1, 1), (1001, 0, None)]
    rows = toxicity.score_documents(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(rows) == len(texts) + len(extra) and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r for r in rows}
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.3)
    held = [i for i in range(700) if by_id[i].held_out]
    assert len(held) > 100
    assert sum(by_id[i].predicted == toxic[i] for i in held) >= 0.98 * len(held)
    found = by_id[1000 + len(extra) - 1]
    assert found.predicted == 1  # an unseen form of a known word, upper-case
    assert {"You BLARGOFUL zerk."[s.start:s.end] for s in found.spans} == {"BLARGOFUL zerk"}
    assert by_id[1005].spans == [] and by_id[1004].score == by_id[1005].score < 0.3


def test_labels_of_held_out_rows_are_not_read(spark):
    texts, toxic = _corpus()
    docs = documents(spark, texts)
    flipped = [1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y for i, y in enumerate(toxic)]
    out = []
    for y in (toxic, flipped):
        labels = spark.createDataFrame(list(enumerate(y)), "doc_id long, toxic int")
        out.append(sorted((r.doc_id, round(r.score, 9)) for r in toxicity.score_documents(docs, labels).collect()))
    assert out[0] == out[1]


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.score_documents(documents(spark, ["a b", None]), none).collect()
    assert [r.score for r in rows] == [0.5, 0.5]
    one = spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, toxic int")
    assert all(r.predicted == 1 for r in toxicity.score_documents(documents(spark, ["a b", "c d"]), one).collect())
    assert toxicity.score_documents(documents(spark, []), one).collect() == []
