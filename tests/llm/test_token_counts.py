import os
import re
import tempfile

import pytest

from strata.llm.token_counts import PATTERNS, TokenTotals, pattern_counts, vocabulary_counts
from tests.llm.helpers import awkward_texts, documents, prose

CHANGES = "doc_id long, tokenizer string, source string, lang string, n_tokens long, op string, batch long, sign int"


def _totals(store):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in store.totals().collect()}


def _changes(spark, rows):
    return spark.createDataFrame([(*r, 9, 9) for r in rows], CHANGES).repartition(2)


def test_batches_against_recount_and_replay(spark):
    store = TokenTotals(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/totals")
    assert _totals(store) == {}
    assert store.apply("one", _changes(spark, [
        (1, "t", "a", "en", 10, "insert"), (2, "t", "a", "en", 5, "insert"), (2, "u", "a", "en", 7, "insert"),
        (3, "t", None, None, 4, "insert"), (4, "t", "b", "fr", None, "insert"), (4, "t", "b", "fr", None, "insert"),
        (None, "t", "a", "en", 99, "insert"), (5, None, "a", "en", 99, "insert"), (6, "t", "a", "en", 99, "other")]))
    want = {("a", "en", "t"): (2, 15), ("a", "en", "u"): (1, 7), (None, None, "t"): (1, 4), ("b", "fr", "t"): (1, 0)}
    assert _totals(store) == want
    second = _changes(spark, [
        (1, "t", "a", "en", 12, "revise"), (2, "t", None, None, None, "delete"), (3, "t", "b", "fr", 6, "revise"),
        (9, "t", "a", "en", None, "delete"), (8, "t", "a", "en", 3, "insert"), (8, "t", "a", "en", 2, "revise")])
    assert store.apply("two", second)
    want = {("a", "en", "t"): (2, 15), ("a", "en", "u"): (1, 7), ("b", "fr", "t"): (2, 6)}
    assert _totals(store) == want
    assert not store.apply("two", second) and not store.apply("one", second)
    assert _totals(store) == want
    assert store.apply("none", _changes(spark, [])) and _totals(store) == want
    assert store.apply("three", _changes(spark, [(2, "t", "a", "en", 1, "insert"), (8, "t", None, None, 5, "delete")]))
    assert _totals(store) == want | {("a", "en", "t"): (2, 13)}


def test_a_batch_that_broke_off_is_written_anew(spark):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/totals"
    store = TokenTotals(spark, path)
    store.apply("one", _changes(spark, [(1, "t", "a", "en", 10, "insert")]))
    broken = _changes(spark, [(1, "t", "a", "en", 11, "revise"), (2, "t", "a", "en", 1, "insert")])
    broken.selectExpr("doc_id", "tokenizer", "source", "lang", "n_tokens", "2L as batch").write.parquet(
        f"{path}/batch-000000002-two/counts")  # counts written, then the driver was lost
    assert _totals(store) == {("a", "en", "t"): (1, 10)}
    assert store.apply("two", broken)
    assert _totals(TokenTotals(spark, path)) == {("a", "en", "t"): (2, 12)}


def test_two_writers_at_once(spark, monkeypatch):
    """Another writer commits while this one works its batch out: nothing is counted twice."""
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/totals"
    one, other = TokenTotals(spark, path), TokenTotals(spark, path)
    write, late = TokenTotals._write, []

    def meanwhile(self, folder, number, changes):
        write(self, folder, number, changes)
        if self is one and not late:
            late.append(True)
            assert other.apply(late_batch, _changes(spark, [(1, "t", "a", "en", 10, "insert")]))

    monkeypatch.setattr(TokenTotals, "_write", meanwhile)
    late_batch = "b"
    assert one.apply("a", _changes(spark, [(1, "t", "a", "en", 30, "insert")]))
    assert _totals(one) == {("a", "en", "t"): (1, 30)} and one.batches() == {"b": 1, "a": 2}
    # The same batch twice at once, as from a driver that was thought lost.
    late.clear()
    late_batch = "c"
    assert not one.apply("c", _changes(spark, [(1, "t", "a", "en", 10, "insert")]))
    assert _totals(other) == {("a", "en", "t"): (1, 10)} and list(one.batches()) == ["b", "a", "c"]


def test_pattern_counts(spark):
    texts = awkward_texts()
    rows = pattern_counts(documents(spark, texts)).collect()
    assert {(r.doc_id, r.tokenizer): r.n_tokens for r in rows} == {
        (i, v): len(re.findall(p, t or "")) for i, t in enumerate(texts) for v, p in PATTERNS.items()}
    assert pattern_counts(documents(spark, [])).collect() == []


def test_vocabulary_counts(spark):
    path = "/opt/tokenizers/byte_bpe_50k.json"
    if not os.path.exists(path):
        pytest.skip("no public tokenizer file here")
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    texts = [prose(1, 30), None, "", "Ünïcödé <|endoftext|>"]
    rows = vocabulary_counts(documents(spark, texts), path, "bpe-50k").collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(t.encode(x or "", add_special_tokens=False).ids) for i, x in enumerate(texts)}
