"""Registered queries against their SQL, and the pipeline's stages against brute force."""

import re
from itertools import combinations

import duckdb
import pytest

import corpus_pipeline
from strata.llm import queries
from tests.llm.helpers import groups, words
from tests.llm.test_simhash import brute as fingerprint

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(repr(round(r[i], 5)) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    res = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert _canon(df.columns, df.collect()) == _canon(columns, res.fetchall())


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SF), f"test-{name}")
        out.append({r.doc_id: r.text for r in docs.collect()})
        assert docs.columns[:5] == columns
    quality, single, cut, clean, mix = out
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(labels[i] for i in quality if i in labels) and all(i in quality for i in labels if labels[i])
    fp = {i: fingerprint(t) for i, t in quality.items()}
    first = groups(fp, [(a, b) for a, b in combinations(fp, 2) if (fp[a] ^ fp[b]).bit_count() <= 4])
    assert set(single) == {i for i in first if first[i] == i}
    assert set(cut) <= set(single)
    for i, t in single.items():
        if cut.get(i) != t:  # what went is in an earlier document, or nearly so
            gone = set(words(t)) - set(words(cut.get(i) or ""))
            earlier = {w for j, u in single.items() if j < i for w in words(u)}
            assert len(gone - earlier) <= 0.2 * max(1, len(words(t)))
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = {tuple(v[p:p + 10]) for v in items for p in range(len(v) - 9)}
    assert all(len(v) >= 10 for v in items)
    hit = {i for i, t in cut.items() if any(tuple(words(t)[p:p + 10]) in grams for p in range(len(words(t)) - 9))}
    assert set(clean) == set(cut) - hit
    assert set(mix) <= set(clean) and len(mix) > len(clean) / 5
    assert {"_topic", "_weight", "_probability"} <= set(docs.columns)
