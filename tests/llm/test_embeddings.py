import numpy as np

from strata.llm import embeddings
from tests.llm.helpers import groups

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, raw string, block string, a string"


def _table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 1, "r", "w", "b", "a")
            for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def _brute(vectors, least):
    good = {}
    for i, v in enumerate(vectors):
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.asarray(v, dtype=np.float32).astype(float)
            good[i] = x / np.linalg.norm(x)
    pairs = [(a, b) for a in good for b in good
             if a != b and len(good[a]) == len(good[b]) and good[a] @ good[b] >= least]
    count = {i: sum(a == i for a, _ in pairs) for i in range(len(vectors))}
    return count, groups(range(len(vectors)), pairs)


def test_against_brute_force(spark):
    r = np.random.default_rng(1)
    centres = r.normal(size=(40, 12))
    vectors = [list(centres[i % 40] + r.normal(size=12) * (0.02 + 0.1 * (i % 3))) for i in range(300)]
    vectors += [vectors[0], vectors[0], list(np.array(vectors[5]) * 1e-30), list(np.array(vectors[6]) * 1e30),
                None, [], [0.0] * 12, [None] + [1.0] * 11, [float("nan")] * 12, [float("inf")] * 12, [1.0] * 5, [2.0] * 5,
                [-0.0] * 11 + [1.0], [0.0] * 11 + [2.0]]
    count, component = _brute(vectors, 0.95)
    for block in (32, 4096):
        rows = embeddings.near_duplicates(_table(spark, vectors), block=block).collect()
        assert {x.vec_id: (x.n_links, x.component_id) for x in rows} == {i: (count[i], component[i]) for i in count}
        assert all(x.kept == (x.vec_id == x.component_id) for x in rows)


def test_repeated_rows_null_ids_and_empty(spark):
    v = [1.0, 2.0, 3.0]
    rows = embeddings.near_duplicates(_table(spark, [v, v, v, None, None], [4, 4, None, None, 9])).collect()
    assert sorted(map(str, ((r.vec_id, r.n_links, r.component_id) for r in rows))) == sorted(
        map(str, [(4, 2, 4), (4, 2, 4), (None, 2, 4), (None, 0, None), (9, 0, 9)]))
    assert embeddings.near_duplicates(_table(spark, [])).collect() == []
    assert [r.n_links for r in embeddings.near_duplicates(_table(spark, [None, [0.0]])).collect()] == [0, 0]
