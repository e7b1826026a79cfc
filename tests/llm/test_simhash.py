import random
import re
from itertools import combinations

import numpy as np
import xxhash

from strata.llm import simhash
from tests.llm.helpers import DOC_SCHEMA, awkward_texts, documents, groups, prose


def brute(text, size=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + size]).encode(), 42) for i in range(max(1, len(w) - size + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_whole_table_against_brute_force(spark):
    texts = awkward_texts()
    texts += [re.sub(r"\w+$", f"end{i}", prose(9, 400)) for i in range(6)]
    ids = [None if t == "one" else i for i, t in enumerate(texts)]
    docs = documents(spark, [*texts, texts[2], texts[2]], [*ids, 2, None])
    fp = {i: brute(t) for i, t in enumerate(texts)}
    named = [i for i in ids if i is not None]
    want = groups(named, [(a, b) for a, b in combinations(named, 2) if (fp[a] ^ fp[b]).bit_count() <= 4])
    assert any(want[i] != i for i in named)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        if r.doc_id is not None:
            assert (r.fingerprint, r.component_id) == (f"{fp[r.doc_id]:016x}", want[r.doc_id])
    # A null id joins the component of its fingerprint, and has none if nobody with an id shares it.
    assert sorted(str(r.component_id) for r in rows if r.doc_id is None) == sorted([str(want[2]), "None"])


def test_one_document_of_each_component_stays(spark):
    docs = documents(spark, ["x y z", "x y z", "x y z", "q r s t", None, "", "other words here now"],
                     [3, 1, 1, 2, 7, 5, None])
    kept = simhash.keep_one(docs).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "2", "5", "None"]
    assert set(kept[0].asDict()) == {c.split()[0] for c in DOC_SCHEMA.split(", ")}


def test_empty(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []
    assert simhash.keep_one(documents(spark, [])).collect() == []


def test_hot_bucket_in_tiles_loses_no_link(spark):
    r = random.Random(7)
    centres = [r.getrandbits(64) for _ in range(4)]
    fps = set()
    while len(fps) < 400:  # most share whole blocks: buckets of far more than a tile
        x = centres[0] if len(fps) < 250 else r.choice(centres)
        for b in r.sample(range(64), r.randrange(6)):
            x ^= 1 << b
        fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(fps)], "fp long, rep long")
    for radius in (2, 4):
        want = groups(range(len(fps)), [(a, b) for a, b in combinations(range(len(fps)), 2)
                                        if (fps[a] ^ fps[b]).bit_count() <= radius])
        edges = simhash.links(df, radius, tile=16).collect()
        assert all((fps[e.a] ^ fps[e.b]).bit_count() <= 64 for e in edges)
        assert groups(range(len(fps)), [(e.a, e.b) for e in edges]) == want
        assert len(edges) < 400 * 400 / 4


def test_counters_agree_with_popcount():
    r = np.random.default_rng(3)
    a = r.integers(0, 1 << 63, 200, dtype=np.uint64)
    b = a.copy()
    for i in range(200):
        for bit in r.choice(64, i % 9, replace=False):
            b[i] ^= np.uint64(1 << int(bit))
    for radius in (0, 1, 3, 4, 7):
        pa, pb = simhash.planes(a), simhash.planes(b)
        near = simhash.within((pa[p] ^ pb[p] for p in range(64)), radius)
        got = np.unpackbits(near.view(np.uint8), bitorder="little")[:200].astype(bool)
        assert (got == (np.bitwise_count(a ^ b) <= radius)).all()
    far = simhash.planes(~a)
    pa = simhash.planes(a)
    seen = []

    def diff():
        for p in range(64):
            seen.append(p)
            yield pa[p][:3] ^ far[p][:3]

    assert simhash.within(diff(), 4) is None and len(seen) == 8  # abandoned at the first look
