"""SimHash near-duplicates by bit-sliced comparison.

A fingerprint has 64 bits. Two fingerprints within ``radius`` bits, cut into ``blocks`` blocks,
agree on at least ``blocks - radius`` whole blocks, so every link is found among rows that agree
on one of the block combinations (a pigeonhole argument: nothing is lost, whatever the data).
Rows that share a combination's value form a bucket, and a bucket is compared bit-sliced: bit
planes are stored vertically (one machine word holds a bit of 64 rows), the planes of the
differences are added up by carry-save counters for many rows at once, and a block of
comparisons is abandoned as soon as all of its distances exceed the radius.

Equal fingerprints are one class, so copies are never compared. A bucket larger than ``tile``
rows is dealt in tiles, and the pairs of tiles go to different tasks. A task returns a spanning
forest of the links that it found rather than all pairs, which keeps components exact and the
output linear.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import by_key_runs, connected_components, free_names, mark, run_bounds, runs, staged, without

#: Rows of a bucket that one task compares with another tile.
TILE = 4096
#: Rows compared at once with a vertical block.
_QUERIES = 256
#: Planes added between two looks at the counters.
_STEP = 8
#: Up to this size, the pairs of all buckets of a batch are compared together.
_SMALL = 64


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """The SimHash of a text's shingles: a bit is 1 if set in over half of the XXH64 values.

    Words are runs without ASCII white space, lower-cased A-Z; repeats count. Fewer words than
    a shingle make one shingle; no words make the fingerprint zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, ends[:-1] + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
    n = len(words) - shingle + 1
    h = np.fromiter((digest(joined[a:b], seed) for a, b in spans), dtype=np.uint64, count=n)
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 4096):
        bits = np.unpackbits(h[i:i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                 seed: int = 42) -> DataFrame:
    """(id, fp long, mark): one row per input row; a null text has no words and the fingerprint zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.large_binary())
            fp = np.fromiter((fingerprint(t.as_py() or b"", shingle, seed) for t in texts), dtype=np.uint64,
                             count=len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), b.column(2)], names=["id", "fp", "mark"])

    ids = F.col(id_col).cast("long").alias("id")
    return (docs.select(ids, F.col(text_col).cast("string").alias("text"), mark(text_col).alias("mark"))
            .mapInArrow(run, "id long, fp long, mark long"))


def _block_masks(blocks: int) -> list[int]:
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def planes(fp: np.ndarray) -> np.ndarray:
    """Vertical bit planes: entry [p, w] holds bit p of rows 64 w to 64 w + 63."""
    n = -(-len(fp) // 64) * 64
    padded = np.zeros(n, dtype=np.uint64)
    padded[:len(fp)] = fp
    bits = np.unpackbits(padded.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def within(diff: Iterator[np.ndarray], radius: int) -> np.ndarray | None:
    """Lanes (bits of words) whose planes of difference add up to ``radius`` or less.

    ``diff`` gives one array of words per plane. The counters are bit-sliced too: ``c[i]`` holds
    bit i of every lane's count, and a carry out of the last one sticks. None if every lane
    exceeds the radius before the planes are through, or at the end.
    """
    size = max(1, radius.bit_length())
    c: list[np.ndarray] = []
    over = None
    far = None
    for k, x in enumerate(diff, 1):
        if not c:
            c, over = [np.zeros_like(x) for _ in range(size)], np.zeros_like(x)
        for i in range(size):
            carry = c[i] & x
            c[i] ^= x
            x = carry
        over |= x
        if k % _STEP == 0 or k == 64:
            # far: count > radius, compared from the highest counter bit down
            far, same = over.copy(), ~over
            for i in reversed(range(size)):
                if radius >> i & 1:
                    same &= c[i]
                else:
                    far |= same & c[i]
                    same &= ~c[i]
            if (far == np.uint64(0xFFFFFFFFFFFFFFFF)).all():
                return None
    return None if far is None else ~far


def _forest(labels: np.ndarray, row: int, linked: np.ndarray) -> list[int]:
    """Joins row with the linked rows in ``labels``; returns the labels that were merged into it."""
    roots = np.unique(labels[linked])
    own = labels[row]
    roots = roots[roots != own]
    if not len(roots):
        return []
    labels[np.isin(labels, roots)] = own
    return roots.tolist()


def tile_links(fp: np.ndarray, side: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest, as row pairs, of the links in one tile pair (or one tile).

    side: 0 and 1 for the two tiles; all 0 when a tile is compared with itself.
    """
    q = np.flatnonzero(side == 0)
    t = np.flatnonzero(side == 1) if side.any() else q
    if not len(q) or not len(t):
        return []
    vertical = planes(fp[t])
    spare = np.uint64(0xFFFFFFFFFFFFFFFF)
    labels = np.arange(len(fp))
    out = []
    for i in range(0, len(q), _QUERIES):
        rows = q[i:i + _QUERIES]
        bits = np.unpackbits(fp[rows].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
        diff = (vertical[p][None, :] ^ np.where(bits[:, p], spare, np.uint64(0))[:, None] for p in range(64))
        near = within(diff, radius)
        if near is None:
            continue
        for k in np.flatnonzero(near.any(axis=1)):
            lanes = np.flatnonzero(np.unpackbits(near[k].view(np.uint8), bitorder="little")[:len(t)])
            for root in _forest(labels, rows[k], t[lanes]):
                out.append((int(rows[k]), root))
    return out


def _small_links(fp: np.ndarray, starts: np.ndarray, ends: np.ndarray, radius: int) -> Iterator[tuple]:
    """Links inside many small buckets at once: lanes are the pairs of rows d apart in a bucket."""
    size = ends - starts
    end_of = np.repeat(ends, size)
    at = np.repeat(starts, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    for d in range(1, int(size.max(initial=0))):
        a = at[at + d < end_of]
        for i in range(0, len(a), 1 << 16):
            x, y = a[i:i + (1 << 16)], a[i:i + (1 << 16)] + d
            px, py = planes(fp[x]), planes(fp[y])
            near = within((px[p] ^ py[p] for p in range(64)), radius)
            if near is not None:
                k = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little")[:len(x)])
                yield x[k], y[k]


def _bucket_links(radius: int):
    keys = ["part", "key", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, keys):
            bounds = run_bounds(t, keys)
            fp = t.column("fp").to_numpy().view(np.uint64)
            rep, side = t.column("rep").to_numpy(), t.column("side").to_numpy()
            starts, ends = bounds[:-1], bounds[1:]
            small = ends - starts <= _SMALL
            two_sided = np.add.reduceat(side, starts) > 0 if len(starts) else small
            small &= ~two_sided
            found = [np.stack(p, axis=1) for p in _small_links(fp, starts[small], ends[small], radius)]
            for a, b in zip(starts[~small], ends[~small]):
                pairs = tile_links(fp[a:b], side[a:b], radius)
                if pairs:
                    found.append(np.array(pairs) + a)
            if found:
                pairs = np.concatenate(found)
                yield pa.RecordBatch.from_arrays([pa.array(rep[pairs[:, 0]]), pa.array(rep[pairs[:, 1]])],
                                                 names=["a", "b"])
    return run


def links(classes: DataFrame, radius: int = 4, blocks: int | None = None, tile: int = TILE) -> DataFrame:
    """Edges (a, b) whose components are those of all links between the classes (fp, rep).

    blocks: the key of a bucket has ``64 (blocks - radius) / blocks`` bits. The default, two blocks more
    than the radius, gives 21 bits and 15 combinations for a radius of 4.
    """
    blocks = blocks or radius + 2
    masks = _block_masks(blocks)
    parts = [sum(masks[i] for i in c) for c in combinations(range(blocks), blocks - radius)]
    keyed = classes.select("fp", "rep", F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("key"))
        for i, m in enumerate(parts)])).alias("k")).select("k.part", "k.key", "fp", "rep")
    sizes = keyed.groupBy("part", "key").agg(F.count("*").alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    dealt = (keyed.join(sizes, ["part", "key"]).withColumn("tiles", tiles).withColumn("own", own)
             .select("part", "key", "fp", "rep", "own", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
             .select("part", "key", "fp", "rep", F.least("own", "other").alias("low"),
                     F.greatest("own", "other").alias("high"), (F.col("own") > F.col("other")).cast("int").alias("side")))
    return by_key_runs(dealt, ["part", "key", "low", "high"], [], _bucket_links(radius), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    radius: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id, mark), one row per row of ``docs``; mark is a hash of the text.

    component_id is the smallest id reachable over links of ``radius`` bits or fewer, itself
    included. Null and empty texts have the fingerprint zero and link like any other. A row with
    a null id gets the component of its fingerprint if a row with an id shares it, else null,
    and never gives its name to a component. Repeated rows stay repeated. Other columns are not
    read. No rows give no rows.
    """
    rows = staged(fingerprints(docs, id_col, text_col, shingle, seed), "simhash-fp")
    classes = rows.groupBy("fp").agg(F.min("id").alias("rep"))
    # The class of a repeated id with two texts: its links join both fingerprints under one name.
    named = staged(classes.where("rep is not null"), "simhash-classes")
    component = connected_components(links(named, radius), "simhash")
    by_fp = named.join(component.withColumnRenamed("node", "rep"), "rep", "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id"))
    return rows.join(by_fp, "fp", "left").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "mark")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each component: that with the smallest id.

    Of rows that repeat an id one stays, with the least text. A row without an id goes if its
    fingerprint is that of a row with one, and stays otherwise.
    """
    found = near_duplicates(docs, id_col, text_col, **how)
    rest = without(docs, found.where("not component_id <=> doc_id"), id_col, text_col)
    id_name, n_name = free_names(docs, "_id", "_n")
    ids = docs.groupBy(F.col(id_col).alias(id_name)).agg(F.count("*").alias(n_name)).where((F.col(n_name) > 1) & F.col(id_name).isNotNull())
    repeated = staged(ids.select(id_name), "simhash-repeated")
    if repeated.isEmpty():
        return rest
    same = F.col(id_col) == F.col(id_name)
    order = Window.partitionBy(id_col).orderBy(F.col(text_col).asc_nulls_first())
    one = (rest.join(repeated, same, "left_semi").withColumn(n_name, F.row_number().over(order))
           .where(F.col(n_name) == 1).drop(n_name))
    return rest.join(repeated, same, "left_anti").union(one)
