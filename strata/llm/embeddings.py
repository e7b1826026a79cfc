"""Near-duplicate embeddings by the epsilon grid order join.

Vectors are scaled to length one, where a cosine of at least c means a distance of at most
``eps = sqrt(2 - 2 c)``. They are projected on their leading principal directions (a projection
never lengthens a distance) and sorted by the cells, ``eps`` wide, of a grid over these. The sorted
sequence is cut into blocks. Pairs of sequence intervals are refined recursively, first over
intervals of many blocks, then inside the tasks down to a few rows, and a pair is skipped when its
bounding boxes are more than ``eps`` apart; so no link is lost. What remains is compared exactly,
in double precision.

Equal vectors are one class with a count. Tasks return counts of links and a spanning forest of
the links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import by_key_runs, connected_components, partitions, run_bounds, runs, staged

#: Leading principal directions of the grid.
DIRECTIONS = 8
#: Rows of a block; a task holds two.
BLOCK = 4096
#: Intervals are split into so many parts per round.
_FAN = 8
#: Rows that are compared without further splitting.
_LEAF = 256
_SLACK = 1e-9


def _unit(raw: pa.ChunkedArray, d: int) -> np.ndarray:
    """Rows of length one from the binary float32 vectors, padded with zeros to d components."""
    out = np.zeros((len(raw), d))
    for i, b in enumerate(raw):
        v = np.frombuffer(b.as_buffer(), dtype=np.float32)
        out[i, :len(v)] = v
    out /= np.abs(out).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def classes(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows (id, raw) of all input, raw null if the vector links with nothing;
    classes (rep, raw, d, n) of equal vectors that have an id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.column(1):
                v = None if x.values is None else np.asarray(x.values.to_numpy(zero_copy_only=False), dtype=np.float32)
                good = v is not None and len(v) and not x.values.null_count and np.isfinite(v).all() and v.any()
                out.append((v + np.float32(0)).tobytes() if good else None)  # + 0: no negative zeros
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, type=pa.binary())], names=["id", "raw"])

    source = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("v"))
    rows = staged(source.mapInArrow(run, "id long, raw binary"), "embeddings-rows")
    grouped = (rows.where("raw is not null").groupBy("raw").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
               .where("rep is not null").select("rep", "raw", (F.octet_length("raw") / 4).cast("int").alias("d"), "n"))
    return rows, staged(grouped, "embeddings-classes")


def principal_directions(distinct: DataFrame, d: int, directions: int) -> np.ndarray:
    """The leading principal directions of the unit vectors, over all rows. Tasks return their sums
    of products, which Spark adds up: (d + 1)^2 / 2 numbers come to the driver."""
    upper = np.triu_indices(d + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d + 1, d + 1))
        for b in batches:
            u = np.hstack([_unit(b.column(0), d), np.ones((b.num_rows, 1))])
            total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]))), pa.array(total[upper])],
                                         names=["cell", "value"])

    rows = (distinct.select("raw").mapInArrow(run, "cell long, value double")
            .groupBy("cell").agg(F.sum("value").alias("value")).toPandas())
    products = np.zeros((d + 1, d + 1))
    flat = np.zeros(len(upper[0]))
    flat[rows["cell"].to_numpy()] = rows["value"].to_numpy()
    products[upper] = flat
    n = max(products[d, d], 1.0)
    mean = products[:d, d] / n
    square = products[:d, :d] + np.triu(products[:d, :d], 1).T
    return np.linalg.eigh(square / n - np.outer(mean, mean))[1][:, ::-1][:, :directions]


def _in_grid_order(distinct: DataFrame, axes, eps: float, block: int) -> DataFrame:
    """The classes with their projections p0, p1, ... and ``seq``, their place in the grid order."""
    d, m = axes.value.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = _unit(b.column("raw"), d) @ axes.value
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(p[:, i]) for i in range(m))],
                                             names=[*b.schema.names, *(f"p{i}" for i in range(m))])

    fields = ", ".join(f"p{i} double" for i in range(m))
    projected = staged(distinct.mapInArrow(run, f"rep long, raw binary, d int, n long, {fields}"), "embeddings-projected")
    cells = [F.floor(F.col(f"p{i}") / eps) for i in range(m)]
    dealt = projected.repartitionByRange(partitions(distinct.sparkSession), *cells, "rep").sortWithinPartitions(*cells, "rep")
    # Places: the index in the partition plus the sizes of those before it (one row per partition).
    numbered = staged(dealt.withColumn("at", F.monotonically_increasing_id()), "embeddings-sorted")
    part = F.shiftrightunsigned("at", 33).alias("part")
    sizes = sorted((r.part, r.n) for r in numbered.groupBy(part).agg(F.count("*").alias("n")).collect())
    before, total = [], 0
    for p, n in sizes:
        before.append((p, total))
        total += n
    offsets = distinct.sparkSession.createDataFrame(before, "part long, before long")
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1).cast("long"))
    return (numbered.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("seq", place)
            .withColumn("block", F.floor(F.col("seq") / block)).drop("part", "before", "at"))


def _apart(x: str, y: str, m: int) -> Column:
    """The squared distance between two boxes (structs of low<i>, high<i>)."""
    total = F.lit(0.0)
    for i in range(m):
        gap = F.greatest(F.lit(0.0), F.col(f"{x}.low{i}") - F.col(f"{y}.high{i}"),
                         F.col(f"{y}.low{i}") - F.col(f"{x}.high{i}"))
        total = total + gap * gap
    return total


def _block_pairs(ordered: DataFrame, m: int, eps: float) -> DataFrame:
    """(a, b), a <= b: the pairs of blocks whose boxes come within ``eps``."""
    def boxes(df: DataFrame, node: Column, low: str, high: str) -> DataFrame:
        sums = [f(src.format(i)).alias(f"{name}{i}") for i in range(m)
                for f, src, name in ((F.min, low, "low"), (F.max, high, "high"))]
        return staged(df.groupBy(node.alias("node")).agg(*sums), "embeddings-boxes")

    levels = [boxes(ordered, F.col("block"), "p{}", "p{}")]
    while levels[-1].count() > 1:
        levels.append(boxes(levels[-1], F.floor(F.col("node") / _FAN), "low{}", "high{}"))
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(levels[:-1]):
        box = level.select("node", F.struct(*[c for c in level.columns if c != "node"]).alias("box"))
        children = [F.explode(F.sequence(F.col(c) * _FAN, F.col(c) * _FAN + _FAN - 1)).alias(c) for c in "ab"]
        near = (pairs.select(children[0], "b").select("a", children[1]).where("a <= b")
                .join(box.withColumnsRenamed({"node": "a", "box": "x"}), "a")
                .join(box.withColumnsRenamed({"node": "b", "box": "y"}), "b")
                .where(_apart("x", "y", m) <= eps * eps + _SLACK).select("a", "b"))
        pairs = staged(near, "embeddings-pairs")
    return pairs


def _leaves(p: np.ndarray, x: tuple[int, int], y: tuple[int, int], eps: float) -> Iterator[tuple]:
    """Splits two sequence intervals until they are short; skips those whose boxes are far apart."""
    a, b = p[x[0]:x[1]], p[y[0]:y[1]]
    gap = np.maximum(0, np.maximum(a.min(axis=0) - b.max(axis=0), b.min(axis=0) - a.max(axis=0)))
    if (gap * gap).sum() > eps * eps + _SLACK:
        return
    if len(a) <= _LEAF and len(b) <= _LEAF:
        yield x, y
        return
    halves = [[z] if z[1] - z[0] <= _LEAF else [(z[0], sum(z) // 2), (sum(z) // 2, z[1])] for z in (x, y)]
    for u in halves[0]:
        for v in halves[1]:
            if x != y or u <= v:
                yield from _leaves(p, u, v, eps)


def _compare(axes, eps: float, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["a", "b"]):
            bounds = run_bounds(t, ["a", "b"])
            for start, end in zip(bounds, bounds[1:]):
                yield _pair(t.slice(start, end - start), axes.value, eps, least)
    return run


def _pair(t: pa.Table, axes: np.ndarray, eps: float, least: float) -> pa.RecordBatch:
    """Links of one pair of blocks: (a, null, links of a) and forest edges (a, b, null)."""
    unit = _unit(t.column("raw"), axes.shape[0])
    rep, n, d = (t.column(c).to_numpy() for c in ("rep", "n", "d"))
    side = t.column("side").to_numpy()
    p = unit @ axes
    split = int(np.searchsorted(side, 1))  # rows come sorted by side
    x, y = (0, split), ((split, len(side)) if split < len(side) else (0, split))
    count = np.zeros(len(side), dtype=np.int64)
    labels = np.arange(len(side))
    edges: list[tuple[int, int]] = []
    for u, v in _leaves(p, x, y, eps) if split else ():
        near = (unit[slice(*u)] @ unit[slice(*v)].T >= least) & (d[slice(*u), None] == d[None, slice(*v)])
        if u == v:
            np.fill_diagonal(near, False)
        if not near.any():
            continue
        count[slice(*u)] += near @ n[slice(*v)]
        if u != v:
            count[slice(*v)] += n[slice(*u)] @ near
        for i in np.flatnonzero(near.any(axis=1)):
            own = labels[u[0] + i]
            roots = np.unique(labels[v[0] + np.flatnonzero(near[i])])
            roots = roots[roots != own]
            if len(roots):
                labels[np.isin(labels, roots)] = own
                edges += [(u[0] + i, r) for r in roots.tolist()]
    at = np.flatnonzero(count)
    e = np.array(edges, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([rep[at], rep[e[:, 0]]])),
        pa.array(np.concatenate([rep[at], rep[e[:, 1]]])),
        pa.array(np.concatenate([count[at], np.zeros(len(e), dtype=np.int64)]))], names=["a", "b", "links"])


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.95,
                    directions: int = DIRECTIONS, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    n_links counts the other rows whose cosine is ``least`` or more; component_id is the smallest
    id reachable over links, the row's own included; kept says that it is the row's own id.
    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing,
    and so do vectors of different lengths. Equal vectors link (repeated rows too, each counting
    the others). A row whose id is null takes part where its vector equals one with an id, else it
    has no links; it never names a component, and its component_id may be null. Other columns,
    labels included, are not read. No rows give no rows.
    """
    spark = vectors.sparkSession
    rows, distinct = classes(vectors, id_col, vector_col)
    d = distinct.agg(F.max("d")).first()[0]
    empty = spark.createDataFrame([], "rep long, near long, component long")
    found = empty
    if d:
        eps = float(np.sqrt(2 - 2 * least))
        m = min(directions, d)
        axes = spark.sparkContext.broadcast(principal_directions(distinct, d, m))
        ordered = staged(_in_grid_order(distinct, axes, eps, block), "embeddings-ordered")
        pairs = _block_pairs(ordered, m, eps)
        sides = pairs.select("a", "b", F.col("a").alias("block"), F.lit(0).alias("side")).union(
            pairs.where("a < b").select("a", "b", F.col("b").alias("block"), F.lit(1).alias("side")))
        dealt = ordered.select("block", "seq", "rep", "raw", "d", "n").join(sides, "block").drop("block")
        links = staged(by_key_runs(dealt, ["a", "b"], ["side", "seq"], _compare(axes, eps, least),
                                   "a long, b long, links long"), "embeddings-links")
        near = links.where("links > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("near"))
        joined = connected_components(links.where("links = 0").select("a", "b"), "embeddings")
        found = near.join(joined.withColumnRenamed("node", "rep"), "rep", "full")
    by_class = (distinct.join(found, "rep", "left")
                .select("raw", F.coalesce("component", "rep").alias("component"),
                        (F.coalesce("near", F.lit(0).cast("long")) + F.col("n") - 1).alias("near")))
    out = rows.join(by_class, "raw", "left").select(
        F.col("id").alias("vec_id"), F.coalesce("near", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
