"""Helpers shared by the operators: staged tables, word spans and hashes over Arrow text, runs.

Text is handled as UTF-8 bytes in numpy: a batch of documents is one byte array, a 256-entry
table lower-cases A-Z and blanks the separators, and words are the runs that remain. Word
hashes come from prefix sums of a polynomial modulo 2^64, so a batch costs a few vector passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import drop_scratch, scratch_path

#: Bytes of text handled at once by the vector passes; one longer text is handled alone.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Spark's switch for deleting a query's shuffle files as it ends; else they stay until the driver collects its garbage.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again.

    It cuts the lineage at files that outlive executors, and what is used twice is computed
    once. The schema is passed on, so an empty result reads back with its columns.
    """
    return staged_parts([df], name)


def staged_parts(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """Like ``staged``, of the rows of all parts (one at least, of one schema), which are written one after the other: only one part's
    shuffle files are on disk at a time. A part is asked for when the one before it is written."""
    path = None
    for df in parts:
        spark, schema = df.sparkSession, df.schema
        path = path or scratch_path(spark, name)
        before = spark.conf.get(_CLEAN_UP, None)
        spark.conf.set(_CLEAN_UP, "true")
        try:
            df.write.mode("append").parquet(path)
        finally:
            if before is None:
                spark.conf.unset(_CLEAN_UP)
            else:
                spark.conf.set(_CLEAN_UP, before)
    out = spark.read.schema(schema).parquet(path)
    out._staged_at = path
    return out


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables, once nothing that is still to run reads them."""
    for df in tables:
        drop_scratch(df.sparkSession, df._staged_at)


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """The byte table of a word rule: 0 for separators, else the byte with A-Z in lower case."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    for low, high in ranges:
        t[low:high + 1] = 0
    t[0] = 0
    return t


#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the lower-cased text: a-z, 0-9 and all non-ASCII.
ALNUM = separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers can be divided out modulo 2^64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[key] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift, multiply), so that near inputs get far hashes."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Words:
    """The words of some documents: byte starts and ends in ``data``, 64-bit hashes, and
    ``first`` (documents + 1 word positions: document d has words first[d]:first[d + 1])."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, byte_table: np.ndarray, hashes: bool = True):
        self.data = byte_table[data]
        n = len(data)
        is_word = self.data != 0
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True  # documents begin and end here: words never span two of them
        before = np.empty(n, dtype=bool)
        if n:
            before[0] = False
            before[1:] = is_word[:-1]
            before[edge[:-1]] = False
        self.starts = np.flatnonzero(is_word & ~before)
        if n:
            after = np.empty(n, dtype=bool)
            after[-1] = False
            after[:-1] = is_word[1:]
            after[edge[1:]] = False
            self.ends = np.flatnonzero(is_word & ~after) + 1
        else:
            self.ends = self.starts
        self.first = np.searchsorted(self.starts, offsets)
        if hashes:
            up, down = _powers(n + 1)
            total = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(self.data * up[:n], out=total[1:], dtype=np.uint64)
            self.hashes = mix((total[self.ends] - total[self.starts]) * down[self.starts])

    def text(self, a: int, b: int) -> str:
        """Words a to b - 1, joined by single spaces."""
        d = self.data
        return b" ".join(d[s:e].tobytes() for s, e in zip(self.starts[a:b], self.ends[a:b])).decode("utf-8", "replace")

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of a string column; a null is an empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        end = min(end, len(column))
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def gram_hashes(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive words; entry i is of words i to i + k - 1 (len - k + 1 entries)."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        total = total * np.uint64(0xA24BAED4963EE407) + word_hashes[j:j + n]
    return mix(total)


def span_hashes(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Like gram_hashes, for long grams: from prefix sums, so the work does not grow with k."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(len(word_hashes) + 1)
    total = np.zeros(len(word_hashes) + 1, dtype=np.uint64)
    np.cumsum(word_hashes * up[:len(word_hashes)], out=total[1:], dtype=np.uint64)
    return mix((total[k:] - total[:n]) * down[:n])


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole runs of equal ``keys`` from a sorted stream, as many at a time as a batch ends.

    Each yielded table holds complete runs only; what may continue is held over.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        at = np.flatnonzero(change)
        if held and any(held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        if len(at):
            yield pa.Table.from_batches([*held, batch.slice(0, int(at[-1]))])
            held = [batch.slice(int(at[-1]))]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def run_bounds(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Row positions where runs begin, and the number of rows."""
    change = np.ones(t.num_rows, dtype=bool)
    if t.num_rows > 1:
        change[1:] = False
    for k in keys:
        v = t.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(change), t.num_rows)


def partitions(spark: SparkSession) -> int:
    """The session's own shuffle partitions, for explicit repartitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_key_runs(df: DataFrame, keys: list[str], order: list[str], fn: Callable, schema: str) -> DataFrame:
    """``fn`` over the Arrow batches of partitions that hold whole key groups, sorted."""
    return (df.repartition(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys, *order)
            .mapInArrow(fn, schema))


def mark(text_col: str):
    """A hash of a row's text: with the id it tells rows apart, also those without an id."""
    return F.xxhash64(F.col(text_col).cast("string"))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores before it as no column of ``df`` has (columns have no case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def without(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are not in ``gone`` (doc_id, mark), compared null-safe."""
    id_name, mark_name = free_names(docs, "_id", "_mark")
    gone = gone.select(F.col("doc_id").alias(id_name), F.col("mark").alias(mark_name))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(id_name)) & (mark(text_col) == F.col(mark_name))
    return docs.join(gone, same, "left_anti")


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of the nodes in ``edges`` (columns a, b; long): component is the
    smallest node reachable.

    Alternates the large-star and small-star steps: each joins every node with the least of its
    neighbours, so a round is a grouped minimum (combined before the shuffle) and an equi-join
    that adaptive execution may split; the edges per round never outnumber the first edges
    plus the nodes. Each round is written to the shared folder, and stops when the set is stable.
    """
    def stable(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
               f"{name}-edges")
    state = stable(e)
    while state[0]:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        e = staged(small.where("a <> b").distinct(), f"{name}-round")
        new = stable(e)
        if new == state:
            break
        state = new
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
