"""Benchmark decontamination by winnowing.

Training texts and benchmark items are cut into words. Of the hashes of k-word grams, every
sliding window of ``window - k + 1`` grams keeps its least one (the rightmost on ties), so two
texts that share ``window`` consecutive words keep a common gram inside them: no shared span of
that length is missed. Kept grams are joined by hash; every joined pair carries its words, is
compared exactly and extended over the words beside the gram; a match of ``window`` words or
more is a hit. An item shorter than ``window`` is one gram of its own length, of which a text
keeps all.

Before the join, texts drop the grams that are not in a Bloom filter of the benchmark's grams.
The filter has a fixed size, whatever the benchmark: a large one only lets more rows through,
and the join decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ALNUM, Words, gram_hashes, mark, mix, staged, text_chunks, without

#: Bits of the Bloom filter (2 MB), two per gram.
FILTER_BITS = 1 << 24
_CONTEXT = "array<string>"


def _kept(words: Words, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the winnowed grams of all documents with at least k + w - 1 words."""
    n = len(words.hashes)
    grams = gram_hashes(words.hashes, k)
    sizes = np.diff(words.first)
    last = np.repeat(words.first[1:], sizes)  # per word, where its document ends
    starts = np.flatnonzero(np.arange(n) + k + w - 1 <= last)
    if not len(starts):
        return starts, grams[:0]
    best = starts.copy()
    least = grams[starts]
    for j in range(1, w):
        h = grams[starts + j]
        lower = h <= least
        best[lower] = starts[lower] + j
        least = np.minimum(least, h)
    keep = np.zeros(n, dtype=bool)
    keep[best] = True
    at = np.flatnonzero(keep)
    return at, grams[at]


def _short(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of all grams of n words inside documents; hashes differ by n."""
    grams = gram_hashes(words.hashes, n)
    last = np.repeat(words.first[1:], np.diff(words.first))
    at = np.flatnonzero(np.arange(len(words.hashes)) + n <= last)
    return at, mix(grams[at] + np.uint64(n))


def _slots(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.uint64(FILTER_BITS - 1)
    return h & size, (h >> np.uint64(32)) & size


def _contexts(words: Words, at: np.ndarray, doc: np.ndarray, before: int, size: int) -> list[list]:
    """The words around each position; None beyond the document's ends."""
    d, s, e = words.data, words.starts, words.ends
    out = []
    for p, i in zip(at.tolist(), doc.tolist()):
        low, high = words.first[i], words.first[i + 1]
        out.append([d[s[j]:e[j]].tobytes().decode("utf-8", "replace") if low <= j < high else None
                    for j in range(p - before, p - before + size)])
    return out


def _grams_of(words: Words, k: int, window: int, lengths: list[int], passes) -> Iterator[tuple]:
    """(length, positions, hashes, documents, contexts) of the grams that ``passes`` lets through."""
    side = window - k
    doc_of = words.doc_of()
    for n, (at, h) in [(window, _kept(words, k, side + 1)), *((n, _short(words, n)) for n in lengths)]:
        ok = passes(n, at, h)
        at, h = at[ok], h[ok]
        docs = doc_of[at]
        before, size = (side, k + 2 * side) if n == window else (0, n)
        yield n, at, h, docs, _contexts(words, at, docs, before, size)


def benchmark_grams(items: DataFrame, id_col: str, text_col: str, k: int, window: int) -> DataFrame:
    """(item_id, n, hash, item_context) of the kept grams of all items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, end, data, offsets in text_chunks(b.column(1)):
                words = Words(data, offsets, ALNUM)
                size = np.diff(words.first)
                lengths = sorted({int(x) for x in size if 0 < x < window})

                def passes(n, at, h, words=words, size=size):
                    return size[words.doc_of()[at]] == n if n < window else np.ones(len(at), dtype=bool)

                for n, at, h, docs, ctx in _grams_of(words, k, window, lengths, passes):
                    if len(at):
                        yield pa.RecordBatch.from_arrays([
                            b.column(0).take(pa.array(docs + row)), pa.array(np.full(len(at), n, dtype=np.int32)),
                            pa.array(h.view(np.int64)), pa.array(ctx, type=pa.list_(pa.string()))],
                            names=["item_id", "n", "hash", "item_context"])

    source = items.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"item_id string, n int, hash long, item_context {_CONTEXT}").distinct()


def bloom(grams: DataFrame) -> np.ndarray:
    """The filter's words; at most FILTER_BITS / 64 rows come to the driver, whatever the input."""
    mask = F.lit(FILTER_BITS - 1).cast("long")
    bit = F.explode(F.array(F.col("hash").bitwiseAND(mask),
                            F.shiftrightunsigned("hash", 32).bitwiseAND(mask))).alias("bit")
    rows = (grams.select(bit).groupBy(F.shiftright("bit", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toPandas())
    out = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    out[rows["word"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def _candidates(docs: DataFrame, id_col: str, text_col: str, k: int, window: int, lengths: list[int],
                bits) -> DataFrame:
    """(doc_id, mark, n_words, found): a document's grams that may be in the benchmark."""
    struct = pa.struct([("n", pa.int32()), ("hash", pa.int64()), ("pos", pa.int32()), ("context", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = bits.value

        def passes(n, at, h):
            ok = np.ones(len(h), dtype=bool)
            for slot in _slots(h):
                ok &= (words_of[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
            return ok

        for b in batches:
            for row, end, data, offsets in text_chunks(b.column(1)):
                words = Words(data, offsets, ALNUM)
                found: list[list] = [[] for _ in range(end - row)]
                for n, at, h, in_doc, ctx in _grams_of(words, k, window, lengths, passes):
                    for p, x, i, c in zip(at.tolist(), h.view(np.int64).tolist(), in_doc.tolist(), ctx):
                        found[i].append({"n": n, "hash": x, "pos": p - int(words.first[i]), "context": c})
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(row, end - row), b.column(2).slice(row, end - row), pa.array(np.diff(words.first)),
                    pa.array(found, type=pa.list_(struct))], names=["doc_id", "mark", "n_words", "found"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         mark(text_col).alias("mark"))
    return source.mapInArrow(
        run, f"doc_id long, mark long, n_words long, found array<struct<n:int,hash:long,pos:int,context:{_CONTEXT}>>")


def _extend(side: int, k: int) -> tuple[Column, Column]:
    """Equal words to the left and right of a gram that starts ``side`` words into its context."""
    def count(ats: list[int]) -> Column:
        total, run = F.lit(0), F.lit(True)
        for i in ats:
            run = run & F.coalesce(F.get("context", F.lit(i)) == F.get("item_context", F.lit(i)), F.lit(False))
            total = total + run.cast("int")
        return total

    return count(list(reversed(range(side)))), count(list(range(side + k, 2 * side + k)))


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", window: int = 10,
         k: int = 8) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): ``rows`` has (row, doc_id, mark, n_words) for every input row; ``spans`` has
    (row, item_id, start, end), the word ranges of a row that match an item."""
    grams = staged(benchmark_grams(items, item_col, item_text_col, k, window), "decontaminate-grams")
    lengths = [r.n for r in grams.where(F.col("n") < window).select("n").distinct().collect()]  # at most window - 1
    bits = docs.sparkSession.sparkContext.broadcast(bloom(grams))
    rows = staged(_candidates(docs, id_col, text_col, k, window, sorted(lengths), bits)
                  .withColumn("row", F.monotonically_increasing_id()), "decontaminate-rows")
    found = rows.select("row", F.explode("found").alias("f")).select("row", "f.*")
    side = window - k
    left, right = _extend(side, k)
    core = F.slice("context", side + 1, k) == F.slice("item_context", side + 1, k)
    long = F.col("n") == window
    spans = (found.join(grams, ["n", "hash"])
             .withColumn("left", F.when(long, left).otherwise(0))
             .withColumn("right", F.when(long, right).otherwise(0))
             .where(F.when(long, core & (F.col("left") + F.col("right") >= side))
                    .otherwise(F.col("context") == F.col("item_context")))
             .select("row", "item_id", (F.col("pos") - F.col("left")).alias("start"),
                     (F.col("pos") + F.when(long, F.lit(k)).otherwise(F.col("n")) + F.col("right")).alias("end")))
    return rows.select("row", "doc_id", "mark", "n_words"), spans


def contamination(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit (words inside an occurrence of an item's
    window), n_items (items with occurring windows), items_sha256 (of their ids, sorted as
    strings and comma-joined; of the empty string if none) and contaminated.

    Null and empty texts have no words, hit nothing and are not contaminated. Items without
    words never occur; items without an id are left out. Repeated item rows count once, repeated
    documents stay repeated, each with its own figures; a null doc_id is kept. Other columns are
    not read. An empty benchmark hits nothing; no documents give no rows.
    """
    rows, spans = hits(docs, items, **how)
    spans = staged(spans.distinct(), "decontaminate-spans")
    upto = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = (spans.select("row", "start", "end").distinct()
               .withColumn("reached", F.coalesce(F.max("end").over(upto), F.lit(0)))
               .groupBy("row").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "reached")))
                                   .cast("long").alias("n_hit")))
    named = (spans.groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
             .select("row", F.size("items").cast("long").alias("n_items"), F.concat_ws(",", "items").alias("items")))
    return (rows.join(covered, "row", "left").join(named, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                    F.sha2(F.coalesce("items", F.lit("")).cast("binary"), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no window of an item; see ``contamination``."""
    rows, spans = hits(docs, items, id_col, text_col, **how)
    return without(docs, rows.join(spans.select("row").distinct(), "row", "left_semi"), id_col, text_col)
