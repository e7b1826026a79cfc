"""Filter interaction audit: what each of five filters removes in every order that they can be applied in.

Documents become a sparse document-term matrix. Every task encodes its texts with the words of a few
megabytes (a shard); the shards' words are joined once with a global dictionary of dense numbers, so
a word is shuffled once per shard, not once per document; and the shards are rewritten to compressed
sparse rows of global numbers. The sum of a row and its number of entries decide the filters on
length and repetition. The other flags are attached to the rows, equal texts are found by a digest,
and documents are summed to cells (part, failed filters, labels). Orders are applied to the cells alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.blanks import codes, spans
from strata.llm.common import staged, text_chunks
from strata.operators.dims import dense_numbering

FILTERS = "ABCDE"
LEAST_WORDS = 200
#: Shares in percent: distinct words of all words, and capitals of all characters.
LEAST_DISTINCT, MOST_CAPITALS = 50, 3
_SIGN = np.zeros(256, dtype=bool)
_SIGN[[ord(c) for c in "#$%&*|"]] = True

_SHARD = ("shard long, doc_ids array<long>, parts array<string>, digests array<binary>, flags array<int>, "
          "row_starts array<int>, columns array<int>, counts array<int>, words array<string>")


def _counted(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=total[1:])
    return np.diff(total[offsets])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Local matrices: one row per chunk of text, its words numbered within the chunk."""
    # One number per chunk of a partition; only the attempt that is committed is read.
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        for row, end, data, offsets in text_chunks(batch.column("text")):
            n = end - row
            starts, ends, first = spans(data, offsets)
            code, words = codes(data, starts, ends)
            doc = np.repeat(np.arange(n), np.diff(first))
            entry, counts = np.unique(doc * max(1, len(words)) + code, return_counts=True)
            row_of, column = np.divmod(entry, max(1, len(words)))
            capitals = _counted((data >= 65) & (data <= 90), offsets)
            characters = _counted((data & 0xC0) != 0x80, offsets)  # not UTF-8 continuation bytes
            flags = np.where(100 * capitals > MOST_CAPITALS * characters, 4, 0) | np.where(_counted(_SIGN[data], offsets) > 0, 8, 0)
            digests = [hashlib.sha256(data[a:b]).digest() for a, b in zip(offsets, offsets[1:])]
            one = [number, batch.column("doc_id").slice(row, n).to_pylist(), batch.column("part").slice(row, n).to_pylist(),
                   digests, flags.astype(np.int32), np.searchsorted(row_of, np.arange(n + 1)).astype(np.int32),
                   column.astype(np.int32), counts.astype(np.int32), words.to_pylist()]
            types = [pa.int64(), *map(pa.list_, (pa.int64(), pa.string(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()))]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(one, types)],
                                             [c.split()[0] for c in _SHARD.split(", ")])
            number += 1


def document_term_matrix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         part_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(matrix, dictionary) of the words of ``docs``.

    dictionary: word, term; terms are 1, 2, ... in the order of the words. matrix: one row per shard, with
    doc_ids, parts, digests and flags by document, and compressed sparse rows: document i of the shard
    has the terms ``columns`` and their ``counts`` at row_starts[i]:row_starts[i + 1]. Words are runs of
    characters other than blanks and the ASCII controls from tab to carriage return, as they are. A
    null text is empty: its row has no entries. Repeated ids and null ids have rows of their own.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    local = staged(rows.mapInArrow(_shards, _SHARD), "matrix-local")
    words = local.select("shard", F.posexplode("words").alias("place", "word"))
    dictionary = staged(dense_numbering(words.select("word").distinct(), ["word"], "term"), "matrix-dictionary")
    terms = (words.join(dictionary, "word").groupBy("shard")
             .agg(F.sort_array(F.collect_list(F.struct("place", "term"))).getField("term").alias("terms")))
    matrix = local.drop("words").join(terms, "shard", "left")
    return matrix.withColumn("columns", F.transform("columns", lambda c: F.get("terms", c))).drop("terms"), dictionary


def _row_facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row sums and numbers of entries of the matrix's rows, with what belongs to their documents."""
    for batch in batches:
        for i in range(batch.num_rows):
            at = {c: batch.column(c)[i].values for c in ("doc_ids", "parts", "digests", "flags", "row_starts", "counts")}
            start = at["row_starts"].to_numpy().astype(np.int64)
            total = np.zeros(len(at["counts"]) + 1, dtype=np.int64)
            np.cumsum(at["counts"].to_numpy(), out=total[1:])
            yield pa.RecordBatch.from_arrays(
                [at["doc_ids"], at["parts"], at["digests"], at["flags"], pa.array(np.diff(total[start])), pa.array(np.diff(start))],
                ["doc_id", "part", "digest", "flags", "n_words", "n_terms"])


def failures(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             part_col: str = "lang") -> DataFrame:
    """Cells (part, mask, good, toxic, n): how many documents of a part fail which filters; bit i of ``mask``
    is filter i of ``FILTERS``."""
    matrix, _ = document_term_matrix(docs, id_col, text_col, part_col)
    rows = matrix.drop("shard", "columns").mapInArrow(
        _row_facts, "doc_id long, part string, digest binary, flags int, n_words long, n_terms long")
    short = F.when(F.col("n_words") < LEAST_WORDS, 1).otherwise(0)
    repeated = F.when(100 * F.col("n_terms") < LEAST_DISTINCT * F.col("n_words"), 2).otherwise(0)
    rows = rows.select("doc_id", "part", "digest", (F.col("flags") + short + repeated).alias("mask"))
    labelled = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    cell = ["digest", "part", "mask", "good", "toxic"]
    one = (rows.join(labelled, "doc_id", "left").fillna(False, ["good", "toxic"])
           .groupBy("doc_id", *cell).agg(F.count("*").alias("n")))
    # Every id comes once in a cell of a text now, so the least id brings its number of rows along.
    named = F.col("doc_id").isNotNull()
    by_text = one.groupBy(*cell).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(~named, F.col("n"))), F.lit(0)).alias("unnamed"),
        F.min(F.when(named, F.struct("doc_id", "n"))).alias("least"))
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))  # a text has a row per part and labels here
    stay = by_text.withColumn("stay", F.col("unnamed") + F.when(F.col("least.doc_id") == first, F.col("least.n")).otherwise(0))
    both = F.explode(F.array(F.struct(F.col("mask"), F.col("stay").alias("n")),
                             F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("stay")).alias("n"))))
    return (stay.select("part", "good", "toxic", both.alias("c")).select("part", "c.mask", "good", "toxic", "c.n").where("n > 0")
            .groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")))


def _effects(spark) -> DataFrame:
    """What happens to a document that fails ``mask`` at each step of each order: 32 x 120 x 5 rows."""
    steps = [("".join(order), s + 1, 1 << FILTERS.index(order[s]), sum(1 << FILTERS.index(x) for x in order[:s]))
             for order in permutations(FILTERS) for s in range(len(FILTERS))]
    table = spark.createDataFrame(steps, "filter_order string, step int, own int, earlier int")
    mask, own, earlier = F.col("mask"), F.col("own"), F.col("earlier")
    fails, gone = mask.bitwiseAND(own) != 0, mask.bitwiseAND(earlier) != 0
    return table.withColumn("mask", F.explode(F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1)))).select(
        "filter_order", "step", "mask", (~fails & ~gone).alias("kept"), (fails & ~gone).alias("removed"),
        (fails & gone).alias("redundant"), (mask == own).alias("unique"),
        # In how many orders the step's filter is the one that removes the document.
        F.when(fails, (F.lit(120) / F.bit_count("mask")).cast("long")).otherwise(0).alias("removals"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "lang") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    One row per part (value of ``part_col``, null as the empty string), each of the 120 orders and each of
    its five steps, counting documents of the part. A document fails A with fewer than 200 words, B with
    less than half of its words distinct, C with more than 3 % capitals A-Z among its characters, D
    with one of the signs ``#$%&*|``, and E if a smaller id anywhere has the same text. A null text
    is empty: it fails A, and E like any other text. A row without an id has no smaller id and is
    none. Rows that repeat an id with its text count each, and fail E only by a smaller one. A document
    is good or toxic if any label row of its id says so; others are neither. Other columns are not read.
    No documents give no rows.
    """
    cells = staged(failures(docs, labels, id_col, text_col, part_col), "audit-cells")
    # 19,200 fixed rows: each cell meets those of its own mask.
    j = cells.join(F.broadcast(_effects(docs.sparkSession)), "mask")

    def number(when: Column) -> Column:
        return F.sum(F.when(when, F.col("n")).otherwise(0)).cast("long")

    return j.groupBy("part", "filter_order", "step").agg(
        number(F.col("kept")).alias("kept"), number(F.col("removed")).alias("removed"),
        number(F.col("redundant")).alias("redundant"), number(F.col("unique")).alias("unique_fails"),
        number(F.col("removed") & F.col("good")).alias("good_lost"), number(F.col("removed") & F.col("toxic")).alias("toxic_lost"),
        F.sum(F.col("n") * F.col("removals")).cast("long").alias("shapley"))
