"""S1 at scale: one huge JSON document read by many tasks.

A daily document is one array, and ``multiLine`` reading gives a file to one task. Here the text
source splits the file by byte ranges (blocks) at the byte ``{``, wherever it stands, in a string
or not. Where records begin and end is then worked out in two passes:

1. Each block is lexed without knowing what stands before it. Quotes flip between inside and outside
   of strings, so a block's effect is the parity of its quotes and, for either state at its start, the
   change of depth. Running sums of these over the blocks of a file (a row per block) give the state
   in which each block begins.
2. Each block is lexed again from its known state and cut where the depth returns to that of the
   array. Records that lie within a block are parsed at once, by ``from_json``. The ends of blocks (at
   most two pieces each) are written aside and joined to the records that span blocks.

Python lexes Arrow batches with numpy; text is never held for more than a batch and the record that is
not finished. A document that is cut off, has text between its records, or holds a damaged record gives
rows with ``CORRUPT_COLUMN``, or raises.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_path
from strata.sources.json_docs import CORRUPT_COLUMN, with_corrupt_column

_SPACE = b" \t\r\n"
_STEP = np.zeros(256, dtype=np.int8)
_STEP[[ord("{"), ord("[")]], _STEP[[ord("}"), ord("]")]] = 1, -1


def _lex(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, steps, quotes) of the braces and brackets of ``text``: each opens (1) or closes (-1), with so
    many quotes before it, not counting those after a backslash; the last quotes entry is of the whole text."""
    b = np.frombuffer(text, dtype=np.uint8)
    quotes = np.flatnonzero(b == 34)
    if len(quotes) and (b[quotes - 1] == 92).any():
        other = np.where(b == 92, -1, np.arange(len(b)))
        np.maximum.accumulate(other, out=other)  # the last place that is no backslash
        before = np.where(quotes > 0, other[np.maximum(quotes - 1, 0)], -1)
        quotes = quotes[(quotes - 1 - before) % 2 == 0]
    at = np.flatnonzero(_STEP[b])
    return at, _STEP[b[at]].astype(np.int64), np.append(np.searchsorted(quotes, at), len(quotes))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch, bytes]]:
    """((file, block), rows, their text), a few thousand pieces of one block at a time."""
    for batch in batches:
        file, block = (batch.column(c).to_numpy() for c in ("file", "block"))
        change = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        for a, b in zip([0, *change], [*change, batch.num_rows]):
            if a < b:
                rows = batch.slice(a, b - a)
                yield (int(file[a]), int(block[a])), rows, b"{".join(rows.column("piece").to_pylist())


class _Reader:
    """Text of one block after another; a piece follows a ``{``, but the first of a file."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.batches = batches

    def __iter__(self) -> Iterator[tuple[tuple, pa.RecordBatch, bytes, bool, bool]]:
        """(block, rows, text, first of its block, last of its block)."""
        held, seen = None, None
        for key, rows, text in _blocks(self.batches):
            begins = key != seen
            text = text if begins and key[1] == 0 else b"{" + text
            if held is not None:
                yield *held, begins
            held, seen = (key, rows, text, begins), key
        if held is not None:
            yield *held, True


_SUMMARY = "file long, block long, quotes long, depth_outside long, depth_inside long, opening string"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, state = [], None
    for (file, block), _, text, begins, ends in _Reader(batches):
        if begins:
            state = [0, 0, 0, b""]
        _, steps, quotes = _lex(text)
        odd = (quotes[:-1] + state[0]) % 2 == 1
        state[1] += int(steps[~odd].sum())
        state[2] += int(steps[odd].sum())
        state[0] += int(quotes[-1])
        state[3] = state[3] or text.lstrip(_SPACE)[:1]
        if ends:
            out.append((file, block, state[0], state[1], state[2], state[3].decode("latin-1")))
    columns = list(zip(*out)) or [()] * 6
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(columns[5], pa.string())],
                                     [c.split()[0] for c in _SUMMARY.split(", ")])


#: part 0: from a block's start, 1: after its last record; a closed piece ends a record. Null: a whole record, closed
#: unless there is text before it that should not be there.
_CUT = "file long, block long, part int, closed boolean, text binary"


def _record(text: bytes, base: int) -> tuple[bool, bytes]:
    """(True, the record) if only what should be lies between it and the one before, else (False, all text)."""
    between, brace, rest = text.partition(b"{")
    allowed = (b"[", b",") if base else (b"",)
    return (True, brace + rest) if between.strip(_SPACE) in allowed else (False, text)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pending: list[bytes] = []
    inside = depth = base = 0
    cut = False  # whether a record of this block has ended
    for (file, block), rows, text, begins, ends in _Reader(batches):
        if begins:
            inside, depth, base = (int(rows.column(c)[0].as_py()) for c in ("inside", "depth", "base"))
            pending, cut = [], False
        at, steps, quotes = _lex(text)
        outside = (quotes[:-1] + inside) % 2 == 0
        after = depth + np.cumsum(steps * outside)
        borders = (at[outside & (steps < 0) & (after == base)] + 1).tolist()
        borders = [i for i in borders if text[i - 1] == 125]
        inside, depth = (inside + int(quotes[-1])) % 2, int(after[-1]) if len(after) else depth
        out, start = [], 0
        for i in borders:
            record = b"".join([*pending, text[start:i]])
            out.append((None, *_record(record, base)) if cut or block == 0 else (0, True, record))
            pending, start, cut = [], i, True
        pending.append(text[start:])
        if ends:
            out.append((int(cut), False, b"".join(pending)))
        if out:
            part, closed, texts = zip(*out)
            n = len(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * n, pa.int64()), pa.array([block] * n, pa.int64()), pa.array(part, pa.int32()),
                 pa.array(closed, pa.bool_()), pa.array(texts, pa.binary())], [c.split()[0] for c in _CUT.split(", ")])


@contextmanager
def _split_every(spark: SparkSession, split_bytes: int | None):
    """Jobs in this context read files in ranges of ``split_bytes``."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    if split_bytes:
        spark.conf.set(names[0], f"{split_bytes}b")
        spark.conf.set(names[1], "0b")
    try:
        yield
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)


def block_states(pieces: DataFrame) -> DataFrame:
    """(file, block, inside, depth, base, final_depth) with which every block begins."""
    blocks = pieces.mapInArrow(_summaries, _SUMMARY)
    # One row per block: a file of a terabyte has some thousands.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    blocks = blocks.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    change = F.when(F.col("inside") == 0, F.col("depth_outside")).otherwise(F.col("depth_inside"))
    opening = F.min_by("opening", F.when(F.col("opening") != "", F.col("block"))).over(whole)
    return blocks.withColumn("change", change).select(
        "file", "block", "inside", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"),
        F.when(opening == "[", 1).otherwise(0).alias("base"))


def read_json_array(spark: SparkSession, path: str | list[str], schema: T.StructType, keep_corrupt: bool = False,
                    split_bytes: int | None = None, file_col: str | None = None) -> DataFrame:
    """Records of JSON documents, each an array of objects, one object, or objects in a row, read by many tasks.

    ``path`` is as for the text source: any Hadoop URI, a glob or a list. ``split_bytes`` is the size of a
    task's range (by default Spark's). Records are parsed with ``schema``, as ``read_json_documents`` does.
    ``keep_corrupt`` adds ``CORRUPT_COLUMN`` with the text of what is no record: damaged records, text
    between records, and the rest of a document that is cut off (empty if it is cut after a record).
    Without it such a document raises. An empty file and an empty array have no records. ``file_col``
    adds the file's path. The read is made at once, into the shared scratch folder; a compressed file
    cannot be split and is one task.
    """
    with _split_every(spark, split_bytes):
        text = spark.read.option("lineSep", "{").text(path)
        where = F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
        pieces = text.select(*where, F.col("value").cast("binary").alias("piece"))
        states_path = scratch_path(spark, "json-blocks")
        block_states(pieces).write.parquet(states_path)
        states = spark.read.parquet(states_path)
        # A row per block of the input: about 40 bytes for every maxPartitionBytes.
        known = pieces.join(F.broadcast(states), ["file", "block"]).select("file", "block", "piece", "inside", "depth", "base")
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
        record_type = with_corrupt_column(schema)
        broken = F.struct(*[F.col("text").cast("string").alias(f.name) if f.name == CORRUPT_COLUMN
                            else F.lit(None).cast(f.dataType).alias(f.name) for f in record_type.fields]).cast(record_type)
        parsed = F.when(F.col("closed"), F.from_json(F.col("text").cast("string"), record_type, options)).otherwise(broken)
        cut = known.mapInArrow(_cut, _CUT).select(
            "file", "block", "part", "closed", F.when(F.col("part").isNotNull(), F.col("text")).alias("text"),
            F.when(F.col("part").isNull(), parsed).alias("record"))
        cut_path = scratch_path(spark, "json-records")
        cut.write.parquet(cut_path)
    cut = spark.read.schema(cut.schema).parquet(cut_path)
    whole = cut.where("part is null").select("file", "record")
    both = whole.unionByName(_spanning(cut, states, parsed))
    record = "record.*"
    if not keep_corrupt:
        damaged = F.raise_error(F.concat(F.lit("damaged JSON record: "), F.substring(f"record.{CORRUPT_COLUMN}", 1, 200)))
        checked = F.when(F.col(f"record.{CORRUPT_COLUMN}").isNotNull(), damaged.cast(cut.schema["record"].dataType)).otherwise(F.col("record"))
        both = both.withColumn("record", checked)
    if file_col:
        names = text.select(where[0], F.col("_metadata.file_path").alias(file_col)).distinct()
        both = both.join(names, "file").select(record, file_col)
    else:
        both = both.select(record)
    return both if keep_corrupt else both.drop(CORRUPT_COLUMN)


def _spanning(cut: DataFrame, states: DataFrame, parsed) -> DataFrame:
    """Records that lie in several blocks, and what is wrong at the end of a file."""
    pieces = cut.where("part is not null").select("file", "block", "part", "closed", "text")
    order = Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    numbered = pieces.withColumn("number", F.coalesce(F.sum(F.col("closed").cast("long")).over(order), F.lit(0)))
    joined = numbered.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("block", "part", "text"))).alias("pieces"), F.max("closed").alias("closed"))
    base = states.where("block = 0").select("file", "base")
    joined = joined.join(base, "file").select(
        "file", "closed", "base", F.array_join(F.transform("pieces", lambda p: p["text"].cast("string")), "").alias("raw"),
        # From the start of the file: no record has ended before.
        ((F.col("number") == 0) & (F.element_at("pieces", 1)["block"] == 0) & (F.element_at("pieces", 1)["part"] == 0)).alias("opening"))
    trimmed = F.regexp_replace("raw", "^[ \t\r\n]+|[ \t\r\n]+$", "")
    between = F.regexp_extract("raw", r"(?s)^[ \t\r\n]*(\[|,|)[ \t\r\n]*\{", 1)
    clean = F.regexp_extract("raw", r"(?s)^[ \t\r\n]*[\[,]?[ \t\r\n]*(\{.*)$", 1)
    right = F.when(F.col("base") == 1, between.isin("[", ",")).otherwise(between == "") & (clean != "")
    ended = F.when(F.col("opening"), (trimmed == "") | trimmed.rlike(r"^\[[ \t\r\n]*\]$")).otherwise(
        trimmed == F.when(F.col("base") == 1, "]").otherwise(""))
    text = F.when(F.col("closed") & right, clean).when(F.col("closed"), F.col("raw")).otherwise(trimmed)
    return (joined.where(F.col("closed") | ~ended).select("file", (F.col("closed") & right).alias("closed"), text.cast("binary").alias("text"))
            .select("file", parsed.alias("record")))
