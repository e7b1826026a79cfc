"""Token totals by source, language and tokenizer version, maintained by signed deltas.

A change inserts, deletes or revises the count of a document under a tokenizer. A batch of changes
is compared with the latest counts of the same documents; the old count leaves and the new one
enters with opposite signs, and the signed rows add up to the batch's delta. Totals are the sum of
all deltas, so a batch touches only its own documents.

A batch's counts and delta are written to a folder of their own and committed by the next entry of a log,
one file that only one writer can make. A batch that the log names is not applied again, a folder that no
entry names is not read, and a writer that comes second works its batch out anew: replays, lost drivers
and writers at the same time change nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources import tables

#: Tokenizer versions that Spark counts itself: the pattern of a token.
PATTERNS = {"words-1": "[^ \t-\r]+", "pieces-1": "[A-Za-z]+|[0-9]|[^ \t-\rA-Za-z0-9]"}

_COUNTS = "doc_id long, tokenizer string, source string, lang string, n_tokens long, batch long"
_DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def pattern_counts(docs: DataFrame, versions: list[str] | None = None, op: str = "insert", id_col: str = "doc_id",
                   text: Column | None = None) -> DataFrame:
    """Changes (doc_id, tokenizer, source, lang, n_tokens, op) with the counts of the named patterns."""
    body = F.coalesce(F.col("text").cast("string") if text is None else text, F.lit(""))
    counts = F.array(*[F.struct(F.lit(v).alias("tokenizer"), F.regexp_count(body, F.lit(PATTERNS[v])).cast("long").alias("n"))
                       for v in versions or list(PATTERNS)])
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), "source", "lang", F.explode(counts).alias("c"))
            .select("doc_id", "c.tokenizer", "source", "lang", F.col("c.n").alias("n_tokens"), F.lit(op).alias("op")))


def vocabulary_counts(docs: DataFrame, path: str, version: str, op: str = "insert") -> DataFrame:
    """Changes with the counts of a public tokenizer file (the JSON of the tokenizers library), which
    every executor must be able to read under ``path``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            n = [len(e.ids) for i in range(0, len(texts), 256)
                 for e in tokenizer.encode_batch(texts[i:i + 256], add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), b.column("lang"),
                                              pa.array(n, pa.int64())], names=["doc_id", "source", "lang", "n_tokens"])

    source: Callable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang",
                                   F.col("text").cast("string").alias("text")).mapInArrow
    return source(run, "doc_id long, source string, lang string, n_tokens long").select(
        "doc_id", F.lit(version).alias("tokenizer"), "source", "lang", "n_tokens", F.lit(op).alias("op"))


class TokenTotals:
    """The totals kept under ``path``, a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _committed(self) -> list[tuple[int, str, str]]:
        """(number, batch, folder) of the committed batches, in their order."""
        found = []
        for name in sorted(n for n in tables._names(self.spark, f"{self.path}/_log") if n.isdigit()):
            batch, folder = tables._read_lines(self.spark, f"{self.path}/_log/{name}")
            found.append((int(name), batch, folder))
        return found

    def batches(self) -> dict[str, int]:
        """The committed batches and their numbers, in the order of commitment."""
        return {batch: number for number, batch, _ in self._committed()}

    def _read(self, what: str, schema: str) -> DataFrame:
        paths = [f"{self.path}/{folder}/{what}" for _, _, folder in self._committed()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def current(self, keys: DataFrame | None = None) -> DataFrame:
        """The latest counts (doc_id, tokenizer, source, lang, n_tokens); n_tokens is null once deleted."""
        log = self._read("counts", _COUNTS)
        if keys is not None:
            log = log.join(keys, ["doc_id", "tokenizer"], "left_semi")
        last = F.max(F.struct("batch", "source", "lang", "n_tokens")).alias("last")
        return log.groupBy("doc_id", "tokenizer").agg(last).select(
            "doc_id", "tokenizer", "last.source", "last.lang", "last.n_tokens")

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commits a batch of changes (doc_id, tokenizer, source, lang, n_tokens, op); False if it already is.

        op: insert and revise set the count, source and language; delete removes the count. To
        insert what is there revises it, to revise or delete what is not there inserts it or does
        nothing. Of several changes of one document and tokenizer in a batch the greatest holds, a
        delete least, then by count. A null count is 0. Changes without an id or a tokenizer, or
        with another op, are left out. Null sources and languages are groups of their own. Other
        columns are not read.

        Several writers may apply batches at once, the same one too: a batch is worked out against the
        batches before its number, into a folder of this attempt, and the log's entry with that number can be
        made once. Who finds it taken works the batch out anew against what was committed meanwhile.
        """
        while True:
            done = self.batches()
            if batch in done:
                return False
            number = max(done.values(), default=0) + 1
            folder = f"batch-{number:09d}-{uuid.uuid4().hex}"
            self._write(f"{self.path}/{folder}", number, changes)
            if tables.create_once(self.spark, f"{self.path}/_log/{number:09d}", f"{batch}\n{folder}"):
                return True

    def _write(self, folder: str, number: int, changes: DataFrame) -> None:
        """The batch's counts, and what they change in the totals of the batches committed so far."""
        n = F.when(F.col("op") != "delete", F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)))
        new = (changes.where("doc_id is not null and tokenizer is not null and op in ('insert', 'revise', 'delete')")
               .select(F.col("doc_id").cast("long").alias("doc_id"), "tokenizer", n.alias("n_tokens"), "source", "lang")
               .groupBy("doc_id", "tokenizer").agg(F.max(F.struct("n_tokens", "source", "lang")).alias("c"))
               .select("doc_id", "tokenizer", "c.source", "c.lang", "c.n_tokens", F.lit(number).cast("long").alias("batch")))
        new.write.mode("overwrite").parquet(f"{folder}/counts")
        new = self.spark.read.schema(_COUNTS).parquet(f"{folder}/counts")
        old = self.current(new.select("doc_id", "tokenizer"))
        signed = (new.select("source", "lang", "tokenizer", "n_tokens", F.lit(1).alias("sign"))
                  .union(old.select("source", "lang", "tokenizer", "n_tokens", F.lit(-1))).where("n_tokens is not null"))
        delta = signed.groupBy("source", "lang", "tokenizer").agg(
            F.sum("sign").cast("long").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens"))
        delta.write.mode("overwrite").parquet(f"{folder}/delta")

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) of all committed batches; emptied groups are gone."""
        return (self._read("delta", _DELTA).groupBy("source", "lang", "tokenizer")
                .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs > 0"))
