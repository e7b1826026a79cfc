"""Web archives: writing records, reading them back, and an index built by external merge.

Archives are written by Spark's text writer: a record is a header block and a body, and the two
line ends that close a WARC record are the writer's line separator, so a part file is a plain
WARC file (gzip over the whole file) in whatever store the path names. Of equal payloads of at
least ``min_bytes``, the one with the smallest id is stored; the others become revisit records.

The index of captures is an external merge. Each task sorts the captures that it read and writes
them as a run. Runs are dealt by ranges of (url key, timestamp, id), and each range merges the
pieces that it gets, already in order, with a loser tree. Ranges are sized by the number of
captures, and cut inside a url's history too, so one hot url spans many tasks.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import staged
from strata.session import scratch_path

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n"
_ID = "urn:page:"


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), F.regexp_replace(value, "[\r\n]", " "), F.lit(_END))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            time_col: str | None = None, min_bytes: int = 100) -> DataFrame:
    """One column ``record``: the text of a WARC record per page, without its closing line ends."""
    time = F.col(time_col).cast("timestamp") if time_col else F.lit(None).cast("timestamp")
    p = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"),
                     F.coalesce(time, F.timestamp_seconds(F.lit(0))).alias("time"))
    p = p.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    first = (p.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
             .agg(F.min("id").alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies"))
    p = p.join(first, "digest", "left")
    name = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "),
                    F.octet_length("payload").cast("string"), F.lit(_END + _END))
    body = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit(f"WARC/1.1{_END}"),
        F.when(revisit, F.lit(f"WARC-Type: revisit{_END}")).otherwise(F.lit(f"WARC-Type: response{_END}")),
        _header("WARC-Record-ID", F.concat(F.lit(f"<{_ID}"), name, F.lit(">"))),
        _header("WARC-Target-URI", F.coalesce("url", F.concat(F.lit(_ID), name))),
        _header("WARC-Date", F.date_format(F.to_utc_timestamp("time", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(
            _header("WARC-Profile", F.lit(PROFILE)),
            _header("WARC-Refers-To", F.concat(F.lit(f"<{_ID}"), F.col("first").cast("string"), F.lit(">"))),
        )).otherwise(F.lit("")),
        F.lit(f"Content-Type: application/http;msgtype=response{_END}"),
        _header("Content-Length", F.octet_length(body).cast("string")))
    return p.select(F.concat(head, F.lit(_END), body).alias("record"))


def write_archives(pages: DataFrame, path: str, records_per_file: int = 4096, **columns) -> None:
    """WARC files under ``path``, at most ``records_per_file`` records in each."""
    (records(pages, **columns).write.option("lineSep", _END + _END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def _parse(f: io.BufferedIOBase) -> Iterator[tuple[dict, bytes, int]]:
    """(headers, body, offset) of each record of an open, decompressed archive."""
    while True:
        offset = f.tell()
        line = f.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {offset}: {line[:40]!r}")
        headers = {}
        while (line := f.readline().rstrip(b"\r\n")):
            k, _, v = line.partition(b": ")
            headers[k.decode().lower()] = v.decode("utf-8", "replace")
        size = int(headers["content-length"])
        body = f.read(size)
        if len(body) != size or f.read(4) != b"\r\n\r\n":
            raise ValueError(f"the record at byte {offset} is cut off")
        yield headers, body, offset


def _capture(headers: dict, body: bytes) -> dict:
    head, _, payload = body.partition(b"\r\n\r\n")
    fields = dict(x.partition(b": ")[::2] for x in head.split(b"\r\n")[1:])
    stated = headers["warc-payload-digest"].partition(":")[2]
    kind = headers["warc-type"]
    own = headers["warc-record-id"].strip("<>").removeprefix(_ID)
    to = headers.get("warc-refers-to", "").strip("<>").removeprefix(_ID)
    digest = hashlib.sha256(payload).hexdigest() if kind == "response" else stated
    if digest != stated:
        raise ValueError(f"record {own}: its payload does not have the digest that its header states")
    return {"page_id": None if own == "null" else int(own), "url": headers["warc-target-uri"],
            "time": headers["warc-date"], "record_type": kind, "refers_to": int(to) if to else None,
            "payload_bytes": int(fields[b"Content-Length"]), "payload_digest": digest}


_CAPTURE = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("time", pa.string()), ("record_type", pa.string()),
                      ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                      ("file", pa.string()), ("offset", pa.int64())])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record under ``path``: its headers, the payload's size and checked digest, and
    the place (file, and offset in the decompressed archive)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0), b.column(1)):
                with gzip.open(io.BytesIO(content.as_buffer())) as f:
                    rows = [_capture(h, body) | {"file": name.as_py(), "offset": at} for h, body, at in _parse(f)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_CAPTURE)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(
        run, "page_id long, url string, time string, record_type string, refers_to long, payload_bytes long, "
             "payload_digest string, file string, offset long")


def url_key(url: Column) -> Column:
    """The sort-friendly key of a url: host labels reversed, then path and query, no scheme."""
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    rest = F.regexp_replace(rest, r"#.*$", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1)), r":\d+$", ""), r"^www\.", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_extract(rest, r"^[^/?]*(.*)$", 1))


class LoserTree:
    """A k-way merge of sorted lists: leaves are the heads of the lists, an inner node keeps the
    loser of its match and the winner moves up, so the next row costs one path of comparisons."""

    def __init__(self, lists: list[list]):
        self.lists, self.k = lists, max(1, len(lists))
        self.at = [0] * len(lists)
        self.tree = [-1] * self.k
        for i in range(len(lists)):
            self._replay(i, building=True)

    def _less(self, a: int, b: int) -> bool:
        """The head of list a goes before that of list b; an empty list goes last, ties by list."""
        x, y = self.lists[a], self.lists[b]
        if self.at[a] >= len(x):
            return False
        if self.at[b] >= len(y):
            return True
        return (x[self.at[a]], a) < (y[self.at[b]], b)

    def _replay(self, i: int, building: bool = False) -> None:
        node = (i + self.k) // 2
        while node > 0:
            other = self.tree[node]
            if other < 0 and building:  # the other side has not come up yet: wait here
                self.tree[node] = i
                return
            if other >= 0 and self._less(other, i):
                self.tree[node], i = i, other
            node //= 2
        self.tree[0] = i

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(list, position) of all entries, in order."""
        for _ in range(sum(map(len, self.lists))):
            w = self.tree[0]
            yield w, self.at[w]
            self.at[w] += 1
            self._replay(w)


_ORDER = ["url_key", "time", "page_id"]


def _sort_keys(t: pa.Table) -> list[tuple]:
    ids = t.column("page_id").to_pylist()
    return [(u, s, i is not None, i or 0) for u, s, i in
            zip(t.column("url_key").to_pylist(), t.column("time").to_pylist(), ids)]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    t = pa.Table.from_batches(held)
    keys = _sort_keys(t)
    cuts = [0, *(i for i in range(1, len(keys)) if keys[i] < keys[i - 1]), len(keys)]  # where a run's piece ends
    order = np.fromiter((cuts[r] + i for r, i in LoserTree([keys[a:b] for a, b in zip(cuts, cuts[1:])])),
                        dtype=np.int64, count=len(keys))
    yield from t.take(pa.array(order)).combine_chunks().to_batches(max_chunksize=10_000)


def capture_index(captures: DataFrame, rows_per_range: int = 250_000) -> DataFrame:
    """The captures in the order of (url key, time, id) over all partitions, with url_key.

    rows_per_range bounds what one merging task holds, whatever the input and however hot a url.
    """
    runs = staged(captures.withColumn("url_key", url_key(F.col("url"))).sortWithinPartitions(*_ORDER), "warc-runs")
    ranges = max(1, math.ceil(runs.count() / rows_per_range))
    schema = runs.schema
    return runs.repartitionByRange(ranges, *_ORDER).mapInArrow(_merge, schema)


def archive_and_index(pages: DataFrame, path: str | None = None, **columns) -> DataFrame:
    """Writes the pages' archives, reads them back and returns the merged index, one row per page:
    page_id, payload_bytes, payload_digest, record_type, refers_to, url, url_key, time, file, offset.

    A null payload is empty. Equal payloads of at least ``min_bytes`` (100) are stored once, under
    the smallest id; pages whose id is null never give their name to others, but may revisit.
    Repeated rows stay repeated: all rows with the smallest id are responses. A null url is
    replaced by a name made of the id; without ``time_col`` the date is 1970. Other columns are
    not read. No pages give an empty index.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, **columns)
    return capture_index(read_archives(spark, path))
