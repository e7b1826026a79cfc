"""A paged extract as a resumable source, in batch and as a stream.

The extractor fetches pages of a fixed size until one is short; run again, it fetches the last page
anew, which may have grown, and goes on. ``PagedSource`` reads such pages with a task per page, or of very many pages some per task. As a
stream its offsets count items: an offset is the first item that was not read, so a page that has grown
gives its new items only, a page fetched again gives nothing, and the checkpoint resumes at the page
where a failure came. A page that is not there yet ends the stream's reach: pages are read in order.

Pages are JSON files ``{"data": [...]}`` whose path ends in the page number (``page_7.json``,
``page=7/part-0.json``), in any file system that Arrow knows (local, HDFS, S3, GCS, Azure).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from strata.operators.windows import keep_one
from strata.sources.landing import TS_FORMAT

#: Items of a full page.
PAGE_SIZE = 250
#: Up to so many pages have a task each; of more, a task reads up to so many, one after another.
SINGLE_PAGES, PAGES_PER_TASK = 128, 64
_ITEMS = "page long, position int, item string"


class Page(InputPartition):
    """Items ``start`` to ``end`` (None: all that there are) of the page that ``paths`` hold."""

    def __init__(self, page: int, paths: list[str], start: int = 0, end: int | None = None):
        self.page, self.paths, self.start, self.end = page, paths, start, end


class PageGroup(InputPartition):
    """Consecutive pages, read one after another."""

    def __init__(self, pages: list[Page]):
        self.pages = pages


def _grouped(pages: list[Page]) -> list[InputPartition]:
    """The partitions of ``pages``: a task costs more than reading a page does."""
    n = min(PAGES_PER_TASK, -(-len(pages) // SINGLE_PAGES))
    return pages if n <= 1 else [PageGroup(pages[i:i + n]) for i in range(0, len(pages), n)]


class _Pages:
    """The page files of a folder. They are listed where a reader is made or asked for what is new."""

    def __init__(self, options: dict):
        options = {k.lower(): v for k, v in options.items()}  # Spark's option names have no case
        self.path = options["path"]
        self.items_field = options.get("itemsfield", "data")
        self.first = int(options.get("firstpage", 0))
        self.size = int(options.get("pagesize", PAGE_SIZE))

    def _store(self):
        from pyarrow import fs
        if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", self.path):
            return fs.FileSystem.from_uri(self.path)
        return fs.LocalFileSystem(), self.path

    def files(self) -> dict[int, list[str]]:
        from pyarrow import fs
        store, root = self._store()
        out: dict[int, list[str]] = {}
        for f in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            name = f.path[len(root):].strip("/")
            if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")):
                # The number in the file's name, or in the folder's where files are named by a writer.
                number = re.search(r"page[=_-]?(\d+)", name)
                if number:
                    out.setdefault(int(number[1]), []).append(f.path)
        return out

    def items(self, paths: list[str]) -> list:
        store, _ = self._store()
        out = []
        for path in sorted(paths):
            with store.open_input_stream(path) as f:
                text = f.readall()
            try:
                out += json.loads(text)[self.items_field] or []
            except (ValueError, KeyError, TypeError) as e:
                raise ValueError(f"damaged page file {path}: {e}") from None
        return out

    def read(self, part: Page | PageGroup | None) -> Iterator[tuple]:
        if part is None:  # Spark reads one partition of nothing where there are none
            return
        if isinstance(part, PageGroup):
            for page in part.pages:
                yield from self.read(page)
            return
        items = self.items(part.paths)
        if part.end is not None and len(items) < part.end:
            raise ValueError(f"page {part.page} has {len(items)} items, fewer than the {part.end} that it had")
        for i in range(part.start, len(items) if part.end is None else part.end):
            yield part.page, i, json.dumps(items[i], ensure_ascii=False)


class _BatchReader(DataSourceReader):
    def __init__(self, options: dict):
        self.pages = _Pages(options)

    def partitions(self):
        return _grouped([Page(n, paths) for n, paths in sorted(self.pages.files().items()) if n >= self.pages.first])

    def read(self, partition):
        return self.pages.read(partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.pages = _Pages(options)
        self.known = (self.pages.first, 0)

    def initialOffset(self) -> dict:
        return {"page": self.pages.first, "item": 0}

    def latestOffset(self) -> dict:
        """After the last item that can be read in order. Only the last page is opened here."""
        files = self.pages.files()
        page = self.known[0]
        while page in files:
            page += 1
        if page > self.pages.first:
            n = len(self.pages.items(files[page - 1])) if page - 1 in files else 0
            # A short page may grow: it is not done with.
            reach = (page, 0) if n >= self.pages.size else (page - 1, n)
            self.known = max(self.known, reach)
        return {"page": self.known[0], "item": self.known[1]}

    def partitions(self, start: dict, end: dict):
        out, files = [], self.pages.files()
        for page in range(start["page"], end["page"] + 1):
            a = start["item"] if page == start["page"] else 0
            b = end["item"] if page == end["page"] else None
            if b is None or a < b:
                out.append(Page(page, files.get(page, []), a, b))
        return _grouped(out)

    def read(self, partition):
        return self.pages.read(partition)

    def commit(self, end: dict) -> None:
        pass


class PagedSource(DataSource):
    """Options: path, itemsField (``data``), firstPage (0), pageSize (250)."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return _ITEMS

    def reader(self, schema):
        return _BatchReader(dict(self.options))

    def streamReader(self, schema):
        return _StreamReader(dict(self.options))


def _parsed(items: DataFrame, item_schema: T.StructType, ts_format: str) -> DataFrame:
    item = F.from_json("item", item_schema, {"mode": "FAILFAST", "timestampNTZFormat": ts_format})
    return items.select("page", "position", item.alias("__item")).select("page", "position", "__item.*")


def _options(reader, path: str, items_field: str, first_page: int, page_size: int):
    return reader.format(PagedSource.name()).options(
        path=path, itemsField=items_field, firstPage=str(first_page), pageSize=str(page_size))


def read_paged(spark: SparkSession, path: str, item_schema: T.StructType, items_field: str = "data", first_page: int = 0,
               page_size: int = PAGE_SIZE, ts_format: str = TS_FORMAT) -> DataFrame:
    """All items of all pages there are: page, position in it, and the item's declared fields."""
    spark.dataSource.register(PagedSource)
    return _parsed(_options(spark.read, path, items_field, first_page, page_size).load(), item_schema, ts_format)


def stream_paged(spark: SparkSession, path: str, item_schema: T.StructType, items_field: str = "data", first_page: int = 0,
                 page_size: int = PAGE_SIZE, ts_format: str = TS_FORMAT) -> DataFrame:
    """``read_paged`` as a stream, each item once."""
    spark.dataSource.register(PagedSource)
    return _parsed(_options(spark.readStream, path, items_field, first_page, page_size).load(), item_schema, ts_format)


def land_paged(spark: SparkSession, path: str, item_schema: T.StructType, key: str, out: str, checkpoint: str,
               **how) -> DataFrame:
    """Read what is new of a paged extract into ``out``, and return one row per ``key`` of all that is landed:
    that of the latest page.

    Each micro-batch is a folder of its own, replaced if the batch is run again, so a run that broke off
    leaves no item twice and none out. A damaged page raises; pages before it that earlier runs have
    landed are not read again once it is mended. ``how`` goes to ``stream_paged``.
    """
    def store(batch: DataFrame, epoch: int) -> None:
        (batch.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .parquet(f"{out.rstrip('/')}/__epoch={epoch}"))

    stream = stream_paged(spark, path, item_schema, **how)
    query = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    landed = T.StructType([T.StructField("page", T.LongType()), T.StructField("position", T.IntegerType()), *item_schema.fields])
    rows = spark.read.schema(landed).option("basePath", out).parquet(f"{out.rstrip('/')}/__epoch=*").drop("__epoch")
    return keep_one(rows, key, ["page", "position"], latest=True)
