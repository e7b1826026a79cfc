"""Sharding by a minimax contiguous partition: near equal bytes, equal texts together.

Documents with equal texts are an atomic group. Groups are ordered by a 60-bit key of their text, and a
shard is a stretch of that order, so a document's shard follows from its own key and at most one
cut per shard: no join. The capacity is the smallest with which greedy filling needs no more than
the given shards; it is found by binary search, and the cuts are where greedy filling closes a
shard. A group that is as large as the mean of what is left takes a shard of its own first, so that
one large group of copies does not leave other shards empty.

The search never sees all groups. The key space is dealt into a fixed number of cells, whose bytes and
counts are grouped sums; greedy filling over cells bounds the capacity from both sides, and only
the cells where a cut may fall are dealt again, until every cut is between two known groups. All
steps are DataFrame operations; the driver sees at most ``CELLS`` rows a round, some rounds in all.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged
from strata.operators.windows import number_within

SHARDS = 40
#: Bytes of a document besides its text.
OVERHEAD = 16
#: Cells of a round of the search, and so rows that the driver sees in it.
CELLS = 1 << 15
KEY_BITS = 60


def measured(docs: DataFrame, id_col: str, text_col: str, overhead: int) -> DataFrame:
    """(doc_id, size, text_crc32, key), one row per row; a null text counts as the empty one."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    key = F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + overhead).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), key.alias("key"))


class _Cells:
    """Known cells (first key, end, bytes, groups) in key order, and the bytes before each."""

    def __init__(self, cells: list[tuple[int, int, int, int]]):
        self.cells = sorted(cells)
        self.before = [0, *accumulate(c[2] for c in self.cells)]
        self.total = self.before[-1]

    def floor(self, x: int) -> int:
        """The greatest known sum that is not above x."""
        return self.before[bisect_right(self.before, x) - 1]

    def ceiling(self, x: int) -> int:
        """A bound from above for the greatest sum that is not above x."""
        i = bisect_right(self.before, x) - 1
        return x if i < len(self.cells) and self.cells[i][3] > 1 else self.before[i]

    def cuts(self, capacity: int, shards: int, step) -> list[int]:
        """Sums where greedy filling closes the shards."""
        out, at = [], 0
        for _ in range(shards):
            at = min(step(at + capacity), self.total)
            out.append(at)
        return out

    def least(self, shards: int, step) -> int:
        """The smallest capacity that fills everything into the shards, by binary search."""
        low, high = -(-self.total // shards), self.total
        while low < high:
            mid = (low + high) // 2
            if self.cuts(mid, shards, step)[-1] == self.total:
                high = mid
            else:
                low = mid + 1
        return low

    def doubtful(self, shards: int) -> tuple[list[tuple[int, int, int, int]], list[int]]:
        """Cells of several groups in which a cut may fall, largest first; and the cuts, exact if there are none."""
        low = self.cuts(self.least(shards, self.ceiling), shards, self.floor)
        high = self.cuts(self.least(shards, self.floor), shards, self.ceiling)
        out = set()
        for a, b in zip(low, high):
            i = bisect_right(self.before, a) - 1
            while i < len(self.cells) and self.before[i] < b:
                if self.cells[i][3] > 1:
                    out.add(self.cells[i])
                i += 1
        return sorted(out, key=lambda c: (-c[2], c)), high

    def refined(self, gone: list, finer: list) -> "_Cells":
        gone = set(gone)
        return _Cells([c for c in self.cells if c not in gone] + finer)


def _large_groups(groups: DataFrame, shards: int, total: int) -> list:
    """Groups that take a shard of their own, largest first: each is at least the mean of what is left."""
    out, left = [], total
    for r in groups.orderBy(F.desc("bytes"), "key").limit(shards).collect():
        if r.bytes * (shards - len(out)) < left:
            break
        out.append(r)
        left -= r.bytes
    return out


def partition(groups: DataFrame, shards: int, cells: int = CELLS) -> tuple[list[int], list[int], int]:
    """For ``groups`` (key, bytes), which is read some times: the keys with shards of their own, the first keys
    of the other shards after the first, and the capacity of these."""
    total = groups.agg(F.sum("bytes").alias("t")).first().t or 0
    large = _large_groups(groups, shards, total)
    alone = [r.key for r in large]
    total -= sum(r.bytes for r in large)
    left = shards - len(alone)
    if not total:
        return alone, [], 0
    rest = groups.where(~F.col("key").isin(alone)) if alone else groups
    width = (1 << KEY_BITS) // cells
    bucket = F.expr(f"key div {width}")  # whole numbers: keys have more bits than a double
    sums = [F.sum("bytes").alias("bytes"), F.count("*").alias("n")]
    rows = rest.groupBy(bucket.alias("bucket")).agg(*sums).collect()
    known = _Cells([(r.bucket * width, (r.bucket + 1) * width, r.bytes, r.n) for r in rows])
    while True:
        open_cells, cuts = known.doubtful(left)
        if not open_cells:
            break
        open_cells = open_cells[:cells // 4]
        parts = cells // len(open_cells)
        dealt = groups.sparkSession.createDataFrame(
            [(a // width, a, b, max(1, -(-(b - a) // parts))) for a, b, *_ in open_cells], "bucket long, a long, b long, step long")
        cell = F.expr("a + (key - a) div step * step")
        rows = (rest.withColumn("bucket", bucket).join(F.broadcast(dealt), "bucket").where("key >= a and key < b")
                .groupBy(cell.alias("cell"), "step", "b").agg(*sums).collect())
        known = known.refined(open_cells, [(r.cell, min(r.cell + r.step, r.b), r.bytes, r.n) for r in rows])
    first = dict(zip(known.before, (c[0] for c in known.cells)))
    return alone, [first[c] for c in cuts if c < known.total], max(b - a for a, b in zip([0, *cuts], cuts))


def shard_of(key: Column, alone: list[int], first: list[int]) -> Column:
    """The shard of a key: its own, or by the number of cuts at or below it."""
    shard = reduce(lambda n, c: n + (key >= F.lit(c)).cast("int"), first, F.lit(len(alone)))
    for i, k in enumerate(alone):
        shard = F.when(key == F.lit(k), F.lit(i)).otherwise(shard)
    return shard.cast("int")


def shards(docs: DataFrame, n_shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
           overhead: int = OVERHEAD, cells: int = CELLS) -> DataFrame:
    """doc_id, size, text_crc32, key, shard and slot, one row per row of ``docs``.

    size is the text's UTF-8 bytes and ``overhead``. Equal texts are in one shard (``key`` is equal for equal
    texts; should two texts share it, they stay together too), and slots number a shard's rows from 0
    by doc_id. A null text is the empty text, with the CRC-32 of no bytes, zero. Null ids come first, and
    rows that repeat an id each have a slot. Where there are fewer groups than shards, the last
    shards are empty. Other columns are not read. No rows give no rows.
    """
    rows = staged(measured(docs, id_col, text_col, overhead), "sharding-rows")
    groups = staged(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "sharding-groups")
    alone, first, _ = partition(groups, n_shards, cells)
    dealt = rows.withColumn("shard", shard_of(F.col("key"), alone, first))
    numbered = number_within(dealt, "shard", ["doc_id", "key"], "slot")
    return numbered.withColumn("slot", F.col("slot") - 1)
