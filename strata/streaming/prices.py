"""The latest price of every key as state of a stream, with expiry.

State holds one price per key. A newer price replaces it; an older one, or the same again, is told apart
as late and changes nothing, so days may arrive in any order. The event-time watermark trails the newest
price by the freshness limit: a key whose price falls behind it is expired by a timer and leaves the
state, and rows that arrive behind it never enter (their number is in the query's progress). State is
thus bounded by the keys priced within the limit, whatever the length of the stream.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_STATE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NEW, LATE, EXPIRED = "new", "late", "expired"
_CHANGE = "change string, time_ms long, price double, n_rows long"


class _LatestPrice(StatefulProcessor):
    """Columns of a row: time_ms and price. The latest time wins, and of its prices the greatest."""

    def __init__(self, keys: Sequence[str]):
        self.keys = list(keys)

    def _change(self, key, change: str, time_ms: int | None, price: float | None, n_rows: int) -> Row:
        names = [*self.keys, "change", "time_ms", "price", "n_rows"]
        return Row(**dict(zip(names, (*tuple(key)[:len(self.keys)], change, time_ms, price, n_rows))))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", "time_ms long, price double")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.latest.get()  # each call is a round trip to the state store; None where nothing is held
        best, n, late = held, 0, 0
        for row in rows:
            own = (row["time_ms"], row["price"])
            n += 1
            if best is None or own > best:
                best = own
            elif held is not None and own <= held:
                late += 1
        if best != held:
            if held is not None:
                self.handle.deleteTimer(held[0])
            self.latest.update(best)
            self.handle.registerTimer(best[0])
            yield self._change(key, NEW, *best, n - late)
        if late:
            yield self._change(key, LATE, None, None, late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        time_ms, price = self.latest.get()
        self.latest.clear()
        yield self._change(key, EXPIRED, time_ms, price, 0)

    def close(self) -> None:
        pass


def latest_price_changes(stream: DataFrame, keys: Sequence[str], time_col: str, price_col: str, fresh_days: int) -> DataFrame:
    """keys, change, time_ms, price, n_rows: what each micro-batch does to the latest price of a key.

    ``new``: the price that holds now, with the rows of the batch that are not late; ``late``: rows that are no
    newer than what was held, with their number; ``expired``: the price that held is ``fresh_days`` old or
    more. Rows without a key, a time or a price say nothing and are left out. Times count in milliseconds.
    """
    keys = list(keys)
    at = F.col(time_col).cast("timestamp")
    rows = stream.select(*keys, at.alias("__at"), F.unix_millis(at).alias("time_ms"), F.col(price_col).cast("double").alias("price"))
    rows = rows.dropna().withWatermark("__at", f"{fresh_days} days")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:len(keys)])
    return rows.groupBy(*keys).transformWithState(_LatestPrice(keys), f"{types}, {_CHANGE}", "Update", "EventTime")


@contextmanager
def state_store(spark: SparkSession):
    """Queries started in this context keep their state in RocksDB, which timers need."""
    before = spark.conf.get(_STATE, None)
    spark.conf.set(_STATE, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_STATE)
        else:
            spark.conf.set(_STATE, before)


def run_latest_prices(stream: DataFrame, keys: Sequence[str], time_col: str, price_col: str, fresh_days: int,
                      out: str, checkpoint: str) -> list[dict]:
    """Process what is new of ``stream`` into ``out``, a folder of changes per micro-batch (one that is run
    again replaces its own); returns the progress of the micro-batches."""
    def store(batch: DataFrame, epoch: int) -> None:
        (batch.withColumn("__seq", F.when(F.col("change") == EXPIRED, 1).otherwise(0)).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").parquet(f"{out.rstrip('/')}/__epoch={epoch}"))

    spark = stream.sparkSession
    with state_store(spark):
        query = (latest_price_changes(stream, keys, time_col, price_col, fresh_days).writeStream.foreachBatch(store)
                 .outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    return [json.loads(p.json) for p in query.recentProgress]


def held_prices(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """The prices that hold after all changes in ``out``: keys, time_ms, price."""
    changes = spark.read.option("basePath", out).parquet(f"{out.rstrip('/')}/__epoch=*").where(F.col("change") != LATE)
    last = F.max_by(F.struct("change", "time_ms", "price"), F.struct(F.col("__epoch").cast("long"), F.col("__seq")))
    return (changes.groupBy(*keys).agg(last.alias("last")).where(F.col("last.change") == NEW)
            .select(*keys, "last.time_ms", "last.price"))
