"""Keyed state that expires, held by Spark's own state store.

A job keeps one row for each key, the newest by (event_time, offset), for `ttl` seconds of event time. The watermark runs `ttl`
behind the newest row, so a row that it reaches is expired: a timer removes it, and rows that come that late are not taken.
What changes is written as it happens, `live` telling a new row from an expired one, and the state itself can be read from
the checkpoint. Restarts, repeated batches and lost executors are Spark's: state is versioned with the batches.

Rows are reduced to one for each key and Arrow batch before they are dealt out, so a symbol that sends a third of all rows
sends one row a batch to its task.

A call of Python and a request to the state store cost milliseconds, a row microseconds. Keys are therefore dealt to a fixed number
of shards by hash, and a shard's keys are read, changed and written at once: the calls of a batch do not grow with its keys.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StringType, StructField, StructType

WATERMARK = "10 minutes"
STATE = "newest"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
QUEUE = "recent"
#: Of the keys of a job, for the life of its checkpoint.
SHARDS = 1024


@contextmanager
def rocks(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which timers and state variables need."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def start(stream: DataFrame, root: str, checkpoint: str, seconds: int | None) -> StreamingQuery:
    """Append `stream` to the Parquet folder `root`; `seconds` is the trigger interval, None processes what is there and ends."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", root).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{seconds} seconds")
    with rocks(stream.sparkSession):
        return writer.start()


def _expiry(micros: int) -> int:
    """The first millisecond that is not before a time."""
    return -(-micros // 1000)


def _shard(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(SHARDS)).cast("int")


class Newest(StatefulProcessor):
    """Keeps the newest row of each symbol of a shard until the watermark reaches it. Rows come as `micros`, `offset` and `values`, a
    JSON text of the rest. The shard has one timer, for the row that goes first."""

    FIELDS = StructType([StructField("symbol", StringType()), StructField("micros", LongType()), StructField("offset", LongType()),
                         StructField("values", StringType())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getListState(STATE, self.FIELDS)

    def _held(self) -> dict[str, tuple]:
        return {row[0]: tuple(row) for row in self.newest.get()}

    def _keep(self, held: dict[str, tuple], before: int | None) -> None:
        """Write the rows, and move the timer that stood at `before`."""
        if held:
            self.newest.put(list(held.values()))
        else:
            self.newest.clear()
        first = min((_expiry(row[1]) for row in held.values()), default=None)
        if first != before:
            if before is not None:
                self.handle.deleteTimer(before)
            if first is not None:
                self.handle.registerTimer(first)

    def _changes(self, rows: list[tuple], live: bool) -> Iterator[pd.DataFrame]:
        if rows:
            yield pd.DataFrame(rows, columns=self.FIELDS.fieldNames()).assign(live=live)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, passed, changed = self._held(), timerValues.getCurrentWatermarkInMs(), {}
        before = min((_expiry(row[1]) for row in held.values()), default=None)
        for frame in rows:
            for row in _last_of_each(frame)[self.FIELDS.fieldNames()].itertuples(index=False, name=None):
                old = held.get(row[0])
                if (old is None or old[1:3] < row[1:3]) and _expiry(row[1]) > passed:
                    held[row[0]] = changed[row[0]] = row
        if changed:
            self._keep(held, before)
            yield from self._changes(list(changed.values()), True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, due, passed = self._held(), expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        gone = [row for row in held.values() if _expiry(row[1]) <= due or _expiry(row[1]) < passed]
        for row in gone:
            del held[row[0]]
        self._keep(held, None)  # Spark removes the timer that has run out
        yield from self._changes(gone, False)

    def close(self) -> None:
        pass


def _packed(rows: DataFrame, kinds: StructType) -> DataFrame:
    rest = F.to_json(F.struct(*[f.name for f in kinds.fields if f.name not in ("symbol", "event_time", "offset")]))
    return rows.where(F.col("symbol").isNotNull() & F.col("event_time").isNotNull()).select(
        "symbol", F.unix_micros(F.col("event_time").cast("timestamp")).alias("micros"),
        F.coalesce("offset", F.lit(-1)).cast("long").alias("offset"), rest.alias("values"))


def _unpacked(rows: DataFrame, kinds: StructType) -> DataFrame:
    """The columns of `kinds` again, with what else `rows` has."""
    rest = StructType([f for f in kinds.fields if f.name not in ("symbol", "event_time", "offset")])
    read = rows.withColumn("values", F.from_json("values", rest))
    time = F.timestamp_micros("micros").cast(kinds["event_time"].dataType)
    plain: dict[str, Column] = {"symbol": F.col("symbol"), "event_time": time, "offset": F.col("offset").cast(kinds["offset"].dataType)}
    kept = [plain.get(f.name, F.col("values")[f.name]).alias(f.name) for f in kinds.fields]
    return read.select(*kept, *[c for c in rows.columns if c not in ("symbol", "micros", "offset", "values")])


def _last_of_each(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.sort_values(["micros", "offset"]).drop_duplicates("symbol", keep="last")


def _newest_of_batches(rows: DataFrame) -> DataFrame:
    """One row for each symbol of an Arrow batch."""

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from map(_last_of_each, batches)

    return rows.mapInPandas(reduce, rows.schema)


def newest_job(rows: DataFrame, root: str, checkpoint: str, ttl: int, seconds: int | None = 30) -> StreamingQuery:
    """Keep the newest row (symbol, event_time, offset, ...) of each symbol for `ttl` seconds of event time."""
    reduced = _newest_of_batches(_packed(rows, rows.schema))
    timed = reduced.withColumn("event_time", F.timestamp_micros("micros")).withWatermark("event_time", f"{int(ttl)} seconds")
    changes = timed.withColumn("shard", _shard("symbol")).groupBy("shard").transformWithStateInPandas(
        Newest(), "symbol string, micros long, offset long, values string, live boolean", "append", "EventTime")
    return start(_unpacked(changes, rows.schema), root, checkpoint, seconds)


def newest_state(spark: SparkSession, checkpoint: str, kinds: StructType) -> DataFrame:
    """The rows a `newest_job` keeps, as of its last batch, read from its checkpoint."""
    store = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    return _unpacked(store.select("list_element.*"), kinds)


# ---- quotes as of a request -------------------------------------------------------------------------------------


class AsOf(StatefulProcessor):
    """Answers requests with the newest quote that was there at their time.

    A key's quotes are kept as long as a request may still come that is older than the next one: those after the watermark, and
    the last one before it.
    """

    QUOTE = StructType([StructField("micros", LongType()), StructField("offset", LongType()), StructField("values", StringType())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.quotes = handle.getListState(QUEUE, self.QUOTE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = {(x[0], x[1]): x[2] for x in self.quotes.get()} if self.quotes.exists() else {}
        asked = []
        for row in rows:
            if row["request"]:
                asked.append((row["micros"], row["offset"], row["values"]))
            else:
                known[row["micros"], row["offset"]] = row["values"]
        # A list state holds at least one value: requests for a symbol without a quote leave none.
        if not known:
            yield from (Row(symbol=key[0], micros=x[0], offset=x[1], values=x[2], quote=None) for x in asked)
            return
        order = sorted(known)
        for micros, offset, values in sorted(asked):
            at = bisect.bisect_right(order, (micros, 1 << 63)) - 1
            yield Row(symbol=key[0], micros=micros, offset=offset, values=values, quote=known[order[at]] if at >= 0 else None)
        first = bisect.bisect_right(order, (timerValues.getCurrentWatermarkInMs() * 1000, 1 << 63)) - 1
        self.quotes.put([(*place, known[place]) for place in order[max(first, 0):]])

    def close(self) -> None:
        pass


def as_of_stream(requests: DataFrame, quotes: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """The columns of `requests` and `found`, as `operators.asof.as_of_join` gives them, of two streams.

    A request is answered when it arrives, from the quotes that have arrived by then.
    """
    kind = StructType([f for f in quotes.schema.fields if f.name not in ("symbol", "event_time")])
    found = F.to_json(F.struct(*kind.fieldNames()))
    offered = quotes.where(F.col("symbol").isNotNull() & F.col("event_time").isNotNull()).select(
        "symbol", F.unix_micros(F.col("event_time").cast("timestamp")).alias("micros"), F.coalesce("offset", F.lit(-1)).cast("long").alias("offset"),
        found.alias("values"))
    both = _packed(requests, requests.schema).withColumn("request", F.lit(True)).unionByName(offered.withColumn("request", F.lit(False)))
    timed = both.withColumn("event_time", F.timestamp_micros("micros")).withWatermark("event_time", watermark)
    answers = timed.groupBy("symbol").transformWithState(
        AsOf(), "symbol string, micros long, offset long, values string, quote string", "append", "EventTime")
    return _unpacked(answers, requests.schema).withColumn("found", F.from_json("quote", kind)).drop("quote")


# ---- the first row of a time bucket -------------------------------------------------------------------------------


def first_of_buckets(rows: DataFrame, seconds: int, watermark: str = WATERMARK) -> DataFrame:
    """Stream of the rows (symbol, bucket, event_time, offset, ...) that are the first of their symbol and bucket.

    Of the rows a batch holds the earliest by (event_time, offset) counts, in whatever order its tasks send them; rows of later
    batches do not pass. Buckets are dealt to shards, so those of a symbol that sends most rows too; a shard's state is the
    buckets that the watermark has not left behind.
    """
    rest = [f for f in rows.schema.fields if f.name not in ("symbol", "bucket", "event_time")]
    packed = rows.withWatermark("event_time", watermark).select(
        "symbol", "event_time", F.unix_micros("event_time").alias("micros"), F.unix_micros("bucket").alias("start"),
        F.coalesce("offset", F.lit(-1)).cast("long").alias("place"), F.to_json(F.struct(*[f.name for f in rest])).alias("values"))

    def earliest(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.sort_values(["micros", "place", "values"]).drop_duplicates(["symbol", "start"])

    def first(key: tuple, frames: Iterator[pd.DataFrame], known: GroupState) -> Iterator[pd.DataFrame]:
        if known.hasTimedOut:
            known.remove()
            return
        seen = {tuple(x) for x in json.loads(known.get[0])} if known.exists else set()
        best = earliest(pd.concat([earliest(frame[["symbol", "micros", "start", "place", "values"]]) for frame in frames]))
        best = best[[x not in seen for x in zip(best["symbol"], best["start"])]]
        passed = known.getCurrentWatermarkMs() * 1000
        open_ = [x for x in [*seen, *zip(best["symbol"], best["start"].tolist())] if x[1] + seconds * 1_000_000 > passed]
        if open_:
            known.update((json.dumps(open_),))
            known.setTimeoutTimestamp(_expiry(max(x[1] for x in open_) + seconds * 1_000_000))
        elif known.exists:
            known.remove()
        yield best[["micros", "start", "values", "symbol"]]

    firsts = packed.withColumn("shard", _shard("symbol", "start")).groupBy("shard").applyInPandasWithState(
        first, "micros long, start long, values string, symbol string", "open string", "append", GroupStateTimeout.EventTimeTimeout)
    read = firsts.withColumn("values", F.from_json("values", StructType(rest)))
    plain = {"symbol": F.col("symbol"), "event_time": F.timestamp_micros("micros"), "bucket": F.timestamp_micros("start")}
    return read.select(*[plain.get(c, F.col("values")[c]).alias(c) for c in rows.columns])
