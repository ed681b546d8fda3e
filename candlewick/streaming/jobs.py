"""The quote jobs. Each takes an envelope stream (topic, event_time, offset, value) and starts one query."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.operators import quotes as q
from candlewick.operators.signals import indicators_over, published_closes, score
from candlewick.streaming import partials, state

# How late a quote may come in the two jobs that keep event-time state. The partial-folder jobs need no limit.
WATERMARK = "10 minutes"


def audited(stream: DataFrame, name: str = "batch") -> DataFrame:
    """Count each micro-batch's rows; the counts appear in the query's progress."""
    return stream.observe(name, F.count(F.lit(1)).alias("rows"))


def batch_sizes(query: StreamingQuery, name: str = "batch") -> list[tuple[int, int]]:
    """(batch id, rows) of the recent non-empty micro-batches."""
    sizes = []
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(name)
        if row is not None and row["rows"]:
            sizes.append((progress.batchId, row["rows"]))
    return sizes


def latest_quotes_job(messages: DataFrame, root: str, checkpoint: str, seconds: int | None = 30) -> StreamingQuery:
    """Newest quote per symbol."""
    return partials.sink(
        messages, lambda batch: q.latest_quotes(q.read_quotes(batch)), root, checkpoint, seconds
    )


def latest_state_job(messages: DataFrame, root: str, checkpoint: str, ttl: int = q.QUOTE_TTL, seconds: int | None = 30) -> StreamingQuery:
    """Newest quote per symbol, gone `ttl` seconds after its event time. `state.newest_state` reads it from the checkpoint."""
    return state.newest_job(q.read_quotes(messages), root, checkpoint, ttl, seconds)


def alert_state_job(
    messages: DataFrame, kind: str, min_change: float, root: str, checkpoint: str, ttl: int = q.ALERT_TTL, seconds: int | None = 30
) -> StreamingQuery:
    """Newest alert per symbol, kept for a day."""
    return state.newest_job(q.alerts(q.read_quotes(messages), kind, min_change), root, checkpoint, ttl, seconds)


def indicator_state_job(
    scored: DataFrame, root: str, checkpoint: str, ttl: int = q.INDICATOR_TTL, seconds: int | None = 30
) -> StreamingQuery:
    """Newest scored quote per symbol, kept for an hour. `scored` streams what `signals_job` writes."""
    return state.newest_job(scored, root, checkpoint, ttl, seconds)


def fallback_job(
    responses: DataFrame, messages: DataFrame, topic: str, root: str, checkpoint: str, seconds: int | None = 30
) -> StreamingQuery:
    """Each primary response, or the quote of `topic` that was newest at its time; only responses without a price meet state."""
    primary = q.clean_responses(responses)
    feed = q.fallback_feed(q.read_quotes(messages).filter(F.col("topic") == topic))
    served = F.col("price").isNotNull()
    asked = state.as_of_stream(primary.filter(~served), feed, WATERMARK)
    own = primary.filter(served).withColumn("found", F.lit(None).cast(asked.schema["found"].dataType))
    return state.start(q.published(own.unionByName(asked)), root, checkpoint, seconds)


def signals_job(
    messages: DataFrame, closes_root: str, root: str, checkpoint: str, seconds: int | None = 30
) -> StreamingQuery:
    """Indicators and score of each symbol's newest quote in the batch, over the closes that are published when it runs."""

    def newest(batch: DataFrame) -> DataFrame:
        return q.latest_quotes(q.read_quotes(batch)).select("symbol", "price", "event_time", "offset")

    def scored(quotes: DataFrame) -> DataFrame:
        return score(indicators_over(quotes, published_closes(quotes, closes_root)))

    return partials.sink(messages, newest, root, checkpoint, seconds, scored)


def buckets_job(
    messages: DataFrame, root: str, checkpoint: str, bucket_seconds: int = 30, seconds: int | None = 30
) -> StreamingQuery:
    """First quote per symbol and time bucket."""
    return partials.sink(
        messages, lambda batch: q.first_in_bucket(q.read_quotes(batch), bucket_seconds), root, checkpoint, seconds
    )


def merge_buckets(rows: DataFrame) -> DataFrame:
    """The earliest of the rows several batches kept for one bucket."""
    values = [name for name in rows.columns if name not in ("symbol", "bucket")]
    return (
        rows.groupBy("symbol", "bucket")
        .agg(F.min_by(F.struct(*values), F.struct("event_time", "offset")).alias("row"))
        .select("symbol", "bucket", *[f"row.{name}" for name in values])
    )


def calls_job(calls: DataFrame, root: str, checkpoint: str, seconds: int | None = 30) -> StreamingQuery:
    """API calls (name, event_time) counted per minute."""
    return partials.sink(calls, q.calls_per_minute, root, checkpoint, seconds)


def rows_job(messages: DataFrame, build, root: str, checkpoint: str, seconds: int | None = 30) -> StreamingQuery:
    """Append-only output: `build` maps a micro-batch of messages to rows."""
    return partials.sink(messages, build, root, checkpoint, seconds)


# ---- jobs with event-time state -------------------------------------------------------------------------------


def distinct_buckets(quotes: DataFrame, bucket_seconds: int = 30, watermark: str = WATERMARK) -> DataFrame:
    """Streaming form of the bucket filter: the first quote of the first batch that has a symbol's bucket passes, others do not."""
    bucketed = quotes.withColumn("event_time", F.col("event_time").cast("timestamp")).withColumn(
        "bucket", F.window("event_time", f"{bucket_seconds} seconds")["start"]
    )
    return state.first_of_buckets(bucketed.where(F.col("symbol").isNotNull()), bucket_seconds, watermark)


def session_counts(calls: DataFrame, gap: int = q.CALL_GAP, watermark: str = WATERMARK) -> DataFrame:
    """Streaming form of the call counter, one row per closed session."""
    timed = calls.withColumn("event_time", F.col("event_time").cast("timestamp")).withWatermark("event_time", watermark)
    return (
        timed.groupBy("name", F.session_window("event_time", f"{gap} seconds").alias("w"))
        .agg(F.count(F.lit(1)).alias("calls"))
        .select("name", F.col("w.start").alias("first_call"), F.col("w.end").alias("expires"), "calls")
    )
