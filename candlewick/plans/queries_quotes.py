"""Registered quote queries, each as a batch and, where the state is kept by a stream, as a finished stream.

The `_stream` forms read the event file as a stream, run until the input is used up, and return the sink's state,
so they share the SQL of the batch form.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, functions as F

from candlewick.operators import quotes as q, signals
from candlewick.plans.catalog import register
from candlewick.plans.inputs import bars, events, latest, messages, quotes, symbols
from candlewick.session import shared_dir, written
from candlewick.sources import topics, trades
from candlewick.streaming import jobs, partials, state

# Look-back used by the expiring queries: the events are minutes apart, so a day stands in for five minutes.
DAY_SECONDS = 86400
CHANGE_LIMIT = 5.0

QUOTE = "symbol:s price:2 change:2 change_rate:2 previous_close:2 volume:i source:s event_time:t offset:i"


def as_of(rows: DataFrame):
    """The newest event time, standing in for the clock."""
    return rows.agg(F.max("event_time")).scalar()


def event_stream(spark, folder) -> DataFrame:
    return topics.read_folder(spark, f"{folder}/events.parquet*", events(spark, folder).schema)


def third(ts) -> Column:
    """Which of three deliveries an event belongs to: days 1-10, 11-20 or 21-31 of a month."""
    return F.least(F.floor((F.dayofmonth(ts) - 1) / 10), F.lit(2)).cast("int")


def delivered(spark, folder) -> tuple[DataFrame, Iterator[int]]:
    """The events as they would arrive, three deliveries in order of time: the stream of their folder, and an iterator that writes
    the next one. `finished` runs a job after each, so a delivery is one micro-batch however many files it has. Reading messages
    takes long for their bytes, and small files are read a few to a task, so rows are dealt to all cores first."""
    rows = events(spark, folder)
    root = f"{shared_dir(spark)}/deliveries/{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)

    def arrivals() -> Iterator[int]:
        for part in range(3):
            rows.where(third("ts") == part).write.mode("append").parquet(root)
            yield part

    return topics.read_folder(spark, root, rows.schema).repartition(spark.sparkContext.defaultParallelism), arrivals()


def message_stream(spark, folder) -> DataFrame:
    return trades.quote_messages(event_stream(spark, folder))


def finished(spark, start, arrivals: Iterable[int] = (0,)) -> str:
    """Run `start(root, checkpoint)` to the end of the input in a fresh folder, again after each of `arrivals`, and return that folder."""
    root = f"{shared_dir(spark)}/streams/{uuid.uuid4().hex}"
    for _ in arrivals:
        start(f"{root}/state", f"{root}/checkpoint").awaitTermination()
    return f"{root}/state"


def _both(name: str, columns: str, sql: str, needs: str = "", extra: str = ""):
    """Register a batch query and its stream form under one SQL."""

    def add(batch, stream):
        register(name, columns, sql, needs, extra)(batch)
        register(f"{name}_stream", columns, sql, needs, extra)(stream)

    return add


@register(
    "parsed_messages", "topic:s readable:s messages:i",
    """SELECT CASE WHEN event_type IN ('view', 'click') THEN 'primary-quotes' ELSE 'secondary-quotes' END AS topic,
              event_type <> 'error' AS readable, count(*) AS messages FROM events GROUP BY ALL""",
)
def parsed_messages(spark, folder):
    return q.parse_messages(messages(spark, folder)).groupBy("topic", "readable").agg(F.count(F.lit(1)).alias("messages"))


@register("usable_quotes", QUOTE + " topic:s", "SELECT * FROM quotes", "quotes")
def usable_quotes(spark, folder):
    return quotes(spark, folder)


# ---- latest state ---------------------------------------------------------------------------------------------


def kept(spark, start, kinds, arrivals: Iterable[int]) -> DataFrame:
    """What a keyed-state job holds once its input is used up. `start(root, checkpoint)` starts it after each of `arrivals`."""
    root = finished(spark, start, arrivals)
    return state.newest_state(spark, root.removesuffix("state") + "checkpoint", kinds)


def latest_state(spark, folder) -> DataFrame:
    """The quotes that the latest-quote stream still holds a day after them."""
    stream, arrivals = delivered(spark, folder)
    start = lambda root, mark: jobs.latest_state_job(trades.quote_messages(stream), root, mark, DAY_SECONDS, None)
    return kept(spark, start, quotes(spark, folder).schema, arrivals)


AGE = "event_time > (SELECT max(event_time) FROM latest) - INTERVAL 86400 SECONDS"


# The clock is the newest quote of the state. In batch form the state, one row a symbol, is written once for both, so that the
# events are read and parsed once; a stream's state is in its checkpoint.


def _alive(rows: DataFrame) -> DataFrame:
    return q.alive(rows, as_of(rows), DAY_SECONDS)


def _from_batch(build):
    return lambda spark, folder: build(written(latest(spark, folder), "latest"))


def _from_stream(build):
    return lambda spark, folder: build(latest_state(spark, folder))


_both("latest_quotes", QUOTE, f"SELECT * FROM latest WHERE {AGE}", "latest")(
    _from_batch(_alive), _from_stream(_alive)
)


def _active(rows: DataFrame) -> DataFrame:
    return q.active_symbols(rows, as_of(rows), DAY_SECONDS // 4)


_both(
    "active_symbols", "symbol:s last_update:t",
    """SELECT symbol, event_time AS last_update FROM latest
       WHERE event_time > (SELECT max(event_time) FROM latest) - INTERVAL 21600 SECONDS""", "latest",
)(_from_batch(_active), _from_stream(_active))


@register(
    "purge_stale", "symbol:s event_time:t",
    "SELECT * FROM latest WHERE event_time >= (SELECT max(event_time) FROM latest) - INTERVAL 172800 SECONDS", "latest",
)
def purge_stale(spark, folder):
    rows = written(latest(spark, folder), "latest")
    return q.purge_stale(rows, as_of(rows), 2 * DAY_SECONDS)


def _summary(rows: DataFrame) -> DataFrame:
    return q.market_summary(rows, as_of(rows), DAY_SECONDS)


SUMMARY = "active_symbols_count:i total_volume:i average_change_rate:2 positive_count:i negative_count:i"
RATED = f"""rated AS (SELECT *, coalesce(change_rate, (price - previous_close) / nullif(previous_close, 0) * 100) AS rate
    FROM latest WHERE {AGE})"""
SUMMARY_SQL = """SELECT (SELECT count(*) FROM rated) AS active_symbols_count, sum(volume) AS total_volume,
    avg(rate) AS average_change_rate, count(*) FILTER (rate > 0) AS positive_count,
    count(*) FILTER (rate < 0) AS negative_count FROM """

_both("market_summary", SUMMARY, SUMMARY_SQL + "rated", "latest", RATED)(
    _from_batch(_summary), _from_stream(_summary)
)


# ---- signals --------------------------------------------------------------------------------------------------

INDICATORS = (
    "symbol:s data_points:i sma_5:2 sma_20:2 ema_12:2 ema_26:2 rsi:2 bb_upper:2 bb_middle:2 bb_lower:2 macd:4 "
    "macd_signal:4 macd_histogram:4 current_price:2 last_close:2"
)
SCORED = INDICATORS + " signals:s strength:i overall_sentiment:s"


def _r(value: str, digits: int) -> str:
    return f"floor(({value}) * 1e{digits} + 0.5) / 1e{digits}"


def _step(before: str, value: str, span: int) -> str:
    return f"({value} * (2e0 / {span + 1}) + {before} * (1 - 2e0 / {span + 1}))"


_F, _S = _step("w.f", "p.x", 12), _step("w.s", "p.x", 26)
LIVE = f"""recent AS MATERIALIZED (
    SELECT symbol, close, row_number() OVER (PARTITION BY symbol ORDER BY date) AS i, count(*) OVER (PARTITION BY symbol) AS n
    FROM (SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 50)
    JOIN latest USING (symbol)),
  points AS MATERIALIZED (
    SELECT symbol, close AS x, i, n FROM recent WHERE n >= 20
    UNION ALL SELECT symbol, price, n + 1, n FROM latest JOIN (SELECT DISTINCT symbol, n FROM recent WHERE n >= 20) USING (symbol)),
  walk AS (
    SELECT symbol, i, n, x AS f, x AS s, 0e0 AS g FROM points WHERE i = 1
    UNION ALL SELECT p.symbol, p.i, p.n, {_F}, {_S}, {_step('w.g', f'({_F} - {_S})', 9)}
    FROM walk w JOIN points p ON p.symbol = w.symbol AND p.i = w.i + 1),
  flat AS (
    SELECT symbol, max(n) AS n, avg(x) FILTER (i > n + 1 - 5) AS sma5, avg(x) FILTER (i > n + 1 - 20) AS m,
           stddev_samp(x) FILTER (i > n + 1 - 20) AS sd, sum(greatest(x - before, 0)) FILTER (i > n + 1 - 14) / 14 AS g,
           sum(greatest(before - x, 0)) FILTER (i > n + 1 - 14) / 14 AS l, max(x) FILTER (i = n + 1) AS price,
           max(x) FILTER (i = n) AS prior
    FROM (SELECT *, lag(x) OVER (PARTITION BY symbol ORDER BY i) AS before FROM points) GROUP BY symbol),
  live AS MATERIALIZED (
    SELECT symbol, flat.n AS data_points, {_r('sma5', 2)} AS sma_5, {_r('m', 2)} AS sma_20, {_r('f', 2)} AS ema_12,
           {_r('s', 2)} AS ema_26,
           {_r('CASE WHEN l = 0 AND flat.g > 0 THEN 100 ELSE 100 - 100 / (1 + flat.g / nullif(l, 0)) END', 2)} AS rsi,
           {_r('m + 2 * sd', 2)} AS bb_upper, {_r('m', 2)} AS bb_middle, {_r('m - 2 * sd', 2)} AS bb_lower,
           {_r('f - s', 4)} AS macd, {_r('walk.g', 4)} AS macd_signal, {_r('f - s - walk.g', 4)} AS macd_histogram,
           price AS current_price, {_r('prior', 2)} AS last_close
    FROM flat JOIN walk USING (symbol) WHERE walk.i = flat.n + 1),
  voted AS (
    SELECT *, coalesce(rsi <> 0, false) AS has_rsi,
           coalesce(current_price <> 0 AND bb_upper <> 0 AND bb_lower <> 0, false) AS has_bands,
           coalesce(current_price <> 0 AND sma_5 <> 0 AND sma_20 <> 0, false) AS has_means,
           coalesce(macd <> 0 AND macd_signal <> 0, false) AS has_macd,
           CASE WHEN rsi < 30 THEN 'RSI_OVERSOLD' WHEN rsi > 70 THEN 'RSI_OVERBOUGHT' END AS c1,
           CASE WHEN current_price >= bb_upper THEN 'BB_UPPER_BREAK' WHEN current_price <= bb_lower THEN 'BB_LOWER_TOUCH'
                WHEN current_price > bb_middle THEN 'BB_ABOVE_MID' ELSE 'BB_BELOW_MID' END AS c2,
           CASE WHEN sma_5 > sma_20 AND current_price > sma_5 THEN 'MA_UPTREND'
                WHEN sma_5 < sma_20 AND current_price < sma_5 THEN 'MA_DOWNTREND' END AS c3,
           CASE WHEN macd > macd_signal AND macd > 0 THEN 'MACD_BUY'
                WHEN macd < macd_signal AND macd < 0 THEN 'MACD_SELL' END AS c4 FROM live),
  points_of(code, points) AS (VALUES ('RSI_OVERSOLD', 30), ('RSI_OVERBOUGHT', -30), ('BB_UPPER_BREAK', -20),
    ('BB_LOWER_TOUCH', 20), ('BB_ABOVE_MID', 10), ('BB_BELOW_MID', -10), ('MA_UPTREND', 15), ('MA_DOWNTREND', -15),
    ('MACD_BUY', 25), ('MACD_SELL', -25)),
  scored AS (
    SELECT *, CASE WHEN strength > 20 THEN 'bullish' WHEN strength < -20 THEN 'bearish' ELSE 'neutral' END AS overall_sentiment
    FROM (SELECT v.*, concat_ws(',', k1, k2, k3, k4) AS signals,
                 coalesce(CAST(trunc((coalesce(p1.points, 0) + coalesce(p2.points, 0) + coalesce(p3.points, 0)
                   + coalesce(p4.points, 0)) / nullif(has_rsi::INT + has_bands::INT + has_means::INT + has_macd::INT, 0)) AS BIGINT), 0)
                   AS strength
          FROM (SELECT *, CASE WHEN has_rsi THEN c1 END AS k1, CASE WHEN has_bands THEN c2 END AS k2,
                       CASE WHEN has_means THEN c3 END AS k3, CASE WHEN has_macd THEN c4 END AS k4 FROM voted) v
          LEFT JOIN points_of p1 ON p1.code = k1 LEFT JOIN points_of p2 ON p2.code = k2
          LEFT JOIN points_of p3 ON p3.code = k3 LEFT JOIN points_of p4 ON p4.code = k4))"""


def _flat(scored: DataFrame) -> DataFrame:
    return scored.withColumn("signals", F.array_join("signals", ","))


def scored_quotes(spark, folder) -> DataFrame:
    return signals.quote_signals(latest(spark, folder).select("symbol", "price", "event_time", "offset"), bars(spark, folder))


def scored_partials(spark, folder) -> str:
    """Folder of a finished signal stream over the closes published before it."""
    closes = f"{shared_dir(spark)}/closes/{uuid.uuid4().hex}"
    signals.publish_closes(bars(spark, folder), closes)
    return finished(spark, lambda root, mark: jobs.signals_job(message_stream(spark, folder), closes, root, mark, None))


def scored_state(spark, folder) -> DataFrame:
    """State left by the signal stream: the newest scored quote of each symbol."""
    return partials.read(spark, scored_partials(spark, folder), scored_quotes(spark, folder).schema, q.latest_quotes)


def indicator_state(spark, folder) -> DataFrame:
    """Scored quotes of the stream of what the signal job wrote, those not older than the hour of their expiry."""
    kinds = scored_quotes(spark, folder).schema
    closes = f"{shared_dir(spark)}/closes/{uuid.uuid4().hex}"
    signals.publish_closes(bars(spark, folder), closes)
    stream, arrivals = delivered(spark, folder)
    root = f"{shared_dir(spark)}/streams/{uuid.uuid4().hex}"

    def scored_deliveries() -> Iterator[int]:
        for part in arrivals:
            jobs.signals_job(trades.quote_messages(stream), closes, f"{root}/state", f"{root}/checkpoint", None).awaitTermination()
            yield part

    def start(state_root: str, mark: str):
        return jobs.indicator_state_job(
            topics.read_folder(spark, f"{root}/state/partials", kinds), state_root, mark, q.INDICATOR_TTL, None)

    held = kept(spark, start, kinds, scored_deliveries())
    return _flat(q.alive(held, as_of(held), q.INDICATOR_TTL))


@register(
    "indicator_state_stream", "symbol:s event_time:t " + SCORED.removeprefix("symbol:s "),
    """SELECT scored.*, event_time FROM scored JOIN latest USING (symbol)
       WHERE event_time > (SELECT max(event_time) FROM scored JOIN latest USING (symbol)) - INTERVAL 3600 SECONDS""", "bars latest", LIVE,
)
def indicator_state_stream(spark, folder):
    return indicator_state(spark, folder)


@register("live_indicators", INDICATORS, "SELECT * FROM live", "bars latest", LIVE)
def live_indicators(spark, folder):
    return signals.live_indicators(latest(spark, folder).select("symbol", "price"), bars(spark, folder))


_both("quote_signals", SCORED, "SELECT * FROM scored", "bars latest", LIVE)(
    lambda spark, folder: _flat(scored_quotes(spark, folder)), lambda spark, folder: _flat(scored_state(spark, folder))
)

def _strong(name: str, strength: int, build) -> None:
    _both(
        name, "symbol:s strength:i signals:s",
        f"SELECT * FROM scored WHERE abs(strength) > {strength} AND signals <> ''", "bars latest", LIVE,
    )(lambda spark, folder: build(scored_quotes(spark, folder), strength), lambda spark, folder: build(scored_state(spark, folder), strength))


def _stronger(rows: DataFrame, strength: int) -> DataFrame:
    return _flat(signals.strong_signals(rows, strength))


# A quote stands far from a day's close here and all groups agree only rarely, so a strength above 30 is mostly not reached; the
# lower limit shows the rows.
_strong("strong_signals", 10, _stronger)
_strong("strong_signals_30", 30, _stronger)


# ---- fallback and routing -------------------------------------------------------------------------------------

FALLBACK = """feed AS (SELECT symbol, event_time AS quoted_at, price, previous_close, volume FROM quotes
      WHERE topic = 'secondary-quotes' AND price > 0),
  responses AS (
    SELECT concat('S', user_id) AS symbol, ts AS event_time, event_id AS "offset", value >= 5 AND value <= 300 AS good,
           floor((500 + value * 80) * 100 + 0.5) / 100 AS price,
           CASE WHEN value < 10 THEN 0 ELSE floor((value - 50) * 100 + 0.5) / 100 END AS change,
           floor((value - 50) / 20 * 100 + 0.5) / 100 AS change_rate
    FROM events WHERE event_type IN ('view', 'click'))"""
FALLBACK_SQL = """
    SELECT r.symbol, CASE WHEN good THEN r.price ELSE f.price END AS price,
           CASE WHEN good THEN change ELSE f.price - previous_close END AS change,
           CASE WHEN good THEN change_rate WHEN previous_close > 0 THEN (f.price - previous_close) / previous_close * 100
                ELSE 0 END AS change_rate,
           CASE WHEN good THEN "offset" ELSE f.volume END AS volume,
           CASE WHEN good THEN 'kis' ELSE 'kis_via_yfinance' END AS data_source, event_time, "offset"
    FROM responses r ASOF LEFT JOIN feed f ON r.symbol = f.symbol AND r.event_time >= f.quoted_at
    WHERE good OR f.price IS NOT NULL"""


def secondary_feed(spark, folder) -> DataFrame:
    return quotes(spark, folder).filter(F.col("topic") == trades.SECONDARY_TOPIC)


def fallback(spark, folder) -> DataFrame:
    return q.with_fallback(trades.primary_responses(events(spark, folder)), secondary_feed(spark, folder))


def fallback_state(spark, folder) -> DataFrame:
    """Rows that the fallback stream sent on, each with the quotes that had come by then."""
    stream, arrivals = delivered(spark, folder)
    responses, feed = trades.primary_responses(stream), trades.quote_messages(stream)
    start = lambda root, mark: jobs.fallback_job(responses, feed, trades.SECONDARY_TOPIC, root, mark, None)
    root = finished(spark, start, arrivals)
    return spark.read.schema(fallback(spark, folder).schema).parquet(root)


_both(
    "quote_fallback", "symbol:s price:2 change:2 change_rate:2 volume:i data_source:s event_time:t offset:i",
    FALLBACK_SQL, "quotes", FALLBACK,
)(fallback, fallback_state)


def routed(spark, folder) -> DataFrame:
    return q.route(quotes(spark, folder), symbols(spark, folder))


def routed_state(spark, folder) -> DataFrame:
    listed = symbols(spark, folder)
    root = finished(
        spark,
        lambda state, mark: jobs.rows_job(
            message_stream(spark, folder), lambda batch: q.route(q.read_quotes(batch), listed), state, mark, None
        ),
    )
    return partials.read(spark, root, routed(spark, folder).schema, lambda rows: rows)


_both(
    "tier_routing", "topic:s symbol:s price:2 tier:i offset:i",
    """SELECT unnest(['nasdaq-tier' || tier || '-realtime', 'stock-realtime-data']) AS topic, symbol, price, tier, "offset"
       FROM (SELECT q.symbol, price, "offset",
                    CASE WHEN market_cap IS NULL OR market_cap NOT LIKE '$%' THEN 3 ELSE t.tier END AS tier
             FROM quotes q LEFT JOIN tiers t USING (symbol))""", "quotes tiers",
)(routed, routed_state)


# ---- buckets, sessions, alerts --------------------------------------------------------------------------------


def buckets(spark, folder) -> DataFrame:
    return q.first_in_bucket(quotes(spark, folder))


def buckets_state(spark, folder) -> DataFrame:
    root = finished(
        spark, lambda state, mark: jobs.buckets_job(message_stream(spark, folder), state, mark, seconds=None)
    )
    return partials.read(spark, root, buckets(spark, folder).schema, jobs.merge_buckets)


_both(
    "quote_dedup_30s", "symbol:s bucket:t price:2 offset:i",
    """SELECT symbol, time_bucket(INTERVAL 30 SECONDS, event_time) AS bucket, price, "offset" FROM quotes
       QUALIFY row_number() OVER (PARTITION BY symbol, bucket ORDER BY event_time, "offset") = 1""", "quotes",
)(buckets, buckets_state)


def calls(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("event_type").alias("name"), F.col("ts").alias("event_time"))


def call_minutes_state(spark, folder) -> DataFrame:
    root = finished(spark, lambda state, mark: jobs.calls_job(calls(event_stream(spark, folder)), state, mark, None))
    schema = q.calls_per_minute(calls(events(spark, folder))).schema
    return q.call_sessions(partials.read(spark, root, schema, q.merge_minutes))


_both(
    "api_call_sessions", "name:s first_call:t last_call:t calls:i",
    """SELECT name, min(ts) AS first_call, max(ts) AS last_call, count(*) AS calls FROM (
         SELECT *, sum(starts) OVER (PARTITION BY name ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM (
           SELECT event_type AS name, ts, event_id,
                  CASE WHEN ts < lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) + INTERVAL 60 SECONDS
                       THEN 0 ELSE 1 END AS starts FROM events)) GROUP BY name, session""",
)(lambda spark, folder: q.call_sessions(q.calls_per_minute(calls(events(spark, folder)))), call_minutes_state)


def _alerts(rows: DataFrame) -> DataFrame:
    return q.alerts(rows, "price move", CHANGE_LIMIT)


def alert_state(spark, folder) -> DataFrame:
    root = finished(
        spark,
        lambda state, mark: jobs.rows_job(
            message_stream(spark, folder), lambda batch: q.last_alerts(_alerts(q.read_quotes(batch))), state, mark, None
        ),
    )
    return partials.read(spark, root, _alerts(quotes(spark, folder)).schema, q.last_alerts)


_both(
    "last_100_alerts", "symbol:s event_time:t title:s color:s",
    f"""SELECT symbol, event_time, '[price move] ' || symbol || ': $' || format('{{:,.2f}}', price) || ' ('
               || format('{{:+.2f}}', change_rate) || '%)' AS title,
               CASE WHEN change_rate > 0 THEN '#36a64f' WHEN change_rate < 0 THEN '#d72b3f' ELSE '#9e9ea6' END AS color
        FROM quotes WHERE abs(change_rate) >= {CHANGE_LIMIT} ORDER BY event_time DESC, "offset" DESC LIMIT 100""", "quotes",
)(lambda spark, folder: q.last_alerts(_alerts(quotes(spark, folder))), alert_state)


# ---- keyed alerts, batch figures, event-time state ------------------------------------------------------------


ALERT_COLUMNS = "symbol:s event_time:t title:s color:s"
ALERTS = f"""raised AS (SELECT symbol, event_time, "offset", '[price move] ' || symbol || ': $' || format('{{:,.2f}}', price) || ' ('
               || format('{{:+.2f}}', change_rate) || '%)' AS title,
               CASE WHEN change_rate > 0 THEN '#36a64f' WHEN change_rate < 0 THEN '#d72b3f' ELSE '#9e9ea6' END AS color
        FROM quotes WHERE abs(change_rate) >= {CHANGE_LIMIT})"""


def keyed_alerts(rows: DataFrame) -> DataFrame:
    return q.alive(rows, as_of(rows), q.ALERT_TTL)


def keyed_alert_state(spark, folder) -> DataFrame:
    stream, arrivals = delivered(spark, folder)
    messages = trades.quote_messages(stream)
    start = lambda root, mark: jobs.alert_state_job(messages, "price move", CHANGE_LIMIT, root, mark, q.ALERT_TTL, None)
    return keyed_alerts(kept(spark, start, _alerts(quotes(spark, folder)).schema, arrivals))


_both(
    "keyed_alerts", ALERT_COLUMNS,
    """SELECT * FROM raised WHERE event_time > (SELECT max(event_time) FROM raised) - INTERVAL 86400 SECONDS
       QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC, "offset" DESC) = 1""", "quotes", ALERTS,
)(lambda spark, folder: keyed_alerts(written(q.latest_quotes(_alerts(quotes(spark, folder))), "alerts")), keyed_alert_state)


@register(
    "batch_audit_stream", "rows:i first_event:t last_event:t",
    """SELECT count(*) AS rows, min(ts) AS first_event, max(ts) AS last_event FROM events
       GROUP BY least(floor((dayofmonth(ts) - 1) / 10), 2)""",
)
def batch_audit_stream(spark, folder):
    """One row for each delivery, summed over the micro-batches it took."""
    stream, arrivals = delivered(spark, folder)
    root = finished(spark, lambda root, mark: jobs.latest_quotes_job(trades.quote_messages(stream), root, mark, None), arrivals)
    figures = partials.audit(spark, root).groupBy(third("first_event").alias("third"))
    return figures.agg(F.sum("rows").alias("rows"), F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event"))


def _all_of(spark, stream: DataFrame, arrivals: Iterable[int]) -> DataFrame:
    """Everything an append stream gives until its input is used up."""
    root = finished(spark, lambda root, mark: state.start(stream, root, mark, None), arrivals)
    return spark.read.schema(stream.schema).parquet(root)


@register(
    "distinct_buckets_stream", "symbol:s bucket:t price:2 offset:i",
    """SELECT symbol, time_bucket(INTERVAL 30 SECONDS, event_time) AS bucket, price, "offset" FROM quotes
       QUALIFY row_number() OVER (PARTITION BY symbol, bucket ORDER BY event_time, "offset") = 1""", "quotes",
)
def distinct_buckets_stream(spark, folder):
    """The event-time form of the bucket filter. Of the rows that a batch has of a bucket the earliest counts, and a bucket never
    spans two deliveries."""
    stream, arrivals = delivered(spark, folder)
    return _all_of(spark, jobs.distinct_buckets(q.read_quotes(trades.quote_messages(stream))), arrivals)


@register(
    "call_sessions_stream", "name:s first_call:t expires:t calls:i",
    """WITH sessions AS (SELECT name, min(ts) AS first_call, max(ts) + INTERVAL 60 SECONDS AS expires, count(*) AS calls FROM (
         SELECT *, sum(starts) OVER (PARTITION BY name ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM (
           SELECT event_type AS name, ts, event_id,
                  CASE WHEN ts < lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) + INTERVAL 60 SECONDS
                       THEN 0 ELSE 1 END AS starts FROM events)) GROUP BY name, session)
       SELECT * FROM sessions WHERE date_trunc('milliseconds', expires) <= date_trunc('milliseconds', (SELECT max(ts) FROM events) - INTERVAL 600 SECONDS)""",
)
def call_sessions_stream(spark, folder):
    """Sessions that the watermark, ten minutes behind the newest call, has closed."""
    stream, arrivals = delivered(spark, folder)
    return _all_of(spark, jobs.session_counts(calls(stream)), arrivals)
