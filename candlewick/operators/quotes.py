"""Live quotes: parsing, cleaning, latest state with expiry, summaries, routing and call counters.

Every keyed result is an aggregate with a partial step before the shuffle, so a symbol that sends a third of all
messages still sends one row per key and input split. The same functions serve batch tables and micro-batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from candlewick.functions.caps import cap_tier
from candlewick.functions.numeric import round_half_up
from candlewick.functions.text import alert_color, alert_title
from candlewick.operators.asof import RANGE_SECONDS, as_of_join
from candlewick.schemas import QUOTE_MESSAGE

# Seconds after which cached state expires, and the topic names of the router.
QUOTE_TTL = 300
PRICE_TTL = 10
TECHNICAL_TTL = 300
INDICATOR_TTL = 3600
ALERT_TTL = 86400
ACTIVE_SECONDS = 300
CALL_GAP = 60
UNIFIED_TOPIC = "stock-realtime-data"

# Fixed value: source tag of a quote taken from the secondary feed.
FALLBACK_SOURCE = "kis_via_yfinance"


def parse_messages(messages: DataFrame, schema: StructType = QUOTE_MESSAGE) -> DataFrame:
    """Envelope columns plus the parsed fields; unreadable text leaves the fields NULL and `readable` false.

    `inline` turns the parsed struct into columns once, so a filter on them cannot be pushed below the parse and
    repeat it per field.
    """
    as_text = StructType([StructField(field.name, StringType()) for field in schema.fields])
    parsed = F.from_json("value", as_text, {"mode": "PERMISSIVE"})
    rows = messages.select("topic", "event_time", "offset", F.inline(F.array(parsed)))
    return rows.select(
        "topic", "event_time", "offset", *[_typed(field).alias(field.name) for field in schema.fields],
        F.col("symbol").isNotNull().alias("readable"),
    )


def rejected_messages(messages: DataFrame) -> Column:
    """Whether a message's text is no quote: no JSON object, or one without a symbol. Tells what `parse_messages` cannot read."""
    return F.get_json_object("value", "$.symbol").isNull()


def _typed(field: StructField) -> Column:
    """A field read as text in its own type: senders write numbers with or without quotes, and volumes with a fraction,
    which is cut. Text that is no number is NULL."""
    text = F.col(field.name)
    if isinstance(field.dataType, LongType):
        return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))
    return text if isinstance(field.dataType, StringType) else text.try_cast(field.dataType)


def reconcile(parsed: DataFrame) -> DataFrame:
    """One quote shape for both sources."""
    return parsed.select(
        "topic", "event_time", "offset", "symbol",
        F.coalesce("price", "current_price").alias("price"),
        "change",
        F.coalesce("change_rate", "change_percent").alias("change_rate"),
        "previous_close",
        "volume",
        F.coalesce("source", "data_source").alias("source"),
    )


def usable(quotes: DataFrame) -> DataFrame:
    """Quotes with a symbol and a price that is a finite number other than zero."""
    price = F.col("price")
    return quotes.filter((F.col("symbol") != "") & (price != 0) & ~F.isnan(price) & (F.abs(price) < float("inf")))


# The message fields a quote is made of; the parser skips all others.
QUOTE_FIELDS = (
    "symbol", "price", "current_price", "change", "change_rate", "change_percent", "previous_close", "volume",
    "source", "data_source",
)


def read_quotes(messages: DataFrame) -> DataFrame:
    fields = StructType([QUOTE_MESSAGE[name] for name in QUOTE_FIELDS])
    return usable(reconcile(parse_messages(messages, fields)))


def _arrival() -> Column:
    return F.struct("event_time", "offset")


def latest_quotes(quotes: DataFrame) -> DataFrame:
    """The newest quote of each symbol by event time, then offset."""
    values = [name for name in quotes.columns if name != "symbol"]
    return (
        quotes.groupBy("symbol")
        .agg(F.max_by(F.struct(*values), _arrival()).alias("row"))
        .select("symbol", *[f"row.{name}" for name in values])
    )


def _age_limit(as_of: Column, seconds: int) -> Column:
    return as_of - F.expr(f"interval {int(seconds)} seconds")


def alive(state: DataFrame, as_of: Column, seconds: int = QUOTE_TTL) -> DataFrame:
    """State rows that have not expired at `as_of`."""
    return state.filter((F.col("event_time") > _age_limit(as_of, seconds)) & (F.col("event_time") <= as_of))


def active_symbols(state: DataFrame, as_of: Column, seconds: int = ACTIVE_SECONDS) -> DataFrame:
    return alive(state, as_of, seconds).select("symbol", F.col("event_time").alias("last_update"))


def purge_stale(state: DataFrame, as_of: Column, seconds: int = ACTIVE_SECONDS) -> DataFrame:
    """State without the rows last updated before the limit."""
    return state.filter(F.col("event_time") >= _age_limit(as_of, seconds))


def market_summary(state: DataFrame, as_of: Column, seconds: int = ACTIVE_SECONDS) -> DataFrame:
    """Active count, volume, mean change rate and number of risers and fallers among the active symbols.

    A missing change rate is derived from price and previous close.
    """
    active = alive(state, as_of, seconds)
    derived = F.when(
        F.col("previous_close") > 0, (F.col("price") - F.col("previous_close")) / F.col("previous_close") * 100
    )
    rate = F.coalesce("change_rate", derived)
    measured = active.withColumn("rate", rate)
    return measured.agg(
        F.count(F.lit(1)).alias("active_symbols_count"),
        F.coalesce(F.sum("volume"), F.lit(0)).alias("total_volume"),
        F.coalesce(round_half_up(F.avg("rate"), 2), F.lit(0.0)).alias("average_change_rate"),
        F.count_if(F.col("rate") > 0).alias("positive_count"),
        F.count_if(F.col("rate") < 0).alias("negative_count"),
    )


# ---- cleaning and fallback -----------------------------------------------------------------------------------


def _number(name: str) -> Column:
    """Vendor text to a number: blank counts as 0, other text that is no number leaves NULL."""
    text = F.trim(F.coalesce(F.col(name), F.lit("0")))
    return F.when(text == "", 0.0).otherwise(text.try_cast("double"))


def clean_responses(responses: DataFrame) -> DataFrame:
    """Price responses (text fields last, diff, rate, tvol) as numbers; `price` is NULL where any is unreadable
    or the price is not positive."""
    fields = responses.select(
        "symbol", "event_time", "offset",
        _number("last").alias("price"), _number("diff").alias("change"),
        _number("rate").alias("change_rate"), _number("tvol").alias("volume"),
    )
    good = F.col("price").isNotNull() & F.col("change").isNotNull() & F.col("change_rate").isNotNull()
    good = good & F.col("volume").isNotNull() & (F.col("price") > 0)
    return fields.select(
        "symbol", "event_time", "offset",
        *[F.when(good, F.col(name)).alias(name) for name in ("price", "change", "change_rate")],
        F.when(good, F.col("volume").cast("bigint")).alias("volume"),
    )


def fallback_feed(quotes: DataFrame) -> DataFrame:
    """The columns of secondary quotes that may stand in for a response, of those with a price."""
    return quotes.filter(F.col("price") > 0).select("symbol", "event_time", "offset", "price", "previous_close", "volume")


def published(rows: DataFrame) -> DataFrame:
    """What is sent on: a cleaned response as it is, or where it has no price the quote in `found`, tagged as such.

    Responses without either are dropped, as there is no price to publish.
    """
    price, previous = F.col("found.price"), F.coalesce("found.previous_close", "found.price")
    change = price - previous
    served = F.col("price").isNotNull()
    rate = F.when(previous > 0, change / previous * 100).otherwise(0.0)
    return rows.filter(served | price.isNotNull()).select(
        "symbol",
        round_half_up(F.when(served, F.col("price")).otherwise(price), 2).alias("price"),
        round_half_up(F.when(served, F.col("change")).otherwise(change), 2).alias("change"),
        round_half_up(F.when(served, F.col("change_rate")).otherwise(rate), 2).alias("change_rate"),
        F.when(served, F.col("volume")).otherwise(F.coalesce("found.volume", F.lit(0))).alias("volume"),
        F.when(served, "kis").otherwise(FALLBACK_SOURCE).alias("data_source"),
        "event_time", "offset",
    )


def with_fallback(responses: DataFrame, secondary: DataFrame, range_seconds: int = RANGE_SECONDS) -> DataFrame:
    """Each primary response, or where it has no price the secondary quote of its symbol that was newest at its time.

    Only responses without a price take part in the as-of merge.
    """
    primary, feed = clean_responses(responses), fallback_feed(secondary)
    served = F.col("price").isNotNull()
    asked = as_of_join(primary.filter(~served), feed, range_seconds=range_seconds)
    own = primary.filter(served).withColumn("found", F.lit(None).cast(asked.schema["found"].dataType))
    return published(own.unionByName(asked))


# ---- time buckets ---------------------------------------------------------------------------------------------


def first_in_bucket(quotes: DataFrame, seconds: int = 30) -> DataFrame:
    """The first quote of each symbol in each time bucket."""
    values = [name for name in quotes.columns if name not in ("symbol", "bucket")]
    bucket = F.window("event_time", f"{seconds} seconds")
    return (
        quotes.groupBy("symbol", bucket.alias("w"))
        .agg(F.min_by(F.struct(*values), _arrival()).alias("row"))
        .select("symbol", F.col("w.start").alias("bucket"), *[f"row.{name}" for name in values])
    )


def calls_per_minute(calls: DataFrame) -> DataFrame:
    """Calls (name, event_time) counted per name and minute, with their first and last time.

    Two calls of one minute are always within the 60-second gap, so these rows hold all that sessions need, and
    one name has at most 1,440 of them a day.
    """
    return (
        calls.groupBy("name", F.window("event_time", "1 minute").alias("w"))
        .agg(
            F.min("event_time").alias("first_call"),
            F.max("event_time").alias("last_call"),
            F.count(F.lit(1)).alias("calls"),
        )
        .select("name", F.col("w.start").alias("minute"), "first_call", "last_call", "calls")
    )


def merge_minutes(minutes: DataFrame) -> DataFrame:
    """Per-minute rows of several batches, one per name and minute again."""
    return minutes.groupBy("name", "minute").agg(
        F.min("first_call").alias("first_call"),
        F.max("last_call").alias("last_call"),
        F.sum("calls").alias("calls"),
    )


def call_sessions(minutes: DataFrame, gap: int = CALL_GAP) -> DataFrame:
    """Counter lifetimes: a counter lives until no call came for `gap` seconds (a multiple of a minute or more),
    since each call renews its expiry."""
    if gap < 60:
        raise ValueError("minute rows cannot resolve a gap below 60 seconds")
    timeline = Window.partitionBy("name").orderBy("minute")
    silence = F.col("first_call") >= F.lag("last_call").over(timeline) + F.expr(f"interval {int(gap)} seconds")
    started = minutes.withColumn("starts", F.coalesce(silence, F.lit(True)).cast("int"))
    running = timeline.rowsBetween(Window.unboundedPreceding, 0)
    return (
        started.withColumn("session", F.sum("starts").over(running))
        .groupBy("name", "session")
        .agg(
            F.min("first_call").alias("first_call"),
            F.max("last_call").alias("last_call"),
            F.sum("calls").alias("calls"),
        )
        .drop("session")
    )


# ---- routing and alerts ---------------------------------------------------------------------------------------


def route(quotes: DataFrame, symbols: DataFrame, tier_mode: str = "router") -> DataFrame:
    """Two output rows per quote: one for its tier's topic, one for the unified topic. A symbol without a listed
    cap belongs to tier 3."""
    caps = symbols.select("symbol", cap_tier(F.col("market_cap"), tier_mode).alias("tier"))
    tiered = quotes.join(caps, "symbol", "left").withColumn("tier", F.coalesce("tier", F.lit(3)))
    own = F.concat(F.lit("nasdaq-tier"), F.col("tier"), F.lit("-realtime"))
    return tiered.drop("topic").withColumn("topic", F.explode(F.array(own, F.lit(UNIFIED_TOPIC))))


def as_messages(rows: DataFrame) -> DataFrame:
    """Topic rows in the shape a message sink takes."""
    body = F.to_json(F.struct(*[name for name in rows.columns if name != "topic"]))
    return rows.select("topic", F.col("symbol").alias("key"), body.alias("value"))


def alerts(quotes: DataFrame, kind: str, min_change: float) -> DataFrame:
    """An alert for each quote whose change rate reaches `min_change` percent either way."""
    rate = F.col("change_rate")
    return quotes.filter(F.abs(rate) >= min_change).select(
        "symbol", "event_time", "offset",
        alert_title(F.lit(kind), F.col("symbol"), F.col("price"), rate).alias("title"),
        alert_color(rate).alias("color"),
    )


def last_alerts(rows: DataFrame, limit: int = 100) -> DataFrame:
    """Newest alerts: each task keeps its own top rows, so only `limit` rows per task reach the last one."""
    return rows.orderBy(F.col("event_time").desc(), F.col("offset").desc()).limit(limit)


