"""Bars, symbols, quotes and logs derived from an order-line, supplier and event star schema.

Every function is one declarative plan over its input, so the derived tables grow with the source tables.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewick.functions.numeric import round_half_up


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _price() -> Column:
    return F.col("l_extendedprice") / F.col("l_quantity")


def _trade_order() -> Column:
    """Trade order within a day: order, line (below 100) and part key (below 10^12) as one decimal of fixed width,
    which keeps min_by/max_by hash-aggregable."""
    return (
        F.col("l_orderkey").cast("decimal(19,0)") * F.lit(Decimal(10**14))
        + F.col("l_linenumber").cast("decimal(2,0)") * F.lit(Decimal(10**12))
        + F.col("l_partkey").cast("decimal(12,0)")
    )


def _bar_aggregates() -> list[Column]:
    price, order = _price(), _trade_order()
    return [
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.sum("l_quantity").cast("bigint").alias("volume"),
    ]


def bars_from_trades(lineitem: DataFrame) -> DataFrame:
    """Daily bars per supplier. Partial aggregation runs before the shuffle, so a supplier holding a large share
    of the lines still sends one row per day and input split."""
    day = F.col("l_shipdate").cast("date").alias("date")
    return (
        lineitem.filter(F.col("l_suppkey").isNotNull() & F.col("l_shipdate").isNotNull())
        .groupBy("l_suppkey", day)
        .agg(*_bar_aggregates())
        .select(
            F.concat(F.lit("S"), F.col("l_suppkey")).alias("symbol"),
            "date", "open", "high", "low", "close", "volume",
        )
    )


def weekly_bars(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Weekly bars per nation (the sector of its suppliers); most have a real open-close range.

    Lines become one row for each supplier and week before they meet the suppliers."""
    week = F.date_trunc("week", F.col("l_shipdate")).cast("date").alias("date")
    price, order = _price(), _trade_order()
    own = lineitem.groupBy("l_suppkey", week).agg(
        F.min(order).alias("first"), F.max(order).alias("last"), F.min_by(price, order).alias("open"), F.max(price).alias("high"),
        F.min(price).alias("low"), F.max_by(price, order).alias("close"), F.sum("l_quantity").alias("volume"))
    sectors = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).select("s_suppkey", "n_name")
    return (
        own.join(sectors, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("n_name").alias("symbol"), "date")
        .agg(
            F.min_by("open", "first").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
            F.max_by("close", "last").alias("close"), F.sum("volume").cast("bigint").alias("volume"))
    )


def symbols_from_suppliers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """One symbol per supplier; the cap text takes the four vendor forms in turn."""
    base = F.floor(F.abs(F.col("s_acctbal"))).cast("bigint")
    form = F.col("s_suppkey") % 4
    cap = (
        F.when(form == 0, F.concat(F.lit("$"), base % 4 + 1, F.lit(".5T")))
        .when(form == 1, F.concat(F.lit("$"), base % 1500 + 1, F.lit("B")))
        .when(form == 2, F.concat(F.lit("$"), base % 900 + 1, F.lit("M")))
        .otherwise(((base + 1) * 100000000).cast("string"))
    )
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("symbol"),
        F.col("s_name").alias("name"),
        cap.alias("market_cap"),
        F.col("n_name").alias("sector"),
    )


PRIMARY_TOPIC = "primary-quotes"
SECONDARY_TOPIC = "secondary-quotes"


def quote_messages(events: DataFrame) -> DataFrame:
    """Message envelopes (topic, event_time, offset, value) holding JSON quotes.

    Views and clicks become quotes of the primary source, purchases and signups of the secondary one, and error
    events become unreadable text. A value below 1 stands for a missing price, one above 300 for a missing symbol.
    """
    value = F.col("value")
    primary = F.col("event_type").isin("view", "click")
    price = F.when(value < 1, 0.0).otherwise(round_half_up(500 + value * 80, 2))
    symbol = F.when(value > 300, "").otherwise(F.concat(F.lit("S"), F.col("user_id")))
    volume = F.col("event_id") + 100
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    primary_body = F.to_json(
        F.struct(
            symbol.alias("symbol"),
            price.alias("price"),
            round_half_up(value - 50, 2).alias("change"),
            round_half_up((value - 50) / 20, 2).alias("change_rate"),
            volume.alias("volume"),
            F.lit("KIS").alias("data_source"),
            stamp.alias("timestamp"),
        )
    )
    secondary_body = F.to_json(
        F.struct(
            symbol.alias("symbol"),
            price.alias("current_price"),
            round_half_up(480 + value * 82, 2).alias("previous_close"),
            round_half_up(price * 0.99, 2).alias("open_price"),
            round_half_up(price * 1.01, 2).alias("day_high"),
            round_half_up(price * 0.97, 2).alias("day_low"),
            volume.alias("volume"),
            F.lit(0).alias("market_cap"),
            F.lit(0).alias("pe_ratio"),
            F.lit("YFINANCE").alias("data_source"),
            stamp.alias("timestamp"),
        )
    )
    return events.select(
        F.when(primary, PRIMARY_TOPIC).otherwise(SECONDARY_TOPIC).alias("topic"),
        F.col("ts").alias("event_time"),
        F.col("event_id").alias("offset"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("{broken "), F.col("event_id")))
        .when(primary, primary_body)
        .otherwise(secondary_body)
        .alias("value"),
    )


def primary_responses(events: DataFrame) -> DataFrame:
    """Raw price responses of the primary source: text fields, blank where the vendor had no figure."""
    value = F.col("value")
    return events.filter(F.col("event_type").isin("view", "click")).select(
        F.concat(F.lit("S"), F.col("user_id")).alias("symbol"),
        F.when(value < 5, "").otherwise(round_half_up(500 + value * 80, 2).cast("string")).alias("last"),
        F.when(value < 10, " ").otherwise(round_half_up(value - 50, 2).cast("string")).alias("diff"),
        F.when(value > 300, "n/a").otherwise(round_half_up((value - 50) / 20, 2).cast("string")).alias("rate"),
        F.col("event_id").cast("string").alias("tvol"),
        F.col("ts").alias("event_time"),
        F.col("event_id").alias("offset"),
    )


def call_log(events: DataFrame) -> DataFrame:
    """API call log; the event type names the test scenario."""
    value = F.col("value")
    return events.select(
        F.col("event_type").alias("scenario"),
        F.concat(F.lit("S"), F.col("user_id")).alias("symbol"),
        F.when(value > 150, "rate_limited").when(value > 100, "failed").otherwise("success").alias("status"),
        (value / 100).alias("response_time"),
        F.when(value > 150, "429").when(value > 100, "empty").alias("error"),
    )


def request_log(events: DataFrame) -> DataFrame:
    """HTTP request log; error events are failed requests."""
    return events.select(
        "ts",
        F.when(F.col("event_type").isin("purchase", "signup"), "POST").otherwise("GET").alias("method"),
        F.concat(F.lit("/api/"), F.col("event_type")).alias("endpoint"),
        F.when(F.col("event_type") == "error", 500).when(F.col("value") > 200, 429).otherwise(200).alias("status"),
        (F.col("value") / 40).alias("duration"),
        F.lit(None).cast("string").alias("error"),
    )


def log_lines(events: DataFrame) -> DataFrame:
    """The same events as lines of the service's text log."""
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS")
    seconds = F.format_string("%.3f", F.floor(F.col("value") * 25 + 0.5) / 1000)
    kind = F.col("event_type")
    message = (
        F.when(kind == "view", F.concat(F.lit("INFO - 🌐 요청: GET /api/view - 200 ("), seconds, F.lit("초)")))
        .when(kind == "click", F.lit("DEBUG - 📤 Kafka 메시지: primary-quotes - success"))
        .when(kind == "purchase", F.concat(F.lit("INFO - 🗃️ DB 작업: insert - success ("), seconds, F.lit("초)")))
        .when(kind == "signup", F.concat(F.lit("WARNING - 🐌 slow "), seconds))
        .otherwise(F.lit("ERROR - ❌ call failed"))
    )
    return events.select(F.concat(stamp, F.lit(" - performance_monitor - "), message).alias("value"))


def load_test_rows(events: DataFrame) -> DataFrame:
    """Load-test statistics rows, one per endpoint and method plus the closing `Aggregated` row."""
    requests = request_log(events)
    milliseconds = F.col("duration") * 1000
    figures = [
        F.count(F.lit(1)).alias("Request Count"),
        F.count_if(F.col("status") >= 400).alias("Failure Count"),
        F.avg(milliseconds).alias("Average Response Time"),
        F.min(milliseconds).alias("Min Response Time"),
        F.max(milliseconds).alias("Max Response Time"),
        (F.count(F.lit(1)) / F.lit(60.0)).alias("Requests/s"),
    ]
    per_endpoint = requests.groupBy(
        F.col("method").alias("Type"), F.concat("endpoint", F.lit("/"), F.col("status")).alias("Name")
    ).agg(*figures)
    total = requests.agg(*figures).select(F.lit("").alias("Type"), F.lit("Aggregated").alias("Name"), "*")
    return per_endpoint.unionByName(total)
