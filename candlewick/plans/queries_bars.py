"""Registered queries over bars, symbols and their storage operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.functions.caps import cap_billions, cap_tier
from candlewick.operators import clean, shards, summary, upsert
from candlewick.plans.catalog import register
from candlewick.plans.inputs import bars, events, symbols
from candlewick.schemas import BAR_COLUMNS
from candlewick.sources import bars as scans, payloads
from candlewick.sources.snapshots import table_profile
from candlewick.sources.trades import table

BAR = "symbol:s date:d open:6 high:6 low:6 close:6 volume:i"


@register("bars_from_trades", BAR, "SELECT * FROM bars", "bars")
def bars_from_trades(spark, folder):
    return bars(spark, folder)


@register("weekly_bars", BAR, "SELECT * FROM weekly", "weekly")
def weekly_bars(spark, folder):
    from candlewick.plans.inputs import weekly

    return weekly(spark, folder)


@register("single_symbol", BAR, "SELECT * FROM bars WHERE symbol = 'S7'", "bars")
def single_symbol(spark, folder):
    return scans.bars_of(bars(spark, folder), "S7")


@register(
    "date_range", BAR, "SELECT * FROM bars WHERE date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'", "bars"
)
def date_range(spark, folder):
    return scans.bars_between(bars(spark, folder), F.lit("1997-01-01").cast("date"), F.lit("1997-12-31").cast("date"))


@register(
    "last_50_bars", BAR + " recency:i",
    """SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS recency FROM bars
       QUALIFY recency <= 50""", "bars",
)
def last_50_bars(spark, folder):
    return scans.last_bars(bars(spark, folder), 50)


@register("active_symbol_list", "symbol:s", "SELECT DISTINCT symbol FROM symbols", "symbols")
def active_symbol_list(spark, folder):
    return scans.active_symbols(symbols(spark, folder))


@register(
    "flagged_symbols", "symbol:s", "SELECT DISTINCT symbol FROM tiers WHERE billions >= 1", "tiers"
)
def flagged_symbols(spark, folder):
    flagged = symbols(spark, folder).withColumn("is_active", cap_billions(F.col("market_cap")) >= 1)
    return scans.active_symbols(flagged, "is_active")


@register(
    "ad_hoc_sql", "sector:s symbols:i avg_close:4",
    """SELECT sector, count(DISTINCT b.symbol) AS symbols, avg(close) AS avg_close
       FROM bars b JOIN symbols s ON s.symbol = b.symbol WHERE date >= DATE '1998-01-01' GROUP BY sector""",
    "bars symbols",
)
def ad_hoc_sql(spark, folder):
    return scans.ad_hoc(
        spark, {"bars": bars(spark, folder), "symbols": symbols(spark, folder)},
        """SELECT sector, count(DISTINCT b.symbol) AS symbols, avg(close) AS avg_close
           FROM bars b JOIN symbols s ON s.symbol = b.symbol WHERE date >= to_date(:since) GROUP BY sector""",
        since="1998-01-01",
    )


# ---- symbols --------------------------------------------------------------------------------------------------


@register(
    "symbols_caps_tiers", "symbol:s name:s market_cap:s sector:s billions:6 tier:i router_tier:i scanner_tier:i",
    """SELECT *, CASE WHEN market_cap NOT LIKE '$%' THEN 3 ELSE tier END AS router_tier,
              CASE WHEN raw >= 100 THEN 1 WHEN raw >= 10 THEN 2 ELSE 3 END AS scanner_tier
       FROM (SELECT *, TRY_CAST(regexp_replace(market_cap, '[$BT]', '', 'g') AS DECIMAL(18,3)) AS raw FROM tiers)""",
    "tiers",
)
def symbols_caps_tiers(spark, folder):
    cap = F.col("market_cap")
    return symbols(spark, folder).select(
        "*", cap_billions(cap).alias("billions"), cap_tier(cap).alias("tier"),
        cap_tier(cap, "router").alias("router_tier"), cap_tier(cap, "scanner").alias("scanner_tier"),
    )


@register(
    "min_cap_symbols", "symbol:s market_cap:s", "SELECT symbol, market_cap FROM symbols WHERE billions >= 1", "symbols"
)
def min_cap_symbols(spark, folder):
    return clean.large_enough(symbols(spark, folder))


@register("symbol_payloads", "symbol:s name:s market_cap:s sector:s", "SELECT * FROM symbols", "symbols")
def symbol_payloads(spark, folder):
    listed = symbols(spark, folder)
    row = F.struct("symbol", "name", F.col("market_cap").alias("marketCap"), "sector")
    body = F.to_json(F.struct(F.struct(F.array(row).alias("rows")).alias("data")))
    return payloads.symbols_from_payloads(listed.select(body.alias("value")))


@register(
    "symbols_upsert", "symbol:s name:s market_cap:s sector:s refreshed:s",
    """SELECT symbol, CASE WHEN billions < 1 THEN concat(name, ' Inc') ELSE name END AS name, market_cap, sector,
              CASE WHEN billions < 1 THEN '2001-06-01' ELSE '2001-01-01' END AS refreshed FROM symbols""", "symbols",
)
def symbols_upsert(spark, folder):
    listed = symbols(spark, folder)
    stored = listed.withColumn("collected_at", F.to_timestamp(F.lit("2001-01-01")))
    renamed = listed.filter(cap_billions(F.col("market_cap")) < 1).withColumn("name", F.concat("name", F.lit(" Inc")))
    merged = upsert.upsert_symbols(stored, renamed, F.to_timestamp(F.lit("2001-06-01")))
    return merged.withColumn("refreshed", F.date_format("collected_at", "yyyy-MM-dd"))


# ---- payloads and cleaning ------------------------------------------------------------------------------------


@register(
    "daily_payloads", "symbol:s date:d open:6 high:6 low:6 close:6 volume:i",
    "SELECT symbol, date, open, high, low, close, CASE WHEN open = close THEN 0 ELSE volume END AS volume FROM bars",
    "bars",
)
def daily_payloads(spark, folder):
    """Bars as vendor responses; a bar whose price never moved lacks its volume field, which then counts as 0."""
    item = F.struct(
        F.date_format("date", "yyyyMMdd").alias("xymd"),
        *[F.col(name).cast("string").alias(name) for name in ("open", "high", "low")],
        F.col("close").cast("string").alias("clos"),
        F.when(F.col("open") != F.col("close"), F.col("volume").cast("string")).alias("tvol"),
    )
    body = F.to_json(F.struct(F.lit("0").alias("rt_cd"), F.array(item).alias("output")))
    return payloads.bars_from_payloads(bars(spark, folder).select("symbol", body.alias("value")))


@register("history_bars", BAR, "SELECT * FROM bars WHERE open <= close", "bars")
def history_bars(spark, folder):
    """Vendor history columns; a falling bar arrives without its close and is dropped."""
    history = bars(spark, folder).select(
        "symbol", F.col("date").cast("timestamp").alias("Date"), F.col("open").alias("Open"),
        F.col("high").alias("High"), F.col("low").alias("Low"),
        F.when(F.col("open") <= F.col("close"), F.col("close")).alias("Close"), F.col("volume").alias("Volume"),
        F.lit(0.0).alias("Stock Splits"),
    )
    return payloads.bars_from_history(history)


@register("typed_bars", BAR, "SELECT * FROM bars WHERE volume < 100", "bars")
def typed_bars(spark, folder):
    """Bars held as text with an unreadable volume from 100 up; such rows are skipped."""
    text = bars(spark, folder).select(
        *[F.col(name).cast("string").alias(name) for name in BAR_COLUMNS if name != "volume"],
        F.when(F.col("volume") < 100, F.col("volume").cast("string")).otherwise("n/a").alias("volume"),
    )
    return clean.complete_bars(clean.typed_bars(text))


# ---- incremental load and upserts -----------------------------------------------------------------------------


@register(
    "incremental_new_bars", BAR,
    "SELECT * FROM bars WHERE date > DATE '2000-06-30'",
    "bars",
)
def incremental_new_bars(spark, folder):
    """Delivery of all bars against a store that ends on 2000-06-30."""
    everything = bars(spark, folder)
    stored = everything.filter(F.col("date") <= F.lit("2000-06-30").cast("date"))
    return clean.new_bars(everything, stored)


@register(
    "bars_upsert", BAR,
    """SELECT symbol, date, open, high, low, CASE WHEN date >= DATE '2000-01-01' THEN close * 1.01e0 ELSE close END AS close,
              volume FROM bars""", "bars",
)
def bars_upsert(spark, folder):
    """Store up to 2000-12-31; the delivery repeats 2000 with corrected closes and adds the rest."""
    everything, day = bars(spark, folder), F.col("date")
    stored = everything.filter(day <= F.lit("2000-12-31").cast("date"))
    incoming = everything.filter(day >= F.lit("2000-01-01").cast("date")).withColumn("close", F.col("close") * 1.01)
    return upsert.upsert_bars(stored, incoming)


@register(
    "bars_upsert_repeated", BAR,
    "SELECT symbol, date, open, high, low, close + 2 AS close, volume FROM bars", "bars",
)
def bars_upsert_repeated(spark, folder):
    """A delivery that holds every key twice: the later copy wins."""
    stored = bars(spark, folder)
    copies = stored.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    incoming = copies.withColumn("close", F.col("close") + F.col("delivery"))
    return upsert.upsert_bars(stored, incoming, F.col("delivery"))


@register(
    "indicators_upsert", "symbol:s date:d sma_5:6 price_change:6",
    """SELECT symbol, date, CASE WHEN date < DATE '2000-01-01' THEN sma_5 END AS sma_5,
              CASE WHEN date >= DATE '2000-01-01' THEN price_change END AS price_change
       FROM (SELECT symbol, date, avg(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS sma_5,
                    close - lag(close) OVER (PARTITION BY symbol ORDER BY date) AS price_change FROM bars)""", "bars",
)
def indicators_upsert(spark, folder):
    """Stored rows with one indicator, replaced from 2000 on by rows with another: missing columns become NULL."""
    from candlewick.operators.indicators import price_change_table, sma_table

    base, start = bars(spark, folder), F.lit("2000-01-01").cast("date")
    return upsert.upsert_indicators(
        sma_table(base, (5,)), price_change_table(base).filter(F.col("date") >= start)
    )


@register(
    "ingest_audit", "symbol:s received:i clean:i fresh:i",
    """SELECT symbol, count(*) AS received, count(*) FILTER (open <= close) AS clean,
              count(*) FILTER (open <= close AND date > DATE '2000-06-30') AS fresh FROM bars GROUP BY symbol""", "bars",
)
def ingest_audit(spark, folder):
    """Delivery whose falling bars lack a close, against a store that ends on 2000-06-30."""
    everything = bars(spark, folder)
    raw = everything.withColumn("close", F.when(F.col("open") <= F.col("close"), F.col("close")))
    stored = everything.filter(F.col("date") <= F.lit("2000-06-30").cast("date"))
    return clean.ingest_audit(raw, stored)


@register(
    "ingest_totals", "succeeded:i failed:i fresh_rows:i",
    """SELECT count(*) FILTER (c > 0) AS succeeded, count(*) FILTER (c = 0) AS failed, sum(f) AS fresh_rows FROM
       (SELECT symbol, count(*) FILTER (open <= close) AS c,
               count(*) FILTER (open <= close AND date > DATE '2000-06-30') AS f FROM bars GROUP BY symbol)""", "bars",
)
def ingest_totals(spark, folder):
    return clean.ingest_totals(ingest_audit(spark, folder))


# ---- summaries ------------------------------------------------------------------------------------------------


@register("latest_date", "symbol:s latest_date:d", "SELECT symbol, max(date) AS latest_date FROM bars GROUP BY symbol", "bars")
def latest_date(spark, folder):
    return summary.latest_dates(bars(spark, folder))


@register("symbol_row_counts", "symbol:s rows:i", "SELECT symbol, count(*) AS rows FROM bars GROUP BY symbol", "bars")
def symbol_row_counts(spark, folder):
    return summary.row_counts(bars(spark, folder))


@register(
    "price_profile", "symbol:s avg_close:4 max_high:6 min_low:6 avg_volume:4",
    """SELECT symbol, avg(close) AS avg_close, max(high) AS max_high, min(low) AS min_low, avg(volume) AS avg_volume
       FROM bars GROUP BY symbol""", "bars",
)
def price_profile(spark, folder):
    return summary.price_profile(bars(spark, folder))


@register(
    "quality_audit", "symbol:s null_cells:i first_date:d last_date:d rows:i",
    """SELECT symbol, count(*) FILTER (open > close) AS null_cells, min(date) AS first_date, max(date) AS last_date,
              count(*) AS rows FROM bars GROUP BY symbol""", "bars",
)
def quality_audit(spark, folder):
    raw = bars(spark, folder).withColumn("close", F.when(F.col("open") <= F.col("close"), F.col("close")))
    return summary.null_audit(raw)


@register(
    "table_profile", "table_name:s rows:i columns:s",
    """SELECT 'stock_data' AS table_name, count(*) AS rows, 'symbol, date, open, high, low, close, volume' AS columns FROM bars
       UNION ALL SELECT 'nasdaq_symbols', count(*), 'symbol, name, market_cap, sector' FROM symbols
       UNION ALL SELECT 'events', count(*), 'event_id, ts, user_id, event_type, value, props' FROM events""",
    "bars symbols",
)
def profile(spark, folder):
    return table_profile(
        {"stock_data": bars(spark, folder), "nasdaq_symbols": symbols(spark, folder), "events": events(spark, folder)}
    )


@register("row_count", "rows:i", "SELECT count(*) AS rows FROM lineitem")
def row_count(spark, folder):
    return summary.row_count(table(spark, folder, "lineitem"))


# ---- shards ---------------------------------------------------------------------------------------------------


def _shard_sql(count: int) -> str:
    """1 + md5 mod count by folding the digest's 32-bit words."""
    word = "CAST('0x' || substr(md5(symbol), {start}, 8) AS BIGINT)"
    rest = "0"
    for start in (1, 9, 17, 25):
        rest = f"(({rest} * 4294967296 + {word.format(start=start)}) % {count})"
    return f"{rest} + 1"


SHARDED = f"sharded AS (SELECT DISTINCT symbol, {_shard_sql(5)} AS shard_number FROM symbols)"


@register("symbol_shards", "symbol:s shard_number:i", "SELECT * FROM sharded", "symbols", SHARDED)
def symbol_shards(spark, folder):
    return shards.symbol_shards(symbols(spark, folder))


@register(
    "symbol_shards_7", "symbol:s shard_number:i", f"SELECT symbol, {_shard_sql(7)} AS shard_number FROM symbols", "symbols"
)
def symbol_shards_7(spark, folder):
    return shards.symbol_shards(symbols(spark, folder), 7)


@register(
    "shard_lookup", "symbol:s shard_number:i",
    """SELECT symbol, CASE WHEN billions >= 100 THEN 9 ELSE shard_number END AS shard_number
       FROM sharded JOIN symbols USING (symbol)""", "symbols", SHARDED,
)
def shard_lookup(spark, folder):
    """Large companies are pinned to shard 9 in the stored map, all others fall back to their hash."""
    listed = symbols(spark, folder)
    pinned = listed.filter(cap_billions(F.col("market_cap")) >= 100).select("symbol", F.lit(9).alias("shard_number"))
    return shards.lookup(listed.select("symbol"), pinned)


@register(
    "shard_map_upsert", "symbol:s shard_number:i updated:s",
    """SELECT symbol, shard_number, CASE WHEN billions >= 100 THEN '2001-06-01' ELSE '2001-01-01' END AS updated
       FROM sharded JOIN symbols USING (symbol)""", "symbols", SHARDED,
)
def shard_map_upsert(spark, folder):
    listed = symbols(spark, folder)
    first, second = F.to_timestamp(F.lit("2001-01-01")), F.to_timestamp(F.lit("2001-06-01"))
    stored = shards.symbol_shards(listed).withColumn("created_at", first).withColumn("updated_at", first)
    large = listed.filter(cap_billions(F.col("market_cap")) >= 100)
    merged = shards.upsert_shard_map(stored, large, second)
    return merged.withColumn("updated", F.date_format("updated_at", "yyyy-MM-dd"))


@register(
    "shard_stats", "shard_number:i symbol_count:i record_count:i",
    f"""SELECT shard_number, count(DISTINCT symbol) AS symbol_count, count(*) AS record_count
        FROM (SELECT symbol, {_shard_sql(5)} AS shard_number FROM bars) GROUP BY shard_number""", "bars",
)
def shard_stats(spark, folder):
    return shards.shard_stats(bars(spark, folder))


COUNTS = f"""{SHARDED}, spread AS (
    SELECT i AS shard_number, coalesce(n, 0) AS count, 100e0 * coalesce(n, 0) / total AS percent,
           abs(coalesce(n, 0) - total / 5e0) / (total / 5e0) * 100 AS deviation_percent
    FROM generate_series(1, 5) g(i) LEFT JOIN (SELECT shard_number, count(*) AS n FROM sharded GROUP BY 1) c
         ON c.shard_number = g.i CROSS JOIN (SELECT count(*) AS total FROM sharded))"""


@register(
    "shard_skew", "shard_number:i count:i percent:6 deviation_percent:6", "SELECT * FROM spread", "symbols", COUNTS
)
def shard_skew(spark, folder):
    return shards.distribution(symbols(spark, folder))


@register(
    "shard_balance", "max_deviation_percent:6 quality:s balance_score:6",
    """SELECT m AS max_deviation_percent,
              CASE WHEN m < 5 THEN 'excellent' WHEN m < 10 THEN 'good' ELSE 'needs improvement' END AS quality,
              100 - m AS balance_score FROM (SELECT max(deviation_percent) AS m FROM spread)""", "symbols", COUNTS,
)
def shard_balance(spark, folder):
    return shards.balance(symbols(spark, folder))


@register(
    "symbols_union", "symbol:s", "SELECT DISTINCT symbol FROM bars UNION SELECT symbol FROM symbols", "bars symbols"
)
def symbols_union(spark, folder):
    return shards.all_symbols([bars(spark, folder), symbols(spark, folder)])
