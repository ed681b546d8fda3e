"""Registered scan, watchlist and dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.operators import indicators as ind, scanner, upsert
from candlewick.plans.catalog import BY_DATE, over, register
from candlewick.plans.inputs import bars, symbols, watchlist
from candlewick.plans.queries_indicators import MOVES, RSI

# A day of the data's span; the summaries take it in place of today.
DAY = "1998-06-30"

SIGNAL = "symbol:s date:d close_price:6 bb_upper:6 condition_type:s condition_value:6 market_cap_tier:i market_cap:s"


@register(
    "bb_view", "symbol:s date:d close_price:6 bb_middle:6 bb_upper:6 bb_lower:6 price_change:6",
    f"""SELECT symbol, date, close AS close_price, m AS bb_middle, m + 2 * sd AS bb_upper, m - 2 * sd AS bb_lower,
               close - lag(close) {BY_DATE} AS price_change FROM bands""", "bands",
)
def bb_view(spark, folder):
    return ind.band_view(bars(spark, folder))


@register("bb_upper_touch", SIGNAL, "SELECT * FROM touches", "touches")
def bb_upper_touch(spark, folder):
    return scanner.touch_scan(bars(spark, folder), symbols(spark, folder))


@register("bb_upper_touch_day", SIGNAL, f"SELECT * FROM touches WHERE date = DATE '{DAY}'", "touches")
def bb_upper_touch_day(spark, folder):
    return scanner.touch_scan_on(bars(spark, folder), symbols(spark, folder), DAY)


@register(
    "multi_scan", "symbol:s date:d condition_type:s condition_value:6 market_cap_tier:i",
    f"""SELECT symbol, date, condition_type, condition_value, tier AS market_cap_tier FROM (
          SELECT symbol, date, 'bollinger_upper_touch' AS condition_type, close / upper AS condition_value
          FROM scanned WHERE close >= upper * 0.98e0
          UNION ALL SELECT symbol, date, 'rsi_overbought', rsi FROM scanned WHERE rsi >= 70
          UNION ALL SELECT symbol, date, 'volume_surge', surge FROM scanned WHERE surge >= 2) JOIN tiers USING (symbol)""",
    "bars tiers",
    f"""{MOVES}, scanned AS (SELECT *, {RSI} AS rsi FROM (
          SELECT symbol, date, close, avg(close) {over(20)} + 2 * stddev_samp(close) {over(20)} AS upper,
                 avg(gain) {over(14)} AS g, avg(loss) {over(14)} AS l, volume / avg(volume) {over(20)} AS surge
          FROM moves))""",
)
def multi_scan(spark, folder):
    return scanner.multi_scan(bars(spark, folder), symbols(spark, folder))


ROW = "symbol:s date:d condition_type:s condition_value:4 market_cap_tier:i"


@register(
    "watchlist_upsert", ROW + " created:s",
    """SELECT *, CASE WHEN date < DATE '1999-01-01' THEN '2001-01-01' ELSE '2001-06-01' END AS created FROM (
         SELECT symbol, date, condition_type, market_cap_tier,
                CASE WHEN date < DATE '1998-01-01' THEN 0.5 ELSE condition_value END AS condition_value FROM watchlist)""",
    "watchlist",
)
def watchlist_upsert(spark, folder):
    """A list kept until the end of 1998 with provisional values, rescanned from 1998 on."""
    found = watchlist(spark, folder)
    day = F.col("date")
    stored = found.filter(day < F.lit("1999-01-01").cast("date")).withColumn(
        "condition_value", F.lit("0.5").cast("decimal(10,4)")
    ).withColumn("created_at", F.to_timestamp(F.lit("2001-01-01")))
    rescanned = found.filter(day >= F.lit("1998-01-01").cast("date"))
    merged = upsert.upsert_watchlist(stored, rescanned, F.to_timestamp(F.lit("2001-06-01")))
    return merged.withColumn("created", F.date_format("created_at", "yyyy-MM-dd"))


@register(
    "watchlist_query", ROW + " name:s market_cap:s sector:s",
    f"""SELECT w.*, name, market_cap, sector FROM watchlist w JOIN symbols USING (symbol)
        WHERE date = DATE '{DAY}' AND condition_type = 'bollinger_upper_touch'""", "watchlist symbols",
)
def watchlist_query(spark, folder):
    return scanner.watchlist_on(watchlist(spark, folder), symbols(spark, folder), DAY, scanner.UPPER_TOUCH)


@register(
    "watchlist_daily_counts", "date:d condition_type:s count:i",
    f"""SELECT date, condition_type, count(*) AS count FROM watchlist
        WHERE date BETWEEN DATE '{DAY}' - 29 AND DATE '{DAY}' GROUP BY ALL""", "watchlist",
)
def watchlist_daily_counts(spark, folder):
    return scanner.daily_counts(watchlist(spark, folder), DAY, 30)


@register(
    "watchlist_sector_stats", "sector:s frequency:i avg_signal_strength:6",
    f"""SELECT sector, count(*) AS frequency, avg(condition_value) AS avg_signal_strength
        FROM watchlist JOIN symbols USING (symbol) WHERE date BETWEEN DATE '{DAY}' - 364 AND DATE '{DAY}'
        GROUP BY sector ORDER BY frequency DESC, sector LIMIT 10""", "watchlist symbols",
)
def watchlist_sector_stats(spark, folder):
    return scanner.sector_stats(watchlist(spark, folder), symbols(spark, folder), DAY, 365)


@register(
    "watchlist_top_symbols", "symbol:s name:s appearances:i avg_signal_strength:6 max_signal_strength:4",
    f"""SELECT symbol, name, count(*) AS appearances,
               CAST(sum(condition_value) AS DOUBLE) / count(*) AS avg_signal_strength,
               max(condition_value) AS max_signal_strength
        FROM watchlist JOIN symbols USING (symbol) WHERE date BETWEEN DATE '{DAY}' - 364 AND DATE '{DAY}'
        GROUP BY symbol, name ORDER BY appearances DESC, avg_signal_strength DESC, symbol LIMIT 20""",
    "watchlist symbols",
)
def watchlist_top_symbols(spark, folder):
    return scanner.top_symbols(watchlist(spark, folder), symbols(spark, folder), DAY, 365)


@register(
    "watchlist_latest", ROW,
    "SELECT * FROM watchlist ORDER BY date DESC, condition_value DESC, symbol, condition_type LIMIT 10", "watchlist",
)
def watchlist_latest(spark, folder):
    return scanner.latest_entries(watchlist(spark, folder))


@register(
    "watchlist_retention", ROW, f"SELECT * FROM watchlist WHERE date >= DATE '{DAY}' - 30", "watchlist"
)
def watchlist_retention(spark, folder):
    return upsert.retained(watchlist(spark, folder), DAY)


@register(
    "watchlist_retention_counts", "kept:i deleted:i",
    f"""SELECT count(*) FILTER (date >= DATE '{DAY}' - 30) AS kept, count(*) FILTER (date < DATE '{DAY}' - 30) AS deleted
        FROM watchlist""", "watchlist",
)
def watchlist_retention_counts(spark, folder):
    return upsert.retention_counts(watchlist(spark, folder), DAY)


TIER_NAME = "CASE market_cap_tier WHEN 1 THEN '대형주' WHEN 2 THEN '중형주' ELSE '소형주' END"


@register(
    "dashboard_rows", "symbol:s name:s sector:s market_cap:s tier_name:s condition_type:s signal_strength:s",
    f"""SELECT symbol, name, sector, market_cap, {TIER_NAME} AS tier_name, condition_type,
               printf('%.3f', (n // 10 + CASE WHEN n % 10 > 5 OR (n % 10 = 5 AND n // 10 % 2 = 1) THEN 1 ELSE 0 END) / 1e3)
                 AS signal_strength
        FROM (SELECT *, CAST(condition_value * 10000 AS BIGINT) AS n FROM watchlist) JOIN symbols USING (symbol) WHERE date = DATE '{DAY}' AND market_cap_tier IN (1, 2)""",
    "watchlist symbols",
)
def dashboard_rows(spark, folder):
    return scanner.dashboard_rows(watchlist(spark, folder), symbols(spark, folder), DAY, tiers=[1, 2])


@register(
    "dashboard_tiers", "total:i tier_1:i tier_2:i tier_3:i",
    """SELECT count(*) AS total, count(*) FILTER (market_cap_tier = 1) AS tier_1,
              count(*) FILTER (market_cap_tier = 2) AS tier_2, count(*) FILTER (market_cap_tier = 3) AS tier_3
       FROM watchlist""", "watchlist",
)
def dashboard_tiers(spark, folder):
    return scanner.tier_counts(watchlist(spark, folder))


@register(
    "sector_distribution", "sector:s count:i",
    "SELECT sector, count(*) AS count FROM watchlist JOIN symbols USING (symbol) GROUP BY sector", "watchlist symbols",
)
def sector_distribution(spark, folder):
    return scanner.sector_distribution(watchlist(spark, folder), symbols(spark, folder))


@register(
    "manual_watchlist", "symbol:s date:d price:6 bb_width:6 bb_position:6",
    """SELECT symbol, date, close AS price, (m + 2 * sd) - (m - 2 * sd) AS bb_width,
              (close - (m - 2 * sd)) / nullif((m + 2 * sd) - (m - 2 * sd), 0) AS bb_position FROM bands""", "bands",
)
def manual_watchlist(spark, folder):
    return scanner.manual_entry(ind.band_view(bars(spark, folder)).withColumnRenamed("close_price", "price"))


MANUAL = "symbol:s signal:s price:6 volume:i bb_upper:6 bb_middle:6 bb_lower:6 bb_width:6 bb_position:6 rsi:6 created_at:t"


@register(
    "manual_watchlist_replaced", MANUAL,
    f"""SELECT symbol, 'bollinger_upper_touch' AS signal, close AS price, volume, m + 2 * sd AS bb_upper, m AS bb_middle, m - 2 * sd AS bb_lower,
               (m + 2 * sd) - (m - 2 * sd) AS bb_width, (close - (m - 2 * sd)) / nullif((m + 2 * sd) - (m - 2 * sd), 0) AS bb_position,
               {RSI} AS rsi, CAST(date AS TIMESTAMP) AS created_at
        FROM (SELECT symbol, date, close, volume, avg(close) {over(20)} AS m, stddev_samp(close) {over(20)} AS sd,
                     avg(gain) {over(14)} AS g, avg(loss) {over(14)} AS l FROM moves)
        WHERE close >= (m + 2 * sd) * 0.98e0
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY CASE WHEN date <= DATE '{DAY}' THEN date END DESC NULLS LAST, date DESC) = 1""",
    "bars", MOVES,
)
def manual_watchlist_replaced(spark, folder):
    """A hand-kept list: what was stored after `DAY` is replaced, symbol by symbol, by the newest entry up to it."""
    rows, day = scanner.manual_rows(bars(spark, folder)), F.to_timestamp(F.lit(DAY))
    stored = upsert.last_per_key(rows.filter(F.col("created_at") > day), ["symbol"], F.col("created_at"))
    return scanner.replace_manual(stored, rows.filter(F.col("created_at") <= day))


@register(
    "first_candidates", SIGNAL,
    f"SELECT * FROM touches WHERE date = DATE '{DAY}' ORDER BY condition_value DESC, symbol LIMIT 10", "touches",
)
def first_candidates(spark, folder):
    return scanner.first_candidates(scanner.touch_scan_on(bars(spark, folder), symbols(spark, folder), DAY))
