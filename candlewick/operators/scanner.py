"""Band scan, watchlist queries and summaries.

Joins with the symbols table carry no broadcast hint: Spark broadcasts it when its measured size is under the
threshold and otherwise shuffles, splitting skewed partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from candlewick.functions.caps import cap_tier, tier_name
from candlewick.functions.numeric import ratio
from candlewick.functions.text import strength_text
from candlewick.operators.indicators import band_view, bollinger, rsi
from candlewick.operators.series import Windows, combine, evaluate, source
from candlewick.operators.upsert import last_per_key, upsert
from candlewick.schemas import MANUAL_WATCHLIST, WATCHLIST_KEY
from candlewick.sources.bars import last_bars

# Condition names, the touch margin, and the thresholds of the two declared conditions.
UPPER_TOUCH = "bollinger_upper_touch"
RSI_OVERBOUGHT = "rsi_overbought"
VOLUME_SURGE = "volume_surge"
TOUCH_MARGIN = 0.98
OVERBOUGHT_LEVEL = 70
SURGE_FACTOR = 2


def _touched(bands: DataFrame) -> DataFrame:
    return bands.filter(F.col("close_price") >= F.col("bb_upper") * TOUCH_MARGIN)


def _signals(touched: DataFrame, symbols: DataFrame, tier_mode: str) -> DataFrame:
    return touched.join(symbols, "symbol").select(
        "symbol", "date", "close_price", "bb_upper",
        F.lit(UPPER_TOUCH).alias("condition_type"),
        ratio(F.col("close_price"), F.col("bb_upper")).alias("condition_value"),
        cap_tier(F.col("market_cap"), tier_mode).alias("market_cap_tier"),
        "market_cap",
    )


def touch_scan(bars: DataFrame, symbols: DataFrame, tier_mode: str = "parsed") -> DataFrame:
    """Every bar that closes within 2 % of its upper band or above it."""
    return _signals(_touched(band_view(bars)), symbols, tier_mode)


def touch_scan_on(bars: DataFrame, symbols: DataFrame, day, tier_mode: str = "parsed") -> DataFrame:
    """The scan for one day. Only each symbol's newest 20 bars up to that day matter, so the day limits the scan
    from above and a group limit trims the rest before the shuffle."""
    until = F.to_date(F.lit(day))
    recent = last_bars(bars.filter(F.col("date") <= until), 20)
    mean, spread = F.avg("close"), F.stddev_samp("close")
    bands = (
        recent.groupBy("symbol")
        .agg(
            F.max("date").alias("date"),
            F.max_by("close", "date").alias("close_price"),
            (mean + 2 * spread).alias("bb_upper"),
        )
        .filter(F.col("date") == until)
    )
    return _signals(_touched(bands), symbols, tier_mode)


def multi_scan(bars: DataFrame, symbols: DataFrame, volume_window: int = 20) -> DataFrame:
    """All conditions in one pass over the bars, one row per bar and matched condition: the band touch, and the
    declared RSI >= 70 and volume >= twice its mean."""
    windows = Windows()
    outputs = {
        "bb_upper": bollinger(windows)["bb_upper"],
        "rsi": rsi(windows),
        "volume_ratio": combine(
            ratio, source("volume"), windows.mean("volume", source("volume"), volume_window)
        ),
    }
    table = evaluate(bars, windows, outputs, ["symbol", "date", "close"])
    close, upper = F.col("close"), F.col("bb_upper")

    def condition(name, met, value):
        return F.when(met, F.struct(F.lit(name).alias("condition_type"), value.alias("condition_value")))

    matches = F.array_compact(
        F.array(
            condition(UPPER_TOUCH, close >= upper * TOUCH_MARGIN, ratio(close, upper)),
            condition(RSI_OVERBOUGHT, F.col("rsi") >= OVERBOUGHT_LEVEL, F.col("rsi")),
            condition(VOLUME_SURGE, F.col("volume_ratio") >= SURGE_FACTOR, F.col("volume_ratio")),
        )
    )
    found = table.select("symbol", "date", F.explode(matches).alias("m"))
    return found.join(symbols.select("symbol", "market_cap"), "symbol").select(
        "symbol", "date", "m.condition_type", "m.condition_value",
        cap_tier(F.col("market_cap")).alias("market_cap_tier"),
    )


def watchlist_rows(signals: DataFrame) -> DataFrame:
    """Scan result in the stored form, its value rounded to DECIMAL(10,4)."""
    return signals.select(
        *WATCHLIST_KEY, F.col("condition_value").cast("decimal(10,4)").alias("condition_value"), "market_cap_tier"
    )


def watchlist_on(watchlist: DataFrame, symbols: DataFrame, day, condition: str | None = None) -> DataFrame:
    """One day's watchlist with company details, by tier and falling value."""
    rows = watchlist.filter(F.col("date") == F.to_date(F.lit(day)))
    if condition:
        rows = rows.filter(F.col("condition_type") == condition)
    return (
        rows.join(symbols, "symbol")
        .select(*WATCHLIST_KEY, "condition_value", "market_cap_tier", "name", "market_cap", "sector")
        .orderBy("market_cap_tier", F.col("condition_value").desc(), "symbol")
    )


def last_days(watchlist: DataFrame, as_of, days: int = 7) -> DataFrame:
    end = F.to_date(F.lit(as_of))
    return watchlist.filter(F.col("date").between(F.date_sub(end, days - 1), end))


def daily_counts(watchlist: DataFrame, as_of, days: int = 7) -> DataFrame:
    return (
        last_days(watchlist, as_of, days)
        .groupBy("date", "condition_type")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("date").desc(), "condition_type")
    )


def _per_symbol(watchlist: DataFrame, as_of, days: int) -> DataFrame:
    """One row per symbol, so that the join with the symbols table meets each symbol once."""
    value = F.col("condition_value").cast("decimal(18,4)")
    return (
        last_days(watchlist, as_of, days)
        .groupBy("symbol")
        .agg(
            F.count(F.lit(1)).alias("appearances"),
            F.sum(value).alias("value_sum"),
            F.max("condition_value").alias("max_signal_strength"),
        )
    )


def sector_stats(watchlist: DataFrame, symbols: DataFrame, as_of, days: int = 7, limit: int = 10) -> DataFrame:
    return (
        _per_symbol(watchlist, as_of, days)
        .join(symbols, "symbol")
        .groupBy("sector")
        .agg(
            F.sum("appearances").alias("frequency"),
            (F.sum("value_sum").cast("double") / F.sum("appearances")).alias("avg_signal_strength"),
        )
        .orderBy(F.col("frequency").desc(), "sector")
        .limit(limit)
    )


def top_symbols(watchlist: DataFrame, symbols: DataFrame, as_of, days: int = 7, limit: int = 20) -> DataFrame:
    return (
        _per_symbol(watchlist, as_of, days)
        .join(symbols, "symbol")
        .select(
            "symbol", "name", "appearances",
            (F.col("value_sum").cast("double") / F.col("appearances")).alias("avg_signal_strength"),
            "max_signal_strength",
        )
        .orderBy(F.col("appearances").desc(), F.col("avg_signal_strength").desc(), "symbol")
        .limit(limit)
    )


def latest_entries(watchlist: DataFrame, limit: int = 10) -> DataFrame:
    return watchlist.orderBy(
        F.col("date").desc(), F.col("condition_value").desc(), "symbol", "condition_type"
    ).limit(limit)


def dashboard_rows(
    watchlist: DataFrame, symbols: DataFrame, day,
    condition: str | None = None, sectors: list[str] | None = None, tiers: list[int] | None = None,
) -> DataFrame:
    """Display form of one day's watchlist, optionally limited to some sectors and tiers."""
    rows = watchlist_on(watchlist, symbols, day, condition)
    if sectors:
        rows = rows.filter(F.col("sector").isin(sectors))
    if tiers:
        rows = rows.filter(F.col("market_cap_tier").isin(tiers))
    return rows.select(
        "symbol", "name", "sector", "market_cap",
        tier_name(F.col("market_cap_tier")).alias("tier_name"),
        "condition_type",
        strength_text(F.col("condition_value")).alias("signal_strength"),
    )


def tier_counts(watchlist: DataFrame) -> DataFrame:
    tier = F.col("market_cap_tier")
    return watchlist.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(tier == n).alias(f"tier_{n}") for n in (1, 2, 3)],
    )


def sector_distribution(watchlist: DataFrame, symbols: DataFrame) -> DataFrame:
    """Watchlist rows per sector; counted per symbol before the join."""
    return (
        watchlist.groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(symbols, "symbol")
        .groupBy("sector")
        .agg(F.sum("rows").alias("count"))
    )


def first_candidates(signals: DataFrame, limit: int = 10) -> DataFrame:
    """The strongest signals of one scan, ties by symbol."""
    return signals.orderBy(F.col("condition_value").desc(), "symbol", "condition_type").limit(limit)


def manual_rows(bars: DataFrame) -> DataFrame:
    """Entries as they are kept by hand, in the columns of `MANUAL_WATCHLIST`, for every bar that touches its upper band."""
    windows = Windows()
    outputs = {"price": source("close"), **bollinger(windows), "rsi": rsi(windows)}
    bands = evaluate(bars, windows, outputs, ["symbol", "date", "volume"])
    touched = bands.filter(F.col("price") >= F.col("bb_upper") * TOUCH_MARGIN)
    entries = manual_entry(touched).withColumn("signal", F.lit(UPPER_TOUCH)).withColumn("created_at", F.col("date").cast("timestamp"))
    return entries.select(*MANUAL_WATCHLIST.fieldNames())


def replace_manual(stored: DataFrame, entries: DataFrame) -> DataFrame:
    """The hand-kept list with one row a symbol: an entry takes the place of what is stored for its symbol, the latest of several."""
    return upsert(stored, last_per_key(entries, ["symbol"], F.col("created_at")), ["symbol"])


def manual_entry(bands: DataFrame) -> DataFrame:
    """Add `bb_width` and `bb_position` to hand-kept rows holding price and bands."""
    width = F.col("bb_upper") - F.col("bb_lower")
    return bands.withColumn("bb_width", width).withColumn(
        "bb_position", ratio(F.col("price") - F.col("bb_lower"), width)
    )
