"""Live indicators and the buy/sell score of a quote.

A symbol's last 50 closes travel as one short array, so that the live price is appended and every indicator,
including the exponential averages, is a built-in expression over at most 51 numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from candlewick.functions.numeric import round_half_up, truthy
from candlewick.functions.hashing import shard_number
from candlewick.functions.rows import computed_once
from candlewick.operators.indicators import relative_strength
from candlewick.sources.bars import last_bars
from candlewick.sources.snapshots import publish_snapshot, read_snapshot

HISTORY = 50
CLOSES_SHARDS = 64
FEWEST_BARS = 20

# Signal codes and the sentence each stands for.
SIGNAL_LABELS = {
    "RSI_OVERSOLD": "RSI 과매도 (매수 신호)",
    "RSI_OVERBOUGHT": "RSI 과매수 (매도 신호)",
    "BB_UPPER_BREAK": "볼린저 밴드 상단 돌파 (매도 고려)",
    "BB_LOWER_TOUCH": "볼린저 밴드 하단 터치 (매수 고려)",
    "BB_ABOVE_MID": "볼린저 밴드 중간선 위 (상승 추세)",
    "BB_BELOW_MID": "볼린저 밴드 중간선 아래 (하락 추세)",
    "MA_UPTREND": "단기 이평선 위 (상승 추세)",
    "MA_DOWNTREND": "단기 이평선 아래 (하락 추세)",
    "MACD_BUY": "MACD 매수 신호",
    "MACD_SELL": "MACD 매도 신호",
}


def recent_closes(bars: DataFrame, days: int = HISTORY) -> DataFrame:
    """Per symbol: the last closes, oldest first (a list of at most `days` numbers), and their number."""
    dated = F.sort_array(F.collect_list(F.struct("date", "close")))
    return (
        last_bars(bars, days)
        .groupBy("symbol")
        .agg(F.transform(dated, lambda bar: bar["close"]).alias("closes"), F.count(F.lit(1)).alias("data_points"))
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def _tail(values: Column, rows: int) -> Column:
    return F.slice(values, F.greatest(F.size(values) - rows + 1, F.lit(1)), rows)


def _strict_mean(values: Column, rows: int) -> Column:
    return F.when(F.size(values) >= rows, _sum(_tail(values, rows)) / rows)


def _smoothed(values: Column) -> Column:
    """Fold the closes once through the recursive EMA 12, EMA 26 and the 9-step average of their difference."""

    def step(state: Column, close: Column) -> Column:
        def move(before: Column, value: Column, span: int) -> Column:
            alpha = 2.0 / (span + 1.0)
            return value * F.lit(alpha) + before * F.lit(1 - alpha)

        fast, slow = move(state["fast"], close, 12), move(state["slow"], close, 26)
        return F.struct(fast.alias("fast"), slow.alias("slow"), move(state["signal"], fast - slow, 9).alias("signal"))

    first = F.element_at(values, 1)
    start = F.struct(first.alias("fast"), first.alias("slow"), F.lit(0.0).alias("signal"))
    return F.aggregate(F.slice(values, 2, HISTORY + 1), start, step)


def live_indicators(quotes: DataFrame, bars: DataFrame, few_quotes: bool = False) -> DataFrame:
    """Rounded indicators of each quote (one per symbol, column `price`) over its symbol's last 50 closes.

    `few_quotes` first restricts the bars to the quoted symbols, which pays where the quotes are a small, stored batch.
    """
    wanted = bars.join(quotes.select("symbol"), "symbol", "left_semi") if few_quotes else bars
    return indicators_over(quotes, recent_closes(wanted))


def publish_closes(bars: DataFrame, root: str) -> int:
    """Publish each symbol's last closes, in folders by shard, for `published_closes`; returns the version."""
    return publish_snapshot(recent_closes(bars).withColumn("shard", shard_number(F.col("symbol"), CLOSES_SHARDS)), root, ["shard"])


def published_closes(quotes: DataFrame, root: str) -> DataFrame:
    """The closes published last, of the shards the quotes fall in: at most `CLOSES_SHARDS` numbers reach the driver.

    Each call looks up the current version, so a job that calls it in every micro-batch follows the daily store.
    """
    closes = read_snapshot(quotes.sparkSession, root)
    if closes is None:  # nothing published yet
        return quotes.sparkSession.createDataFrame([], "symbol string, closes array<double>, data_points long")
    shards = [row[0] for row in quotes.select(shard_number(F.col("symbol"), CLOSES_SHARDS)).distinct().collect()]
    return closes.where(F.col("shard").isin(shards)).drop("shard")


def indicators_over(quotes: DataFrame, history: DataFrame) -> DataFrame:
    """`live_indicators` over closes as `recent_closes` gives them.

    Symbols with fewer than 20 stored bars give no row. A price of 0 counts as no live price.
    """
    rows = quotes.join(history.filter(F.col("data_points") >= FEWEST_BARS), "symbol")
    price = F.when(truthy(F.col("price")), F.col("price"))
    rows = rows.withColumn("price", price).withColumn(
        "closes", F.when(price.isNull(), F.col("closes")).otherwise(F.concat("closes", F.array(price)))
    )
    closes = F.col("closes")
    last20, last15 = _tail(closes, 20), _tail(closes, 15)
    mean = _sum(last20) / 20
    rows = rows.withColumn("mean", F.when(F.size(closes) >= 20, mean)).withColumn("ema", _smoothed(closes))
    squares = F.aggregate(last20, F.lit(0.0), lambda total, v: total + (v - F.col("mean")) * (v - F.col("mean")))
    changes = F.zip_with(F.slice(last15, 1, 14), F.slice(last15, 2, 14), lambda a, b: b - a)
    rows = rows.withColumn("sd", F.sqrt(squares / 19)).withColumn("changes", changes)
    gain = _sum(F.transform("changes", lambda c: F.greatest(c, F.lit(0.0)))) / 14
    loss = _sum(F.transform("changes", lambda c: F.greatest(-c, F.lit(0.0)))) / 14
    rows = rows.withColumn("gain", gain).withColumn("loss", loss)
    macd, signal = F.col("ema.fast") - F.col("ema.slow"), F.col("ema.signal")
    return computed_once(
        rows,
        *[F.col(name) for name in quotes.columns if name != "price"],
        F.col("data_points"),
        round_half_up(_strict_mean(closes, 5), 2).alias("sma_5"),
        round_half_up(F.col("mean"), 2).alias("sma_20"),
        round_half_up(F.col("ema.fast"), 2).alias("ema_12"),
        round_half_up(F.col("ema.slow"), 2).alias("ema_26"),
        round_half_up(relative_strength(F.col("gain"), F.col("loss"), True), 2).alias("rsi"),
        round_half_up(F.col("mean") + 2 * F.col("sd"), 2).alias("bb_upper"),
        round_half_up(F.col("mean"), 2).alias("bb_middle"),
        round_half_up(F.col("mean") - 2 * F.col("sd"), 2).alias("bb_lower"),
        round_half_up(macd, 4).alias("macd"),
        round_half_up(signal, 4).alias("macd_signal"),
        round_half_up(macd - signal, 4).alias("macd_histogram"),
        F.col("price").alias("current_price"),
        round_half_up(F.element_at("closes", -2), 2).alias("last_close"),
    )


def score(indicators: DataFrame) -> DataFrame:
    """Add `signals`, `strength` and `overall_sentiment` from the rounded indicators.

    Four groups vote: RSI, bands, moving averages, MACD. A group counts when all its inputs are present and not
    zero; the strength is the mean vote of the groups that count, cut toward zero.
    """
    price, c = F.col("current_price"), F.col
    up_trend = (c("sma_5") > c("sma_20")) & (price > c("sma_5"))
    down_trend = (c("sma_5") < c("sma_20")) & (price < c("sma_5"))
    buy = (c("macd") > c("macd_signal")) & (c("macd") > 0)
    sell = (c("macd") < c("macd_signal")) & (c("macd") < 0)
    groups = [
        (truthy(c("rsi")), [(c("rsi") < 30, 30, "RSI_OVERSOLD"), (c("rsi") > 70, -30, "RSI_OVERBOUGHT")]),
        (
            truthy(price) & truthy(c("bb_upper")) & truthy(c("bb_lower")),
            [
                (price >= c("bb_upper"), -20, "BB_UPPER_BREAK"),
                (price <= c("bb_lower"), 20, "BB_LOWER_TOUCH"),
                (price > c("bb_middle"), 10, "BB_ABOVE_MID"),
                (F.lit(True), -10, "BB_BELOW_MID"),
            ],
        ),
        (
            truthy(price) & truthy(c("sma_5")) & truthy(c("sma_20")),
            [(up_trend, 15, "MA_UPTREND"), (down_trend, -15, "MA_DOWNTREND")],
        ),
        (truthy(c("macd")) & truthy(c("macd_signal")), [(buy, 25, "MACD_BUY"), (sell, -25, "MACD_SELL")]),
    ]
    votes, codes, counted = F.lit(0), [], F.lit(0)
    for counts, rules in groups:
        vote, code = F.lit(0), F.lit(None).cast("string")
        for met, points, name in reversed(rules):
            vote, code = F.when(met, points).otherwise(vote), F.when(met, name).otherwise(code)
        votes = votes + F.when(counts, vote).otherwise(0)
        codes.append(F.when(counts, code))
        counted = counted + counts.cast("int")
    strength = F.coalesce(F.try_divide(votes, counted).cast("int"), F.lit(0))
    return (
        indicators.withColumn("signals", F.array_compact(F.array(*codes)))
        .withColumn("strength", strength)
        .withColumn(
            "overall_sentiment",
            F.when(F.col("strength") > 20, "bullish").when(F.col("strength") < -20, "bearish").otherwise("neutral"),
        )
    )


def quote_signals(quotes: DataFrame, bars: DataFrame, few_quotes: bool = False) -> DataFrame:
    return score(live_indicators(quotes, bars, few_quotes))


def strong_signals(scored: DataFrame, threshold: int = 30) -> DataFrame:
    return scored.filter((F.abs("strength") > threshold) & (F.size("signals") > 0))


def signal_label(code: Column) -> Column:
    """The sentence of a signal code."""
    return F.create_map(*[F.lit(text) for pair in SIGNAL_LABELS.items() for text in pair])[code]
