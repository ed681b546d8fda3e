"""Technical indicators computed by window expressions.

Each takes a `Windows` collector and returns a `Term` (or several). Where the indicator exists in more than one
published form the form is a `mode`: `partial` starts with the first bar, `strict` waits for a full frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from candlewick.functions.numeric import ratio
from candlewick.operators.series import Term, Windows, combine, evaluate, running, source, trailing
from candlewick.schemas import INDICATOR_COLUMNS

def _close() -> Term:
    return source("close")


def sma(windows: Windows, period: int, strict: bool = False) -> Term:
    mean = windows.mean("close", _close(), period)
    return windows.full(mean, period) if strict else mean


def ema_blend(windows: Windows, period: int) -> Term:
    """One-step EMA seeded by the moving average: `sma * (1 - a) + close * a`, a = 2 / (period + 1)."""
    alpha = 2.0 / (period + 1.0)
    return combine(
        lambda mean, close: mean * F.lit(1 - alpha) + close * F.lit(alpha), sma(windows, period), _close()
    )


def bollinger(windows: Windows, period: int = 20, width: float = 2.0, strict: bool = False) -> dict[str, Term]:
    middle = sma(windows, period, strict)
    spread = windows.deviation("close", _close(), period)
    return {
        "bb_middle": middle,
        "bb_upper": combine(lambda m, s: m + s * F.lit(width), middle, spread),
        "bb_lower": combine(lambda m, s: m - s * F.lit(width), middle, spread),
    }


def macd_blend(windows: Windows, fast: int = 12, slow: int = 26, signal: int = 9) -> dict[str, Term]:
    """MACD of the blended EMAs; its signal line is a plain mean of the last `signal` values."""
    line = combine(lambda f, s: f - s, ema_blend(windows, fast), ema_blend(windows, slow))
    mean = windows.mean(f"macd_{fast}_{slow}", line, signal)
    return {
        "macd": line,
        "macd_signal": mean,
        "macd_histogram": combine(lambda value, average: value - average, line, mean),
    }


def price_change(windows: Windows) -> Term:
    return combine(lambda close, previous: close - previous, _close(), windows.lag("close", _close()))


def relative_strength(gain: Column, loss: Column, strict: bool) -> Column:
    """100 - 100 / (1 + gain / loss). Without any loss: NULL, or in the strict form 100 if there was a gain."""
    index = 100 - 100 / (1 + ratio(gain, loss))
    return F.when((loss == 0) & (gain > 0), F.lit(100.0)).otherwise(index) if strict else index


def rsi(windows: Windows, period: int = 14, strict: bool = False) -> Term:
    """RSI over plain means of gains and losses; the first bar counts as no gain and no loss."""
    change = price_change(windows)
    gain = combine(lambda c: F.when(c > 0, c).otherwise(0.0), change)
    loss = combine(lambda c: F.when(c < 0, -c).otherwise(0.0), change)
    index = combine(
        lambda g, l: relative_strength(g, l, strict),
        windows.mean("gain", gain, period),
        windows.mean("loss", loss, period),
    )
    return windows.full(index, period) if strict else index


def typical_price() -> Term:
    return combine(lambda h, l, c: (h + l + c) / 3, source("high"), source("low"), _close())


def cci(windows: Windows, period: int = 20, mode: str = "rowwise") -> Term:
    """Commodity channel index. The mean deviation takes each bar's distance from its own moving average
    (`rowwise`) or from the current bar's moving average (`textbook`)."""
    typical = typical_price()
    mean = windows.mean("typical", typical, period)
    if mode == "rowwise":
        distance = combine(lambda t, m: F.abs(t - m), typical, mean)
        deviation = windows.mean("typical_distance", distance, period)
    else:
        # The list is the frame itself, so it never holds more than `period` numbers.
        frame = windows.over(
            f"typical_list_{period}", F.collect_list, trailing(period), typical
        )
        deviation = combine(
            lambda values, m: F.aggregate(values, F.lit(0.0), lambda total, v: total + F.abs(v - m)) / F.size(values),
            frame,
            mean,
        )
    return combine(lambda t, m, d: ratio(t - m, F.lit(0.015) * d), typical, mean, deviation)


def obv(windows: Windows) -> Term:
    """Running sum of the volume, signed by the direction of the close."""
    step = combine(
        lambda change, volume: F.when(change > 0, volume).when(change < 0, -volume).otherwise(0),
        price_change(windows),
        source("volume"),
    )
    return windows.over("obv", F.sum, running(), step)


# ---- tables -------------------------------------------------------------------------------------------------

KEY = ["symbol", "date"]


def sma_table(bars: DataFrame, periods=(5, 20, 60, 112, 224, 448), strict: bool = False) -> DataFrame:
    windows = Windows()
    return evaluate(bars, windows, {f"sma_{p}": sma(windows, p, strict) for p in periods}, KEY)


def ema_blend_table(bars: DataFrame, periods=(5, 20, 60, 12, 26)) -> DataFrame:
    windows = Windows()
    return evaluate(bars, windows, {f"ema_{p}": ema_blend(windows, p) for p in periods}, KEY)


def bollinger_table(bars: DataFrame, period: int = 20, width: float = 2.0, strict: bool = False) -> DataFrame:
    windows = Windows()
    return evaluate(bars, windows, bollinger(windows, period, width, strict), [*KEY, "close"])


def macd_table(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    windows = Windows()
    return evaluate(bars, windows, macd_blend(windows, fast, slow, signal), KEY)


def rsi_table(bars: DataFrame, period: int = 14, strict: bool = False) -> DataFrame:
    windows = Windows()
    return evaluate(bars, windows, {"rsi": rsi(windows, period, strict)}, KEY)


def cci_table(bars: DataFrame, period: int = 20, mode: str = "rowwise") -> DataFrame:
    windows = Windows()
    return evaluate(bars, windows, {"cci": cci(windows, period, mode)}, KEY)


def obv_table(bars: DataFrame) -> DataFrame:
    windows = Windows()
    return evaluate(bars, windows, {"obv": obv(windows)}, KEY)


def price_change_table(bars: DataFrame) -> DataFrame:
    windows = Windows()
    return evaluate(bars, windows, {"price_change": price_change(windows)}, KEY)


def band_view(bars: DataFrame) -> DataFrame:
    """Close, 20-day bands and price change of every bar: the input of the scanner."""
    windows = Windows()
    outputs = {"close_price": _close(), **bollinger(windows), "price_change": price_change(windows)}
    return evaluate(bars, windows, outputs, KEY)


def indicator_table(bars: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """The stored indicator table, every column from one shuffle of the bars. `also` names columns of the bars to keep."""
    windows = Windows()
    outputs = {
        **bollinger(windows),
        **macd_blend(windows),
        "rsi": rsi(windows),
        **{f"sma_{p}": sma(windows, p) for p in (5, 20, 60)},
        **{f"ema_{p}": ema_blend(windows, p) for p in (5, 20, 60)},
        "cci": cci(windows),
        "obv": obv(windows),
        **{f"ma_{p}": sma(windows, p) for p in (112, 224, 448)},
    }
    return evaluate(bars, windows, outputs, [*KEY, *also]).select(*INDICATOR_COLUMNS, *also)


def latest_complete(table: DataFrame) -> DataFrame:
    """Newest row of each symbol in which every column has a value."""
    values = [name for name in table.columns if name != "symbol"]
    return (
        table.na.drop()
        .groupBy("symbol")
        .agg(F.max_by(F.struct(*values), "date").alias("row"))
        .select("symbol", *[f"row.{name}" for name in values])
    )
