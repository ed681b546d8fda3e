"""Indicator types a registry may name, and the registry evaluator.

A registry entry is (name, type, parameters). Types are evaluated together
through one `Windows` collector, EMA and MACD of any mode too; parabolic SAR lines are folded over each symbol's bars.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from inspect import signature

from pyspark.sql import DataFrame, functions as F

from candlewick.functions.numeric import ratio
from candlewick.operators import indicators as core
from candlewick.operators import recursive
from candlewick.operators.recursive import with_parabolic_sar
from candlewick.operators.series import Term, Windows, combine, evaluate, running, source, trailing

def _high() -> Term:
    return source("high")


def _low() -> Term:
    return source("low")


def _close() -> Term:
    return source("close")


def _volume() -> Term:
    return source("volume")


def _highest(windows: Windows, rows: int) -> Term:
    return windows.over(f"high_max_{rows}", F.max, trailing(rows), _high())


def _lowest(windows: Windows, rows: int) -> Term:
    return windows.over(f"low_min_{rows}", F.min, trailing(rows), _low())


def stoch_k(windows: Windows, period: int = 14) -> Term:
    """Position of the close within the range of the last `period` bars, 0 to 100."""
    return combine(
        lambda c, high, low: ratio(100 * (c - low), high - low), _close(), _highest(windows, period), _lowest(windows, period)
    )


def stoch_d(windows: Windows, period: int = 3, k: int = 14) -> Term:
    return windows.mean(f"stoch_k_{k}", stoch_k(windows, k), period)


def williams_r(windows: Windows, period: int = 14) -> Term:
    return combine(
        lambda c, high, low: ratio(-100 * (high - c), high - low), _close(), _highest(windows, period), _lowest(windows, period)
    )


def roc(windows: Windows, period: int = 12) -> Term:
    """Change of the close against `period` bars ago, in percent."""
    return combine(lambda c, before: ratio(100 * (c - before), before), _close(), windows.lag("close", _close(), period))


def _true_range(windows: Windows) -> Term:
    return combine(
        lambda high, low, previous: F.greatest(high - low, F.abs(high - previous), F.abs(low - previous)),
        _high(), _low(), windows.lag("close", _close()),
    )


def atr(windows: Windows, period: int = 14) -> Term:
    """Plain mean of the true range; the first bar's true range is its high minus its low."""
    return windows.mean("true_range", _true_range(windows), period)


def bb_width(windows: Windows, period: int = 20) -> Term:
    bands = core.bollinger(windows, period)
    return combine(lambda upper, lower: upper - lower, bands["bb_upper"], bands["bb_lower"])


def bb_percent(windows: Windows, period: int = 20) -> Term:
    bands = core.bollinger(windows, period)
    return combine(
        lambda c, upper, lower: ratio(c - lower, upper - lower), _close(), bands["bb_upper"], bands["bb_lower"]
    )


def vwap(windows: Windows, period: int = 20) -> Term:
    weighted = combine(lambda t, v: t * v, core.typical_price(), _volume())
    return combine(ratio, windows.total("typical_volume", weighted, period), windows.total("volume", _volume(), period))


def _money_flow() -> Term:
    """Volume times where the close lies in the bar's range (-1 to 1); 0 for a bar without a range."""
    return combine(
        lambda h, l, c, v: F.coalesce(ratio((c - l) - (h - c), h - l), F.lit(0.0)) * v, _high(), _low(), _close(), _volume()
    )


def ad_line(windows: Windows) -> Term:
    return windows.over("ad_line", F.sum, running(), _money_flow())


def cmf(windows: Windows, period: int = 20) -> Term:
    return combine(
        ratio, windows.total("money_flow", _money_flow(), period), windows.total("volume", _volume(), period)
    )


def adx(windows: Windows, period: int = 14) -> Term:
    """Average directional index with plain means in place of Wilder's smoothing."""
    up = combine(lambda h, before: h - before, _high(), windows.lag("high", _high()))
    down = combine(lambda l, before: before - l, _low(), windows.lag("low", _low()))
    plus = combine(lambda u, d: F.when((u > d) & (u > 0), u).otherwise(0.0), up, down)
    minus = combine(lambda u, d: F.when((d > u) & (d > 0), d).otherwise(0.0), up, down)
    span = atr(windows, period)
    plus_index = combine(lambda m, a: ratio(100 * m, a), windows.mean("plus_dm", plus, period), span)
    minus_index = combine(lambda m, a: ratio(100 * m, a), windows.mean("minus_dm", minus, period), span)
    direction = combine(lambda p, m: ratio(100 * F.abs(p - m), p + m), plus_index, minus_index)
    return windows.mean(f"direction_{period}", direction, period)


def fibonacci(windows: Windows, level: float, period: int = 60) -> Term:
    """Retracement price: the high of the last `period` bars less `level` of their range."""
    return combine(
        lambda high, low: high - F.lit(float(level)) * (high - low), _highest(windows, period), _lowest(windows, period)
    )


def _midrange(windows: Windows, period: int) -> Term:
    return combine(lambda high, low: (high + low) / 2, _highest(windows, period), _lowest(windows, period))


def ichimoku_tenkan(windows: Windows, period: int = 9) -> Term:
    return _midrange(windows, period)


def ichimoku_kijun(windows: Windows, period: int = 26) -> Term:
    return _midrange(windows, period)


def ichimoku_senkou_a(windows: Windows, period: int = 26) -> Term:
    """Mean of tenkan (9) and kijun (`period`), drawn `period` bars ahead."""
    middle = combine(lambda a, b: (a + b) / 2, _midrange(windows, 9), _midrange(windows, period))
    return windows.lag(f"senkou_a_{period}", middle, period)


def ichimoku_senkou_b(windows: Windows, period: int = 52, ahead: int = 26) -> Term:
    return windows.lag(f"senkou_b_{period}", _midrange(windows, period), ahead)


def ema(windows: Windows, period: int, mode: str = "blend") -> Term:
    return core.ema_blend(windows, period) if mode == "blend" else recursive.ema(windows, period, mode)


def macd(windows: Windows, fast: int = 12, slow: int = 26, signal: int = 9, mode: str = "blend") -> Term:
    if mode == "blend":
        return core.macd_blend(windows, fast, slow, signal)["macd"]
    return recursive.macd(windows, fast, slow, signal, mode)["macd"]


def _band(name: str) -> Callable[..., Term]:
    return lambda windows, period=20: core.bollinger(windows, period)[name]


TYPES: dict[str, Callable[..., Term]] = {
    "SMA": core.sma,
    "EMA": ema,
    "RSI": core.rsi,
    "CCI": core.cci,
    "OBV": lambda windows, period=None: core.obv(windows),
    "BB_UPPER": _band("bb_upper"),
    "BB_MIDDLE": _band("bb_middle"),
    "BB_LOWER": _band("bb_lower"),
    "MACD": macd,
    "STOCH_K": stoch_k,
    "STOCH_D": stoch_d,
    "WILLIAMS_R": williams_r,
    "ROC": roc,
    "ATR": atr,
    "BB_WIDTH": bb_width,
    "BB_PERCENT": bb_percent,
    "VWAP": vwap,
    "AD_LINE": lambda windows, period=None: ad_line(windows),
    "CMF": cmf,
    "ADX": adx,
    "FIBONACCI": fibonacci,
    "ICHIMOKU_TENKAN": ichimoku_tenkan,
    "ICHIMOKU_KIJUN": ichimoku_kijun,
    "ICHIMOKU_SENKOU_A": ichimoku_senkou_a,
    "ICHIMOKU_SENKOU_B": ichimoku_senkou_b,
}


def registry_table(bars: DataFrame, entries: Iterable[tuple[str, str, dict]]) -> DataFrame:
    """(symbol, date) and one column per registry entry. An unknown type becomes a NULL column.

    EMA and MACD take `mode` = `blend` (default), `recursive` or `adjusted`. `period` of an OBV or A/D line and
    `signal` of a MACD line change nothing; any other parameter a type does not have is an error naming the entry.
    """
    windows = Windows()
    outputs: dict[str, Term] = {}
    lines = []
    names = []
    for name, kind, parameters in entries:
        names.append(name)
        build = with_parabolic_sar if kind == "PARABOLIC_SAR" else TYPES.get(kind)
        if build is None:
            outputs[name] = Term(F.lit(None).cast("double"))
            continue
        known = {"step", "limit"} if kind == "PARABOLIC_SAR" else set(list(signature(build).parameters)[1:])
        if unknown := sorted(set(parameters) - known):
            raise ValueError(f"entry {name}: {kind} has no parameter {', '.join(unknown)}")
        if kind == "PARABOLIC_SAR":
            lines.append({"name": name, **parameters})
        else:
            outputs[name] = build(windows, **parameters)
    table = evaluate(bars, windows, outputs, bars.columns if lines else ["symbol", "date"])
    for line in lines:
        table = with_parabolic_sar(table, **line)
    return table.select("symbol", "date", *names)
