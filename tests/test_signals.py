"""The score rules and the live indicators against a plain-Python reading of the rules."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.operators import signals
from candlewick.schemas import BARS

NEUTRAL = dict(
    rsi=50.0, bb_upper=110.0, bb_middle=100.0, bb_lower=90.0, sma_5=100.0, sma_20=100.0, macd=1.0, macd_signal=1.0,
    current_price=105.0,
)
CASES = [
    # changed inputs, signals, strength, sentiment
    ({}, ["BB_ABOVE_MID"], 2, "neutral"),
    ({"rsi": 29.99}, ["RSI_OVERSOLD", "BB_ABOVE_MID"], 10, "neutral"),
    ({"rsi": 30.0}, ["BB_ABOVE_MID"], 2, "neutral"),
    ({"rsi": 70.01}, ["RSI_OVERBOUGHT", "BB_ABOVE_MID"], -5, "neutral"),
    ({"current_price": 110.0}, ["BB_UPPER_BREAK"], -5, "neutral"),
    ({"current_price": 90.0}, ["BB_LOWER_TOUCH"], 5, "neutral"),
    ({"current_price": 100.0}, ["BB_BELOW_MID"], -2, "neutral"),
    ({"sma_5": 101.0}, ["BB_ABOVE_MID", "MA_UPTREND"], 6, "neutral"),
    ({"sma_5": 99.0, "current_price": 98.0}, ["BB_BELOW_MID", "MA_DOWNTREND"], -6, "neutral"),
    ({"macd": 2.0}, ["BB_ABOVE_MID", "MACD_BUY"], 8, "neutral"),
    ({"macd": -2.0}, ["BB_ABOVE_MID", "MACD_SELL"], -3, "neutral"),
    ({"macd": -0.5, "macd_signal": -1.0}, ["BB_ABOVE_MID"], 2, "neutral"),
    # A missing or zero input takes its group out of the mean.
    ({"macd": 0.0}, ["BB_ABOVE_MID"], 3, "neutral"),
    ({"rsi": None, "macd": None, "sma_5": None}, ["BB_ABOVE_MID"], 10, "neutral"),
    ({"current_price": None, "rsi": 20.0, "macd": 2.0}, ["RSI_OVERSOLD", "MACD_BUY"], 27, "bullish"),
    ({"current_price": None, "rsi": 80.0, "macd": -2.0}, ["RSI_OVERBOUGHT", "MACD_SELL"], -27, "bearish"),
    ({"current_price": None, "rsi": None, "macd": None}, [], 0, "neutral"),
    # The mean is cut toward zero: -8.75 becomes -8.
    ({"current_price": 112.0, "rsi": 80.0, "sma_5": 111.0, "macd": 0.5}, ["RSI_OVERBOUGHT", "BB_UPPER_BREAK", "MA_UPTREND"], -8, "neutral"),
    ({"current_price": 110.0, "rsi": None, "sma_5": None, "macd": 2.0}, ["BB_UPPER_BREAK", "MACD_BUY"], 2, "neutral"),
]


def test_score_rules(spark):
    fields = list(NEUTRAL)
    rows = [tuple({**NEUTRAL, **change}[f] for f in fields) + (i,) for i, (change, *_) in enumerate(CASES)]
    frame = spark.createDataFrame(rows, ", ".join(f"{f} double" for f in fields) + ", i int")
    found = signals.score(frame).orderBy("i").collect()
    for row, (change, codes, strength, sentiment) in zip(found, CASES):
        assert (row["signals"], row["strength"], row["overall_sentiment"]) == (codes, strength, sentiment), change


def test_strong_signals(spark):
    frame = spark.createDataFrame(
        [(31, ["A"]), (-31, ["A"]), (30, ["A"]), (40, [])], "strength int, signals array<string>"
    )
    assert [r["strength"] for r in signals.strong_signals(frame).collect()] == [31, -31]


def test_labels(spark):
    codes = list(signals.SIGNAL_LABELS)
    frame = spark.createDataFrame([(c,) for c in codes], "c string")
    assert {r[0]: r[1] for r in frame.select("c", signals.signal_label(F.col("c"))).collect()} == signals.SIGNAL_LABELS


def expected(closes, live):
    """The rules on one symbol's last 50 closes, by pandas."""
    if len(closes) < 20:
        return None
    prices = pd.Series(closes[-50:] + ([live] if live else []))
    change = prices.diff()
    gain = change.where(change > 0, 0).rolling(14).mean()
    loss = (-change.where(change < 0, 0)).rolling(14).mean()
    mean, sd = prices.rolling(20).mean(), prices.rolling(20).std()
    fast, slow = prices.ewm(span=12, adjust=False).mean(), prices.ewm(span=26, adjust=False).mean()
    line = fast - slow
    signal = line.ewm(span=9, adjust=False).mean()
    last = {
        "sma_5": prices.rolling(5).mean(), "sma_20": mean, "ema_12": fast, "ema_26": slow,
        "rsi": 100 - 100 / (1 + gain / loss), "bb_upper": mean + 2 * sd, "bb_lower": mean - 2 * sd,
        "macd": line, "macd_signal": signal, "macd_histogram": line - signal,
    }
    return {name: values.iloc[-1] for name, values in last.items()} | {"last_close": prices.iloc[-2]}


@pytest.mark.parametrize("few_quotes", [False, True])
def test_live_indicators(spark, few_quotes):
    rng = np.random.default_rng(5)
    lengths = {"A": 300, "B": 50, "C": 20, "D": 19, "E": 33}
    first = dt.date(2021, 1, 1)
    closes = {s: [float(v) for v in 100 + np.cumsum(rng.normal(0, 1, n))] for s, n in lengths.items()}
    rows = [
        (s, first + dt.timedelta(days=i), v, v, v, v, 10) for s, values in closes.items() for i, v in enumerate(values)
    ]
    bars = spark.createDataFrame(rows, BARS)
    live = {"A": 101.5, "B": 99.0, "C": 100.25, "D": 100.0, "E": 0.0, "X": 5.0}
    quotes = spark.createDataFrame(list(live.items()), "symbol string, price double")
    found = {r["symbol"]: r.asDict() for r in signals.live_indicators(quotes, bars, few_quotes).collect()}
    assert set(found) == {"A", "B", "C", "E"}  # D has too few bars, X none
    for symbol, row in found.items():
        want = expected(closes[symbol], live[symbol])
        for name, value in want.items():
            digits = 4 if name.startswith("macd") else 2
            assert row[name] == pytest.approx(value, abs=0.5001 * 10**-digits), (symbol, name)
        assert row["data_points"] == min(50, lengths[symbol])
    assert found["E"]["current_price"] is None
