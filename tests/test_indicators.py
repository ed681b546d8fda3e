"""Indicators against pandas, invariants, and the shape of their plans."""

import datetime as dt

from functools import reduce

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import DataFrame, functions as F

from candlewick.operators import declared, indicators as ind, recursive
from candlewick.schemas import BARS, INDICATOR_COLUMNS
from candlewick.sources.files import DEFAULT_REGISTRY, add_indicator, read_registry, registry_entries, write_registry

DAYS = 500


def series(seed: int) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    close = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, DAYS)))
    close[40:80] = close[40] * 1.01 ** np.arange(40)  # a stretch without losses
    close[200:230] = close[200]  # and one without any move
    # Uneven ranges: were they even, the flat stretch would have one typical price up to float noise, and its CCI
    # would be the undefined quotient 0 / 0.
    above, below = np.abs(rng.normal(0, 1, DAYS)), np.abs(rng.normal(0, 1, DAYS))
    first = dt.date(2020, 1, 1)
    return pd.DataFrame({
        "symbol": f"T{seed}", "date": [first + dt.timedelta(days=i) for i in range(DAYS)],
        "open": close, "high": close + above, "low": close - below, "close": close,
        "volume": rng.integers(1, 10**10, DAYS),
    })


@pytest.fixture(scope="module")
def history():
    return pd.concat([series(1), series(2)], ignore_index=True)


@pytest.fixture(scope="module")
def bars(spark, history):
    return spark.createDataFrame(history.sample(frac=1, random_state=3), BARS).repartition(3).persist()


def result(frame) -> pd.DataFrame:
    return frame.toPandas().sort_values(["symbol", "date"], ignore_index=True)


def per_symbol(history, compute) -> np.ndarray:
    return np.concatenate([np.asarray(compute(g), dtype=float) for _, g in history.groupby("symbol")])


def same(actual, expected):
    np.testing.assert_allclose(np.asarray(actual, dtype=float), expected, rtol=1e-9, atol=1e-9, equal_nan=True)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("period", [5, 60, 112, 224, 448, 101])
def test_sma(bars, history, period, strict):
    found = result(ind.sma_table(bars, (period,), strict))[f"sma_{period}"]
    least = period if strict else 1
    same(found, per_symbol(history, lambda g: g["close"].rolling(period, min_periods=least).mean()))


@pytest.mark.parametrize("mode,adjust", [("recursive", False), ("adjusted", True)])
def test_ema_and_macd(bars, history, mode, adjust):
    found = result(recursive.with_ema(bars, {"ema_12": 12}, (12, 26, 9), mode))

    def smooth(values, span):
        # Straight from the definition, step by step.
        decay, out, top, bottom = 1 - 2 / (span + 1), [], 0.0, 0.0
        for i, value in enumerate(values):
            if adjust:
                top, bottom = value + decay * top, 1 + decay * bottom
                out.append(top / bottom)
            else:
                top = value if i == 0 else (1 - decay) * value + decay * top
                out.append(top)
        return np.array(out)

    def line(g):
        return smooth(g["close"], 12) - smooth(g["close"], 26)

    same(found["ema_12"], per_symbol(history, lambda g: smooth(g["close"], 12)))
    same(found["macd"], per_symbol(history, line))
    same(found["macd_signal"], per_symbol(history, lambda g: smooth(line(g), 9)))


def pandas_rsi(group, least):
    change = group["close"].diff()
    gain = change.where(change > 0, 0).rolling(14, min_periods=least).mean()
    loss = (-change).where(change < 0, 0).rolling(14, min_periods=least).mean()
    return gain, loss


def test_rsi_modes(bars, history):
    strict = result(ind.rsi_table(bars, strict=True))["rsi"]

    def expected(group):
        gain, loss = pandas_rsi(group, 14)
        return 100 - 100 / (1 + gain / loss)

    # pandas: 100 with gains only, NaN with no move at all; both occur in the series.
    same(strict, per_symbol(history, expected))
    assert (strict == 100).any() and strict.isna().sum() > 2 * 13

    def partial(group):
        gain, loss = pandas_rsi(group, 1)
        return (100 - 100 / (1 + gain / loss)).where(loss != 0)

    batch = result(ind.rsi_table(bars))["rsi"]
    same(batch, per_symbol(history, partial))
    assert batch.dropna().between(0, 100).all()


def test_bands(bars):
    partial, strict = result(ind.bollinger_table(bars)), result(ind.bollinger_table(bars, strict=True))
    assert partial.groupby("symbol")["bb_upper"].first().notna().all()  # second bar on
    assert strict.groupby("symbol")["bb_middle"].apply(lambda s: s.isna().sum()).eq(19).all()
    both = strict["bb_middle"].notna()
    same(partial[both]["bb_upper"], strict[both]["bb_upper"])
    complete = partial.dropna()
    assert (complete["bb_lower"] <= complete["bb_middle"] + 1e-9).all()
    assert (complete["bb_middle"] <= complete["bb_upper"] + 1e-9).all()


def test_cci_modes(bars, history):
    def expected(group, textbook):
        typical = (group["high"] + group["low"] + group["close"]) / 3
        mean = typical.rolling(20, min_periods=1).mean()
        if textbook:
            deviation = typical.rolling(20, min_periods=1).apply(lambda w: np.abs(w - w.mean()).mean(), raw=True)
        else:
            deviation = (typical - mean).abs().rolling(20, min_periods=1).mean()
        return ((typical - mean) / (0.015 * deviation)).where(deviation != 0)

    same(result(ind.cci_table(bars))["cci"], per_symbol(history, lambda g: expected(g, False)))
    same(result(ind.cci_table(bars, mode="textbook"))["cci"], per_symbol(history, lambda g: expected(g, True)))


def test_obv(bars, history):
    found = result(ind.obv_table(bars))["obv"]
    expected = per_symbol(history, lambda g: (np.sign(g["close"].diff()).fillna(0) * g["volume"]).cumsum())
    same(found, expected)


def test_latest_complete(bars, history):
    latest = result(ind.latest_complete(recursive.strict_indicator_table(bars)))
    assert list(latest["date"]) == [history["date"].max()] * 2
    assert not latest.isna().any().any()


def test_latest_without_the_table(spark, bars):
    """The newest complete rows, of symbols that end in a flat stretch or have too few bars as well."""
    ends = [bars.withColumn("symbol", F.concat("symbol", F.lit(f"_{n}"))).where(F.col("date") < F.date_add(F.lit("2020-01-01"), n))
            for n in (1, 59, 60, 90, 212, 220, 225, 230, 400)]
    several = reduce(DataFrame.unionByName, ends)
    want = result(ind.latest_complete(recursive.strict_indicator_table(several)))
    found = result(recursive.latest_strict(several))
    assert len(want) == 14 and list(found["symbol"]) == list(want["symbol"]) and list(found["date"]) == list(want["date"])
    for name in want.columns[2:]:
        if name in found.columns:
            same(found[name], want[name])
    assert set(want.columns) - set(found.columns) == {"open", "high", "low"}


def walk(values, span, adjust):
    """An average straight from its definition, value by value; missing ones are passed over."""
    decay, out, top, bottom, seen = 1 - 2 / (span + 1), [], 0.0, 0.0, False
    for value in values:
        if value is not None:
            if adjust:
                top, bottom = value + decay * top, 1 + decay * bottom
            else:
                top, bottom = value if not seen else (1 - decay) * value + decay * top, 1.0
            seen = True
        out.append(top / bottom if seen else np.nan)
    return out


@pytest.mark.parametrize("span", [1, 2, 5, 60, 448])
@pytest.mark.parametrize("mode", ["recursive", "adjusted"])
def test_averages_over_many_blocks(spark, span, mode):
    """5,000 bars, with gaps of missing closes at the start, across block borders and at the end."""
    rng = np.random.default_rng(span)
    close = [float(x) for x in 100 * np.exp(np.cumsum(rng.normal(0, 0.02, 5000)))]
    for a, b in ((0, 3), (500, 530), (1020, 1030), (2040, 2080), (4990, 5000)):
        close[a:b] = [None] * (b - a)
    close[1500:4000:7] = [None] * len(close[1500:4000:7])
    first = dt.date(2000, 1, 1)
    frame = spark.createDataFrame([("A", first + dt.timedelta(days=i), x) for i, x in enumerate(close)], "symbol string, date date, close double")
    found = result(recursive.with_ema(frame, {"e": span}, mode=mode))["e"]
    same(found, np.array(walk(close, span, mode == "adjusted")))


def test_block_lengths():
    for span in (2, 3, 5, 9, 26, 60, 448, 5000):
        rows, blocks = recursive._block(recursive.keep_of(span))
        keep = recursive.keep_of(span)
        assert keep**-rows < 1e300 and keep ** (rows * blocks) <= recursive.NEGLIGIBLE * 1.01 and blocks <= 4
    with pytest.raises(ValueError):
        recursive.keep_of(0)


def test_parabolic_sar_walk(spark, bars, history):
    """The fold against a plain walk, over lengths around its runs of 64 bars."""
    def stops(group):
        high, low = group["high"].tolist(), group["low"].tolist()
        out = [np.nan] * len(high)
        if len(high) > 1:
            up = high[1] >= high[0]
            stop, top, speed = (low[0], high[1], 0.02) if up else (high[0], low[1], 0.02)
            out[1] = stop
            for i in range(2, len(high)):
                stop += speed * (top - stop)
                stop = min(stop, low[i - 1], low[i - 2]) if up else max(stop, high[i - 1], high[i - 2])
                if (low[i] < stop) if up else (high[i] > stop):
                    stop, up, speed = top, not up, 0.02
                    top = high[i] if up else low[i]
                elif (high[i] > top) if up else (low[i] < top):
                    top, speed = high[i] if up else low[i], min(0.2, speed + 0.02)
                out[i] = stop
        return out

    for days in (1, 2, 3, 65, 66, 67, 130, DAYS):
        short = history.groupby("symbol").head(days)
        frame = bars.where(F.col("date") < F.date_add(F.lit("2020-01-01"), days))
        found = recursive.with_parabolic_sar(frame)
        assert found.columns == [*bars.columns, "parabolic_sar"]
        table = result(found)
        same(table["parabolic_sar"], np.concatenate([stops(g) for _, g in short.groupby("symbol")]))
        same(table["close"], short.sort_values(["symbol", "date"])["close"])


def test_unknown_parameters_are_errors(bars):
    for kind, parameters in (("EMA", {"period": 5, "mode": "recursive", "spam": 1}), ("MACD", {"mode": "adjusted", "period": 5}),
                             ("PARABOLIC_SAR", {"period": 5}), ("SMA", {"mode": "blend", "period": 5})):
        with pytest.raises(ValueError, match="entry x"):
            declared.registry_table(bars, [("x", kind, parameters)])


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, bars, tmp_path_factory):
    """The bars as a Parquet table: the plan of a cached frame would also print the steps that filled the cache."""
    path = str(tmp_path_factory.mktemp("bars"))
    bars.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_indicator_table_needs_one_shuffle(stored):
    text = plan(ind.indicator_table(stored))
    assert text.count("Exchange") == 1
    assert text.count("Sort [") == 1
    assert "Python" not in text and "Pandas" not in text


def test_scan_reads_only_needed_columns(stored):
    text = plan(ind.sma_table(stored, (5,)))
    assert "ReadSchema: struct<symbol:string,date:date,close:double>" in text


def test_single_symbol_filter_reaches_the_scan(stored):
    from candlewick.sources.bars import bars_of

    assert "PushedFilters: [IsNotNull(symbol), EqualTo(symbol,T1)]" in plan(ind.rsi_table(bars_of(stored, "T1")))


def test_last_bars_are_limited_before_the_shuffle(stored):
    from candlewick.sources.bars import last_bars

    text = plan(last_bars(stored, 50))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_indicator_table_columns(bars):
    assert ind.indicator_table(bars).columns == INDICATOR_COLUMNS


def test_strict_table_needs_one_shuffle(stored):
    for frame in (recursive.strict_indicator_table(stored), recursive.latest_strict(stored), recursive.with_ema(stored, {"e": 5}, (12, 26, 9)),
                  recursive.with_parabolic_sar(stored)):
        text = plan(frame)
        assert text.count("Exchange") == 1 and "Python" not in text and "Pandas" not in text


def test_registry(spark, bars, tmp_path):
    assert read_registry(spark, str(tmp_path / "none.json")) == DEFAULT_REGISTRY
    registry = add_indicator(DEFAULT_REGISTRY, "momentum", "rsi_7", "RSI", period=7)
    registry = add_indicator(registry, "trend", "ema_9", "EMA", period=9, mode="recursive")
    registry = add_indicator(registry, "trend", "macd_fast", "MACD", fast=8, slow=21, mode="adjusted")
    registry = add_indicator(registry, "trend", "sar", "PARABOLIC_SAR")
    registry = add_indicator(registry, "other", "mystery", "NO_SUCH_TYPE")
    path = str(tmp_path / "registry.json")
    write_registry(spark, path, registry)
    assert read_registry(spark, path) == registry
    assert "momentum" not in DEFAULT_REGISTRY["indicators"]
    entries = registry_entries(registry)
    table = result(declared.registry_table(bars, entries))
    assert list(table.columns) == ["symbol", "date"] + [name for name, _, _ in entries]
    assert table["mystery"].isna().all()
    same(table["ema_9"], result(recursive.with_ema(bars, {"e": 9}))["e"])
    same(table["rsi_7"], result(ind.rsi_table(bars, 7))["rsi"])
    assert table["sar"].notna().sum() == len(table) - 2


def test_manual_entry_sample(spark):
    from candlewick.operators.scanner import manual_entry

    row = manual_entry(
        spark.createDataFrame([(180.5, 185.0, 175.0)], "price double, bb_upper double, bb_lower double")
    ).first()
    assert row["bb_width"] == 10.0 and row["bb_position"] == pytest.approx(0.55)
