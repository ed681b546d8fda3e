"""Hand-worked vectors for the column functions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from candlewick.functions.caps import cap_billions, cap_tier, tier_name
from candlewick.functions.hashing import shard_number
from candlewick.functions.numeric import round_half_up
from candlewick.functions.text import alert_color, alert_title, strength_text

CAPS = [
    # text, billions, tier, router tier, scanner tier
    ("$3.0T", 3000.0, 1, 1, 3),
    ("$800B", 800.0, 1, 1, 1),
    ("$45M", 0.045, 3, 3, 3),
    ("1.5M", 0.0015, 3, 3, 3),
    ("12.5B", 12.5, 2, 2, 2),
    ("3500000000000", 3500.0, 1, 3, 1),
    ("1,500,000,000", 1.5, 3, 3, 3),
    ("$", 0.0, 3, 3, 3),
    ("", 0.0, 3, 3, 3),
    ("n/a", 0.0, 3, 3, 3),
    ("1.2.3", 0.0, 3, 3, 3),
    (None, 0.0, 3, 3, 3),
]


def test_caps(spark):
    cap = F.col("cap")
    rows = spark.createDataFrame([(c[0],) for c in CAPS], "cap string").select(
        "cap", cap_billions(cap), cap_tier(cap), cap_tier(cap, "router"), cap_tier(cap, "scanner")
    ).collect()
    assert [tuple(r) for r in rows] == [pytest.approx(c) if c[0] else c for c in CAPS]


def test_tier_names(spark):
    rows = spark.range(1, 5).select(tier_name(F.col("id"))).collect()
    assert [r[0] for r in rows] == ["대형주", "중형주", "소형주", None]


@pytest.mark.parametrize("shards", [2, 5, 7, 16, 1000])
def test_shard_number(spark, shards):
    symbols = [f"SYM{i}" for i in range(200)] + ["", "AAPL", "한국"]
    rows = spark.createDataFrame([(s,) for s in symbols], "s string").select("s", shard_number(F.col("s"), shards)).collect()
    for symbol, shard in rows:
        assert shard == int(hashlib.md5(symbol.encode()).hexdigest(), 16) % shards + 1


def test_display_text(spark):
    row = spark.range(1).select(
        alert_title(F.lit("price"), F.lit("AAPL"), F.lit(12345.678), F.lit(-1.5)),
        alert_color(F.lit(1.0)), alert_color(F.lit(-1.0)), alert_color(F.lit(0.0)),
        strength_text(F.lit("1.0045").cast("decimal(10,4)")),
        strength_text(F.lit("1.0055").cast("decimal(10,4)")),
        strength_text(F.lit("0").cast("decimal(10,4)")),
        strength_text(F.lit(None).cast("decimal(10,4)")),
    ).first()
    assert list(row) == [
        "[price] AAPL: $12,345.68 (-1.50%)", "#36a64f", "#d72b3f", "#9e9ea6", "1.004", "1.006", "N/A", "N/A",
    ]


def test_rounding_keeps_large_values_and_nan(spark):
    rows = spark.createDataFrame([(1e14,), (1e300,), (2.5,), (float("nan"),), (None,)], "x double")
    found = [row.r for row in rows.select(round_half_up(F.col("x"), 6).alias("r")).collect()]
    assert found[:3] == [1e14, 1e300, 2.5] and found[3] != found[3] and found[4] is None


def test_quotes_with_numbers_as_text(spark):
    from candlewick.operators import quotes as q

    bodies = [
        '{"symbol": "A", "price": "12.5", "volume": "7"}', '{"symbol": "B", "price": 3, "volume": 1.5}',
        '{"symbol": "C", "price": "NaN", "volume": 1}', '{"symbol": "D", "price": "none", "volume": 1}',
        '{"symbol": "E", "price": 0, "volume": 1}', "{broken", '{"symbol": "F", "price": 2.5, "volume": 9007199254740993}',
    ]
    rows = spark.createDataFrame([("t", i, x) for i, x in enumerate(bodies)], "topic string, offset int, value string")
    got = q.read_quotes(rows.selectExpr("topic", "timestamp '2024-01-01 00:00:00' AS event_time", "offset", "value"))
    assert {(x.symbol, x.price, x.volume) for x in got.collect()} == {
        ("A", 12.5, 7), ("B", 3.0, 1), ("F", 2.5, 9007199254740993)}


def test_registry_parameters(spark):
    import pytest

    from candlewick.operators.declared import registry_table

    bars = spark.sql(
        "SELECT 'A' AS symbol, date_add(date '2024-01-01', CAST(id AS INT)) AS date, 1.0d AS open, 2.0d AS high, 1.0d AS low, "
        "1.5d + id AS close, 10L AS volume FROM range(5)")
    table = registry_table(bars, [("m", "MACD", {"signal": 5}), ("o", "OBV", {"period": 3})])
    assert table.columns == ["symbol", "date", "m", "o"] and table.count() == 5
    with pytest.raises(ValueError, match="entry x: RSI has no parameter weight"):
        registry_table(bars, [("x", "RSI", {"weight": 3})])
