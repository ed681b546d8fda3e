"""One symbol holding a third of all rows: results stay whole, and each step reduces before it shuffles."""

import pytest
from pyspark.sql import functions as F

from candlewick.operators import quotes as q
from candlewick.operators.indicators import indicator_table
from candlewick.sources import trades

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hot_lines(spark):
    """Order lines of which more than a third belong to supplier 1."""
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    return lines.withColumn("l_suppkey", F.when(F.col("l_orderkey") % 5 < 2, 1).otherwise(F.col("l_suppkey")).cast("bigint"))


def shuffle_inputs(frame) -> list[str]:
    """The operator right below each shuffle of the plan. The `select` gives a plan that has not run yet: one that
    has also prints its initial form."""
    lines = frame.select("*")._jdf.queryExecution().executedPlan().toString().splitlines()
    return [below.strip(" :+-*()0123456789").split("(")[0] for line, below in zip(lines, lines[1:]) if "Exchange hash" in line]


def test_bars_of_a_hot_symbol(spark, hot_lines):
    bars = trades.bars_from_trades(hot_lines)
    assert shuffle_inputs(bars)[0] == "HashAggregate"
    assert bars.agg(F.sum("volume")).first()[0] == hot_lines.agg(F.sum("l_quantity")).first()[0]
    # However many lines it has, a symbol has at most one bar per day.
    days = hot_lines.select(F.col("l_shipdate").cast("date")).distinct().count()
    assert bars.filter("symbol = 'S1'").count() <= days
    assert indicator_table(bars).count() == bars.count()


def test_quotes_of_a_hot_symbol(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet").withColumn(
        "user_id", F.when(F.col("event_id") % 2 == 0, 1).otherwise(F.col("user_id")).cast("bigint")
    )
    quotes = q.read_quotes(trades.quote_messages(events))
    rows = quotes.collect()
    newest = {}
    for row in rows:
        key = (row["event_time"], row["offset"])
        if row["symbol"] not in newest or key > newest[row["symbol"]]:
            newest[row["symbol"]] = key
    latest = q.latest_quotes(quotes)
    assert {r["symbol"]: (r["event_time"], r["offset"]) for r in latest.collect()} == newest
    assert shuffle_inputs(latest) == ["SortAggregate"]
    bucketed = q.first_in_bucket(quotes)
    assert shuffle_inputs(bucketed) == ["SortAggregate"]
    calls = events.select(F.lit("api").alias("name"), F.col("ts").alias("event_time"))
    minutes = q.calls_per_minute(calls)
    assert shuffle_inputs(minutes) == ["HashAggregate"]
    assert q.call_sessions(minutes).agg(F.sum("calls")).first()[0] == events.count()
