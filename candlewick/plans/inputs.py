"""The derived tables the registered queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.operators import scanner
from candlewick.operators.quotes import latest_quotes, read_quotes
from candlewick.sources import trades
from candlewick.sources.trades import table


def bars(spark: SparkSession, folder: str) -> DataFrame:
    return trades.bars_from_trades(table(spark, folder, "lineitem"))


def weekly(spark: SparkSession, folder: str) -> DataFrame:
    return trades.weekly_bars(*[table(spark, folder, name) for name in ("lineitem", "supplier", "nation")])


def symbols(spark: SparkSession, folder: str) -> DataFrame:
    return trades.symbols_from_suppliers(table(spark, folder, "supplier"), table(spark, folder, "nation"))


def watchlist(spark: SparkSession, folder: str) -> DataFrame:
    return scanner.watchlist_rows(scanner.touch_scan(bars(spark, folder), symbols(spark, folder)))


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return trades.quote_messages(events(spark, folder))


def quotes(spark: SparkSession, folder: str) -> DataFrame:
    return read_quotes(messages(spark, folder))


def latest(spark: SparkSession, folder: str) -> DataFrame:
    return latest_quotes(quotes(spark, folder))
