"""Scans of the bars and symbols tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from candlewick.schemas import BARS


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BARS).parquet(path)


def bars_of(bars: DataFrame, symbol: str) -> DataFrame:
    """Bars of one symbol; the equality reaches the Parquet scan."""
    return bars.filter(F.col("symbol") == symbol)


def bars_between(bars: DataFrame, first: Column, last: Column) -> DataFrame:
    return bars.filter(F.col("date").between(first, last))


def last_bars(bars: DataFrame, count: int = 50) -> DataFrame:
    """Newest `count` bars of every symbol.

    The rank filter becomes a group limit below the shuffle, so each input split sends at most `count` rows per
    symbol.
    """
    newest_first = Window.partitionBy("symbol").orderBy(F.col("date").desc())
    return bars.withColumn("recency", F.row_number().over(newest_first)).filter(F.col("recency") <= count)


def active_symbols(symbols: DataFrame, flag: str | None = None) -> DataFrame:
    """Distinct symbols, optionally only those whose boolean `flag` column is true."""
    if flag:
        symbols = symbols.filter(F.col(flag))
    return symbols.select("symbol").distinct()


def ad_hoc(spark: SparkSession, tables: dict[str, DataFrame], query: str, **parameters) -> DataFrame:
    """Parameterised SQL over the given tables, registered as temporary views."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return spark.sql(query, args=parameters)
