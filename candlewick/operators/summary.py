"""Counts and quality reports over bars and symbols."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from candlewick.schemas import BAR_COLUMNS


def latest_dates(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(F.max("date").alias("latest_date"))


def row_counts(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"))


def price_profile(bars: DataFrame) -> DataFrame:
    """Per symbol: mean close, highest high, lowest low, mean volume."""
    return bars.groupBy("symbol").agg(
        F.avg("close").alias("avg_close"),
        F.max("high").alias("max_high"),
        F.min("low").alias("min_low"),
        F.avg("volume").alias("avg_volume"),
    )


def null_audit(bars: DataFrame) -> DataFrame:
    """Per symbol: number of empty cells, first and last date, rows."""
    empty = F.lit(0)
    for name in BAR_COLUMNS:
        if name != "symbol":
            empty = empty + F.col(name).isNull().cast("int")
    return bars.groupBy("symbol").agg(
        F.sum(empty).alias("null_cells"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("rows"),
    )


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("rows"))
