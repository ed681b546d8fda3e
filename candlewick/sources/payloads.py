"""Vendor payloads to table rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewick.schemas import BAR_COLUMNS, DAILY_PAYLOAD, SYMBOL_PAYLOAD


def read_symbol_payload(spark: SparkSession, path: str) -> DataFrame:
    """Symbol-list responses stored as JSON documents, one per file."""
    return _symbol_rows(spark.read.schema(SYMBOL_PAYLOAD).json(path, multiLine=True))


def symbols_from_payloads(payloads: DataFrame, column: str = "value") -> DataFrame:
    """Symbol-list responses held as JSON text."""
    return _symbol_rows(payloads.select(F.from_json(column, SYMBOL_PAYLOAD).alias("p")).select("p.data"))


def _symbol_rows(parsed: DataFrame) -> DataFrame:
    return parsed.select(F.explode("data.rows").alias("row")).select(
        "row.symbol", "row.name", F.col("row.marketCap").alias("market_cap"), "row.sector"
    )


def bars_from_payloads(payloads: DataFrame, column: str = "value") -> DataFrame:
    """Daily-price responses (symbol, JSON text) to bars. A missing figure counts as 0; a response whose
    `rt_cd` is not `0` holds no rows; an unreadable figure or date leaves NULL for `clean.complete_bars`."""
    body = payloads.select("symbol", F.from_json(column, DAILY_PAYLOAD).alias("p")).filter(F.col("p.rt_cd") == "0")
    item = body.select("symbol", F.explode("p.output").alias("o"))
    return item.select(
        "symbol",
        F.try_to_date(F.col("o.xymd"), "yyyyMMdd").alias("date"),
        *[_figure(F.col(f"o.{source}")).alias(name)
          for source, name in [("open", "open"), ("high", "high"), ("low", "low"), ("clos", "close")]],
        F.coalesce(F.col("o.tvol"), F.lit("0")).try_cast("bigint").alias("volume"),
    )


def _figure(text: Column) -> Column:
    return F.coalesce(text, F.lit("0")).try_cast("double")


def bars_from_history(history: DataFrame, symbol: Column | None = None) -> DataFrame:
    """Vendor history (Date, Open, ..) to bars: lower-case names, spaces to underscores, seven columns, no nulls.
    A row with an unreadable date or volume is left out."""
    named = history.toDF(*[name.lower().replace(" ", "_") for name in history.columns])
    if symbol is not None:
        named = named.withColumn("symbol", symbol)
    return (
        named.withColumn("date", F.col("date").try_cast("date"))
        .withColumn("volume", F.col("volume").try_cast("bigint"))
        .select(*BAR_COLUMNS)
        .na.drop()
    )
