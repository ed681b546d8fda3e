"""Hash shards of the symbols: assignment, sharded storage, distribution reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from candlewick.functions.hashing import DEFAULT_SHARDS, shard_number
from candlewick.operators.upsert import upsert


def symbol_shards(symbols: DataFrame, shards: int = DEFAULT_SHARDS) -> DataFrame:
    distinct = symbols.select("symbol").distinct()
    return distinct.withColumn("shard_number", shard_number(F.col("symbol"), shards))


def write_sharded(bars: DataFrame, path: str, shards: int = DEFAULT_SHARDS) -> None:
    """Store bars in one folder per shard. The few folders are spread over all tasks by (shard, symbol)."""
    sharded = bars.withColumn("shard", shard_number(F.col("symbol"), shards))
    sharded.repartition("shard", "symbol").write.mode("overwrite").partitionBy("shard").parquet(path)


def upsert_shard_map(stored: DataFrame, symbols: DataFrame, now, shards: int = DEFAULT_SHARDS) -> DataFrame:
    """Shard map with the given symbols replaced; `now` stamps both times of a replaced row."""
    fresh = symbol_shards(symbols, shards).withColumn("created_at", now).withColumn("updated_at", now)
    return upsert(stored, fresh, ["symbol"])


def lookup(symbols: DataFrame, stored: DataFrame, shards: int = DEFAULT_SHARDS) -> DataFrame:
    """Stored shard of each symbol, or its hash where the map does not hold it."""
    known = stored.select("symbol", F.col("shard_number").alias("stored_shard"))
    return symbols.join(known, "symbol", "left").select(
        "symbol", F.coalesce("stored_shard", shard_number(F.col("symbol"), shards)).alias("shard_number")
    )


def all_symbols(tables: list[DataFrame]) -> DataFrame:
    """Distinct symbols over several shard tables."""
    return reduce(DataFrame.unionByName, [table.select("symbol") for table in tables]).distinct()


def shard_stats(bars: DataFrame, shards: int = DEFAULT_SHARDS) -> DataFrame:
    """Symbols and rows per shard. Rows are first counted per symbol, so each symbol is hashed once and the
    distinct count needs no second pass."""
    per_symbol = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"))
    return per_symbol.groupBy(shard_number(F.col("symbol"), shards).alias("shard_number")).agg(
        F.count(F.lit(1)).alias("symbol_count"), F.sum("rows").alias("record_count")
    )


def distribution(symbols: DataFrame, shards: int = DEFAULT_SHARDS) -> DataFrame:
    """Per shard: symbols, share in percent and deviation from an even spread in percent. Empty shards count."""
    counts = symbol_shards(symbols, shards).groupBy("shard_number").agg(F.count(F.lit(1)).alias("filled"))
    every = symbols.sparkSession.range(1, shards + 1).select(F.col("id").cast("int").alias("shard_number"))
    total = counts.agg(F.sum("filled")).scalar()
    count = F.coalesce("filled", F.lit(0))
    even = total / F.lit(shards)
    return every.join(counts, "shard_number", "left").select(
        "shard_number",
        count.alias("count"),
        F.try_divide(count * 100, total).alias("percent"),
        (F.try_divide(F.abs(count - even), even) * 100).alias("deviation_percent"),
    )


def balance(symbols: DataFrame, shards: int = DEFAULT_SHARDS) -> DataFrame:
    """Largest deviation, its quality class and the balance score."""
    worst = distribution(symbols, shards).agg(F.max("deviation_percent").alias("max_deviation_percent"))
    deviation = F.col("max_deviation_percent")
    return worst.select(
        "max_deviation_percent",
        F.when(deviation < 5, "excellent").when(deviation < 10, "good").otherwise("needs improvement").alias("quality"),
        (100 - deviation).alias("balance_score"),
    )
