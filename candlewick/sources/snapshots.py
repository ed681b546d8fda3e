"""Published table snapshots: each version is its own Parquet folder and a one-line pointer names the current one.

A reader resolves the pointer once, so a writer never replaces files under a running query, and a job lost
halfway leaves only an unreferenced folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType


def _file_system(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    return jvm, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, root: str) -> int | None:
    jvm, files = _file_system(spark, root)
    pointer = jvm.org.apache.hadoop.fs.Path(f"{root}/CURRENT")
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        return int(stream.readLine())
    finally:
        stream.close()


def read_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    version = current_version(spark, root)
    return None if version is None else spark.read.parquet(f"{root}/v={version}")


def publish_snapshot(table: DataFrame, root: str, partition_by: list[str] | None = None) -> int:
    """Write `table` as the next version, then move the pointer to it. One writer per root."""
    spark = table.sparkSession
    version = (current_version(spark, root) or 0) + 1
    writer = table.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/v={version}")
    jvm, files = _file_system(spark, root)
    hadoop = jvm.org.apache.hadoop.fs
    fresh = hadoop.Path(f"{root}/CURRENT.{version}")
    out = files.create(fresh, True)
    try:
        out.writeBytes(f"{version}\n")
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = getattr(jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    context.rename(fresh, hadoop.Path(f"{root}/CURRENT"), overwrite)
    return version


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Delete all but the last `keep` published versions; returns the numbers deleted.

    A reader that resolved the pointer earlier may still read an older version: `keep` says how many publications it may take."""
    if keep < 1:
        raise ValueError("the current version stays")
    version = current_version(spark, root)
    if version is None:
        return []
    jvm, files = _file_system(spark, root)
    found = [int(entry.getPath().getName()[2:]) for entry in files.listStatus(jvm.org.apache.hadoop.fs.Path(root))
             if entry.getPath().getName().startswith("v=")]
    old = sorted(number for number in found if number <= version - keep)
    for number in old:
        files.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/v={number}"), True)
    return old


def write_months(table: DataFrame, root: str) -> None:
    """Write a date table in month folders, replacing the months it holds and no others.

    The table may be made of those very months: Spark writes the new folders to a staging folder below `root` and swaps them in
    when the last row is written, so what was read is there until then, and the staging folder keeps what a driver lost while
    swapping did not swap.

    Small months become one file each and Spark splits large ones; files are in order of symbol, so that a filter on it skips
    most of their row groups. Their codec is that which makes them smallest, as a store is written once a day and kept."""
    (
        table.withColumn("month", month_of())
        .hint("rebalance", "month")
        .sortWithinPartitions("month", "symbol", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("month")
        .parquet(root)
    )


def read_months(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """A month-foldered table with its `month`, all its parts; empty where nothing was written yet. A filter on `month` reads those
    folders only."""
    month = StructField("month", StringType())
    parts = stored_parts(spark, root)
    if parts is None:
        return spark.createDataFrame([], StructType([*schema.fields, month]))
    if parts == 1:
        return spark.read.schema(StructType([*schema.fields, month])).parquet(root)
    stored = StructType([*schema.fields, StructField("part", IntegerType()), month])
    return spark.read.schema(stored).parquet(f"{root}/parts={parts}").drop("part")


def stored_parts(spark: SparkSession, root: str) -> int | None:
    """The number of parts a month-foldered table is kept in; None where nothing was written yet."""
    jvm, files = _file_system(spark, root)
    path = jvm.org.apache.hadoop.fs.Path(root)
    names = [entry.getPath().getName() for entry in files.listStatus(path)] if files.exists(path) else []
    parts = [int(name.removeprefix("parts=")) for name in names if name.startswith("parts=")]
    return parts[0] if parts else 1 if any(name.startswith("month=") for name in names) else None


def part_root(root: str, part: int, parts: int) -> str:
    """The folder with the months of one part of a table; of a table in one part its own."""
    return root if parts == 1 else f"{root}/parts={parts}/part={part}"


def part_of(parts: int) -> Column:
    """The part a symbol belongs to. The hash is not the one by which Spark shuffles, so a part's symbols fall on all tasks."""
    return F.pmod(F.xxhash64("symbol"), F.lit(parts)).cast("int")


def month_of(day: str = "date") -> Column:
    return F.date_format(day, "yyyy-MM")


def merge_months(incoming: DataFrame, root: str, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    """Merge rows into a month-foldered table, reading and rewriting only the months the rows fall in."""
    # A list of months: bounded by the calendar, twelve entries a year.
    months = [row[0] for row in incoming.select(month_of()).distinct().collect()]
    stored = read_months(incoming.sparkSession, root, incoming.schema)
    write_months(merge(stored.filter(F.col("month").isin(months)).drop("month"), incoming), root)


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: row count and column list. The counts run as one job."""
    rows = [
        table.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(", ".join(table.columns)).alias("columns")
        )
        for name, table in tables.items()
    ]
    profile = rows[0]
    for row in rows[1:]:
        profile = profile.unionByName(row)
    return profile
