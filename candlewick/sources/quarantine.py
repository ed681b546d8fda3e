"""Bad records set aside: one pass writes good and rejected rows to folders of their own and counts both.

Sources keep what they could not read: CSV and JSON readers put the raw record into `CORRUPT`, typed rows name the columns that
could not be read. Nothing is dropped silently and nothing is read twice to be counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Divided:
    """Rows taken, rows set aside, and how many there are of both."""

    good: DataFrame
    rejected: DataFrame
    n_good: int
    n_rejected: int


def with_corrupt(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A CSV file with a header line; a line that does not fit the schema keeps its text in `CORRUPT`."""
    return spark.read.csv(path, header=True, schema=with_corrupt(schema), mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A file of JSON lines; a line that is no object of the schema keeps its text in `CORRUPT`."""
    return spark.read.json(path, schema=with_corrupt(schema), mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)


def unreadable(schema: StructType) -> Column:
    """The names of the columns that are missing or whose text is no value of their type, an empty list for a good row."""
    bad = [F.when(F.col(f.name).cast("string").try_cast(f.dataType).isNull(), F.lit(f.name)) for f in schema.fields]
    return F.array_compact(F.array(*bad))


def divide(rows: DataFrame, bad: Column, root: str) -> Divided:
    """Write `rows` below `root`, those for which `bad` is true apart from the others, and read both back."""
    spark, seen = rows.sparkSession, Observation()
    marked = rows.withColumn("rejected", F.coalesce(bad, F.lit(False)))
    counted = marked.observe(seen, F.count_if(~F.col("rejected")).alias("good"), F.count_if("rejected").alias("rejected"))
    counted.write.partitionBy("rejected").parquet(root)
    counts = seen.get
    stored = spark.read.schema(StructType([*rows.schema.fields, StructField("rejected", BooleanType())])).parquet(root)
    part = lambda which: stored.where(F.col("rejected") == which).drop("rejected")
    return Divided(part(False), part(True), counts["good"], counts["rejected"])
