"""What tables a folder holds, from their footers, and copies whose content is compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, functions as F


def tables_below(spark: SparkSession, root: str) -> dict[str, str]:
    """Name and path of each Parquet table right below a folder: entries named `*.parquet`, or folders that hold such files."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {}
    for entry in files.listStatus(path):
        name = entry.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if name.endswith(".parquet") or entry.isDirectory() and files.globStatus(jvm.org.apache.hadoop.fs.Path(entry.getPath(), "*.parquet")):
            found[name.removesuffix(".parquet")] = entry.getPath().toString()
    return dict(sorted(found.items()))


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application in which counts, minima and maxima of Parquet tables come from the files' footers."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def catalog_profile(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, rows, columns) of each table below a folder. No data page is read: the counts are in the footers."""
    session, profile = footer_session(spark), None
    for name, path in tables_below(spark, root).items():
        frame = session.read.parquet(path)
        row = frame.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(", ".join(frame.columns)).alias("columns"))
        profile = row if profile is None else profile.unionByName(row)
    return session.createDataFrame([], "table_name string, rows bigint, columns string") if profile is None else profile


def content(frame: DataFrame) -> Row:
    """(rows, low, high): the number of rows and two sums of 64-bit hashes of them, equal for equal bags of rows."""
    columns = [F.to_json(F.col(f.name)) if f.dataType.typeName() in ("map", "variant") else F.col(f.name) for f in frame.schema.fields]
    row = F.struct(*columns)
    total = lambda value: F.coalesce(F.sum(value.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    return frame.agg(
        F.count(F.lit(1)).alias("rows"), total(F.xxhash64(row)).alias("low"), total(F.xxhash64(F.lit(1), row)).alias("high")).first()


def copy_table(spark: SparkSession, source: str, target: str) -> int:
    """Copy a Parquet table and check that both sides hold the same rows, by content and not only by count."""
    original = spark.read.parquet(source)
    original.write.mode("errorifexists").parquet(target)
    before, after = content(original), content(spark.read.parquet(target))
    if before != after:
        raise RuntimeError(f"the copy of {source} differs: {after['rows']} rows of {before['rows']}, or other values")
    return after["rows"]
