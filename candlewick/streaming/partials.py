"""Keyed state kept as one small Parquet folder per micro-batch and merged when read.

Each micro-batch reduces its rows with a partial aggregate and writes `batch_id=<n>`; a batch that runs again
after a failure overwrites its own folder, so results are counted once. A reader merges the folders with the same
aggregate. Nothing is dropped for being late, and no executor holds state between batches. `fold` replaces the
folders up to a batch by one published snapshot so that reads stay short, `forget` deletes what it covers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from candlewick.sources.snapshots import drop_old_versions, publish_snapshot, read_snapshot

Reduce = Callable[[DataFrame], DataFrame]


AUDIT = "rows bigint, first_event timestamp, last_event timestamp"


def sink(
    stream: DataFrame, reduce: Reduce, root: str, checkpoint: str, seconds: int | None = 30, finish: Reduce | None = None
) -> StreamingQuery:
    """Start writing partials; `seconds` is the trigger interval, None processes what is there and ends.

    With `finish` the reduced rows are written first and `finish` of the written ones is the partial, for steps that read
    their input more than once. Each batch that has rows leaves one row of figures, taken while it is reduced (`audit`).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        folder, seen = f"batch_id={batch_id}", Observation()
        time = F.col("event_time").cast("timestamp") if "event_time" in batch.columns else F.lit(None).cast("timestamp")
        rows = reduce(batch.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.min(time).alias("first_event"), F.max(time).alias("last_event")))
        if finish is None:
            rows.write.mode("overwrite").parquet(f"{root}/partials/{folder}")
        else:
            rows.write.mode("overwrite").parquet(f"{root}/reduced/{folder}")
            stored = batch.sparkSession.read.schema(rows.schema).parquet(f"{root}/reduced/{folder}")
            finish(stored).write.mode("overwrite").parquet(f"{root}/partials/{folder}")
        found = seen.get
        if found["rows"]:
            one = batch.sparkSession.createDataFrame([(found["rows"], found["first_event"], found["last_event"])], AUDIT)
            one.write.mode("overwrite").parquet(f"{root}/audit/{folder}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{seconds} seconds")
    return writer.start()


def _folders(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All batch folders below a path with their `batch_id`."""
    stored = StructType([*schema.fields, StructField("batch_id", LongType())])
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    if not root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], stored)
    return spark.read.schema(stored).parquet(path)


def audit(spark: SparkSession, root: str) -> DataFrame:
    """(batch_id, rows, first_event, last_event) of each micro-batch that had rows. A batch that ran again overwrote its own row."""
    return _folders(spark, f"{root}/audit", StructType.fromDDL(AUDIT)).select("batch_id", "rows", "first_event", "last_event")


def _rows(spark: SparkSession, root: str, schema: StructType, upto: int | None = None) -> DataFrame:
    """The last folded snapshot and the partials after it, up to a batch if given."""
    recent = _folders(spark, f"{root}/partials", schema)
    if upto is not None:
        recent = recent.filter(F.col("batch_id") <= upto)
    folded = read_snapshot(spark, f"{root}/folded")
    if folded is None:
        return recent.drop("batch_id")
    # The snapshot's own batch number is a partition value, so this reads one number from the file listing.
    last = folded.agg(F.max("upto_batch")).scalar()
    later = recent.filter(F.col("batch_id") > F.coalesce(last, F.lit(-1))).drop("batch_id")
    return folded.drop("upto_batch").unionByName(later)


def read(spark: SparkSession, root: str, schema: StructType, merge: Reduce) -> DataFrame:
    """Current state: the last folded snapshot and all later partials, merged."""
    return merge(_rows(spark, root, schema))


def forget(spark: SparkSession, root: str) -> list[int]:
    """Delete the partial folders that the published snapshot covers, once readers of the state before it are done; returns
    their batch numbers. The figures of `audit` stay, one small row a batch."""
    folded = read_snapshot(spark, f"{root}/folded")
    upto = -1 if folded is None else folded.agg(F.max("upto_batch")).first()[0]
    jvm = spark.sparkContext._jvm
    gone = []
    for kind in ("partials", "reduced"):
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/{kind}")
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if files.exists(path):
            for entry in files.listStatus(path):
                name = entry.getPath().getName()
                if name.startswith("batch_id=") and int(name[9:]) <= upto:
                    files.delete(entry.getPath(), True)
                    gone.append(int(name[9:]))
    drop_old_versions(spark, f"{root}/folded")
    return sorted(set(gone))


def fold(spark: SparkSession, root: str, schema: StructType, merge: Reduce, upto: int) -> int | None:
    """Publish the merged state of all batches up to `upto`; the partial folders it covers may then be removed.
    Without any row there is nothing to publish."""
    state = merge(_rows(spark, root, schema, upto)).withColumn("upto_batch", F.lit(upto).cast("bigint"))
    return None if state.isEmpty() else publish_snapshot(state, f"{root}/folded", ["upto_batch"])
