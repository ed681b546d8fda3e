"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # Recording the Python call site of every column expression costs more than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "candlewick", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def written(frame: DataFrame, label: str) -> DataFrame:
    """`frame` written to the shared folder and read again, for results that are used more than once."""
    path = f"{shared_dir(frame.sparkSession)}/written/{label}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    back = frame.sparkSession.read.schema(frame.schema).parquet(path)
    back.stored_at = path
    return back


def release(*frames: DataFrame) -> None:
    """Delete tables made by `written` that no later step reads."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(frame.stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside give up their shuffle files when they end, not when the driver happens to collect its garbage.

    A frame that is run a second time inside shuffles anew."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


_local_dir: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for written tables and stream checkpoints.

    The cluster names it in `spark.checkpoint.dir`. Only a local session, whose driver and executors are one
    process, may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dir:
        _local_dir[app] = tempfile.mkdtemp(prefix="candlewick-")
    return _local_dir[app]
