"""As-of merge: each row of one table with the newest row of another that was there at its time.

Both sides are put into one table by key and time, which is cut into time ranges. Inside a range a running `last` over (key, range)
finds the newest right-hand row; what the ranges before leave behind is one row for each key and range, carried on by a
second, much shorter running `last`. A key with a third of all rows is thus spread over as many tasks as it has ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

RANGE_SECONDS = 3600


def as_of_join(left: DataFrame, right: DataFrame, key: str = "symbol", time: str = "event_time", range_seconds: int = RANGE_SECONDS) -> DataFrame:
    """All columns of `left`, and `found`: the other columns of the newest row of `right` with an equal key and a time not after
    the left row's, NULL if there is none.

    Of several right-hand rows of one key and time the greatest counts. Rows of `left` without a key or time find nothing.
    """
    values = [name for name in right.columns if name not in (key, time)]
    newest = right.where(F.col(key).isNotNull() & F.col(time).isNotNull()).groupBy(key, time).agg(F.max(F.struct(*values)).alias("r"))
    kind = newest.schema["r"].dataType
    row = F.struct(*left.columns)
    timed = left.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    both = newest.select(key, time, F.lit(0).alias("side"), F.lit(None).cast(timed.select(row.alias("l")).schema["l"].dataType).alias("l"), "r").unionByName(
        timed.select(key, time, F.lit(1).alias("side"), row.alias("l"), F.lit(None).cast(kind).alias("r")))
    ranged = both.withColumn("range", F.window(time, f"{int(range_seconds)} seconds")["start"])
    inside = Window.partitionBy(key, "range").orderBy(time, "side").rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("near", F.last("r", ignorenulls=True).over(inside))
    before = Window.partitionBy(key).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ends = ranged.groupBy(key, "range").agg(F.max_by("r", F.when(F.col("side") == 0, F.col(time))).alias("end"))
    carried = ends.select(key, "range", F.last("end", ignorenulls=True).over(before).alias("carried"))
    found = local.where("side = 1").join(carried, [key, "range"]).select("l.*", F.coalesce("near", "carried").alias("found"))
    lost = left.where(F.col(key).isNull() | F.col(time).isNull())
    return found.unionByName(lost.withColumn("found", F.lit(None).cast(kind)))
