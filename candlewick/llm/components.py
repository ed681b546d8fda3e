"""Connected components of links too many for one machine: alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from candlewick.llm.common import release, stored


def local_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index that each of 0..n-1 reaches over the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest node near by: the larger ones (large star) or the smaller ones (small star)."""
    if large:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    near = both.join(lowest, "u")
    if large:
        out = near.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        out = near.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v")).union(
            lowest.select("u", F.col("low").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v): every node with a link, and the smallest node it reaches (itself left out).

    Rounds grow with the logarithm of the longest chain; each is written to the shared folder. A node with many links is
    a skewed join key that Spark splits; its minimum is aggregated before the shuffle.
    """
    now, before = stored(links, "links"), None
    while True:
        sums = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(sums) == before or sums[0] == 0:
            return now
        before = tuple(sums)
        new = stored(_star(_star(now, large=True), large=False), "links")
        release(now)
        now = new
