"""Exact order statistics by distributed selection.

Equal values are counted first. Then, pass by pass, approximate quantiles of what is left cut each group's range into pieces, exact
counts tell which piece holds the wanted element, and only that piece goes on; a pass leaves about one value in `CUTS`. Once
no group has more than `MOST` distinct values left, these are put in order. So no task orders more than `MOST` values of a group
and every count has a partial step, however the values lie.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from candlewick.session import written

CUTS = 64
MOST = 4096


def _reached(parts: Column, wanted: Column) -> Column:
    """The first of some (..., n) in order with which `wanted` + 1 elements are reached, and `before`, the elements before it."""
    kind = lambda p, before: F.struct(p.alias("part"), before.alias("before"), (before + p["n"]).alias("until"))
    start = F.struct(F.get(parts, F.lit(0)).alias("part"), F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("until"))
    return F.aggregate(parts, start, lambda state, p: F.when(state["until"] > wanted, state).otherwise(kind(p, state["until"])))


def select_element(
    rows: DataFrame, value: str, by: list[str] | None, place: Callable[[Column], Column], name: str, cuts: int = CUTS, most: int = MOST
) -> DataFrame:
    """For each group (`by`; none: all rows) the element at `place(n)`, counted from 0, of its n values in order. NULLs are left out."""
    by = by or []
    counts = written(
        rows.where(F.col(value).isNotNull()).groupBy(*[F.col(c).alias(f"k{i}") for i, c in enumerate(by)], F.col(value).cast("double").alias("v"))
        .agg(F.count(F.lit(1)).alias("n")), "values")
    key = [f"k{i}" for i in range(len(by))]
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in key] or [F.lit(True)]
    ranges = written(
        counts.groupBy(*key).agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("values"))
        .where("n > 0").select(*key, place(F.col("n")).cast("long").alias("wanted"), "low", "high", "values"), "ranges")

    def within(ranges: DataFrame) -> DataFrame:
        on = F.lit(True)
        for condition in same("c", "r"):
            on = on & condition
        return counts.alias("c").join(ranges.alias("r"), on & (F.col("v") >= F.col("low")) & (F.col("v") <= F.col("high"))).select(
            *[F.col(f"r.{k}") for k in key], "v", "n", "wanted", "low", "high", "cuts" if "cuts" in ranges.columns else F.lit(None).alias("cuts"))

    while (ranges.agg(F.max("values")).first()[0] or 0) > most:
        wide, narrow = ranges.where(F.col("values") > most), ranges.where(F.col("values") <= most)
        points = F.percentile_approx("v", F.array(*[F.lit(i / cuts) for i in range(1, cuts)]), F.lit(20 * cuts)).alias("cuts")
        cut = written(within(wide).groupBy(*key, "wanted", "low", "high").agg(points), "cuts")
        # A piece ends with its cut: the number of cuts below a value is its piece.
        pieces = within(cut).select(*key, "wanted", "v", "n", F.size(F.filter("cuts", lambda c: c < F.col("v"))).alias("piece"))
        sums = pieces.groupBy(*key, "wanted", "piece").agg(
            F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("values"))
        parts = sums.groupBy(*key, "wanted").agg(F.array_sort(F.collect_list(F.struct("piece", "n", "low", "high", "values"))).alias("parts"))
        found = parts.withColumn("at", _reached(F.col("parts"), F.col("wanted"))).select(
            *key, (F.col("wanted") - F.col("at.before")).alias("wanted"), "at.part.low", "at.part.high", "at.part.values")
        ranges = written(found.unionByName(narrow), "ranges")

    last = within(ranges).groupBy(*key, "wanted").agg(F.array_sort(F.collect_list(F.struct("v", "n"))).alias("parts"))
    return last.select(*[F.col(k).alias(c) for k, c in zip(key, by)], _reached(F.col("parts"), F.col("wanted"))["part"]["v"].alias(name))


def upper_median(rows: DataFrame, value: str, by: list[str] | None = None, cuts: int = CUTS, most: int = MOST) -> DataFrame:
    """Exact element n // 2 (0-based) of each group's values in order."""
    return select_element(rows, value, by, lambda n: F.floor(n / 2), "upper_median", cuts, most)
