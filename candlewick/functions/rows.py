"""Row shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(frame: DataFrame, *columns: Column) -> DataFrame:
    """Select costly columns by way of a one-element `inline`.

    A filter on the result stays above it. Pushed below a plain `select` it would repeat each expression it names,
    and every expression those are made of.
    """
    return frame.select(F.inline(F.array(F.struct(*columns))))
