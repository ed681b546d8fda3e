"""Display text for the dashboard and for alerts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from candlewick.functions.numeric import truthy

# Attachment colours for a rise, a fall and no change.
RISE_COLOR = "#36a64f"
FALL_COLOR = "#d72b3f"
FLAT_COLOR = "#9e9ea6"


def strength_text(value: Column) -> Column:
    """A DECIMAL(10,4) with three decimals, ties to the even digit; `N/A` where it is missing or zero."""
    rounded = F.bround(value.cast("decimal(10,4)"), 3).cast("decimal(10,3)")
    return F.when(truthy(value), rounded.cast("string")).otherwise("N/A")


def alert_title(kind: Column, symbol: Column, price: Column, change_percent: Column) -> Column:
    return F.format_string("[%s] %s: $%,.2f (%+.2f%%)", kind, symbol, price, change_percent)


def alert_color(change_percent: Column) -> Column:
    return F.when(change_percent > 0, RISE_COLOR).when(change_percent < 0, FALL_COLOR).otherwise(FLAT_COLOR)
