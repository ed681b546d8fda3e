"""Window columns over each symbol's bars, collected first and evaluated together.

An indicator is a function that asks a `Windows` collector for the window columns it needs and returns its final
expression. The collector keeps one dictionary per level, where a level may read only columns of the levels below
it. `evaluate` then adds one `select` per level. All levels share one partitioning and order, so any number of
indicators costs a single shuffle and sort of the bars, and equal window columns are computed once.

Bars are unique by (symbol, date) and dates have day grain, so a window partition is bounded by the calendar
(about 37,000 rows for a century) however the rows are spread over symbols.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

# Longest frame evaluated directly. Spark re-reads a sliding frame for every row, so longer means add up
# a few lagged sums of shorter frames instead.
LONGEST_FRAME = 60


def by_symbol() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("date")


def running() -> WindowSpec:
    return by_symbol().rowsBetween(Window.unboundedPreceding, 0)


def trailing(rows: int) -> WindowSpec:
    """The current row and the `rows - 1` rows before it."""
    return by_symbol().rowsBetween(1 - rows, 0)


@dataclass(frozen=True)
class Term:
    """A column expression and the first level at which it can be read."""

    column: Column
    level: int = 0


def source(name: str) -> Term:
    return Term(F.col(name))


def combine(build: Callable[..., Column], *terms: Term) -> Term:
    """A row-wise expression over terms."""
    return Term(build(*[term.column for term in terms]), max(term.level for term in terms))


@dataclass
class Windows:
    levels: list[dict[str, Column]] = field(default_factory=list)

    def over(self, name: str, aggregate: Callable[[Column], Column], frame: WindowSpec, term: Term) -> Term:
        """Add `aggregate(term) OVER frame` as a hidden column; the same name means the same column."""
        while len(self.levels) <= term.level:
            self.levels.append({})
        hidden = f"__{name}"
        self.levels[term.level].setdefault(hidden, aggregate(term.column).over(frame))
        return Term(F.col(hidden), term.level + 1)

    def column(self, name: str, build: Callable[..., Column], *terms: Term) -> Term:
        """A row-wise expression as a hidden column of its own, which windows may name in their partitioning and order."""
        term = combine(build, *terms)
        while len(self.levels) <= term.level:
            self.levels.append({})
        self.levels[term.level].setdefault(f"__{name}", term.column)
        return Term(F.col(f"__{name}"), term.level + 1)

    def position(self) -> Term:
        """1-based row number within the symbol."""
        return self.over("position", lambda _: F.row_number(), by_symbol(), Term(F.lit(None)))

    def lag(self, name: str, term: Term, rows: int = 1, default=None) -> Term:
        return self.over(f"{name}_lag_{rows}", lambda c: F.lag(c, rows, default), by_symbol(), term)

    def total(self, name: str, term: Term, rows: int) -> Term:
        return self.over(f"{name}_sum_{rows}", F.sum, trailing(rows), term)

    def mean(self, name: str, term: Term, rows: int) -> Term:
        """Mean of the values that are not NULL among the last `rows` rows (fewer at the start of a series); NULL
        without any. Beyond `LONGEST_FRAME` rows it is put together from lagged sums, and from a running count."""
        block = max((n for n in range(1, min(rows, LONGEST_FRAME) + 1) if rows % n == 0), default=rows)
        if rows <= LONGEST_FRAME or block == 1:
            return self.over(f"{name}_mean_{rows}", F.avg, trailing(rows), term)
        part = self.total(name, term, block)
        parts = [part] + [
            self.lag(f"{name}_sum_{block}", part, block * i) for i in range(1, rows // block)
        ]
        seen = self.over(f"{name}_seen", F.count, running(), term)
        before = self.lag(f"{name}_seen", seen, rows, 0)

        def build(seen: Column, before: Column, *sums: Column) -> Column:
            known = [F.coalesce(value, F.lit(0.0)) for value in sums]
            return F.when(seen > before, sum(known[1:], known[0]) / (seen - before))

        return combine(build, seen, before, *parts)

    def deviation(self, name: str, term: Term, rows: int) -> Term:
        """Sample standard deviation of the last `rows` values; NULL on a single value."""
        return self.over(f"{name}_sd_{rows}", F.stddev_samp, trailing(rows), term)

    def full(self, term: Term, rows: int) -> Term:
        """The term where the symbol already has `rows` rows, else NULL."""
        return combine(lambda value, position: F.when(position >= rows, value), term, self.position())


def evaluate(bars: DataFrame, windows: Windows, outputs: dict[str, Term], keep: list[str] | None = None) -> DataFrame:
    """Bars plus the output columns. `keep` limits the bar columns of the result."""
    frame = bars
    for level in windows.levels:
        frame = frame.select("*", *[column.alias(name) for name, column in level.items()])
    kept = [name for name in (keep or bars.columns) if name not in outputs]
    return frame.select(*kept, *[term.column.alias(name) for name, term in outputs.items()])
