"""Path-dependent indicators: exponential averages over the whole history, the newest values alone, and the parabolic SAR.

Spark's window frames cannot refer to their own previous result, but a decaying sum can be put together from blocks. Within a
block of `rows` values the running sum of `value / keep^place`, times `keep^place`, is the decaying sum of the block so far; the
sums at the ends of the blocks before it follow, each weakened by `keep^rows`. So many of them are taken that what is left out
is below the precision of a double. Blocks are long enough that one or two do, and short enough that no power leaves the
range of a double. Values that are NULL are passed over: the average stays as it was.

All windows of a block length share the order (symbol, block, date), so averages of any number cost one more sort, no shuffle.
A symbol's window partition is bounded by the calendar (see `series`).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from candlewick.functions.numeric import ratio
from candlewick.operators.indicators import bollinger, relative_strength, rsi, sma
from candlewick.operators.series import Term, Windows, combine, evaluate, running, source

BLOCK = 1024
#: Sums weakened by less than this no longer change a double.
NEGLIGIBLE = 1e-18
#: Powers of the weight stay below this.
GREATEST = 1e280


def keep_of(span: int) -> float:
    """What an average of `span` keeps of its last value at each step."""
    if span < 1:
        raise ValueError("the span of an average is at least 1")
    return 1 - 2.0 / (span + 1)


def _block(keep: float) -> tuple[int, int]:
    """Rows of a block, and how many blocks before the current one still matter."""
    rows = BLOCK
    while -rows * math.log(keep) > math.log(GREATEST):
        rows //= 2
    while rows * math.log(keep) * 3 > math.log(NEGLIGIBLE):  # long averages
        rows *= 2
    return rows, math.ceil(math.log(NEGLIGIBLE) / (rows * math.log(keep)))


def decaying_sum(windows: Windows, name: str, term: Term, keep: float, weight: float = 1.0) -> Term:
    """Sum of the values so far, each weakened by `keep` for every value since; all but the first count `weight` times."""
    rows, blocks = _block(keep)
    seen = windows.over(f"{name}_seen", F.count, running(), term)
    block = windows.column(f"{name}_block_{rows}", lambda n: F.floor((n - 1) / rows), seen)
    place = windows.column(f"{name}_place_{rows}", lambda n: F.pmod(n - 1, F.lit(rows)), seen)
    label = f"{name}_{keep!r}_{weight!r}".replace(".", "_")
    by_block = Window.partitionBy("symbol", block.column).orderBy("date")
    in_order = Window.partitionBy("symbol").orderBy(block.column, "date")
    weighted = combine(
        lambda x, n, p: F.coalesce(x, F.lit(0.0)) * F.when(n == 1, 1.0).otherwise(weight) * F.pow(F.lit(keep), -p), term, seen, place)
    inside = windows.over(f"{label}_inside", F.sum, by_block.rowsBetween(Window.unboundedPreceding, 0), weighted)
    own = windows.column(f"{label}_own", lambda s, p: s * F.pow(F.lit(keep), p), inside, place)
    carried = Term(F.lit(0.0), own.level)
    for step in range(blocks):
        # At the end of a block: its sum and what it took over.
        end = combine(lambda x, s, p, c: F.when((p == rows - 1) & x.isNotNull(), s + keep**rows * c), term, own, place, carried)
        last = windows.over(f"{label}_end_{step}", lambda c: F.last(c, ignorenulls=True), in_order.rowsBetween(Window.unboundedPreceding, -1), end)
        carried = combine(lambda c: F.coalesce(c, F.lit(0.0)), last)
    whole = combine(lambda x, s, p, c: F.when(x.isNotNull(), s + F.pow(F.lit(keep), p + 1) * c), term, own, place, carried)
    # Rows without a value follow the end of their block, so they take the sum of the last row that has one.
    return windows.over(f"{label}_sum", lambda c: F.last(c, ignorenulls=True), in_order.rowsBetween(Window.unboundedPreceding, 0), whole)


def smoothed(windows: Windows, name: str, term: Term, span: int, mode: str = "recursive") -> Term:
    """Exponential average of a term. `recursive` starts from the first value (e = a * value + (1 - a) * e); `adjusted` divides
    the weighted sum by the sum of weights, so early values are unbiased."""
    if mode not in ("recursive", "adjusted"):
        raise ValueError(f"unknown mode {mode} of an exponential average")
    keep = keep_of(span)
    if keep == 0:
        return windows.over(f"{name}_last", lambda c: F.last(c, ignorenulls=True), running(), term)
    alpha = 1 - keep
    if mode == "recursive":
        return decaying_sum(windows, name, term, keep, alpha)
    seen = windows.over(f"{name}_seen", F.count, running(), term)
    return combine(lambda s, n: ratio(s, (1 - F.pow(F.lit(keep), n)) / alpha), decaying_sum(windows, name, term, keep), seen)


def ema(windows: Windows, period: int, mode: str = "recursive") -> Term:
    return smoothed(windows, "close", source("close"), period, mode)


def macd(windows: Windows, fast: int = 12, slow: int = 26, signal: int = 9, mode: str = "recursive") -> dict[str, Term]:
    """MACD of recursive or adjusted averages; its signal line is such an average too."""
    line = windows.column(
        f"macd_{fast}_{slow}_{mode}", lambda f, s: f - s, ema(windows, fast, mode), ema(windows, slow, mode))
    average = smoothed(windows, f"macd_{fast}_{slow}_{mode}", line, signal, mode)
    return {"macd": line, "macd_signal": average, "macd_histogram": combine(lambda value, mean: value - mean, line, average)}


def with_ema(
    bars: DataFrame,
    averages: dict[str, int] | None = None,
    macd_spans: tuple[int, int, int] | None = None,
    mode: str = "recursive",
    macd_names: tuple[str, str, str] = ("macd", "macd_signal", "macd_histogram"),
) -> DataFrame:
    """Add exponential averages of the close, and optionally MACD (fast, slow, signal)."""
    windows = Windows()
    outputs = {name: ema(windows, span, mode) for name, span in (averages or {}).items()}
    if macd_spans:
        outputs |= dict(zip(macd_names, macd(windows, *macd_spans, mode).values()))
    return evaluate(bars, windows, outputs)


def strict_indicator_table(bars: DataFrame) -> DataFrame:
    """Strict bands, RSI and means with adjusted EMAs and MACD, from one shuffle of the bars."""
    windows = Windows()
    return evaluate(bars, windows, {
        **bollinger(windows, strict=True),
        "rsi": rsi(windows, strict=True),
        **{f"sma_{p}": sma(windows, p, strict=True) for p in (5, 20, 60)},
        **{f"ema_{p}": ema(windows, p, "adjusted") for p in (5, 20, 60)},
        **macd(windows, mode="adjusted"),
    })


def latest_strict(bars: DataFrame, averages: tuple[int, ...] = (5, 20, 60), macd_spans: tuple[int, int, int] = (12, 26, 9)) -> DataFrame:
    """The newest row of each symbol in which every column of the strict table has a value, without building that table.

    A row is complete from bar 60 on if the close moved within its 14 last steps (else RSI is undefined), so its place follows
    from the last move. Counted from there every average is one decaying-weight aggregate. Only the signal line needs
    averages of earlier bars; those are running sums. Bars too old to change a double are left out before either.
    """
    steps, band, least = 14, 20, max(60, *averages)
    fast, slow, signal = (keep_of(span) for span in macd_spans)
    reach = lambda keep: math.ceil(math.log(NEGLIGIBLE) / math.log(keep))
    oldest = max(least, reach(signal) + max(reach(fast), reach(slow)), *(reach(keep_of(p)) for p in averages))
    in_order = Window.partitionBy("symbol").orderBy("date")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    p, age, close, change = F.col("p"), F.col("age"), F.col("close"), F.col("change")
    numbered = bars.select(
        "symbol", "date", "close", "volume", F.row_number().over(in_order).alias("p"), (close - F.lag(close).over(in_order)).alias("change"))
    placed = numbered.select("*", F.max("p").over(whole).alias("n"), F.max(F.when(change != 0, p)).over(whole).alias("moved"))
    placed = placed.withColumn("age", F.least("n", F.col("moved") + (steps - 1)) - p).where(
        (age >= 0) & (age < oldest) & (age + p >= least))

    weight = lambda keep, rows: F.pow(F.lit(keep), rows)
    # Sum of weights of an average's first p values, over the weight of the newest one.
    weights = lambda keep, p: (1 - weight(keep, p)) / (1 - keep)
    # Ages run down to 0, so no power of a weight that is kept grows beyond what its reach allows.
    running_sum = lambda keep: F.sum(close * weight(keep, age)).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    walked = placed.select("*", running_sum(fast).alias("f"), running_sum(slow).alias("s"))
    line = F.col("f") * weight(fast, -age) / weights(fast, p) - F.col("s") * weight(slow, -age) / weights(slow, p)
    near = lambda value, rows: F.when(age < rows, value)
    newest = lambda value: F.max(F.when(age == 0, value))
    found = walked.withColumn("line", near(line, reach(signal))).groupBy("symbol").agg(
        newest(F.col("date")).alias("date"), newest(close).alias("close"), newest(F.col("volume")).alias("volume"), newest(p).alias("p"),
        F.avg(near(close, band)).alias("bb_middle"), F.stddev_samp(near(close, band)).alias("sd"),
        F.avg(near(F.greatest(change, F.lit(0.0)), steps)).alias("gain"), F.avg(near(F.greatest(-change, F.lit(0.0)), steps)).alias("loss"),
        *[F.avg(near(close, period)).alias(f"sma_{period}") for period in averages],
        *[F.sum(close * weight(keep_of(period), age)).alias(f"ema_{period}") for period in averages],
        newest(F.col("line")).alias("macd"), F.sum(F.col("line") * weight(signal, age)).alias("macd_signal"))
    middle, spread, line = F.col("bb_middle"), 2.0 * F.col("sd"), F.col("macd")
    average = F.col("macd_signal") / weights(signal, p)
    return found.select(
        "symbol", "date", "close", "volume", middle, (middle + spread).alias("bb_upper"), (middle - spread).alias("bb_lower"),
        relative_strength(F.col("gain"), F.col("loss"), True).alias("rsi"), *[f"sma_{period}" for period in averages],
        *[(F.col(f"ema_{period}") / weights(keep_of(period), p)).alias(f"ema_{period}") for period in averages],
        line, average.alias("macd_signal"), (line - average).alias("macd_histogram"))


# ---- a fold over a symbol's bars in order -----------------------------------------------------------------------


def _ordered(bars: DataFrame, values: list[str]) -> DataFrame:
    """(symbol, bars): each symbol's bars as one array in order of date, at most one for each calendar day."""
    return bars.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("date", *values))).alias("bars"))


#: Bars whose stops are put into one array at a time, so that no long array grows value by value.
RUN = 64


def with_parabolic_sar(
    bars: DataFrame, step: float = 0.02, limit: float = 0.2, name: str = "parabolic_sar"
) -> DataFrame:
    """Add Wilder's stop-and-reverse line. The first bar has none; the second decides the starting trend.

    A state machine folded over each symbol's bars in order: `stop`, whether the trend is rising, its extreme, its speed.
    """
    values = [c for c in bars.columns if c not in ("symbol", "date")]
    place = lambda i: F.get("bars", i)
    double = lambda c: c.cast("double")

    def state(stop: Column, rising: Column, extreme: Column, speed: Column) -> Column:
        return F.struct(double(stop).alias("stop"), rising.alias("rising"), double(extreme).alias("extreme"), double(speed).alias("speed"))

    def follow(old: Column, i: Column) -> Column:
        """The state after bar i (from 2)."""
        bar, one, two = place(i), place(i - 1), place(i - 2)
        rising, extreme, speed = old["rising"], old["extreme"], old["speed"]
        plain = old["stop"] + speed * (extreme - old["stop"])
        stop = F.when(rising, F.least(plain, one["low"], two["low"])).otherwise(F.greatest(plain, one["high"], two["high"]))

        def turn(stop: Column) -> Column:
            crossed = F.when(rising, bar["low"] < stop).otherwise(bar["high"] > stop)
            beyond = F.when(rising, bar["high"] > extreme).otherwise(bar["low"] < extreme)
            ahead, back = F.when(rising, bar["high"]).otherwise(bar["low"]), F.when(rising, bar["low"]).otherwise(bar["high"])
            return state(
                F.when(crossed, extreme).otherwise(stop), rising != crossed,
                F.when(crossed, back).when(beyond, ahead).otherwise(extreme),
                F.when(crossed, step).when(beyond, F.least(F.lit(limit), speed + step)).otherwise(speed))

        # An array of one, so that the stop is worked out once.
        return F.transform(F.array(double(stop)), turn)[0]

    rising = place(1)["high"] >= place(0)["high"]
    first = state(
        F.when(rising, place(0)["low"]).otherwise(place(0)["high"]), rising,
        F.when(rising, place(1)["high"]).otherwise(place(1)["low"]), F.lit(step))
    n = F.size("bars")

    def run(acc: Column, begin: Column) -> Column:
        """The stops of `RUN` bars, as one more array of `acc.done`."""
        stops = F.aggregate(
            F.sequence(begin, F.least(begin + (RUN - 1), n - 1)), F.struct(acc["now"].alias("now"), F.array().cast("array<double>").alias("stops")),
            lambda some, i: F.transform(F.array(follow(some["now"], i)), lambda new: F.struct(
                new.alias("now"), F.concat(some["stops"], F.array(new["stop"])).alias("stops")))[0])
        return F.transform(F.array(stops), lambda new: F.struct(
            new["now"].alias("now"), F.concat(acc["done"], F.array(new["stops"])).alias("done")))[0]

    start = F.struct(first.alias("now"), F.array(F.array(F.lit(None).cast("double"), first["stop"])).alias("done"))
    begins = F.when(n > 2, F.sequence(F.lit(2), F.greatest(n - 1, F.lit(2)), F.lit(RUN))).otherwise(F.array().cast("array<int>"))
    stops = F.flatten(F.aggregate(begins, start, run)["done"])
    lines = _ordered(bars, values).select("symbol", F.explode(F.arrays_zip(F.col("bars"), F.slice(stops, F.lit(1), n).alias("stops"))).alias("x"))
    columns = {c: F.col("x.bars")[c] for c in ("date", *values)} | {"symbol": F.col("symbol")}
    return lines.select(*[columns[c].alias(c) for c in bars.columns if c != name], F.col("x.stops").alias(name))
