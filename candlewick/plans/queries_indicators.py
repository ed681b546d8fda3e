"""Registered indicator queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from candlewick.operators import declared, indicators as ind, recursive
from candlewick.plans import daily
from candlewick.plans.catalog import BY_DATE, over, register
from candlewick.plans.inputs import bars, weekly
from candlewick.session import shared_dir
from candlewick.sources.files import DEFAULT_REGISTRY, registry_entries
from candlewick.sources.snapshots import read_months

KEY = "symbol:s date:d "


def _mean(period: int, value: str = "close") -> str:
    return f"avg({value}) {over(period)}"


def _strict(period: int, value: str) -> str:
    return f"CASE WHEN row_number() {BY_DATE} >= {period} THEN {value} END"


def _blend(period: int) -> str:
    alpha = 2.0 / (period + 1.0)
    return f"({_mean(period)} * CAST({1 - alpha!r} AS DOUBLE) + close * CAST({alpha!r} AS DOUBLE))"


SMA_PERIODS = (5, 20, 60, 112, 224, 448)


@register(
    "sma_all", KEY + " ".join(f"sma_{p}:6" for p in SMA_PERIODS),
    f"SELECT symbol, date, {', '.join(f'{_mean(p)} AS sma_{p}' for p in SMA_PERIODS)} FROM bars", "bars",
)
def sma_all(spark, folder):
    return ind.sma_table(bars(spark, folder), SMA_PERIODS)


GAP_PERIODS = (60, 61, 64, 120)


@register(
    "sma_gaps", KEY + " ".join(f"sma_{p}:4" for p in GAP_PERIODS),
    f"""SELECT symbol, date, {', '.join(f'{_mean(p)} AS sma_{p}' for p in GAP_PERIODS)}
        FROM (SELECT symbol, date, CASE WHEN volume % 3 = 0 THEN close END AS close FROM bars)""", "bars",
)
def sma_gaps(spark, folder):
    """Means of closes of which two thirds are NULL, on both sides of the longest direct frame."""
    gaps = bars(spark, folder).withColumn("close", F.when(F.col("volume") % 3 == 0, F.col("close")))
    return ind.sma_table(gaps, GAP_PERIODS)


@register(
    "sma_strict",KEY + "sma_5:6 sma_20:6 sma_60:6",
    f"SELECT symbol, date, {', '.join(f'{_strict(p, _mean(p))} AS sma_{p}' for p in (5, 20, 60))} FROM bars", "bars",
)
def sma_strict(spark, folder):
    return ind.sma_table(bars(spark, folder), (5, 20, 60), strict=True)


BANDS = KEY + "close:6 bb_middle:6 bb_upper:6 bb_lower:6"


@register(
    "bollinger_partial", BANDS,
    "SELECT symbol, date, close, m AS bb_middle, m + 2 * sd AS bb_upper, m - 2 * sd AS bb_lower FROM bands", "bands",
)
def bollinger_partial(spark, folder):
    return ind.bollinger_table(bars(spark, folder))


@register(
    "bollinger_strict", BANDS,
    f"""SELECT symbol, date, close, {_strict(20, 'm')} AS bb_middle, {_strict(20, 'm + 2 * sd')} AS bb_upper,
               {_strict(20, 'm - 2 * sd')} AS bb_lower FROM bands""", "bands",
)
def bollinger_strict(spark, folder):
    return ind.bollinger_table(bars(spark, folder), strict=True)


MOVES = f"""moves AS (SELECT *, greatest(coalesce(change, 0), 0) AS gain, greatest(-coalesce(change, 0), 0) AS loss
    FROM (SELECT *, close - lag(close) {BY_DATE} AS change FROM bars))"""
RSI = "100 - 100 / (1 + g / nullif(l, 0))"


def _rsi_source(period: int = 14) -> str:
    return f"(SELECT symbol, date, {_mean(period, 'gain')} AS g, {_mean(period, 'loss')} AS l FROM moves)"


@register("rsi_batch", KEY + "rsi:6", f"SELECT symbol, date, {RSI} AS rsi FROM {_rsi_source()}", "bars", MOVES)
def rsi_batch(spark, folder):
    return ind.rsi_table(bars(spark, folder))


STRICT_RSI = _strict(14, f"CASE WHEN l = 0 AND g > 0 THEN 100 ELSE {RSI} END")


@register(
    "rsi_strict", KEY + "rsi:6", f"SELECT symbol, date, {STRICT_RSI} AS rsi FROM {_rsi_source()}", "bars", MOVES
)
def rsi_strict(spark, folder):
    return ind.rsi_table(bars(spark, folder), strict=True)


TYPICAL = f"""typical AS (SELECT symbol, date, tp, avg(tp) {over(20)} AS m,
    list(tp) {over(20)} AS frame FROM (SELECT *, (high + low + close) / 3 AS tp FROM weekly))"""


@register(
    "cci_rowwise", KEY + "cci:4",
    f"""SELECT symbol, date, (tp - m) / nullif(0.015e0 * avg(abs(tp - m)) {over(20)}, 0) AS cci FROM typical""",
    "weekly", TYPICAL,
)
def cci_rowwise(spark, folder):
    return ind.cci_table(weekly(spark, folder))


@register(
    "cci_textbook", KEY + "cci:4",
    """SELECT symbol, date, (tp - m) / nullif(0.015e0 * list_avg(list_transform(frame, lambda v: abs(v - m))), 0) AS cci
       FROM typical""",
    "weekly", TYPICAL,
)
def cci_textbook(spark, folder):
    return ind.cci_table(weekly(spark, folder), mode="textbook")


OBV = f"""sum(CASE WHEN change > 0 THEN volume WHEN change < 0 THEN -volume ELSE 0 END) {BY_DATE}"""


@register("obv", KEY + "obv:i", f"SELECT symbol, date, {OBV} AS obv FROM moves", "bars", MOVES)
def obv(spark, folder):
    return ind.obv_table(bars(spark, folder))


@register("price_change", KEY + "price_change:6", "SELECT symbol, date, change AS price_change FROM moves", "bars", MOVES)
def price_change(spark, folder):
    return ind.price_change_table(bars(spark, folder))


BLEND_PERIODS = (5, 20, 60, 12, 26)


@register(
    "ema_blend", KEY + " ".join(f"ema_{p}:6" for p in BLEND_PERIODS),
    f"SELECT symbol, date, {', '.join(f'{_blend(p)} AS ema_{p}' for p in BLEND_PERIODS)} FROM bars", "bars",
)
def ema_blend(spark, folder):
    return ind.ema_blend_table(bars(spark, folder), BLEND_PERIODS)


MACD = "macd:6 macd_signal:6 macd_histogram:6"
MACD_SOURCE = f"""(SELECT *, avg(macd) {over(9)} AS macd_signal
    FROM (SELECT *, {_blend(12)} - {_blend(26)} AS macd FROM bars))"""


@register(
    "macd_batch", KEY + MACD,
    f"SELECT symbol, date, macd, macd_signal, macd - macd_signal AS macd_histogram FROM {MACD_SOURCE}", "bars",
)
def macd_batch(spark, folder):
    return ind.macd_table(bars(spark, folder))


NUMBERED = f"""numbered AS MATERIALIZED
    (SELECT symbol, date, close, row_number() {BY_DATE} AS i FROM bars)"""
STEP = "FROM walk w JOIN numbered n ON n.symbol = w.symbol AND n.i = w.i + 1"


def _move(before: str, value: str, span: int) -> str:
    return f"({value} * (2e0 / {span + 1}) + {before} * (1 - 2e0 / {span + 1}))"


RECURSIVE_PERIODS = (5, 20, 60)
EMA_WALK = f"""{NUMBERED}, walk AS (
    SELECT symbol, date, i, {', '.join(f'close AS e{p}' for p in RECURSIVE_PERIODS)} FROM numbered WHERE i = 1
    UNION ALL SELECT n.symbol, n.date, n.i, {', '.join(_move(f'w.e{p}', 'n.close', p) for p in RECURSIVE_PERIODS)} {STEP})"""
EMA_COLUMNS = KEY + " ".join(f"ema_{p}:6~" for p in RECURSIVE_PERIODS)


@register(
    "ema_recursive", EMA_COLUMNS,
    f"SELECT symbol, date, {', '.join(f'e{p} AS ema_{p}' for p in RECURSIVE_PERIODS)} FROM walk", "bars", EMA_WALK,
)
def ema_recursive(spark, folder):
    return recursive.with_ema(
        bars(spark, folder).select("symbol", "date", "close"), {f"ema_{p}": p for p in RECURSIVE_PERIODS}
    )


def _keep(span: int) -> str:
    return f"(1 - 2e0 / {span + 1})"


ADJUSTED_WALK = f"""{NUMBERED}, walk AS (
    SELECT symbol, date, i, {', '.join(f'close AS n{p}, 1e0 AS d{p}' for p in RECURSIVE_PERIODS)} FROM numbered WHERE i = 1
    UNION ALL SELECT n.symbol, n.date, n.i,
        {', '.join(f'n.close + {_keep(p)} * w.n{p}, 1 + {_keep(p)} * w.d{p}' for p in RECURSIVE_PERIODS)} {STEP})"""


@register(
    "ema_adjusted", EMA_COLUMNS,
    f"SELECT symbol, date, {', '.join(f'n{p} / d{p} AS ema_{p}' for p in RECURSIVE_PERIODS)} FROM walk",
    "bars", ADJUSTED_WALK,
)
def ema_adjusted(spark, folder):
    return recursive.with_ema(
        bars(spark, folder).select("symbol", "date", "close"),
        {f"ema_{p}": p for p in RECURSIVE_PERIODS}, mode="adjusted",
    )


_F, _S = _move("w.f", "n.close", 12), _move("w.s", "n.close", 26)
MACD_WALKED = MACD.replace(":6", ":6~")
MACD_WALK = f"""{NUMBERED}, walk AS (
    SELECT symbol, date, i, close AS f, close AS s, 0e0 AS g FROM numbered WHERE i = 1
    UNION ALL SELECT n.symbol, n.date, n.i, {_F}, {_S}, {_move('w.g', f'({_F} - {_S})', 9)} {STEP})"""


@register(
    "macd_realtime", KEY + MACD_WALKED,
    "SELECT symbol, date, f - s AS macd, g AS macd_signal, f - s - g AS macd_histogram FROM walk", "bars", MACD_WALK,
)
def macd_realtime(spark, folder):
    return recursive.with_ema(bars(spark, folder).select("symbol", "date", "close"), macd_spans=(12, 26, 9))


_FN, _FD = f"(n.close + {_keep(12)} * w.fn)", f"(1 + {_keep(12)} * w.fd)"
_SN, _SD = f"(n.close + {_keep(26)} * w.sn)", f"(1 + {_keep(26)} * w.sd)"
MACD_ADJUSTED_WALK = f"""{NUMBERED}, walk AS (
    SELECT symbol, date, i, close AS fn, 1e0 AS fd, close AS sn, 1e0 AS sd, 0e0 AS gn, 1e0 AS gd FROM numbered WHERE i = 1
    UNION ALL SELECT n.symbol, n.date, n.i, {_FN}, {_FD}, {_SN}, {_SD},
        {_FN} / {_FD} - {_SN} / {_SD} + {_keep(9)} * w.gn, 1 + {_keep(9)} * w.gd {STEP})"""


@register(
    "macd_adjusted", KEY + MACD_WALKED,
    """SELECT symbol, date, fn / fd - sn / sd AS macd, gn / gd AS macd_signal,
              fn / fd - sn / sd - gn / gd AS macd_histogram FROM walk""", "bars", MACD_ADJUSTED_WALK,
)
def macd_adjusted(spark, folder):
    return recursive.with_ema(
        bars(spark, folder).select("symbol", "date", "close"), macd_spans=(12, 26, 9), mode="adjusted"
    )


# ---- whole tables ---------------------------------------------------------------------------------------------

TABLE_SQL = f"""
    SELECT symbol, date, m AS bb_middle, m + 2 * sd AS bb_upper, m - 2 * sd AS bb_lower,
           macd, macd_signal, macd - macd_signal AS macd_histogram, {RSI} AS rsi,
           (tp - tm) / nullif(0.015e0 * avg(abs(tp - tm)) {over(20)}, 0) AS cci,
           obv, sma_5, sma_20, sma_60, ema_5, ema_20, ema_60, ma_112, ma_224, ma_448
    FROM (SELECT *, avg(macd) {over(9)} AS macd_signal, {_mean(14, 'gain')} AS g, {_mean(14, 'loss')} AS l,
                 {OBV} AS obv
          FROM (SELECT *, {_blend(12)} - {_blend(26)} AS macd, (high + low + close) / 3 AS tp,
                       avg((high + low + close) / 3) {over(20)} AS tm, stddev_samp(close) {over(20)} AS sd,
                       avg(close) {over(20)} AS m,
                       {', '.join(f'{_mean(p)} AS sma_{p}, {_blend(p)} AS ema_{p}' for p in (5, 20, 60))},
                       {', '.join(f'{_mean(p)} AS ma_{p}' for p in (112, 224, 448))}
                FROM moves))"""


@register(
    "indicator_table",
    KEY + "bb_upper:6 bb_middle:6 bb_lower:6 " + MACD + " rsi:6 sma_5:6 sma_20:6 sma_60:6 ema_5:6 ema_20:6 ema_60:6 "
    "cci:4 obv:i ma_112:6 ma_224:6 ma_448:6",
    TABLE_SQL, "bars", MOVES,
)
def indicator_table(spark, folder):
    return ind.indicator_table(bars(spark, folder))


def deliveries(rows: DataFrame) -> list[DataFrame]:
    """The bars as three deliveries, `line` being the order in which rows came.

    The first ends in June 1997 and has wrong prices for a fifth of the symbols, of which it lacks some days; the second begins
    a month earlier and holds a seventh of its bars twice, first with wrong prices; the third is old: what the first got wrong.
    """
    prices = ["open", "high", "low", "close"]
    wrong = lambda bars: bars.withColumns({name: F.col(name) * 1.5 for name in prices})
    day = F.datediff("date", F.lit("1990-01-01"))
    fifth = F.substring("symbol", 2, 20).cast("long") % 5 == 0
    lost, twice = fifth & (day % 50 == 0), day % 7 == 0
    early, late = rows.where("date < '1997-07-01'"), rows.where("date >= '1997-06-01'")
    line = lambda bars, n: bars.withColumn("line", F.lit(n))
    return [
        line(wrong(early.where(fifth & ~lost)).unionByName(early.where(~fifth)), 0),
        line(wrong(late.where(twice)), 0).unionByName(line(late, 1)),
        line(early.where(fifth), 0),
    ]


@register(
    "daily_store",
    KEY + "bb_upper:6~ bb_middle:6~ bb_lower:6~ " + MACD_WALKED + " rsi:6~ sma_5:6~ sma_20:6~ sma_60:6~ ema_5:6~ ema_20:6~ ema_60:6~ "
    "cci:3~ obv:i ma_112:6~ ma_224:6~ ma_448:6~",
    TABLE_SQL, "bars", MOVES,
)
def daily_store(spark, folder):
    """The stored indicators after overlapping, repeated and old deliveries."""
    root = f"{shared_dir(spark)}/daily/{uuid.uuid4().hex}"
    for delivery in deliveries(bars(spark, folder)):
        daily.store_delivery(delivery, f"{root}/bars", f"{root}/indicators", "line")
    return read_months(spark, f"{root}/indicators", ind.indicator_table(bars(spark, folder)).schema)


LATEST_WALK = f"""{NUMBERED}, walk AS (
    SELECT symbol, date, i, close AS fn, 1e0 AS fd, close AS sn, 1e0 AS sd, 0e0 AS gn, 1e0 AS gd,
           {', '.join(f'close AS n{p}, 1e0 AS d{p}' for p in RECURSIVE_PERIODS)} FROM numbered WHERE i = 1
    UNION ALL SELECT n.symbol, n.date, n.i, {_FN}, {_FD}, {_SN}, {_SD},
        {_FN} / {_FD} - {_SN} / {_SD} + {_keep(9)} * w.gn, 1 + {_keep(9)} * w.gd,
        {', '.join(f'n.close + {_keep(p)} * w.n{p}, 1 + {_keep(p)} * w.d{p}' for p in RECURSIVE_PERIODS)} {STEP}), {MOVES}"""


@register(
    "latest_indicators",
    KEY + "close:6 volume:i bb_middle:6 bb_upper:6 bb_lower:6 rsi:6 sma_5:6 sma_20:6 sma_60:6 "
    "ema_5:6 ema_20:6 ema_60:6 " + MACD,
    f"""SELECT * FROM (
          SELECT symbol, date, close, volume, {_strict(20, 'm')} AS bb_middle, {_strict(20, 'm + 2 * sd')} AS bb_upper,
                 {_strict(20, 'm - 2 * sd')} AS bb_lower, {STRICT_RSI} AS rsi,
                 {', '.join(f'{_strict(p, f"s{p}")} AS sma_{p}' for p in (5, 20, 60))}
          FROM (SELECT *, avg(close) {over(20)} AS m, stddev_samp(close) {over(20)} AS sd,
                       {', '.join(f'{_mean(p)} AS s{p}' for p in (5, 20, 60))},
                       {_mean(14, 'gain')} AS g, {_mean(14, 'loss')} AS l FROM moves))
        JOIN (SELECT symbol, date, fn / fd - sn / sd AS macd, gn / gd AS macd_signal,
                     fn / fd - sn / sd - gn / gd AS macd_histogram,
                     {', '.join(f'n{p} / d{p} AS ema_{p}' for p in RECURSIVE_PERIODS)} FROM walk) USING (symbol, date)
        WHERE sma_60 IS NOT NULL AND rsi IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1""",
    "bars", LATEST_WALK,
)
def latest_indicators(spark, folder):
    return recursive.latest_strict(bars(spark, folder))


# ---- declared types -------------------------------------------------------------------------------------------


def _declared(name: str, kind: str, sql: str, digits: int = 6, extra: str = "", **parameters) -> None:
    """Register one declared indicator over weekly bars; `sql` selects symbol, date and `value`."""

    @register(f"x_{name}", KEY + f"value:{digits}", sql, "weekly", extra)
    def build(spark, folder):
        return declared.registry_table(weekly(spark, folder), [("value", kind, parameters)])


def _range(rows: int) -> str:
    return f"max(high) {over(rows)} AS hh, min(low) {over(rows)} AS ll"


def _mid(rows: int) -> str:
    return f"(max(high) {over(rows)} + min(low) {over(rows)}) / 2"


STOCH = f"(SELECT symbol, date, 100 * (close - ll) / nullif(hh - ll, 0) AS k FROM (SELECT *, {_range(14)} FROM weekly))"
TRUE_RANGE = f"""ranges AS (SELECT *, greatest(high - low, abs(high - pc), abs(low - pc)) AS tr,
    CASE WHEN high - ph > pl - low AND high - ph > 0 THEN high - ph ELSE 0 END AS pdm,
    CASE WHEN pl - low > high - ph AND pl - low > 0 THEN pl - low ELSE 0 END AS mdm
    FROM (SELECT *, lag(close) {BY_DATE} AS pc, lag(high) {BY_DATE} AS ph, lag(low) {BY_DATE} AS pl FROM weekly))"""
FLOWS = """flows AS (SELECT *, coalesce(((close - low) - (high - close)) / nullif(high - low, 0), 0) * volume AS mfv
    FROM weekly)"""
WEEKLY_MOVES = MOVES.replace("FROM bars", "FROM weekly")
W_BANDS = f"""(SELECT *, avg(close) {over(20)} AS m, stddev_samp(close) {over(20)} AS sd FROM weekly)"""

_declared("sma_10", "SMA", f"SELECT symbol, date, {_mean(10)} AS value FROM weekly", period=10)
_declared("sma_50", "SMA", f"SELECT symbol, date, {_mean(50)} AS value FROM weekly", period=50)
_declared("sma_200", "SMA", f"SELECT symbol, date, {_mean(200)} AS value FROM weekly", period=200)
_declared("ema_12", "EMA", f"SELECT symbol, date, {_blend(12)} AS value FROM weekly", period=12)
_declared("ema_26", "EMA", f"SELECT symbol, date, {_blend(26)} AS value FROM weekly", period=26)
for _period in (7, 21):
    _declared(
        f"rsi_{_period}", "RSI", f"SELECT symbol, date, {RSI} AS value FROM {_rsi_source(_period)}",
        extra=WEEKLY_MOVES, period=_period,
    )
_declared("stoch_k", "STOCH_K", f"SELECT symbol, date, k AS value FROM {STOCH}", period=14)
_declared("stoch_d", "STOCH_D", f"SELECT symbol, date, avg(k) {over(3)} AS value FROM {STOCH}", period=3)
_declared(
    "williams_r", "WILLIAMS_R",
    f"SELECT symbol, date, -100 * (hh - close) / nullif(hh - ll, 0) AS value FROM (SELECT *, {_range(14)} FROM weekly)",
    period=14,
)
_declared(
    "roc", "ROC",
    f"SELECT symbol, date, 100 * (close - lag(close, 12) {BY_DATE}) / nullif(lag(close, 12) {BY_DATE}, 0) AS value FROM weekly",
    period=12,
)
_declared("atr", "ATR", f"SELECT symbol, date, avg(tr) {over(14)} AS value FROM ranges", extra=TRUE_RANGE, period=14)
_declared("bb_width", "BB_WIDTH", f"SELECT symbol, date, (m + 2 * sd) - (m - 2 * sd) AS value FROM {W_BANDS}", period=20)
_declared(
    "bb_percent", "BB_PERCENT",
    f"SELECT symbol, date, (close - (m - 2 * sd)) / nullif((m + 2 * sd) - (m - 2 * sd), 0) AS value FROM {W_BANDS}",
    period=20,
)
_declared(
    "vwap", "VWAP",
    f"""SELECT symbol, date, sum((high + low + close) / 3 * volume) {over(20)} / nullif(sum(volume) {over(20)}, 0) AS value
        FROM weekly""", period=20,
)
_declared("ad_line", "AD_LINE", f"SELECT symbol, date, sum(mfv) {BY_DATE} AS value FROM flows", 4, FLOWS, period=14)
_declared(
    "cmf", "CMF", f"SELECT symbol, date, sum(mfv) {over(20)} / nullif(sum(volume) {over(20)}, 0) AS value FROM flows",
    extra=FLOWS, period=20,
)
_declared(
    "macd_8_21", "MACD", f"SELECT symbol, date, {_blend(8)} - {_blend(21)} AS value FROM weekly", fast=8, slow=21
)
_declared(
    "adx", "ADX",
    f"""SELECT symbol, date, avg(dx) {over(14)} AS value FROM (
          SELECT symbol, date, 100 * abs(p - q) / nullif(p + q, 0) AS dx FROM (
            SELECT symbol, date, 100 * avg(pdm) {over(14)} / nullif(avg(tr) {over(14)}, 0) AS p,
                   100 * avg(mdm) {over(14)} / nullif(avg(tr) {over(14)}, 0) AS q FROM ranges))""",
    extra=TRUE_RANGE, period=14,
)
for _name, _level in (("fib_23_6", 0.236), ("fib_38_2", 0.382), ("fib_61_8", 0.618)):
    _declared(
        _name, "FIBONACCI",
        f"SELECT symbol, date, hh - {_level}e0 * (hh - ll) AS value FROM (SELECT *, {_range(60)} FROM weekly)",
        level=_level,
    )
_declared("tenkan_sen", "ICHIMOKU_TENKAN", f"SELECT symbol, date, {_mid(9)} AS value FROM weekly", period=9)
_declared("kijun_sen", "ICHIMOKU_KIJUN", f"SELECT symbol, date, {_mid(26)} AS value FROM weekly", period=26)
_declared(
    "senkou_span_a", "ICHIMOKU_SENKOU_A",
    f"""SELECT symbol, date, lag(v, 26) {BY_DATE} AS value
        FROM (SELECT symbol, date, ({_mid(9)} + {_mid(26)}) / 2 AS v FROM weekly)""", period=26,
)
_declared(
    "senkou_span_b", "ICHIMOKU_SENKOU_B",
    f"SELECT symbol, date, lag(v, 26) {BY_DATE} AS value FROM (SELECT symbol, date, {_mid(52)} AS v FROM weekly)",
    period=52,
)

# One step of the stop-and-reverse line: r rising, p stop, e extreme, a speed; h, l and h1, l1 the two bars before.
_STOP = """CASE WHEN w.r THEN least(w.p + w.a * (w.e - w.p), w.l, w.l1) ELSE greatest(w.p + w.a * (w.e - w.p), w.h, w.h1) END"""
SAR_WALK = f"""series AS MATERIALIZED (SELECT *, row_number() {BY_DATE} AS i FROM weekly), walk AS (
    SELECT b.symbol, b.date, b.i, b.high AS h, b.low AS l, a.high AS h1, a.low AS l1, b.high >= a.high AS r,
           CASE WHEN b.high >= a.high THEN a.low ELSE a.high END AS p,
           CASE WHEN b.high >= a.high THEN b.high ELSE b.low END AS e, 0.02e0 AS a
    FROM series a JOIN series b ON b.symbol = a.symbol AND a.i = 1 AND b.i = 2
    UNION ALL
    SELECT symbol, date, i, high, low, h, l, r <> crossed,
           CASE WHEN crossed THEN e ELSE stop END,
           CASE WHEN crossed THEN CASE WHEN r THEN low ELSE high END
                WHEN r THEN greatest(e, high) ELSE least(e, low) END,
           CASE WHEN crossed THEN 0.02e0 WHEN (r AND high > e) OR (NOT r AND low < e) THEN least(0.2e0, a + 0.02e0) ELSE a END
    FROM (SELECT n.symbol, n.date, n.i, n.high, n.low, w.h, w.l, w.r, w.e, w.a, {_STOP} AS stop,
                 CASE WHEN w.r THEN n.low < {_STOP} ELSE n.high > {_STOP} END AS crossed
          FROM walk w JOIN series n ON n.symbol = w.symbol AND n.i = w.i + 1))"""
_declared(
    "parabolic_sar", "PARABOLIC_SAR",
    "SELECT s.symbol, s.date, p AS value FROM series s LEFT JOIN walk w ON w.symbol = s.symbol AND w.i = s.i",
    extra=SAR_WALK,
)

REGISTRY = registry_entries(DEFAULT_REGISTRY) + [
    ("sma_10", "SMA", {"period": 10}), ("roc", "ROC", {"period": 12}), ("unknown", "NO_SUCH_TYPE", {"period": 3}),
]


@register(
    "registry_table", KEY + "bb_upper:6 bb_middle:6 bb_lower:6 macd:6 rsi:6 sma_10:6 roc:6 unknown:6",
    f"""SELECT symbol, date, m + 2 * sd AS bb_upper, m AS bb_middle, m - 2 * sd AS bb_lower, macd, {RSI} AS rsi, sma_10,
               100 * (close - c12) / nullif(c12, 0) AS roc, CAST(NULL AS DOUBLE) AS unknown
        FROM (SELECT *, avg(close) {over(20)} AS m, stddev_samp(close) {over(20)} AS sd, {_blend(12)} - {_blend(26)} AS macd,
                     {_mean(14, 'gain')} AS g, {_mean(14, 'loss')} AS l, {_mean(10)} AS sma_10, lag(close, 12) {BY_DATE} AS c12
              FROM moves)""",
    "bars", MOVES,
)
def registry_table(spark, folder):
    return declared.registry_table(bars(spark, folder), REGISTRY)
