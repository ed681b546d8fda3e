"""Registered queries: a builder, a column list and the equivalent SQL.

The column list is a string of `name:kind` pairs, applied to both sides so that they agree in form:
`s` as it is, `i` bigint, `d` date and `t` timestamp as text, a digit a double rounded to that many places. With a `~` behind the
digit the border between two rounded values lies a thousandth of a unit below the half: prices are cents over a quantity, so exact
halves occur, and sums taken in another order may end on either side of one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.functions.numeric import round_half_up

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    build: Build
    columns: list[tuple[str, str]]
    sql: str | None


ENTRIES: dict[str, Entry] = {}

# Named table expressions the SQL texts build on: name -> (names it needs, text).
COMMON: dict[str, tuple[tuple[str, ...], str]] = {
    "bars": ((), """
        SELECT concat('S', l_suppkey) AS symbol, CAST(l_shipdate AS DATE) AS date,
               arg_min(price, k) AS open, max(price) AS high, min(price) AS low, arg_max(price, k) AS close,
               CAST(sum(l_quantity) AS BIGINT) AS volume
        FROM (SELECT l_suppkey, l_shipdate, l_quantity, l_extendedprice / l_quantity AS price,
                     row(l_orderkey, l_linenumber, l_partkey) AS k FROM lineitem)
        GROUP BY l_suppkey, CAST(l_shipdate AS DATE)"""),
    "weekly": ((), """
        SELECT n_name AS symbol, CAST(date_trunc('week', l_shipdate) AS DATE) AS date,
               arg_min(price, k) AS open, max(price) AS high, min(price) AS low, arg_max(price, k) AS close,
               CAST(sum(l_quantity) AS BIGINT) AS volume
        FROM (SELECT l_suppkey, l_shipdate, l_quantity, l_extendedprice / l_quantity AS price,
                     row(l_orderkey, l_linenumber, l_partkey) AS k FROM lineitem)
        JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
        GROUP BY n_name, CAST(date_trunc('week', l_shipdate) AS DATE)"""),
    "symbols": ((), """
        SELECT concat('S', s_suppkey) AS symbol, s_name AS name, n_name AS sector,
               CASE s_suppkey % 4 WHEN 0 THEN concat('$', v % 4 + 1, '.5T') WHEN 1 THEN concat('$', v % 1500 + 1, 'B')
                                  WHEN 2 THEN concat('$', v % 900 + 1, 'M')
                                  ELSE CAST((v + 1) * 100000000 AS VARCHAR) END AS market_cap,
               CASE s_suppkey % 4 WHEN 0 THEN (v % 4 + 1.5) * 1000 WHEN 1 THEN v % 1500 + 1
                                  WHEN 2 THEN (v % 900 + 1) / 1e3 ELSE (v + 1) * 100000000 / 1e9 END AS billions
        FROM (SELECT *, CAST(floor(abs(s_acctbal)) AS BIGINT) AS v FROM supplier)
        JOIN nation ON n_nationkey = s_nationkey"""),
    "tiers": (("symbols",), """
        SELECT *, CASE WHEN billions >= 100 THEN 1 WHEN billions >= 10 THEN 2 ELSE 3 END AS tier FROM symbols"""),
    "bands": (("bars",), """
        SELECT symbol, date, close, avg(close) OVER w AS m, stddev_samp(close) OVER w AS sd FROM bars
        WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""),
    "touches": (("bands", "tiers"), """
        SELECT symbol, date, close AS close_price, m + 2 * sd AS bb_upper,
               'bollinger_upper_touch' AS condition_type, close / (m + 2 * sd) AS condition_value,
               tier AS market_cap_tier, market_cap
        FROM bands JOIN tiers USING (symbol) WHERE close >= (m + 2 * sd) * 0.98e0"""),
    "watchlist": (("touches",), """
        SELECT symbol, date, condition_type, CAST(condition_value AS DECIMAL(10,4)) AS condition_value, market_cap_tier
        FROM touches"""),
    "priced": ((), """
        SELECT *, CASE WHEN value < 1 THEN 0.0 ELSE floor((500 + value * 80) * 100 + 0.5) / 100 END AS quoted,
               event_type IN ('view', 'click') AS is_primary
        FROM events WHERE event_type <> 'error'"""),
    "quotes": (("priced",), """
        SELECT concat('S', user_id) AS symbol, quoted AS price, ts AS event_time, event_id AS "offset",
               CASE WHEN is_primary THEN floor((value - 50) * 100 + 0.5) / 100 END AS change,
               CASE WHEN is_primary THEN floor((value - 50) / 20 * 100 + 0.5) / 100 END AS change_rate,
               CASE WHEN NOT is_primary THEN floor((480 + value * 82) * 100 + 0.5) / 100 END AS previous_close,
               event_id + 100 AS volume, CASE WHEN is_primary THEN 'KIS' ELSE 'YFINANCE' END AS source,
               CASE WHEN is_primary THEN 'primary-quotes' ELSE 'secondary-quotes' END AS topic
        FROM priced WHERE value <= 300 AND quoted <> 0"""),
    "latest": (("quotes",), """
        SELECT * FROM quotes QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC, "offset" DESC) = 1"""),
    "requests": ((), """
        SELECT ts, CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
               concat('/api/', event_type) AS endpoint,
               CASE WHEN event_type = 'error' THEN 500 WHEN value > 200 THEN 429 ELSE 200 END AS status,
               value / 40 AS duration FROM events"""),
}


def _with(needs: tuple[str, ...]) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in COMMON[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    return ", ".join(f"{name} AS MATERIALIZED ({COMMON[name][1]})" for name in ordered)


def over(rows: int) -> str:
    """SQL frame of the last `rows` bars of a symbol."""
    return f"OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


BY_DATE = "OVER (PARTITION BY symbol ORDER BY date)"


def _sql_column(name: str, kind: str) -> str:
    if kind == "s":
        return f'"{name}"'
    if kind == "i":
        return f'CAST("{name}" AS BIGINT) AS "{name}"'
    if kind == "d":
        return f'CAST("{name}" AS VARCHAR) AS "{name}"'
    if kind == "t":
        return f"strftime(\"{name}\", '%Y-%m-%d %H:%M:%S.%f') AS \"{name}\""
    half = 0.501 if kind.endswith("~") else 0.5
    return f'floor(CAST("{name}" AS DOUBLE) * 1e{kind[0]} + {half}) / 1e{kind[0]} AS "{name}"'


def _spark_column(name: str, kind: str):
    column = F.col(name)
    if kind == "i":
        column = column.cast("bigint")
    elif kind == "d":
        column = column.cast("string")
    elif kind == "t":
        column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif kind.endswith("~"):
        column = F.floor(column.cast("double") * 10.0 ** int(kind[0]) + 0.501) / 10.0 ** int(kind[0])
    elif kind != "s":
        column = round_half_up(column.cast("double"), int(kind))
    return column.alias(name)


def register(name: str, columns: str, sql: str | None = None, needs: str = "", extra: str = ""):
    """Add a query. `needs` names the common table expressions of its SQL, `extra` adds its own."""
    pairs = [tuple(pair.rsplit(":", 1)) for pair in columns.split()]

    def add(build: Build) -> Build:
        def projected(spark: SparkSession, folder: str) -> DataFrame:
            return build(spark, folder).select(*[_spark_column(n, k) for n, k in pairs])

        text = None
        if sql is not None:
            shared = ", ".join(part for part in (_with(tuple(needs.split())), extra) if part)
            prefix = f"WITH RECURSIVE {shared} " if shared else ""
            text = f"{prefix}SELECT {', '.join(_sql_column(n, k) for n, k in pairs)} FROM ({sql})"
        if name in ENTRIES:
            raise ValueError(f"query {name} is registered twice")
        ENTRIES[name] = Entry(projected, pairs, text)
        return build

    return add
