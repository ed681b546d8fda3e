"""Explicit schemas of the tables and messages the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T


STRING, DATE, DOUBLE, LONG, INT = T.StringType(), T.DateType(), T.DoubleType(), T.LongType(), T.IntegerType()
TIMESTAMP, WALL_TIME = T.TimestampType(), T.TimestampNTZType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Daily price bars, unique by (symbol, date). `date` has day grain, so one symbol never holds more rows than
# the calendar has days: this is the size bound every per-symbol window in `operators` relies on.
BARS = _table(symbol=STRING, date=DATE, open=DOUBLE, high=DOUBLE, low=DOUBLE, close=DOUBLE, volume=LONG)
BAR_COLUMNS = BARS.fieldNames()
BAR_KEY = ["symbol", "date"]

SYMBOLS = _table(symbol=STRING, name=STRING, market_cap=STRING, sector=STRING, collected_at=TIMESTAMP)

WATCHLIST = _table(
    symbol=STRING, date=DATE, condition_type=STRING, condition_value=T.DecimalType(10, 4), market_cap_tier=INT,
    created_at=TIMESTAMP,
)
WATCHLIST_KEY = ["symbol", "date", "condition_type"]

MANUAL_WATCHLIST = _table(
    symbol=STRING, signal=STRING, price=DOUBLE, volume=LONG, bb_upper=DOUBLE, bb_middle=DOUBLE, bb_lower=DOUBLE,
    bb_width=DOUBLE, bb_position=DOUBLE, rsi=DOUBLE, created_at=TIMESTAMP,
)

SYMBOL_SHARDS = _table(symbol=STRING, shard_number=INT, created_at=TIMESTAMP, updated_at=TIMESTAMP)

# The columns of the stored indicator table, in order.
INDICATOR_COLUMNS = [
    "symbol", "date",
    "bb_upper", "bb_middle", "bb_lower",
    "macd", "macd_signal", "macd_histogram",
    "rsi",
    "sma_5", "sma_20", "sma_60",
    "ema_5", "ema_20", "ema_60",
    "cci", "obv",
    "ma_112", "ma_224", "ma_448",
]

# Union of the two live-quote message shapes; a message fills the fields of its own source. Volume is a long:
# an int field would turn a volume over 2^31 into NULL.
QUOTE_MESSAGE = _table(
    symbol=STRING, price=DOUBLE, change=DOUBLE, change_rate=DOUBLE, volume=LONG, data_source=STRING,
    timestamp=STRING, current_price=DOUBLE, previous_close=DOUBLE, open_price=DOUBLE, day_high=DOUBLE,
    day_low=DOUBLE, market_cap=LONG, pe_ratio=DOUBLE, source=STRING, change_percent=DOUBLE,
)

# Payload shapes of the vendor responses.
SYMBOL_PAYLOAD = _table(
    data=_table(rows=T.ArrayType(_table(symbol=STRING, name=STRING, marketCap=STRING, sector=STRING)))
)
DAILY_PAYLOAD = _table(
    rt_cd=STRING,
    output=T.ArrayType(_table(xymd=STRING, open=STRING, high=STRING, low=STRING, clos=STRING, tvol=STRING)),
)

LOAD_TEST = _table(
    **{
        "Type": STRING, "Name": STRING, "Request Count": LONG, "Failure Count": LONG,
        **{f"{figure} Response Time": DOUBLE for figure in ("Median", "Average", "Min", "Max")},
        "Average Content Size": DOUBLE, "Requests/s": DOUBLE, "Failures/s": DOUBLE,
        **{
            f"{percent}%": DOUBLE
            for percent in ("50", "66", "75", "80", "90", "95", "98", "99", "99.9", "99.99", "100")
        },
    }
)

CALL_LOG = _table(scenario=STRING, symbol=STRING, status=STRING, response_time=DOUBLE, error=STRING)
REQUEST_LOG = _table(ts=WALL_TIME, method=STRING, endpoint=STRING, status=INT, duration=DOUBLE, error=STRING)
HOST_METRICS = _table(host=STRING, cpu=DOUBLE, memory=DOUBLE, disk=DOUBLE)
