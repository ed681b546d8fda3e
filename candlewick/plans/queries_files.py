"""Registered queries that write files derived from the tables and read them back through the file sources."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from candlewick.operators import clean, declared, opslog, quotes as q, shards
from candlewick.plans.catalog import over, register
from candlewick.plans.inputs import bars, events, messages, symbols
from candlewick.plans.queries_bars import _shard_sql
from candlewick.plans.queries_indicators import MOVES, RSI
from candlewick.schemas import BARS, LOAD_TEST
from candlewick.session import shared_dir
from candlewick.sources import files, profile, quarantine, trades


def fresh(spark, name: str) -> str:
    return f"{shared_dir(spark)}/files/{name}-{uuid.uuid4().hex}"


def reported(parts: quarantine.Divided, good: DataFrame, rejected: DataFrame) -> DataFrame:
    """Good and rejected rows in one table, with the counts taken while they were divided."""
    rows = good.withColumn("taken", F.lit(True)).unionByName(rejected.withColumn("taken", F.lit(False)), allowMissingColumns=True)
    return rows.withColumn("n_good", F.lit(parts.n_good)).withColumn("n_rejected", F.lit(parts.n_rejected))


COUNTS = " taken:s n_good:i n_rejected:i"


def _counted(sql: str) -> str:
    return f"""SELECT *, CAST(count(*) FILTER (taken) OVER () AS BIGINT) AS n_good, CAST(count(*) FILTER (NOT taken) OVER () AS BIGINT) AS n_rejected
               FROM ({sql})"""


# ---- quarantine -----------------------------------------------------------------------------------------------


@register(
    "load_test_quarantine", "name:s requests:i mean:4 raw:s" + COUNTS,
    _counted("""SELECT CASE WHEN user_id % 7 = 0 OR user_id % 5 = 0 THEN NULL ELSE concat('/api/user/', user_id) END AS name,
                       CASE WHEN user_id % 7 = 0 OR user_id % 5 = 0 THEN NULL ELSE n END AS requests,
                       CASE WHEN user_id % 7 = 0 OR user_id % 5 = 0 THEN NULL ELSE mean END AS mean,
                       CASE WHEN user_id % 7 = 0 THEN concat('GET,/api/user/', user_id)
                            WHEN user_id % 5 = 0 THEN concat('GET,/api/user/', user_id, ',many', repeat(',', 19)) END AS raw,
                       user_id % 7 <> 0 AND user_id % 5 <> 0 AS taken
                FROM (SELECT user_id, count(*) AS n, floor(avg(value) * 1000 + 0.5) / 1000 AS mean FROM events GROUP BY user_id)"""),
)
def load_test_quarantine(spark, folder):
    """Load-test statistics by user as CSV. Lines of every seventh user are cut short, every fifth has text for a number."""
    per_user = events(spark, folder).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), (F.floor(F.avg("value") * 1000 + 0.5) / 1000).alias("mean"))
    name = F.concat(F.lit("/api/user/"), "user_id")
    whole = {"Type": F.lit("GET"), "Name": name, "Request Count": F.col("n").cast("string"), "Average Response Time": F.col("mean").cast("string")}
    broken = {"Type": F.lit("GET"), "Name": name, "Request Count": F.lit("many")}
    cut, wrong = F.col("user_id") % 7 == 0, F.col("user_id") % 5 == 0

    def lines(rows: DataFrame, values: dict) -> DataFrame:
        return rows.select(*[values.get(f.name, F.lit(None).cast("string")).alias(f.name) for f in LOAD_TEST.fields])

    root = fresh(spark, "load-test")
    options = {"header": True, "mode": "append", "quoteAll": False, "emptyValue": ""}
    lines(per_user.where(~cut & ~wrong), whole).write.csv(root, **options)
    lines(per_user.where(~cut & wrong), broken).write.csv(root, **options)
    per_user.where(cut).select(F.lit("GET").alias("Type"), name.alias("Name")).write.csv(root, **options)
    parts = quarantine.divide(files.read_load_test(spark, root), F.col(quarantine.CORRUPT).isNotNull(), fresh(spark, "divided"))
    good = parts.good.select(F.col("Name").alias("name"), F.col("Request Count").alias("requests"), F.col("Average Response Time").alias("mean"))
    return reported(parts, good, parts.rejected.select(F.col(quarantine.CORRUPT).alias("raw")))


@register(
    "message_quarantine", "topic:s offset:i symbol:s raw:s" + COUNTS,
    _counted("""SELECT CASE WHEN event_type IN ('view', 'click') THEN 'primary-quotes' ELSE 'secondary-quotes' END AS topic,
                       event_id AS "offset",
                       CASE WHEN event_type <> 'error' THEN CASE WHEN value > 300 THEN '' ELSE concat('S', user_id) END END AS symbol,
                       CASE WHEN event_type = 'error' THEN concat('{broken ', event_id) END AS raw, event_type <> 'error' AS taken
                FROM events"""),
)
def message_quarantine(spark, folder):
    """Quote messages: those that can be read, parsed, and the text of the others."""
    parts = quarantine.divide(messages(spark, folder), q.rejected_messages(messages(spark, folder)), fresh(spark, "messages"))
    good = q.parse_messages(parts.good).select("topic", "offset", "symbol")
    return reported(parts, good, parts.rejected.select("topic", "offset", F.col("value").alias("raw")))


@register(
    "bars_quarantine", "symbol:s date:d close:6 reasons:s" + COUNTS,
    _counted("""SELECT symbol, date, CASE WHEN open > close THEN NULL ELSE close END AS close,
                       concat_ws(',', CASE WHEN open > close THEN 'close' END, CASE WHEN volume % 10 = 0 THEN 'volume' END) AS reasons,
                       NOT (open > close OR volume % 10 = 0) AS taken FROM bars"""), "bars",
)
def bars_quarantine(spark, folder):
    """Bars as JSON lines of text fields. Falling bars have words for a close, some volumes are missing; the rejected name both."""
    falls = F.col("open") > F.col("close")
    text = bars(spark, folder).select(
        "symbol", F.col("date").cast("string").alias("date"), *[F.col(c).cast("string").alias(c) for c in ("open", "high", "low")],
        F.when(falls, "n/a").otherwise(F.col("close").cast("string")).alias("close"),
        F.when(F.col("volume") % 10 != 0, F.col("volume").cast("string")).alias("volume"))
    root = fresh(spark, "bars")
    text.write.json(root)
    raw = quarantine.read_json(spark, root, text.schema).withColumn("reasons", F.array_join(quarantine.unreadable(BARS), ","))
    parts = quarantine.divide(raw, (F.col("reasons") != "") | F.col(quarantine.CORRUPT).isNotNull(), fresh(spark, "divided"))
    typed = lambda rows: clean.typed_bars(rows).select("symbol", "date", "close")
    keyed = parts.rejected.select("symbol", F.col("date").try_cast("date").alias("date"), F.col("close").try_cast("double").alias("close"), "reasons")
    return reported(parts, typed(parts.good).withColumn("reasons", F.lit("")), keyed)


# ---- logs, registry, shards -----------------------------------------------------------------------------------


@register(
    "log_file_counts", "lines:i api:i kafka:i db:i warning:i error:i error_rate:6",
    """SELECT count(*) AS lines, count(*) FILTER (event_type = 'view') AS api, count(*) FILTER (event_type = 'click') AS kafka,
              count(*) FILTER (event_type = 'purchase') AS db, count(*) FILTER (event_type = 'signup') AS warning,
              count(*) FILTER (event_type = 'error') AS error,
              100e0 * count(*) FILTER (event_type = 'error')
                / nullif(count(*) FILTER (event_type IN ('view', 'click', 'purchase')), 0) AS error_rate FROM events""",
)
def log_file_counts(spark, folder):
    root = fresh(spark, "log")
    trades.log_lines(events(spark, folder)).write.text(root)
    return opslog.log_event_counts(files.read_log(spark, root))


@register(
    "registry_file_table", "symbol:s date:d rsi:6 sma_10:6 ema_12:6",
    f"""SELECT symbol, date, {RSI} AS rsi, sma_10, sma_12 * CAST({1 - 2 / 13!r} AS DOUBLE) + close * CAST({2 / 13!r} AS DOUBLE) AS ema_12
        FROM (SELECT *, avg(gain) {over(14)} AS g, avg(loss) {over(14)} AS l, avg(close) {over(10)} AS sma_10, avg(close) {over(12)} AS sma_12
              FROM moves)""", "bars", MOVES,
)
def registry_file_table(spark, folder):
    """Indicators named by a registry file in the shared folder: the stored default with two more."""
    path = fresh(spark, "registry") + ".json"
    registry = files.read_registry(spark, path)  # there is none yet
    for name, kind, period in (("sma_10", "SMA", 10), ("ema_12", "EMA", 12)):
        registry = files.add_indicator(registry, "moving_average", name, kind, period=period)
    files.write_registry(spark, path, registry)
    entries = files.registry_entries(files.read_registry(spark, path))
    return declared.registry_table(bars(spark, folder), [e for e in entries if e[0] in ("rsi", "sma_10", "ema_12")])


@register(
    "sharded_bars", "shard:i symbol:s bars:i volume:i",
    f"SELECT {_shard_sql(5)} AS shard, symbol, count(*) AS bars, sum(volume) AS volume FROM bars GROUP BY symbol", "bars",
)
def sharded_bars(spark, folder):
    """Bars stored in a folder for each shard and read back."""
    root = fresh(spark, "shards")
    shards.write_sharded(bars(spark, folder), root)
    return spark.read.parquet(root).groupBy("shard", "symbol").agg(F.count(F.lit(1)).alias("bars"), F.sum("volume").alias("volume"))


# ---- profiles and copies --------------------------------------------------------------------------------------

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


@register(
    "catalog_profile", "table_name:s rows:i columns:s",
    " UNION ALL ".join(f"""SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows,
                                  (SELECT string_agg(name, ', ' ORDER BY cid) FROM pragma_table_info('{t}')) AS columns""" for t in TABLES),
)
def catalog_profile(spark, folder):
    """The tables of the input folder, listed and counted from their footers."""
    return profile.catalog_profile(spark, folder)


@register("copied_table", "symbol:s name:s market_cap:s sector:s", "SELECT * FROM symbols", "symbols")
def copied_table(spark, folder):
    """A table copied with a check of its content, read from the copy."""
    source, target = fresh(spark, "source"), fresh(spark, "copy")
    symbols(spark, folder).write.parquet(source)
    profile.copy_table(spark, source, target)
    return spark.read.parquet(target).select("symbol", "name", "market_cap", "sector")
