"""Reports over load-test statistics, text logs, call logs and request logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from candlewick.functions.numeric import ratio
from candlewick.operators.selection import upper_median

# Marker texts of the log lines, in order of precedence, and the class each line counts for.
LOG_MARKERS = [
    ("api", ["🌐 요청:", "API 요청"]),
    ("kafka", ["📤 Kafka", "Kafka 메시지"]),
    ("db", ["🗃️ DB", "DB 작업"]),
    ("warning", ["WARNING", "⚠️"]),
    ("error", ["ERROR", "❌"]),
]
SECONDS_SUFFIX = "초)"

# Percent of (cpu, memory, disk) above which a host is critical or in warning, and the duration in
# seconds above which a request is slow.
CRITICAL_LEVELS = (90, 95, 95)
WARNING_LEVELS = (70, 80, 85)
SLOW_SECONDS = 5.0


# ---- load-test statistics -------------------------------------------------------------------------------------


def load_test_totals(stats: DataFrame, include_aggregated: bool = False) -> DataFrame:
    """Totals over the request rows. The file's closing `Aggregated` row repeats all others and is left out
    unless asked for; `weighted_avg_response` weighs each row by its requests."""
    rows = stats if include_aggregated else stats.filter(F.col("Name") != "Aggregated")
    requests, failures = F.sum("Request Count"), F.sum("Failure Count")
    return rows.agg(
        requests.alias("total_requests"),
        failures.alias("total_failures"),
        (ratio(failures, requests) * 100).alias("error_rate"),
        F.avg("Average Response Time").alias("avg_response"),
        ratio(F.sum(F.col("Average Response Time") * F.col("Request Count")), requests).alias("weighted_avg_response"),
        F.max("Max Response Time").alias("max_response"),
        F.avg("`Requests/s`").alias("avg_requests_per_second"),
    )


def slowest_requests(stats: DataFrame, limit: int = 5, include_aggregated: bool = False) -> DataFrame:
    rows = stats if include_aggregated else stats.filter(F.col("Name") != "Aggregated")
    return rows.orderBy(F.col("Average Response Time").desc(), "Name", "Type").limit(limit).select(
        F.col("Name").alias("name"),
        F.col("Average Response Time").alias("avg_response"),
        F.col("Request Count").alias("requests"),
    )


def most_failing_requests(stats: DataFrame, limit: int = 5, include_aggregated: bool = False) -> DataFrame:
    rows = stats if include_aggregated else stats.filter(F.col("Name") != "Aggregated")
    rate = F.coalesce(ratio(F.col("Failure Count"), F.col("Request Count")) * 100, F.lit(0.0))
    return (
        rows.withColumn("error_rate", rate)
        .filter(F.col("error_rate") > 0)
        .orderBy(F.col("error_rate").desc(), "Name", "Type")
        .limit(limit)
        .select(F.col("Name").alias("name"), "error_rate", F.col("Failure Count").alias("failures"))
    )


# ---- text log -------------------------------------------------------------------------------------------------


def line_class(line: Column) -> Column:
    """First matching class of a log line, NULL for other lines."""
    kind = F.lit(None).cast("string")
    for name, markers in reversed(LOG_MARKERS):
        found = F.lit(False)
        for marker in markers:
            found = found | line.contains(marker)
        kind = F.when(found, name).otherwise(kind)
    return kind


def response_seconds(line: Column) -> Column:
    """Number between the line's first `(` and the following `초)`; NULL where there is none."""
    inside = F.split(line, r"\(")[1]
    return F.when(
        line.contains("(") & line.contains(SECONDS_SUFFIX),
        F.substring_index(inside, SECONDS_SUFFIX, 1).try_cast("double"),
    )


def log_event_counts(lines: DataFrame) -> DataFrame:
    """One row: lines and lines of each class, and the share of errors among api, kafka and db lines."""
    classed = lines.select(line_class(F.col("value")).alias("kind"))
    counts = classed.agg(
        F.count(F.lit(1)).alias("lines"),
        *[F.count_if(F.col("kind") == name).alias(name) for name, _ in LOG_MARKERS],
    )
    operations = F.col("api") + F.col("kafka") + F.col("db")
    return counts.withColumn("error_rate", ratio(F.col("error") * 100, operations))


def response_stats(lines: DataFrame) -> DataFrame:
    """Mean, least, greatest and upper-median response time of the api lines."""
    line = F.col("value")
    times = lines.filter(line_class(line) == "api").select(response_seconds(line).alias("seconds")).na.drop()
    figures = times.agg(
        F.avg("seconds").alias("avg_seconds"), F.min("seconds").alias("min_seconds"), F.max("seconds").alias("max_seconds")
    )
    return figures.withColumn("median_seconds", upper_median(times, "seconds").select("upper_median").scalar())


# ---- call and request logs ------------------------------------------------------------------------------------


def call_report(calls: DataFrame) -> DataFrame:
    """Per scenario: calls by outcome, response times and rates."""
    total, status = F.count(F.lit(1)), F.col("status")
    limited, failed = F.count_if(status == "rate_limited"), F.count_if(status == "failed")
    return calls.groupBy("scenario").agg(
        total.alias("total_requests"),
        F.count_if(status == "success").alias("successful_requests"),
        failed.alias("failed_requests"),
        limited.alias("rate_limited_requests"),
        F.avg("response_time").alias("avg_response_time"),
        F.max("response_time").alias("max_response_time"),
        ((failed + limited) / total * 100).alias("error_rate"),
        (limited / total * 100).alias("rate_limit_rate"),
    )


def endpoint_report(requests: DataFrame) -> DataFrame:
    """Per method, endpoint and status: requests, errors, mean duration and slow requests."""
    failed = (F.col("status") >= 400) | F.col("error").isNotNull()
    return requests.groupBy("method", "endpoint", "status").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(failed).alias("errors"),
        F.avg("duration").alias("avg_duration"),
        F.count_if(F.col("duration") > SLOW_SECONDS).alias("slow_requests"),
    )


def health(metrics: DataFrame) -> DataFrame:
    """Add `status` from the cpu, memory and disk percentages."""

    def above(levels) -> Column:
        cpu, memory, disk = levels
        return (F.col("cpu") > cpu) | (F.col("memory") > memory) | (F.col("disk") > disk)

    return metrics.withColumn(
        "status", F.when(above(CRITICAL_LEVELS), "critical").when(above(WARNING_LEVELS), "warning").otherwise("healthy")
    )
