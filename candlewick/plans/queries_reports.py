"""Registered reports over call logs, request logs, text logs and load-test statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.operators import opslog
from candlewick.plans.catalog import register
from candlewick.plans.inputs import events
from candlewick.sources import trades

CALLS = """calls AS (SELECT event_type AS scenario, value / 100 AS t,
    CASE WHEN value > 150 THEN 'rate_limited' WHEN value > 100 THEN 'failed' ELSE 'success' END AS status FROM events)"""


@register(
    "call_report",
    "scenario:s total_requests:i successful_requests:i failed_requests:i rate_limited_requests:i avg_response_time:6 "
    "max_response_time:6 error_rate:6 rate_limit_rate:6",
    """SELECT scenario, count(*) AS total_requests, count(*) FILTER (status = 'success') AS successful_requests,
              count(*) FILTER (status = 'failed') AS failed_requests,
              count(*) FILTER (status = 'rate_limited') AS rate_limited_requests, avg(t) AS avg_response_time,
              max(t) AS max_response_time, 100e0 * count(*) FILTER (status <> 'success') / count(*) AS error_rate,
              100e0 * count(*) FILTER (status = 'rate_limited') / count(*) AS rate_limit_rate
       FROM calls GROUP BY scenario""", extra=CALLS,
)
def call_report(spark, folder):
    return opslog.call_report(trades.call_log(events(spark, folder)))


@register(
    "endpoint_errors", "method:s endpoint:s status:i requests:i errors:i avg_duration:6 slow_requests:i",
    """SELECT method, endpoint, status, count(*) AS requests, count(*) FILTER (status >= 400) AS errors,
              avg(duration) AS avg_duration, count(*) FILTER (duration > 5) AS slow_requests
       FROM requests GROUP BY ALL""", "requests",
)
def endpoint_errors(spark, folder):
    return opslog.endpoint_report(trades.request_log(events(spark, folder)))


@register(
    "response_median", "endpoint:s upper_median:6",
    """SELECT endpoint, percentile_disc(0.5) WITHIN GROUP (ORDER BY duration DESC) AS upper_median
       FROM requests GROUP BY endpoint""", "requests",
)
def response_median(spark, folder):
    return opslog.upper_median(trades.request_log(events(spark, folder)), "duration", ["endpoint"])


@register(
    "log_event_counts", "lines:i api:i kafka:i db:i warning:i error:i error_rate:6",
    """SELECT count(*) AS lines, count(*) FILTER (event_type = 'view') AS api, count(*) FILTER (event_type = 'click') AS kafka,
              count(*) FILTER (event_type = 'purchase') AS db, count(*) FILTER (event_type = 'signup') AS warning,
              count(*) FILTER (event_type = 'error') AS error,
              100e0 * count(*) FILTER (event_type = 'error')
                / nullif(count(*) FILTER (event_type IN ('view', 'click', 'purchase')), 0) AS error_rate FROM events""",
)
def log_event_counts(spark, folder):
    return opslog.log_event_counts(trades.log_lines(events(spark, folder)))


@register(
    "log_response_stats", "avg_seconds:6 min_seconds:6 max_seconds:6 median_seconds:6",
    """SELECT avg(s) AS avg_seconds, min(s) AS min_seconds, max(s) AS max_seconds,
              percentile_disc(0.5) WITHIN GROUP (ORDER BY s DESC) AS median_seconds
       FROM (SELECT floor(value * 25 + 0.5) / 1000 AS s FROM events WHERE event_type = 'view')""",
)
def log_response_stats(spark, folder):
    return opslog.response_stats(trades.log_lines(events(spark, folder)))


STATS = """stats AS (SELECT method, concat(endpoint, '/', status) AS name, count(*) AS requests,
    count(*) FILTER (status >= 400) AS failures, avg(duration * 1000) AS mean, max(duration * 1000) AS top
    FROM requests GROUP BY ALL)"""
ALL_STATS = STATS + """, every_row AS (SELECT * FROM stats UNION ALL SELECT '', 'Aggregated', count(*),
    count(*) FILTER (status >= 400), avg(duration * 1000), max(duration * 1000) FROM requests)"""
TOTALS = "total_requests:i total_failures:i error_rate:6 avg_response:4 weighted_avg_response:4 max_response:4 avg_requests_per_second:4"
TOTALS_SQL = """SELECT sum(requests) AS total_requests, sum(failures) AS total_failures,
    100e0 * sum(failures) / sum(requests) AS error_rate, avg(mean) AS avg_response,
    sum(mean * requests) / sum(requests) AS weighted_avg_response, max(top) AS max_response,
    avg(requests / 60e0) AS avg_requests_per_second FROM """


@register("load_test_totals", TOTALS, TOTALS_SQL + "stats", "requests", STATS)
def load_test_totals(spark, folder):
    return opslog.load_test_totals(trades.load_test_rows(events(spark, folder)))


@register("load_test_totals_all_rows", TOTALS, TOTALS_SQL + "every_row", "requests", ALL_STATS)
def load_test_totals_all_rows(spark, folder):
    return opslog.load_test_totals(trades.load_test_rows(events(spark, folder)), include_aggregated=True)


@register(
    "slowest_requests", "name:s avg_response:4 requests:i",
    "SELECT name, mean AS avg_response, requests FROM stats ORDER BY mean DESC, name, method LIMIT 5", "requests", STATS,
)
def slowest_requests(spark, folder):
    return opslog.slowest_requests(trades.load_test_rows(events(spark, folder)))


@register(
    "most_failing_requests", "name:s error_rate:6 failures:i",
    """SELECT name, 100e0 * failures / requests AS error_rate, failures FROM stats WHERE failures > 0
       ORDER BY error_rate DESC, name, method LIMIT 5""", "requests", STATS,
)
def most_failing_requests(spark, folder):
    return opslog.most_failing_requests(trades.load_test_rows(events(spark, folder)))


@register(
    "host_health", "host:s cpu:6 memory:6 disk:6 status:s",
    """SELECT *, CASE WHEN cpu > 90 OR memory > 95 OR disk > 95 THEN 'critical'
                      WHEN cpu > 70 OR memory > 80 OR disk > 85 THEN 'warning' ELSE 'healthy' END AS status
       FROM (SELECT concat('host-', user_id) AS host, least(avg(value) * 1.4, 100) AS cpu,
                    100e0 * count(*) FILTER (event_type <> 'error') / count(*) AS memory,
                    least(max(value) / 4, 100) AS disk FROM events GROUP BY user_id)""",
)
def host_health(spark, folder):
    """Host figures from each user's events: load from the mean value, memory from the share that succeeded."""
    succeeded = F.count_if(F.col("event_type") != "error")
    metrics = events(spark, folder).groupBy("user_id").agg(
        F.least(F.avg("value") * 1.4, F.lit(100.0)).alias("cpu"),
        (succeeded * 100 / F.count(F.lit(1))).alias("memory"),
        F.least(F.max("value") / 4, F.lit(100.0)).alias("disk"),
    )
    return opslog.health(metrics.select(F.concat(F.lit("host-"), "user_id").alias("host"), "cpu", "memory", "disk"))
