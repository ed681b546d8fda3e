"""Streams against batch results, restarts, late rows, folding, and the event-time operators."""

import datetime as dt
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from candlewick.operators import quotes as q, signals
from candlewick.operators.asof import as_of_join
from candlewick.sources import topics
from candlewick.streaming import jobs, partials, state

START = dt.datetime(2024, 1, 1)
ENVELOPE = "topic string, event_time timestamp_ntz, offset bigint, value string"


def message(offset, seconds, symbol="A", price=100.0, **fields):
    body = json.dumps({"symbol": symbol, "price": price, **fields})
    return ("t", START + dt.timedelta(seconds=seconds), offset, body)


def feed(spark, folder, rows):
    spark.createDataFrame(rows, ENVELOPE).coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder):
    return topics.read_folder(spark, str(folder), spark.createDataFrame([], ENVELOPE).schema)


def run(start):
    query = start()
    query.awaitTermination()
    return query


def test_parse_and_reconcile(spark):
    rows = spark.createDataFrame(
        [
            message(1, 0, price=5.0, change_rate=1.0, volume=3_000_000_000, data_source="KIS"),
            ("t", START, 2, json.dumps({"symbol": "B", "current_price": 6.0, "source": "YFINANCE", "change_percent": 2.0})),
            ("t", START, 3, "{broken"),
            ("t", START, 4, None),
            message(5, 0, symbol="", price=5.0),
            message(6, 0, price=0.0),
            message(7, 0, symbol="C", price=None),
        ],
        ENVELOPE,
    )
    assert [r["readable"] for r in q.parse_messages(rows).orderBy("offset").collect()][:4] == [True, True, False, False]
    found = q.read_quotes(rows).orderBy("offset").collect()
    assert [(r["symbol"], r["price"], r["change_rate"], r["source"]) for r in found] == [
        ("A", 5.0, 1.0, "KIS"), ("B", 6.0, 2.0, "YFINANCE")
    ]
    assert found[0]["volume"] == 3_000_000_000


def test_latest_restart_late_rows_and_fold(spark, tmp_path):
    source, root, mark = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "mark")
    schema = q.latest_quotes(q.read_quotes(spark.createDataFrame([], ENVELOPE))).schema

    def step():
        return run(lambda: jobs.latest_quotes_job(stream(spark, source), root, mark, None))

    def state():
        rows = partials.read(spark, root, schema, q.latest_quotes).collect()
        return {r["symbol"]: (r["price"], r["offset"]) for r in rows}

    assert state() == {}
    feed(spark, source, [message(1, 10, price=1.0), message(2, 20, price=2.0), message(3, 5, "B", 3.0)])
    step()
    assert state() == {"A": (2.0, 2), "B": (3.0, 3)}
    # A restart from the checkpoint reads only new files. The late row of A changes nothing, the equal time wins
    # by offset.
    feed(spark, source, [message(4, 15, price=4.0), message(5, 5, "B", 5.0), message(6, 1, "C", 6.0)])
    step()
    expected = {"A": (2.0, 2), "B": (5.0, 5), "C": (6.0, 6)}
    assert state() == expected
    everything = q.latest_quotes(q.read_quotes(spark.read.parquet(str(source))))
    assert {r["symbol"]: (r["price"], r["offset"]) for r in everything.collect()} == expected
    partials.fold(spark, root, schema, q.latest_quotes, 0)
    assert state() == expected
    feed(spark, source, [message(7, 30, price=7.0)])
    step()
    partials.fold(spark, root, schema, q.latest_quotes, 2)
    assert state() == {**expected, "A": (7.0, 7)}
    assert partials.forget(spark, root) == [0, 1, 2] and partials.forget(spark, root) == []
    assert state() == {**expected, "A": (7.0, 7)}
    feed(spark, source, [message(8, 40, price=8.0)])
    step()
    assert state() == {**expected, "A": (8.0, 8)} and partials.forget(spark, root) == []


def test_a_repeated_batch_counts_once(spark, tmp_path):
    calls = spark.createDataFrame(
        [("api", START + dt.timedelta(seconds=s)) for s in (0, 30, 100)], "name string, event_time timestamp_ntz"
    )
    root = str(tmp_path / "state")
    for _ in range(2):  # the same batch id written twice, as after a failure
        q.calls_per_minute(calls).write.mode("overwrite").parquet(f"{root}/partials/batch_id=0")
    merged = partials.read(spark, root, q.calls_per_minute(calls).schema, q.merge_minutes)
    assert sum(r["calls"] for r in q.call_sessions(merged).collect()) == 3


def brute_sessions(times, gap):
    sessions = []
    for t in sorted(times):
        if sessions and t < sessions[-1][1] + dt.timedelta(seconds=gap):
            sessions[-1] = (sessions[-1][0], t, sessions[-1][2] + 1)
        else:
            sessions.append((t, t, 1))
    return sessions


@pytest.mark.parametrize("gap", [60, 90])
def test_call_sessions(spark, gap):
    offsets = [0, 59.9, 119.8, 180, 240, 299, 1000, 1000, 1059.999, 1120, 5000]
    times = [START + dt.timedelta(seconds=s) for s in offsets]
    calls = spark.createDataFrame([("api", t) for t in times], "name string, event_time timestamp_ntz")
    rows = q.call_sessions(q.calls_per_minute(calls), gap).orderBy("first_call").collect()
    assert [(r["first_call"], r["last_call"], r["calls"]) for r in rows] == brute_sessions(times, gap)
    with pytest.raises(ValueError):
        q.call_sessions(q.calls_per_minute(calls), 30)


def test_session_window_stream(spark, tmp_path):
    rows = [("api", START + dt.timedelta(seconds=s)) for s in (0, 30, 200, 5000)]
    folder = str(tmp_path / "calls")
    frame = spark.createDataFrame(rows, "name string, event_time timestamp_ntz")
    frame.write.parquet(folder)
    counted = jobs.session_counts(spark.readStream.schema(frame.schema).parquet(folder))
    query = counted.writeStream.format("memory").queryName("sessions").trigger(availableNow=True).start()
    query.awaitTermination()
    # The last session stays open until the watermark passes it.
    assert sorted(r["calls"] for r in spark.table("sessions").collect()) == [1, 2]


def test_distinct_buckets_stream(spark, tmp_path):
    source = tmp_path / "in"
    feed(spark, source, [message(1, 0), message(2, 10), message(3, 31), message(4, 12, "B")])
    kept = jobs.distinct_buckets(q.read_quotes(stream(spark, source)))
    query = kept.writeStream.format("memory").queryName("buckets").trigger(availableNow=True).start()
    query.awaitTermination()
    found = {(r["symbol"], r["bucket"].second) for r in spark.table("buckets").collect()}
    assert found == {("A", 0), ("A", 30), ("B", 0)}


def test_batch_sizes(spark, tmp_path):
    source = tmp_path / "in"
    feed(spark, source, [message(i, i) for i in range(7)])
    audited = jobs.audited(stream(spark, source))
    query = run(
        lambda: audited.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "m"))
        .trigger(availableNow=True).start()
    )
    assert jobs.batch_sizes(query) == [(0, 7)]


def test_console_sink(spark, tmp_path):
    source = tmp_path / "in"
    feed(spark, source, [message(i, i) for i in range(3)])
    query = topics.write_console(q.read_quotes(stream(spark, source)), str(tmp_path / "mark"))
    try:
        query.processAllAvailable()
        assert sum(progress.numInputRows for progress in query.recentProgress) == 3
    finally:
        query.stop()


def test_expiry(spark):
    state = spark.createDataFrame(
        [(s, START - dt.timedelta(seconds=age)) for s, age in [("A", 0), ("B", 299), ("C", 300), ("D", 301), ("E", -5)]],
        "symbol string, event_time timestamp_ntz",
    )
    now = F.lit(START).cast("timestamp_ntz")
    assert {r["symbol"] for r in q.alive(state, now).collect()} == {"A", "B"}
    assert {r["symbol"] for r in q.alive(state, now, q.PRICE_TTL).collect()} == {"A"}
    assert {r["symbol"] for r in q.purge_stale(state, now).collect()} == {"A", "B", "C", "E"}


def responses(spark, rows):
    """Price responses (symbol, last, seconds, offset) without other figures."""
    return spark.createDataFrame(
        [(symbol, last, "1", "1", "1", None if at is None else START + dt.timedelta(seconds=at), n) for symbol, last, at, n in rows],
        "symbol string, last string, diff string, rate string, tvol string, event_time timestamp_ntz, offset bigint")


SECONDARY = "symbol string, event_time timestamp_ntz, offset bigint, price double, previous_close double, volume bigint"


def secondary(spark, rows):
    return spark.createDataFrame([(s, START + dt.timedelta(seconds=at), n, *x) for s, at, n, *x in rows], SECONDARY)


def test_fallback(spark):
    primary = spark.createDataFrame(
        [
            ("A", "10.5", "0.5", "5", "100"), ("B", "", "1", "1", "1"), ("C", "-1", "1", "1", "1"),
            ("D", "x", "1", "1", "1"), ("E", "0", " ", None, ""), ("F", "7", " ", None, ""),
        ],
        "symbol string, last string, diff string, rate string, tvol string",
    ).withColumn("event_time", F.lit(START).cast("timestamp_ntz")).withColumn("offset", F.lit(1))
    feed = secondary(spark, [("A", -9, 1, 99.0, 90.0, 1), ("B", -9, 2, 11.0, 10.0, 2), ("C", -9, 3, 12.0, None, 3), ("D", -9, 4, 0.0, 1.0, 4)])
    found = {r["symbol"]: (r["price"], r["change"], r["change_rate"], r["volume"], r["data_source"])
             for r in q.with_fallback(primary, feed).collect()}
    assert found == {
        "A": (10.5, 0.5, 5.0, 100, "kis"),
        "B": (11.0, 1.0, 10.0, 2, "kis_via_yfinance"),
        "C": (12.0, 0.0, 0.0, 3, "kis_via_yfinance"),
        "F": (7.0, 0.0, 0.0, 0, "kis"),
    }


@pytest.mark.parametrize("seconds", [7, 60, 100_000])
def test_as_of_join_matches_a_plain_search(spark, seconds):
    """Any cut into ranges gives the newest row at the time, equal times included; one key holds most rows."""
    pick = random.Random(seconds)
    key = lambda: pick.choice(["HOT"] * 6 + ["A", "B", "C", None])
    left = [(key(), pick.choice([None, *range(300)]), i) for i in range(400)]
    right = [(key(), pick.choice([None, *range(50, 300)]), i) for i in range(300)]
    time = lambda at: None if at is None else START + dt.timedelta(seconds=at)
    kind = "symbol string, event_time timestamp_ntz, n long"
    tables = [spark.createDataFrame([(k, time(t), n) for k, t, n in rows], kind) for rows in (left, right)]
    found = as_of_join(*tables, range_seconds=seconds).collect()
    assert len(found) == len(left)
    for row in found:
        k, t, n = next(x for x in left if x[2] == row["n"])
        known = [(b, m) for a, b, m in right if a == k and k is not None and b is not None and t is not None and b <= t]
        assert (row["found"]["n"] if row["found"] else None) == (max(known)[1] if known else None)


def test_as_of_spreads_a_hot_key(spark):
    """No window goes over a key alone but the one over its ranges."""
    quotes = secondary(spark, [("A", 0, 1, 1.0, 1.0, 1)])
    text = as_of_join(quotes, quotes)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in text and text.count("hashpartitioning(symbol") >= 2 and "SinglePartition" not in text


def folder_stream(spark, folder, frame, files=1):
    return topics.read_folder(spark, str(folder), frame.schema, files)


def quotes_at(spark, rows):
    """Messages (symbol, price, seconds, offset)."""
    return spark.createDataFrame([message(n, at, symbol, price) for symbol, price, at, n in rows], ENVELOPE)


def deliver(frame, folder):
    frame.coalesce(1).write.mode("append").parquet(str(folder))


def test_keyed_state_expires_and_survives_restarts(spark, tmp_path):
    source, root, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    kinds = q.read_quotes(quotes_at(spark, [("A", 1.0, 0, 1)])).schema

    def step(*deliveries):
        for rows in deliveries:
            deliver(quotes_at(spark, rows), source)
        run(lambda: jobs.latest_state_job(folder_stream(spark, source, quotes_at(spark, [])), root, mark, 300, None))
        return {r["symbol"]: (r["price"], r["offset"]) for r in state.newest_state(spark, mark, kinds).collect()}

    assert step([("A", 1.0, 0, 1), ("A", 2.0, 10, 2), ("B", 3.0, 5, 3)]) == {"A": (2.0, 2), "B": (3.0, 3)}
    # A late row of C counts, an older one of A does not; equal times go to the later offset. B expires at 305, A at 310.
    assert step([("C", 4.0, 100, 5), ("B", 5.0, 5, 6), ("A", 9.0, 9, 7)], [("D", 6.0, 304, 8)]) == {
        "A": (2.0, 2), "B": (5.0, 6), "C": (4.0, 5), "D": (6.0, 8)}
    assert step([("D", 7.0, 309, 9)]) == {"A": (2.0, 2), "C": (4.0, 5), "D": (7.0, 9)}
    # Older than the state lives: not taken. C is renewed before its time.
    assert step([("E", 1.0, 1, 10), ("C", 8.0, 399, 11)]) == {"C": (8.0, 11), "D": (7.0, 9)}
    assert step([("F", 1.0, 5000, 12)]) == {"F": (1.0, 12)}
    log = spark.read.parquet(root).where("not live").select("symbol", "price").collect()
    assert sorted(map(tuple, log)) == [("A", 2.0), ("B", 5.0), ("C", 8.0), ("D", 7.0)]


def test_fallback_stream_does_not_see_the_future(spark, tmp_path):
    asked, told = tmp_path / "asked", tmp_path / "told"
    schema = responses(spark, []).schema
    deliver(responses(spark, [("A", "", 50, 1), ("A", "5", 60, 2), ("B", "", 10, 3), ("A", "", 20, 4)]), asked)
    topic = lambda rows: quotes_at(spark, rows)
    deliver(topic([("A", 11.0, 20, 1), ("A", 12.0, 49, 2), ("A", 13.0, 51, 3), ("B", 9.0, 11, 4)]), told)
    root, mark = str(tmp_path / "out"), str(tmp_path / "mark")

    def step():
        run(lambda: jobs.fallback_job(
            topics.read_folder(spark, str(asked), schema), topics.read_folder(spark, str(told), topic([]).schema), "t", root, mark, None))
        return sorted((r["offset"], r["price"], r["data_source"]) for r in spark.read.parquet(root).collect())

    first = [(1, 12.0, "kis_via_yfinance"), (2, 5.0, "kis"), (4, 11.0, "kis_via_yfinance")]
    assert step() == first
    # After a restart the state still knows what came before.
    deliver(responses(spark, [("A", "", 2000, 5), ("B", "", 1000, 6), ("A", "", 1500, 7)]), asked)
    deliver(topic([("A", 14.0, 1501, 5)]), told)
    assert step() == sorted([*first, (5, 14.0, "kis_via_yfinance"), (6, 9.0, "kis_via_yfinance"), (7, 13.0, "kis_via_yfinance")])


def test_fallback_stream_of_symbols_without_a_quote(spark, tmp_path):
    asked, told, root, mark = tmp_path / "asked", tmp_path / "told", str(tmp_path / "out"), str(tmp_path / "mark")
    deliver(responses(spark, [("A", "", 50, 1), ("B", "", 50, 2), ("B", "5", 60, 3)]), asked)
    kinds, schema = quotes_at(spark, []).schema, responses(spark, []).schema
    told.mkdir()

    def step():
        run(lambda: jobs.fallback_job(
            topics.read_folder(spark, str(asked), schema), topics.read_folder(spark, str(told), kinds), "t", root, mark, None))
        return sorted((r["offset"], r["price"]) for r in spark.read.parquet(root).collect())

    assert step() == [(3, 5.0)]
    # Quotes without an offset, then a request of a symbol that has one now.
    deliver(quotes_at(spark, [("A", 11.0, 70, None), ("A", 12.0, 70, 1)]), told)
    deliver(responses(spark, [("A", "", 80, 4), ("C", "", 80, 5)]), asked)
    assert step() == [(3, 5.0), (4, 12.0)]


def test_a_delivery_is_one_batch_however_many_files_it_has(spark, tmp_path):
    from candlewick.plans import queries_quotes

    rows = [(n, START + dt.timedelta(days=d, seconds=1000 * n), n % 3, "view" if n % 2 else "purchase", 50.0, "") for d in (0, 12, 24)
            for n in range(60)]
    frame = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    frame.repartition(12).write.parquet(str(tmp_path / "events.parquet"))
    stream, arrivals = queries_quotes.delivered(spark, str(tmp_path))
    sizes, most = [], []

    def start(root, mark):
        query = jobs.latest_state_job(queries_quotes.trades.quote_messages(stream), root, mark, 86400, None)
        query.awaitTermination()
        sizes.append([p.numInputRows for p in query.recentProgress if p.numInputRows])
        return query

    queries_quotes.finished(spark, start, arrivals)
    assert sizes == [[60], [60], [60]]


def test_the_earliest_of_a_batch_passes_the_bucket_filter(spark, tmp_path):
    source, root, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")

    def step(*rows):
        # Later rows first, in files that tasks of their own read.
        for row in sorted(rows, key=lambda r: -r[2]):
            feed(spark, source, [row])
        run(lambda: state.start(jobs.distinct_buckets(q.read_quotes(stream(spark, source))), root, mark, None))
        return sorted((r["symbol"], r["bucket"].minute * 60 + r["bucket"].second, r["offset"]) for r in spark.read.parquet(root).collect())

    first = [("A", 0, 1), ("A", 30, 5), ("B", 0, 4)]
    assert step(message(1, 1), message(2, 2), message(3, 20), message(4, 12, "B"), message(6, 33), message(5, 31)) == first
    # After a restart the buckets that may still get rows are known; those of other times pass.
    assert step(message(7, 0), message(8, 0, "C"), message(9, 60)) == sorted([*first, ("A", 60, 9), ("C", 0, 8)])


def closes(spark, level, symbols=("A", "B")):
    days = [(s, dt.date(2024, 1, 1) + dt.timedelta(days=i), level + i % 3) for s in symbols for i in range(30)]
    return spark.createDataFrame(days, "symbol string, date date, close double")


def test_signals_follow_the_published_closes(spark, tmp_path):
    source, root, mark, published = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark"), str(tmp_path / "closes")
    schema = signals.quote_signals(
        q.latest_quotes(q.read_quotes(quotes_at(spark, []))).select("symbol", "price", "event_time", "offset"), closes(spark, 1.0)).schema

    def step(*rows):
        deliver(quotes_at(spark, rows), source)
        run(lambda: jobs.signals_job(folder_stream(spark, source, quotes_at(spark, [])), published, root, mark, None))
        return {(r["symbol"], r["offset"]): r["sma_20"] for r in partials.read(spark, root, schema, lambda x: x).collect()}

    assert step(("A", 10.0, 0, 1)) == {}  # nothing published yet
    signals.publish_closes(closes(spark, 10.0), published)
    low = step(("A", 10.0, 1, 2), ("C", 1.0, 1, 3))
    assert set(low) == {("A", 2)} and 10 < low["A", 2] < 13
    signals.publish_closes(closes(spark, 100.0), published)
    both = step(("A", 10.0, 2, 4), ("B", 10.0, 2, 5))
    assert both["A", 2] == low["A", 2] and both["A", 4] > 90 and both["B", 5] > 90
    newest = spark.createDataFrame([("A", 1.0)], "symbol string, price double")
    text = signals.published_closes(newest, published)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*shard", text)  # other shards are not read


def test_audit_counts_each_batch_once(spark, tmp_path):
    source, root, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    for rows in ([("A", 1.0, 0, 1), ("B", 1.0, 7, 2)], [], [("A", 1.0, 3, 3)]):
        deliver(quotes_at(spark, rows), source)
    start = lambda: jobs.latest_quotes_job(folder_stream(spark, source, quotes_at(spark, [])), root, mark, None)
    run(start)
    figures = lambda: [(r["rows"], r["first_event"].second, r["last_event"].second) for r in partials.audit(spark, root).orderBy("batch_id").collect()]
    assert figures() == [(2, 0, 7), (1, 3, 3)]
    # The last batch runs again, as after a failure between its writes and its commit.
    commits = sorted((tmp_path / "mark" / "commits").glob("[0-9]*"), key=lambda x: int(x.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    run(start)
    assert figures() == [(2, 0, 7), (1, 3, 3)]
    assert partials.audit(spark, str(tmp_path / "nowhere")).count() == 0


def test_a_shard_keeps_its_symbols_apart(spark, tmp_path, monkeypatch):
    """All symbols of one shard: each is renewed and expires at its own time, with one timer for all; buckets likewise."""
    monkeypatch.setattr(state, "SHARDS", 1)
    source, root, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    kinds = q.read_quotes(quotes_at(spark, [("A", 1.0, 0, 1)])).schema

    def step(*rows):
        deliver(quotes_at(spark, rows), source)
        run(lambda: jobs.latest_state_job(folder_stream(spark, source, quotes_at(spark, [])), root, mark, 300, None))
        return {r["symbol"]: r["offset"] for r in state.newest_state(spark, mark, kinds).collect()}

    names = [f"S{n}" for n in range(40)]
    assert step(*[(name, 1.0, n, n) for n, name in enumerate(names)]) == {name: n for n, name in enumerate(names)}
    # The first ten are renewed; of the others those up to 20 seconds expire.
    held = step(*[(name, 2.0, 320, 100 + n) for n, name in enumerate(names[:10])])
    assert held == {name: 100 + n if n < 10 else n for n, name in enumerate(names) if n < 10 or n >= 20}
    log = spark.read.parquet(root).where("not live").select("symbol", "offset").collect()
    assert sorted(map(tuple, log)) == [(f"S{n}", n) for n in range(10, 20)]


def test_calls_of_the_keyed_state_do_not_grow_with_its_symbols(spark, tmp_path):
    """One group for each shard, so more symbols do not mean more calls and timers."""
    rows = [(f"S{n}", 1.0, n % 7, n) for n in range(4 * state.SHARDS)]
    source, root, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    deliver(quotes_at(spark, rows), source)
    query = run(lambda: jobs.latest_state_job(folder_stream(spark, source, quotes_at(spark, [])), root, mark, 300, None))
    timers = sum(p.stateOperators[0].customMetrics["numRegisteredTimers"] for p in query.recentProgress if p.numInputRows)
    assert 0 < timers <= state.SHARDS
