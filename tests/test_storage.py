"""Snapshots, upserts, payloads and the daily job."""

import datetime as dt
import json
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from candlewick.operators import clean, shards, upsert
from candlewick.operators.indicators import indicator_table
from candlewick.plans import daily
from candlewick.schemas import BARS, SYMBOLS
from candlewick.session import freed_shuffles, shared_dir
from candlewick.sources import files, payloads, profile, snapshots

DAY = dt.date(2024, 3, 1)


def bar(symbol, day, close, volume=1):
    return (symbol, DAY + dt.timedelta(days=day), close, close, close, close, volume)


def closes(table):
    return {(r["symbol"], (r["date"] - DAY).days): r["close"] for r in table.collect()}


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "bars")
    assert snapshots.read_snapshot(spark, root) is None
    assert snapshots.publish_snapshot(spark.createDataFrame([bar("A", 0, 1.0)], BARS), root) == 1
    reader = snapshots.read_snapshot(spark, root)
    second = reader.unionByName(spark.createDataFrame([bar("A", 1, 2.0)], BARS))
    assert snapshots.publish_snapshot(second, root) == 2
    assert reader.count() == 1  # a running reader keeps its version
    assert snapshots.read_snapshot(spark, root).count() == 2
    assert profile.copy_table(spark, f"{root}/v=2", str(tmp_path / "copy")) == 2


def test_merge_months(spark, tmp_path):
    root = str(tmp_path / "months")
    old = spark.createDataFrame([bar("A", d, float(d)) for d in range(0, 90)], BARS)
    snapshots.write_months(old, root)
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "months" / "month=2024-03").iterdir()}
    delivery = spark.createDataFrame([bar("A", 60, -1.0), bar("B", 61, -2.0)], BARS)
    snapshots.merge_months(delivery, root, upsert.upsert_bars)
    merged = closes(spark.read.parquet(root))
    assert merged == {("A", d): float(d) for d in range(90)} | {("A", 60): -1.0, ("B", 61): -2.0}
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "months" / "month=2024-03").iterdir()} == untouched


def test_upsert_bars_keeps_the_last_delivery(spark):
    stored = spark.createDataFrame([bar("A", 0, 1.0), bar("A", 1, 1.0)], BARS)
    batch = spark.createDataFrame(
        [(*bar("A", 1, 5.0), 1), (*bar("A", 1, 7.0), 2), (*bar("B", 0, 3.0), 1)], [*BARS.names, "seq"]
    ).withColumn("volume", F.col("volume").cast("bigint"))
    merged = closes(upsert.upsert_bars(stored, batch, F.col("seq")))
    assert merged == {("A", 0): 1.0, ("A", 1): 7.0, ("B", 0): 3.0}


def test_new_bars_is_an_anti_join(spark):
    stored = spark.createDataFrame([bar("A", d, 1.0) for d in (-2000, 0)], BARS)
    incoming = spark.createDataFrame([bar("A", d, 2.0) for d in (-2000, 0, 1)], BARS)
    found = clean.new_bars(incoming, stored)
    assert set(closes(found)) == {("A", 1)}  # a stored bar is known however old it is
    assert "LeftAnti" in found._jdf.queryExecution().executedPlan().toString()


def test_payloads(spark, tmp_path):
    body = {"data": {"rows": [
        {"symbol": "A", "name": "Alpha", "marketCap": "$3.0T", "sector": "Tech"},
        {"symbol": "B", "name": "Beta", "marketCap": "", "sector": None},
    ]}}
    path = tmp_path / "symbols.json"
    path.write_text(json.dumps(body, indent=2))
    from_file = payloads.read_symbol_payload(spark, str(path)).collect()
    text = spark.createDataFrame([(json.dumps(body),), ("broken",)], "value string")
    assert payloads.symbols_from_payloads(text).collect() == from_file
    assert [tuple(r) for r in from_file] == [("A", "Alpha", "$3.0T", "Tech"), ("B", "Beta", "", None)]

    daily_body = {"rt_cd": "0", "output": [
        {"xymd": "20240301", "open": "1.5", "high": "2", "low": "1", "clos": "1.75", "tvol": "3000000000"},
        {"xymd": "20240302", "open": "1.5", "high": "2", "low": "1"},
        {"xymd": "bad", "open": "x", "high": "2", "low": "1", "clos": "1", "tvol": "1"},
    ]}
    rows = spark.createDataFrame(
        [("A", json.dumps(daily_body)), ("B", json.dumps({**daily_body, "rt_cd": "1"}))], "symbol string, value string"
    )
    bars = payloads.bars_from_payloads(rows)
    assert [tuple(r) for r in bars.orderBy("date").collect()] == [
        ("A", None, None, 2.0, 1.0, 1.0, 1),
        ("A", DAY, 1.5, 2.0, 1.0, 1.75, 3000000000),
        ("A", DAY + dt.timedelta(days=1), 1.5, 2.0, 1.0, 0.0, 0),
    ]
    assert clean.complete_bars(bars).count() == 2


def test_load_test_file(spark, tmp_path):
    from candlewick.operators import opslog

    header = ",".join(f.name for f in files.LOAD_TEST.fields)
    lines = [
        header,
        "GET,/a,10,2,1,100.0,1,500,0,1.0,0" + ",0" * 11,
        "GET,/b,30,0,1,20.0,1,90,0,3.0,0" + ",0" * 11,
        ",Aggregated,40,2,1,40.0,1,500,0,4.0,0" + ",0" * 11,
    ]
    path = tmp_path / "stats.csv"
    path.write_text("\n".join(lines))
    stats = files.read_load_test(spark, str(path))
    assert [tuple(r) for r in opslog.load_test_totals(stats).collect()] == [(40, 2, 5.0, 60.0, 40.0, 500.0, 2.0)]
    doubled = opslog.load_test_totals(stats, include_aggregated=True).first()
    assert doubled["total_requests"] == 80 and doubled["total_failures"] == 4
    assert [r["name"] for r in opslog.slowest_requests(stats).collect()] == ["/a", "/b"]
    assert [tuple(r) for r in opslog.most_failing_requests(stats).collect()] == [("/a", 20.0, 2)]


def test_log_file(spark, tmp_path):
    from candlewick.operators import opslog

    path = tmp_path / "service.log"
    path.write_text("\n".join([
        "t - m - INFO - 🌐 요청: GET /x - 200 (0.300초)",
        "t - m - INFO - 🌐 요청: GET /x - 500 (0.100초)",
        "t - m - INFO - 🌐 요청: GET /x - 500 (abc초)",
        "t - m - WARNING - API 요청 (1.5초) ERROR",
        "t - m - DEBUG - 📤 Kafka 메시지: a - success",
        "t - m - INFO - 🗃️ DB 작업: insert - success (0.5초)",
        "t - m - WARNING - slow",
        "t - m - ERROR - ❌ failed",
        "{",
    ]), encoding="utf-8")
    lines = files.read_log(spark, str(path))
    assert [tuple(r) for r in opslog.log_event_counts(lines).collect()] == [(9, 4, 1, 1, 1, 1, pytest.approx(100 / 6))]
    stats = opslog.response_stats(lines).first()
    assert stats["median_seconds"] == 0.3 and stats["max_seconds"] == 1.5 and stats["min_seconds"] == 0.1


@pytest.mark.parametrize("count", [1, 2, 3, 10, 11])
def test_upper_median(spark, count):
    from candlewick.operators import opslog

    values = {"a": [i * 0.37 % 5 for i in range(count)], "b": [1.0] * count + [2.0]}
    rows = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k string, v double")
    found = {r["k"]: r["upper_median"] for r in opslog.upper_median(rows, "v", ["k"]).collect()}
    assert found == {k: sorted(vs)[len(vs) // 2] for k, vs in values.items()}


@pytest.mark.parametrize("cuts, most", [(64, 4096), (8, 50), (4, 1)])
def test_upper_median_of_dense_values(spark, cuts, most):
    """All values within 0.01, one group with most rows, few distinct values, one value, none: as plain sorting has it."""
    from candlewick.operators import selection

    rng = np.random.default_rng(cuts)
    groups = {"dense": 5 + rng.random(6000) / 100, "wide": np.exp(rng.normal(0, 20, 900)) * rng.choice([-1, 1], 900),
              "few": rng.choice([1.0, 2.0, 3.0], 500), "one": np.array([7.0]), None: rng.random(40)}
    rows = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs] + [("one", None), ("none", None)], "k string, v double")
    found = {r["k"]: r["upper_median"] for r in selection.upper_median(rows, "v", ["k"], cuts, most).collect()}
    assert found == {k: sorted(vs)[len(vs) // 2] for k, vs in groups.items()}
    whole = sorted(v for vs in groups.values() for v in vs)
    frame = selection.upper_median(rows, "v", None, cuts, most)
    assert [tuple(r) for r in frame.collect()] == [(whole[len(whole) // 2],)]
    assert selection.upper_median(rows.where("v > 1e300"), "v", None, cuts, most).count() == 0
    third = selection.select_element(rows, "v", ["k"], lambda n: F.floor(n / 3), "third", cuts, most)
    assert {r["k"]: r["third"] for r in third.collect()} == {k: sorted(vs)[len(vs) // 3] for k, vs in groups.items()}
    # One task gets the values of the last range, at most `most` of them; no exchange to one task lies above all values.
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_sharded_write(spark, tmp_path):
    bars = spark.createDataFrame([bar(f"S{i}", d, 1.0) for i in range(40) for d in range(3)], BARS)
    path = str(tmp_path / "shards")
    shards.write_sharded(bars, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 120
    stats = {r["shard_number"]: (r["symbol_count"], r["record_count"]) for r in shards.shard_stats(bars).collect()}
    sizes = {r["shard"]: r["count"] for r in stored.groupBy("shard").count().collect()}
    assert sizes == {k: v[1] for k, v in stats.items()}
    assert sum(v[0] for v in stats.values()) == 40


def test_daily_job(spark, tmp_path):
    rising = [bar("A", d, 100.0 + d) for d in range(30)] + [bar("B", d, 130.0 - d) for d in range(30)]
    symbols = spark.createDataFrame(
        [("A", "Alpha", "$3.0T", "Tech", None), ("B", "Beta", "$5B", "Tech", None)], SYMBOLS
    )
    bars_root, list_root = str(tmp_path / "bars"), str(tmp_path / "list")
    first = spark.createDataFrame(rising[:20] + rising[30:], BARS)
    daily.store_bars(first, bars_root)
    daily.store_bars(spark.createDataFrame(rising, BARS), bars_root)
    stored = snapshots.read_snapshot(spark, bars_root)
    assert stored.count() == 60
    daily.store_indicators(bars_root, str(tmp_path / "indicators"), spark)
    assert snapshots.read_snapshot(spark, str(tmp_path / "indicators")).count() == 60
    days = [DAY + dt.timedelta(days=d) for d in (28, 29, 29)]
    for day in days:
        daily.store_watchlist(stored, symbols, list_root, str(day))
    rows = snapshots.read_snapshot(spark, list_root).orderBy("date").collect()
    assert [(r["symbol"], r["date"], r["market_cap_tier"]) for r in rows] == [("A", days[0], 1), ("A", days[1], 1)]
    before = {r["date"]: r["created_at"] for r in rows}
    daily.store_watchlist(stored, symbols, list_root, str(days[1]))
    after = {r["date"]: r["created_at"] for r in snapshots.read_snapshot(spark, list_root).collect()}
    assert after == before  # a rescan keeps the time of the first entry


def test_daily_store_keeps_keys_unique(spark, tmp_path):
    root = str(tmp_path / "unique")
    delivery = spark.createDataFrame([bar("A", -2000, 1.0), bar("A", 0, 1.0), bar("A", 0, 2.0)], BARS)
    daily.store_bars(delivery, root)
    daily.store_bars(delivery, root)
    assert sorted(row.close for row in snapshots.read_snapshot(spark, root).collect()) == [1.0, 2.0]
    # The last delivered row counts, not the one with the greater figures.
    falling = spark.createDataFrame([(*bar("A", 0, 9.0), 1), (*bar("A", 0, 5.0), 2), (*bar("A", 0, 7.0), 0)], StructType([*BARS.fields, StructField("line", LongType())]))
    daily.store_bars(falling.repartition(3), root, "line")
    assert sorted(row.close for row in snapshots.read_snapshot(spark, root).collect()) == [1.0, 5.0]


def test_delivery_touches_only_what_changed(spark, tmp_path):
    bars_root, table_root = tmp_path / "bars", tmp_path / "indicators"
    rng = np.random.default_rng(5)
    first = dt.date(2022, 1, 1)
    history = {s: {first + dt.timedelta(days=i): 50 + float(x) for i, x in enumerate(np.cumsum(rng.normal(0, 1, 700)))} for s in "ABC"}

    def rows(symbol, days):
        return [(symbol, d, c, c + 1, c - 1, c, 10 + d.day) for d, c in sorted(history[symbol].items()) if d in days]

    def store(data):
        daily.store_delivery(spark.createDataFrame(data, BARS), str(bars_root), str(table_root))

    def times(root):
        return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in root.rglob("*.parquet")}

    def check():
        bars = snapshots.read_months(spark, str(bars_root), BARS).drop("month")
        want = {(r["symbol"], r["date"]): r for r in indicator_table(bars).collect()}
        kinds = indicator_table(spark.createDataFrame([], BARS)).schema
        found = {(r["symbol"], r["date"]): r for r in snapshots.read_months(spark, str(table_root), kinds).collect()}
        assert set(found) == set(want) and len(want) > 0
        for key, row in want.items():
            for name in want[key].asDict():
                if isinstance(row[name], float):
                    assert found[key][name] == pytest.approx(row[name], rel=1e-9, abs=1e-9), (key, name)
                else:
                    assert found[key][name] == row[name], (key, name)

    days = sorted(history["A"])
    store([x for s in "ABC" for x in rows(s, set(days[:650]) - {days[20]})])
    check()
    before = times(bars_root) | {"t/" + k: v for k, v in times(table_root).items()}
    # Delivered again, unchanged: nothing is written.
    store(rows("B", set(days[600:640])))
    assert times(bars_root) | {"t/" + k: v for k, v in times(table_root).items()} == before
    # New days, with some old ones again: only months from the first new day on are written.
    store([x for s in "AB" for x in rows(s, set(days[640:700]))])
    check()
    after = times(bars_root) | {"t/" + k: v for k, v in times(table_root).items()}
    old = {k: v for k, v in before.items() if k.split("month=")[1][:7] < days[650].strftime("%Y-%m")}
    assert old.items() <= after.items() and after.keys() - before.keys()
    # An old day that was missing, and a corrected one: the running volume of all later days changes.
    history["A"][days[300]] += 7
    store(rows("A", {days[300]}) + rows("C", {days[20]}))
    check()
    assert times(bars_root).items() >= {k: v for k, v in times(bars_root).items() if days[300].strftime("%Y-%m") not in k}.items()


def test_a_delivery_leaves_only_the_tables(spark, tmp_path):
    work = Path(shared_dir(spark).removeprefix("file:"))
    left = lambda: {p for name in ("written", "staged") for p in (work / name).glob("*")}
    before = left()
    for day in (0, 1, 1):
        daily.store_delivery(
            spark.createDataFrame([bar("A", day, 1.0), bar("B", day, 2.0)], BARS), str(tmp_path / "bars"), str(tmp_path / "indicators"))
    assert left() == before
    assert spark.read.parquet(str(tmp_path / "bars")).count() == spark.read.parquet(str(tmp_path / "indicators")).count() == 4


def test_a_large_store_is_kept_in_parts(spark, tmp_path, monkeypatch):
    """A part is worked out and swapped at a time; the rows are those of the whole table, whatever later deliveries hold."""
    monkeypatch.setattr(daily, "PART_ROWS", 50)
    roots, kinds = [str(tmp_path / "bars"), str(tmp_path / "indicators")], indicator_table(spark.createDataFrame([], BARS)).schema
    placed, held, swapped = StructType([*BARS.fields, StructField("line", LongType())]), {}, []
    write = lambda table, root: (swapped.append(root), snapshots.write_months(table, root))
    monkeypatch.setattr(daily, "write_months", write)

    def store(rows):
        held.update({row[:2]: row for row in rows})
        # Each row comes twice, first with a wrong close.
        lines = [(*row[:5], row[5] + 9, row[6], 2 * n) for n, row in enumerate(rows)] + [(*row, 2 * n + 1) for n, row in enumerate(rows)]
        daily.store_delivery(spark.createDataFrame(lines, placed).repartition(3), *roots, "line")
        bars = snapshots.read_months(spark, roots[0], BARS).drop("month")
        assert {tuple(r[:2]): tuple(r) for r in bars.collect()} == held and bars.count() == len(held)
        want = {tuple(r[:2]): r for r in indicator_table(spark.createDataFrame(list(held.values()), BARS)).collect()}
        table = snapshots.read_months(spark, roots[1], kinds)
        assert table.columns == [*kinds.names, "month"] and table.count() == len(held)
        for row in table.collect():
            assert row["month"] == row["date"].strftime("%Y-%m")
            for found, value in zip(row[2:-1], want[tuple(row[:2])][2:], strict=True):
                assert found == (value if value is None else pytest.approx(value, rel=1e-9, abs=1e-9)), row
        for root in roots:  # a symbol lies in one part
            where = spark.read.parquet(f"{root}/parts=2").groupBy("symbol").agg(F.countDistinct("part").alias("n"))
            assert where.where("n > 1").count() == 0

    store([bar(f"S{i}", d, 50.0 + (7 * i + d * d) % 23, 5 + d) for i in range(9) for d in range(5)])
    assert {snapshots.stored_parts(spark, root) for root in roots} == {2} and len(swapped) == len(set(swapped)) > 1
    # Later deliveries keep the parts: an old day corrected, a day that was missing, a new symbol.
    monkeypatch.setattr(daily, "PART_ROWS", 1)
    store([bar("S3", 2, 70.0), bar("S4", 40, 71.0), bar("new", 1, 72.0)])
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    store([bar("S3", 2, 70.0), bar("new", 1, 72.0)])
    assert {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")} == before
    # Tables laid out differently are not mixed.
    with pytest.raises(ValueError):
        snapshots.write_months(spark.createDataFrame([bar("A", 0, 1.0)], BARS), str(tmp_path / "other"))
        daily.store_delivery(spark.createDataFrame([bar("A", 0, 1.0)], BARS), str(tmp_path / "other"), roots[1])


def test_a_delivery_leaves_no_shuffle_files(spark, tmp_path):
    dirs = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {str(p) for at in dirs for p in Path(at).rglob("shuffle_*")}
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(name, None), files()
    daily.store_delivery(
        spark.createDataFrame([bar(f"S{i}", d, 1.0 + d) for i in range(9) for d in range(9)], BARS).repartition(3), str(tmp_path / "bars"),
        str(tmp_path / "indicators"))
    deadline = time.time() + 20  # files go a moment after their query
    while files() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(name, None) == setting
    with pytest.raises(KeyError), freed_shuffles(spark):
        raise KeyError
    assert spark.conf.get(name, None) == setting


def test_old_versions_go(spark, tmp_path):
    root = str(tmp_path / "table")
    assert snapshots.drop_old_versions(spark, root) == []
    for n in range(5):
        snapshots.publish_snapshot(spark.createDataFrame([bar("A", n, 1.0)], BARS), root)
    (tmp_path / "table" / "v=6").mkdir()  # a writer is at work
    before = snapshots.read_snapshot(spark, root)
    assert snapshots.drop_old_versions(spark, root) == [1, 2, 3] and snapshots.drop_old_versions(spark, root) == []
    assert before.count() == 1 and closes(snapshots.read_snapshot(spark, root)) == {("A", 4): 1.0}
    with pytest.raises(ValueError):
        snapshots.drop_old_versions(spark, root, 0)
