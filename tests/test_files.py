"""Quarantine, profiles from footers, copies checked by content."""

import pytest
from pyspark.sql import functions as F

from candlewick.schemas import BARS, LOAD_TEST
from candlewick.sources import files, profile, quarantine

FOLDER = "/root/testdata/sf0.001"


def test_csv_keeps_bad_lines(spark, tmp_path):
    header = ",".join(f.name for f in LOAD_TEST.fields)
    good = "GET,/a,10,1," + ",".join(["2.5"] * 18)
    bad = ["GET,/b,ten,1," + ",".join(["2.5"] * 18), "GET,/c", good + ",more", ""]
    (tmp_path / "x.csv").write_text("\n".join([header, good, *bad, good]), encoding="utf-8")
    parts = quarantine.divide(
        files.read_load_test(spark, str(tmp_path / "x.csv")), F.col(quarantine.CORRUPT).isNotNull(), str(tmp_path / "parts"))
    assert (parts.n_good, parts.n_rejected) == (2, 3) == (parts.good.count(), parts.rejected.count())
    assert {r[quarantine.CORRUPT] for r in parts.rejected.collect()} == set(bad[:3])
    assert [r["Request Count"] for r in parts.good.collect()] == [10, 10]


def test_json_keeps_bad_lines(spark, tmp_path):
    lines = ['{"symbol": "A", "close": 1.5}', "{broken", '["no", "object"]', '{"symbol": "B"}', "null", "7"]
    (tmp_path / "x.json").write_text("\n".join(lines), encoding="utf-8")
    raw = quarantine.read_json(spark, str(tmp_path / "x.json"), BARS)
    parts = quarantine.divide(raw, F.col(quarantine.CORRUPT).isNotNull(), str(tmp_path / "parts"))
    assert {r["symbol"] for r in parts.good.collect()} >= {"A", "B"}
    assert "{broken" in {r[quarantine.CORRUPT] for r in parts.rejected.collect()}
    assert parts.n_good + parts.n_rejected == raw.count()


def test_unreadable_names_the_columns(spark):
    text = "symbol string, date string, open string, high string, low string, close string, volume string"
    rows = spark.createDataFrame(
        [("A", "2024-01-01", "1", "1", "1", "1", "1"), ("A", "yesterday", "1", "1", "1", "x", None), (None, "2024-01-01", "1", "1", "1", "1", "1.5")], text)
    found = [r[0] for r in rows.select(quarantine.unreadable(BARS)).collect()]
    assert found == [[], ["date", "close", "volume"], ["symbol", "volume"]]


def test_nothing_to_divide(spark, tmp_path):
    empty = spark.createDataFrame([], BARS)
    parts = quarantine.divide(empty, F.col("close") < 0, str(tmp_path / "parts"))
    assert (parts.n_good, parts.n_rejected, parts.good.count(), parts.rejected.count()) == (0, 0, 0, 0)


def test_profile_reads_footers_only(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "one"))
    spark.range(7).repartition(3).write.parquet(str(tmp_path / "two.parquet"))
    (tmp_path / "other").mkdir()
    found = profile.catalog_profile(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == [("one", 10, "id"), ("two", 7, "id")]
    text = profile.catalog_profile(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert text.count("PushedAggregation: [COUNT(*)]") == 2
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as it was
    (tmp_path / "empty").mkdir()
    assert profile.catalog_profile(spark, str(tmp_path / "empty")).count() == 0


def test_copies_are_compared_by_content(spark, tmp_path, monkeypatch):
    source = str(tmp_path / "source")
    rows = spark.createDataFrame([(1, "a", [1.0], {"k": 1}), (2, None, None, None), (2, None, None, None)], "n int, s string, v array<double>, m map<string,int>")
    rows.write.parquet(source)
    assert profile.copy_table(spark, source, str(tmp_path / "copy")) == 3
    for other in (rows.where("n = 1").unionByName(rows.where("n = 1")).unionByName(rows.where("n = 1")), rows.limit(2),
                  rows.withColumn("s", F.coalesce("s", F.lit("")))):
        assert profile.content(rows) != profile.content(other)
    before = profile.content
    monkeypatch.setattr(profile, "content", lambda frame: before(frame.limit(2) if "wrong" in frame.inputFiles()[0] else frame))
    with pytest.raises(RuntimeError):
        profile.copy_table(spark, source, str(tmp_path / "wrong"))


def test_registry_on_any_file_system(spark, tmp_path):
    path = f"file://{tmp_path}/deep/registry.json"
    files.write_registry(spark, path, {"indicators": {"한국": {"x": {"type": "SMA", "period": 5}}}})
    assert files.registry_entries(files.read_registry(spark, path)) == [("x", "SMA", {"period": 5})]
