"""Small report and configuration files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from candlewick.schemas import LOAD_TEST
from candlewick.sources import quarantine

# The registry used where no file exists.
DEFAULT_REGISTRY = {
    "indicators": {
        "existing": {
            "bb_upper": {"type": "BB_UPPER", "period": 20},
            "bb_middle": {"type": "BB_MIDDLE", "period": 20},
            "bb_lower": {"type": "BB_LOWER", "period": 20},
            "macd": {"type": "MACD", "fast": 12, "slow": 26},
            "rsi": {"type": "RSI", "period": 14},
        }
    }
}


def read_load_test(spark: SparkSession, path: str) -> DataFrame:
    """Load-test statistics; a line that does not fit keeps its text in `quarantine.CORRUPT`."""
    return quarantine.read_csv(spark, path, LOAD_TEST)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def _path(spark: SparkSession, path: str):
    """The path and its file system, wherever the cluster keeps it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_registry(spark: SparkSession, path: str) -> dict:
    """Indicator registry, a JSON file of a few kilobytes; the default one where the file is missing."""
    place, files = _path(spark, path)
    if not files.exists(place):
        return DEFAULT_REGISTRY
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def write_registry(spark: SparkSession, path: str, registry: dict) -> None:
    place, files = _path(spark, path)
    out = files.create(place, True)
    try:
        out.write(bytearray(json.dumps(registry, indent=2).encode()))
    finally:
        out.close()


def add_indicator(registry: dict, category: str, name: str, kind: str, **parameters) -> dict:
    """A copy of the registry with one more indicator."""
    categories = {key: dict(value) for key, value in registry["indicators"].items()}
    categories.setdefault(category, {})[name] = {"type": kind, **parameters}
    return {"indicators": categories}


def registry_entries(registry: dict) -> list[tuple[str, str, dict]]:
    """(name, type, parameters) of every indicator, in file order."""
    entries = []
    for category in registry["indicators"].values():
        for name, config in category.items():
            entries.append((name, config["type"], {k: v for k, v in config.items() if k != "type"}))
    return entries
