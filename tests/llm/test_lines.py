"""Line dedup: the perfect hash, both ways of probing, and brute force on defined cases."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import lines
from candlewick.llm.queries import QUERIES, SQL
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n_chars int, own long, mark string, row int, kept string, a long, docs int"


def rows():
    common = "  A line that many HOLD  "
    out = [(i, f"{common}\nown line number {i}\nshort\n{common.lower()}", 1) for i in range(1, 40)]
    out += [(None, f"only rows without id hold this\n{common}", 1), (None, "only rows without id hold this", 1)]
    out += [(7, f"own line number 7\nown line number 9\né öü äß ñç\t", 1), (3, "É öü äß ñç\né öü äß ñç", 1), (50, "é öü äß ñç\x0b", 1)]
    out += [(60, None, None), (61, "", 0), (62, "\n\n", 2), (63, "\n".join(["own line number 5"] * 50), 1)]
    out += [(64, "x" * 200_000 + "\n" + "word " * 300_000, 1), (65, "y\n" + "x" * 200_000, 1)] + [(70, "repeated row of one id", 1)] * 5
    return [(*x, 5, "m", 6, "k", 7, 8) for x in out]


def expected(rows, least=10):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    place = lambda doc_id: (doc_id is None, doc_id or 0)
    first = {}
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            first[key(line)] = min(first.get(key(line), place(doc_id)), place(doc_id))
    out = []
    for doc_id, text, *_ in rows:
        split = (text or "").split("\n")
        kept = [x for x in split if len(key(x)) < least or first[key(x)] >= place(doc_id)]
        out.append((doc_id, len(split), len(split) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limits", [{}, {"index_bytes": 0}, {"index_bytes": 0, "shard_keys": 3}, {"shard_keys": 2}])
def test_lines_match_brute_force(spark, limits):
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    index = lines.build_index(docs, **limits)
    assert (index.held is None) == ("index_bytes" in limits) and (index.n_shards > 1) == ("shard_keys" in limits)
    if index.held is None:
        few = lines._dropped_by_shards(docs, index, probes=4).select("row.doc_id", "kept").collect()
        assert len(few) == len(rows())
    found = lines.dropped_lines(docs, index).select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256)).collect()
    assert sorted(map(tuple, found), key=repr) == expected(rows())
    clean = lines.without_repeated_lines(docs, index)
    assert clean.columns == docs.columns and clean.dtypes == docs.dtypes
    assert clean.where("doc_id = 60").first()["text"] is None


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for limit in (0, 1 << 20):
        assert lines.dropped_lines(empty, lines.build_index(empty, index_bytes=limit)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_hash_is_perfect_and_minimal(n):
    rng = np.random.default_rng(n)
    a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for _ in range(2))
    counts, firsts = rng.integers(2, 70_000, n), rng.integers(-5, 1 << 60, n)
    shard = lines.LineShard.from_bytes(lines.LineShard.build(a, b, counts, firsts).to_bytes())
    assert sorted(shard._slots(a, b).tolist()) == list(range(n))
    found = shard.find(a, b)
    assert (found[0] == counts).all() and (found[1] == firsts).all()
    other = shard.find(rng.integers(0, 1 << 63, 500).astype(np.uint64), rng.integers(0, 1 << 63, 500).astype(np.uint64))
    assert (other[0] == 0).all() and (other[1] == lines.NO_ID).all()


def test_query_matches_sql(spark):
    assert difference(QUERIES["op13_line_dedup"](spark, FOLDER), connect(FOLDER), SQL["op13_line_dedup"]) is None
