"""Hard negatives against brute force in whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import negatives
from candlewick.llm.queries import QUERIES, SQL
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, row int, v string, low int, anchor int, window int"


def rows(n=600, labels=4, dim=6):
    rng = np.random.default_rng(7)
    middle = rng.standard_normal((labels, dim))
    out = []
    for i in range(n):
        label = int(rng.integers(0, labels) if i % 3 else 0)  # one label holds more than a third
        out.append((i, [float(x) for x in np.round(middle[label] + rng.standard_normal(dim), 1)], label))
    out += [(i, out[40][1], 1 + i % 2) for i in range(1000, 1060)]  # copies: ties
    out += [(200, out[3][1], 2), (None, out[5][1], 1), (None, out[6][1], 0), (800, None, 1), (900, out[1][1], None)]
    out += [(801, [float("nan")] * dim, 1), (802, [None] * dim, 1), (803, [float("inf")] * dim, 1), (804, [1e300] * dim, 1)]
    out += [(700, [0.0] * dim, 1), (2000, [1.0, 2.0], 3), (2001, [1.5, 2.0], 3), (2002, [1.0, 1.9], 0), (2100, [], 0), (2101, [], 0)]
    return [(*x, 1, "v", 2, 3, 4) for x in out]


def expected(rows, k_positives=5, k=5, least=80):
    good = []
    for vec_id, v, label, *_ in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and max(map(abs, v), default=0) < 1e9:
            good.append((vec_id, [math.floor(256 * x) for x in v], label))
    order = lambda x: (-x[1], x[0] is None, x[0] or 0)
    out = []
    for i, (anchor, a, label) in enumerate(good):
        if anchor is None or anchor % 100:
            continue
        score = [(vec_id, sum(p * q for p, q in zip(a, v)), other) for j, (vec_id, v, other) in enumerate(good) if j != i and len(v) == len(a)]
        for positive, ps, _ in sorted((x for x in score if x[2] == label), key=order)[:k_positives]:
            near = sorted((x for x in score if x[2] != label and least * ps <= 100 * x[1] <= 100 * ps), key=order)[:k]
            out += [(anchor, positive, rank, vec_id, ps, ns) for rank, (vec_id, ns, _) in enumerate(near, 1)]
    return sorted(out, key=repr)


def found(spark, data, **limits):
    vectors = negatives.integer_vectors(spark.createDataFrame(data, SCHEMA).repartition(3), F.col("label"))
    out = negatives.hard_negatives(vectors, vectors.where(F.col("vec_id") % 100 == 0), **limits)
    return sorted((tuple(x)[:6] for x in out.collect()), key=repr)


@pytest.mark.parametrize("limits", [{}, {"block_rows": 50, "group": 3}])
def test_negatives_match_brute_force(spark, limits):
    assert found(spark, rows(), **limits) == expected(rows())


def test_many_labels_and_none(spark):
    data = [(i, [float(i % 7), 1.0], i // 2, 1, "v", 2, 3, 4) for i in range(300)]
    assert found(spark, data, block_rows=20) == expected(data)
    assert found(spark, []) == [] and found(spark, data[:1]) == []


def test_lists_stop_early():
    """Rows that the threshold rules out are never scored."""
    rng = np.random.default_rng(1)
    vectors = np.abs(rng.integers(0, 50, (20_000, 3)))
    vectors[:10] += 1000
    lists = negatives.Lists(np.arange(len(vectors)), np.arange(len(vectors)), np.zeros(len(vectors), int), vectors)
    scored, scores = [], lists.scores
    lists.scores = lambda at, anchor: scored.append(len(at)) or scores(at, anchor)
    best = lists.search(np.array([1, 2, 1]), np.ones(len(vectors), bool), np.array([-negatives.NO_ID]), np.array([negatives.NO_ID]), 5)
    want = sorted((-int(v @ [1, 2, 1]), i) for i, v in enumerate(vectors))[:5]
    assert [(-s, i) for i, s in zip(*(x.tolist() for x in best[0]))] == want and sum(scored) < 200


def test_large_numbers_stay_exact():
    vectors = np.array([[1 << 29, 1], [1 << 29, 2], [-(1 << 29), 3]])
    lists = negatives.Lists(np.arange(3), np.arange(3), np.zeros(3, int), vectors)
    assert lists.scores(np.arange(3), np.array([1 << 29, 1])).tolist() == [(1 << 58) + 1, (1 << 58) + 2, -(1 << 58) + 3]


def test_query_matches_sql(spark):
    assert difference(QUERIES["op12_hard_negatives"](spark, FOLDER), connect(FOLDER), SQL["op12_hard_negatives"]) is None
