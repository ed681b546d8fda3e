"""Hard negatives by Fagin's threshold algorithm over blocks of integer vectors.

Vectors are scaled to whole numbers, so that scores are exact integers and ties are real ties. A block keeps, for each
dimension, the list of its rows sorted by that component. An anchor reads all lists side by side, from the top where its own
component is positive and from the bottom where it is negative (a zero is not read at all), scores every row it meets for the
first time from the whole vector, and after each stride knows a threshold: no row that it has not met scores more than the sum
of its components times those at the present depth. It stops once the threshold is strictly below what each window still
needs: the kth score found there or, while the window is not full, its lowest score that counts.

The first search finds each anchor's positives, among blocks of its own label only. The second looks for negatives in the
windows `[share * positive score, positive score]` of all positives at once, in all blocks.

Rows are dealt into blocks of about `BLOCK_ROWS`, anchors into groups of about `ANCHORS`; a task searches one block for one
group, so no task holds a label, however common, and an anchor leaves a task with at most k rows a window. The blocks of a
label's bucket grow in number with the bucket, and rare labels share one.

Defined cases: rows without a label or vector, with a null, NaN or infinite component, or with components so large that an inner
product could leave 64 bits (squares above 2^62 in sum) take no part; an empty vector scores 0; vectors meet only those of
their own dimension; every row is a candidate and an anchor of its own, rows of one vec_id too; ties go to the smaller
vec_id, a null one last; an empty table, or anchors without positives or negatives, give no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from candlewick.llm.common import stored, table

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LEAST_PERCENT = 80
BLOCK_ROWS = 8192
ANCHORS = 8192
STRIDE = 32
NO_ID = (1 << 63) - 1


def integer_vectors(frame: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, label, v, dim): one row per usable vector, `row` a number of its own. Stored, as `row` depends on the files read."""
    x = F.col("x")
    usable = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    small = F.aggregate(x, F.lit(0.0), lambda a, e: a + F.floor(e * scale).cast("double") * F.floor(e * scale).cast("double"))
    taken = frame.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                         F.col("embedding").cast("array<double>").alias("x")).where(
        F.col("label").isNotNull() & x.isNotNull() & usable).where(small < float(1 << 62))
    return stored(taken.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "label", F.transform(x, lambda e: F.floor(e * scale).cast("long")).alias("v"),
        F.size(x).alias("dim")), "negatives-vectors")


class Lists:
    """The sorted lists of a block."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((rows, ids))  # places in the block are in the order of ties
        self.rows, self.ids, self.labels, self.vectors = rows[order], ids[order], labels[order], vectors[order]
        self.order = np.argsort(-self.vectors, axis=0, kind="stable").T.astype(np.int32).copy()
        self.sorted = np.take_along_axis(self.vectors.T, self.order, 1)
        # Products are exact in double precision, and faster, while no sum can reach 2^52.
        self.longest = float(np.sqrt((self.vectors.astype(float) ** 2).sum(1).max(initial=0)))
        self.doubles = self.vectors.astype(float)

    def scores(self, at: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        if self.longest * float(np.sqrt((anchor.astype(float) ** 2).sum())) < 1 << 52:
            return (self.doubles[at] @ anchor.astype(float)).astype(np.int64)
        return self.vectors[at] @ anchor

    def search(self, anchor: np.ndarray, usable: np.ndarray, low: np.ndarray, high: np.ndarray,
               k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window `low <= score <= high` the places and scores of its k best usable rows; ties to the smaller place.

        Fewer than k if there are no more. `low` may be the least integer.
        """
        n = len(self.rows)
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in low]
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        seen, depth, stride = np.zeros(n, bool), 0, STRIDE
        while depth < n:
            end = min(depth + stride, n)
            met = np.zeros(n, bool)
            met[self.order[up, depth:end].ravel()] = True
            met[self.order[down, n - end : n - depth].ravel()] = True
            if end == n:  # rows that no list has shown: all of them if the anchor is zero
                met[:] = True
            met &= ~seen
            seen |= met
            new = np.flatnonzero(met & usable)
            scores = self.scores(new, anchor)
            for i, (a, b) in enumerate(zip(low.tolist(), high.tolist())):
                inside = (scores >= a) & (scores <= b)
                if inside.any():
                    at, s = np.concatenate([best[i][0], new[inside]]), np.concatenate([best[i][1], scores[inside]])
                    first = np.lexsort((at, -s))[:k]
                    best[i] = at[first], s[first]
            # What the next rows of the lists could add up to.
            if end < n:
                most = int(anchor[up] @ self.sorted[up, end] + anchor[down] @ self.sorted[down, n - 1 - end])
                if all(most < (int(s[-1]) if len(s) == k else a) for (_, s), a in zip(best, low.tolist())):
                    break
            depth, stride = end, stride * 2
        return best


def _tiles(vectors: DataFrame, asked: DataFrame, block_rows: int, group: int, own_label: bool) -> DataFrame:
    """Rows (dim, block, group, kind, ...) of all pairs of a block and a group of anchors that have to meet.

    `asked` has row, vec_id, label, v, dim, low and high. With `own_label` an anchor meets the blocks of its label's bucket only.
    """
    sizes = vectors.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("buckets"))
    bucket = F.pmod(F.xxhash64("label"), F.col("buckets")).cast("int")
    placed = vectors.join(sizes, "dim").withColumn("bucket", bucket)
    counts = placed.groupBy("dim", "bucket").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts"))
    groups = asked.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / group).cast("int").alias("groups"))
    held = placed.join(counts, ["dim", "bucket"]).join(groups, "dim").select(
        "dim", "bucket", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), F.lit(0).alias("kind"),
        "row", "vec_id", "label", "v", F.array().cast("array<long>").alias("low"), F.array().cast("array<long>").alias("high"))
    own = asked.join(sizes, "dim").join(groups, "dim").withColumn("own", bucket).join(counts, "dim")
    if own_label:
        own = own.where(F.col("bucket") == F.col("own"))
    sent = own.select(
        "dim", "bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("row"), F.col("groups")).cast("int").alias("group"), F.lit(1).alias("kind"),
        "row", "vec_id", "label", "v", "low", "high")
    return held.union(sent)


def _searched(tiles: DataFrame, k: int, own_label: bool) -> DataFrame:
    """(anchor, window, row, vec_id, score): the k best rows of each block for each window of each anchor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, lists = None, [], None
        for batch in batches:
            out: list[pd.DataFrame] = []
            for dim, bucket, part, group, kind, row, vec_id, label, v, low, high in zip(*(batch[c] for c in batch.columns)):
                if key != (dim, bucket, part, group):
                    key, held, lists = (dim, bucket, part, group), [], None
                if kind == 0:
                    held.append((row, vec_id, label, v))
                    continue
                if lists is None:
                    if not held:
                        continue
                    lists = Lists(*(np.array([x[i] for x in held], np.int64) for i in range(3)),
                                  np.array([x[3] for x in held], np.int64).reshape(len(held), dim))
                    held = []
                usable = (lists.labels == label) & (lists.rows != row) if own_label else lists.labels != label
                best = lists.search(np.asarray(v, np.int64), usable, np.asarray(low), np.asarray(high), k)
                at, scores = (np.concatenate(x) for x in zip(*best))
                window = np.repeat(np.arange(len(best), dtype=np.int32), [len(x) for x, _ in best])
                out.append((np.full(len(at), row), window, lists.rows[at], lists.ids[at], scores))
            if out:
                yield pd.DataFrame(dict(zip(("anchor", "window", "row", "vec_id", "score"), map(np.concatenate, zip(*out)))))

    place = ("dim", "bucket", "part", "group")
    dealt = tiles.withColumn("vec_id", F.coalesce("vec_id", F.lit(NO_ID))).repartition(*place)
    return dealt.sortWithinPartitions(*place, "kind", "row").mapInPandas(
        run, "anchor long, window int, row long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of all blocks, with their rank. A block sends at most k rows a window, and Spark cuts again before the shuffle."""
    place = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def positives(vectors: DataFrame, anchors: DataFrame, k: int = POSITIVES, block_rows: int = BLOCK_ROWS, group: int = ANCHORS) -> DataFrame:
    """(anchor, rank, row, vec_id, score): for each row of `anchors` its k best other rows of the same label."""
    lowest, highest = (F.array(F.lit(x)).alias(name) for x, name in ((-NO_ID - 1, "low"), (NO_ID, "high")))
    tiles = _tiles(vectors, anchors.select("*", lowest, highest), block_rows, group, own_label=True)
    return _best(_searched(tiles, k, own_label=True), k).select("anchor", "rank", "row", "vec_id", "score")


def hard_negatives(
    vectors: DataFrame, anchors: DataFrame, k_positives: int = POSITIVES, k: int = NEGATIVES, least_percent: int = LEAST_PERCENT,
    block_rows: int = BLOCK_ROWS, group: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), and the rows `anchor`, `positive`, `negative`.

    Both sides from `integer_vectors`; `anchors` are some rows of `vectors`.
    """
    near = stored(positives(vectors, anchors, k_positives, block_rows, group), "negatives-positives")
    least = F.ceil(F.col("score").cast("decimal(20,0)") * least_percent / 100).cast("long")
    windows = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", least.alias("low"), "score"))).alias("w"))
    asked = anchors.join(windows, F.col("row") == F.col("anchor")).select(
        anchors["*"], F.col("w.low").alias("low"), F.col("w.score").alias("high"))
    found = _best(_searched(_tiles(vectors, asked, block_rows, group, own_label=False), k, own_label=False), k)
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    names = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    pairs = near.select("anchor", (F.col("rank") - 1).alias("window"), F.col("row").alias("positive"),
                        known("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(pairs, ["anchor", "window"]).join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", known("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
        "anchor", "positive", F.col("row").alias("negative"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"), label)
    found = hard_negatives(vectors, vectors.where(F.col("vec_id") % 100 == 0))
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


OP12_SQL = f"""
WITH vectors AS (
    SELECT row_number() OVER () AS r, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
    SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
           CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM vectors a JOIN vectors b ON a.r <> b.r AND len(a.v) = len(b.v)
    WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT * FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, r) <= {POSITIVES})
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER w AS INTEGER) AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON p.anchor = n.anchor AND NOT n.same
     AND {LEAST_PERCENT} * p.score <= 100 * n.score AND n.score <= p.score
WINDOW w AS (PARTITION BY p.anchor, p.r ORDER BY n.score DESC, n.vec_id, n.r)
QUALIFY row_number() OVER w <= {NEGATIVES}"""
