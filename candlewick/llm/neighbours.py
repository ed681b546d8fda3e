"""Approximate nearest neighbours by collision counting on single random projections.

A block of vectors keeps, for each projection, the sorted array of its projected values, and of each vector its rank in that array.
A query centres a window on its own value in every array: an interval of ranks, found for all queries of a batch by one
binary search per array. A vector collides where its rank lies inside. Windows widen step by step (virtual rehashing: the
arrays stay, only the intervals grow) to the first width at which enough vectors collide in `SHARE_OF_PROJECTIONS` of the
projections; those that collide most often are verified by their exact inner product in double precision.

A query verifies about `VERIFIED` vectors of the whole table, whatever its size: each block answers for its share of them, larger
for longer vectors, and for no fewer than are asked for.
Projections grow with the logarithm of the number of vectors, so that as few false collisions are left in a larger table.

Largest inner product becomes least distance by one more coordinate: a vector x of length at most M becomes
(x, sqrt(M^2 - |x|^2)), a query (q, 0) brought to length M.

Vectors are dealt into bands of nearly equal length (within a factor of `BAND`), and by hash inside a band into blocks of
about `BLOCK_ROWS`; M is a block's own longest, as a far longer vector would leave the others hardly apart. Windows that keep
nine of ten near neighbours in some dozens of dimensions hold about half of all vectors, so a query meets every block; the
queries go through a block in batches, and a query's best of each block are merged. Recall against brute force is tested.

Vectors that are null, empty, zero, or hold nulls or non-finite numbers take no part; every other row is a candidate and, if
asked, a query of its own, rows of one id too; vectors meet only those of their own dimension; equal scores go to the smaller
id, a null one last; fewer candidates than asked for are all returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from candlewick.llm.common import stored, table

NO_ID = (1 << 63) - 1
LEAST_PROJECTIONS = 96
PROJECTIONS_A_DOUBLING = 8  # more for each doubling of the table beyond 1,024 vectors
MOST_PROJECTIONS = 255  # collisions are counted in one byte
SHARE_OF_PROJECTIONS = 0.62
VERIFIED = 4000  # vectors a query
WIDTHS = np.geomspace(0.1, 4.0, 28)  # of half a window, in units of M
BAND = 1.1
LENGTH_POWER = 4
BLOCK_ROWS = 4096
BATCH = 256
NEAREST = 20


def clean_vectors(frame: DataFrame) -> DataFrame:
    """(row, vec_id, v, dim, band): each row with a usable vector, in double precision, `row` being a number of its own.

    Stored, as `row` depends on the files read."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = frame.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where(
        v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    return stored(usable.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "v", F.size("v").alias("dim"), band().alias("band")), "vectors")


def band() -> Column:
    """Logarithm of the length to the base `BAND`, rounded. Taken by the greatest number, so that no square overflows."""
    greatest = F.array_max(F.transform("v", F.abs))
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / greatest) * (x / greatest))
    return F.round((F.log(greatest) + F.log(squares) / 2) / float(np.log(BAND))).cast("int")


def projections(vectors: int) -> int:
    more = PROJECTIONS_A_DOUBLING * max(0.0, float(np.log2(max(vectors, 1) / 1024)))
    return int(min(MOST_PROJECTIONS, LEAST_PROJECTIONS + more))


class Block:
    """The index of some vectors of one dimension, out of a table of `of`; `share` is what each adds to what a query verifies."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, of: int, share: float):
        order = np.lexsort((rows, ids))  # places are in the order of ties
        self.rows, self.ids, self.vectors = rows[order], ids[order], vectors[order]
        # Lengths and projections of vectors brought to a length of at most 1, so that no square overflows.
        self.scale = float(np.abs(vectors).max())
        small = self.vectors / self.scale
        square = np.einsum("ij,ij->i", small, small)
        self.longest, self.share = float(np.sqrt(square.max())), share
        self.directions = np.random.default_rng(7).standard_normal((vectors.shape[1] + 1, projections(of)))
        rest = np.sqrt(np.maximum(self.longest**2 - square, 0))
        values = (small @ self.directions[:-1] + rest[:, None] * self.directions[-1]).T
        places = np.argsort(values, axis=1, kind="stable")
        self.sorted = np.take_along_axis(values, places, 1)
        # Rank of each vector in each sorted array; 16 bits, as a block has fewer rows than that.
        self.rank = np.empty(values.shape, np.uint16)
        np.put_along_axis(self.rank, places, np.arange(values.shape[1], dtype=np.uint16)[None, :], 1)

    def windows(self, centres: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """First rank and number of ranks of the windows of some queries (rows) in each array (columns)."""
        width = WIDTHS[level] * self.longest
        low, high = np.empty(centres.shape, np.int64), np.empty(centres.shape, np.int64)
        for j, values in enumerate(self.sorted):
            low[:, j] = np.searchsorted(values, centres[:, j] - width)
            high[:, j] = np.searchsorted(values, centres[:, j] + width, "right")
        return low, high - low

    def collisions(self, low: np.ndarray, size: np.ndarray) -> np.ndarray:
        """In how many arrays each vector lies inside one query's window."""
        inside = self.rank - low.astype(np.uint16)[:, None] < size.astype(np.uint16)[:, None]  # wraps round below `low`
        return np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8)

    def candidates(self, queries: np.ndarray, wanted: int) -> list[np.ndarray]:
        """Places of the `wanted` vectors that collide most, for each query, at the first width at which so many collide often enough."""
        n, m = len(self.rows), len(self.sorted)
        if wanted >= n:
            return [np.arange(n)] * len(queries)
        length = np.sqrt(np.einsum("ij,ij->i", queries, queries))
        centres = (queries * (self.longest / length)[:, None]) @ self.directions[:-1]
        enough, known, out = int(np.ceil(SHARE_OF_PROJECTIONS * m)), {}, []
        level = len(WIDTHS) // 2
        for i in range(len(queries)):
            # Windows of one level hold those of the level below, so the first level that does can be sought from any other.
            counts, fits = {}, {}

            def fit(at: int) -> bool:
                if at not in fits:
                    if at not in known:
                        known[at] = self.windows(centres, at)
                    counts[at] = self.collisions(known[at][0][i], known[at][1][i])
                    fits[at] = bool(np.count_nonzero(counts[at] >= enough) >= wanted)
                return fits[at]

            last = len(WIDTHS) - 1
            while level < last and not fit(level):
                level += 1
            while level > 0 and fit(level - 1):
                level -= 1
            fit(level)
            found = counts[level].astype(np.int16)
            out.append(np.argpartition(-found, wanted - 1)[:wanted])
        return out

    def nearest(self, rows: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and scores of each query's k best, its own row left out."""
        wanted = max(k + 1, int(np.ceil(VERIFIED * len(self.rows) * self.share)))
        for row, query, at in zip(rows, queries, self.candidates(queries / self.scale, wanted)):
            at = at[self.rows[at] != row]
            # Summed row by row, so that equal vectors get equal scores wherever they stand.
            scores = (self.vectors[at] * query).sum(1)
            best = np.lexsort((at, -scores))[:k]
            yield at[best], scores[best]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEAREST, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score), and `query`, the number of the query's row; both sides from `clean_vectors`."""
    if block_rows >= 1 << 15:
        raise ValueError("ranks inside a block have 16 bits")
    sizes = vectors.groupBy("dim", "band").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.groupBy("dim").agg(F.max("band").alias("longest"), F.sum("n").alias("of"))
    # A vector's part in what is verified grows with a power of its length, as longer ones are nearer by inner product.
    sizes = sizes.join(total, "dim").withColumn("weight", F.pow(F.lit(BAND), F.greatest(F.lit(-600), LENGTH_POWER * (F.col("band") - F.col("longest")))))
    whole = sizes.groupBy("dim").agg(F.sum(F.col("weight") * F.col("n")).alias("whole"))
    sizes = sizes.join(whole, "dim").withColumn("share", F.col("weight") / F.col("whole"))
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    vec_id = F.coalesce("vec_id", F.lit(NO_ID)).alias("vec_id")
    dealt = vectors.join(sizes, ["dim", "band"]).select(
        "dim", "band", F.pmod(F.xxhash64("row"), blocks).cast("int").alias("block"), F.lit(0).alias("kind"), "row", vec_id, "v", "of", "share")
    asked = queries.drop("band").join(sizes, "dim").select(
        "dim", "band", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(1).alias("kind"), "row", vec_id, "v", "of", "share")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, block, waiting = None, [], None, []

        def answered() -> pd.DataFrame:
            rows, ids, queries = (np.array([x[i] for x in waiting]) for i in range(3))
            found = list(block.nearest(rows, np.stack([x[2] for x in waiting]), k))
            size = [len(at) for at, _ in found]
            at = np.concatenate([at for at, _ in found])
            return pd.DataFrame({
                "query": np.repeat(rows, size), "query_id": np.repeat(ids, size), "row": block.rows[at], "vec_id": block.ids[at],
                "score": np.concatenate([scores for _, scores in found])})

        for batch in batches:
            for dim, band, part, kind, row, vec_id, v, of, share in zip(*(batch[c] for c in batch.columns)):
                if key != (dim, band, part) or len(waiting) == BATCH:
                    if waiting and block is not None:
                        yield answered()
                    waiting = []
                if key != (dim, band, part):
                    key, held, block = (dim, band, part), [], None
                if kind == 0:
                    held.append((row, vec_id, v))
                    continue
                if held:
                    block = Block(np.array([x[0] for x in held], np.int64), np.array([x[1] for x in held], np.int64), np.stack([x[2] for x in held]), of, share)
                    held = []
                if block is not None:
                    waiting.append((row, vec_id, np.asarray(v)))
        if waiting:
            yield answered()

    at = ("dim", "band", "block")
    found = dealt.union(asked).repartition(*at).sortWithinPartitions(*at, "kind", "row").mapInPandas(
        run, "query long, query_id long, row long, vec_id long, score double")
    place = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "row")
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select(
        known("query_id"), "rank", known("vec_id"), "score", "query")


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = clean_vectors(table(spark, sf_dir, "embeddings"))
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0)).select("query_id", "rank", "vec_id", "score")
