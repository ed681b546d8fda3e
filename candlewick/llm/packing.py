"""Packing documents into sequences of bounded length: length patterns fitted by non-negative least squares.

1. Every document becomes token ids with an end id; only those longer than a sequence are cut.
2. The histogram of piece lengths (at most one count per possible length, so bounded) goes to the driver, which plans:
   every pattern of two or three lengths that fills a sequence exactly gets a repeat count by non-negative least squares
   against the histogram, the counts are rounded and cut to what the histogram holds, and the rest is packed by best
   fit, longest first, still on counts instead of documents.
3. The plan gives ranges of ranks: "the documents of length 900 with ranks 40 to 80 stand in sequences 7 to 46 at offset
   3196". Pieces are ranked within their length in parallel and meet their slot in an equi-join on (length, rank block).

No length is held by one task: ranks come from hash ranges of about `RANGE_ROWS` pieces, and the join deals out blocks
of `BLOCK` ranks.

Defined cases: a null or empty text is the end id alone; repeated rows are packed once each; a null doc_id is kept; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from candlewick.llm.common import encoder, in_rows, stored, table, tokenizer_path

SEQUENCE = 4096
END_ID = 1
RANGE_ROWS = 4096
BLOCK = 64
ROUNDS = 40
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"


def token_pieces(docs: DataFrame, path: str, cut: str, end_id: int, longest: int, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and `ids` (array of int) if asked for."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(path, cut).encode, int(end_id).to_bytes(4, "little")
        for batch in in_rows(batches, ["doc_id", "text"]):
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * longest)):
                    part = ids[at : at + 4 * longest]
                    row = (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, "<i4")) if with_ids else row)
            names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
            out = pd.DataFrame(rows, columns=names)
            yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    return docs.select("doc_id", "text").mapInPandas(pieces, PIECES + ", ids array<int>" * with_ids)


def length_patterns(lengths: np.ndarray, longest: int) -> np.ndarray:
    """All ascending patterns of two or three of `lengths` that sum to `longest`; a pair has 0 as its first part."""
    present = np.zeros(longest + 1, bool)
    present[lengths] = True
    present[0] = True
    found = []
    for first in np.flatnonzero(present[: longest // 3 + 1]):
        second = np.arange(max(first, 1), (longest - first) // 2 + 1)
        third = longest - first - second
        fits = present[second] & present[third]
        found.append(np.stack([np.full(fits.sum(), first), second[fits], third[fits]], 1).astype(np.int32))
    return np.concatenate(found) if found else np.zeros((0, 3), np.int32)


def fitted_counts(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 that bring the patterns' use of each length near `counts` in least squares.

    Multiplicative updates: x <- x * (A'h) / (A'Ax) keep x non-negative and lower the squared error in each round.
    """
    h = counts.astype(float)
    h[0] = 0.0  # the missing part of a pair
    parts = [patterns[:, i] for i in range(patterns.shape[1])]
    wanted = sum(h[part] for part in parts)
    x = wanted / max(wanted.max(initial=0), 1.0)
    for _ in range(rounds):
        now = sum(np.bincount(part, weights=x, minlength=len(h)) for part in parts)
        now[0] = 0.0
        x *= wanted / np.maximum(sum(now[part] for part in parts), 1e-12)
    return x


def packing_plan(histogram: dict[int, int], longest: int = SEQUENCE) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, first rank, last rank + 1, pieces per sequence, first sequence, offset) that hold every piece."""
    counts = np.zeros(longest + 1, np.int64)
    for length, count in histogram.items():
        counts[length] = count
    groups: list[tuple[int, tuple]] = []  # (sequences, chain of (rest of chain, length, pieces per sequence))
    if counts[longest]:
        groups.append((int(counts[longest]), ((), longest, 1)))
        counts[longest] = 0
    patterns = length_patterns(np.flatnonzero(counts), longest)
    if len(patterns):
        x = fitted_counts(patterns, counts)
        steps = np.floor(np.concatenate(([0.0], np.cumsum(x))) + 0.5)  # rounds the running sum: the total stays right
        repeats = np.diff(steps).astype(np.int64)
        for at in np.flatnonzero(repeats):
            parts, per = np.unique(patterns[at][patterns[at] > 0], return_counts=True)
            repeat = min(int(repeats[at]), int((counts[parts] // per).min()))
            if repeat:
                counts[parts] -= repeat * per
                chain: tuple = ()
                for length, m in zip(parts[::-1].tolist(), per[::-1].tolist()):
                    chain = (chain, length, m)
                groups.append((repeat, chain))
    groups += _best_fit(counts, longest)
    slots, used, sequence = [], np.zeros(longest + 1, np.int64), 0
    for n, chain in groups:
        offset = 0
        while chain:
            chain, length, m = chain
            first = int(used[length])
            slots.append((length, first, first + n * m, m, sequence, offset))
            used[length] += n * m
            offset += length * m
        sequence += n
    return slots


def _best_fit(counts: np.ndarray, longest: int) -> list[tuple[int, tuple]]:
    """Best fit, longest first, on counts: open sequences with the same content are one group."""
    import bisect

    open_by_room: dict[int, list[tuple[int, tuple]]] = {}
    rooms: list[int] = []  # sorted, those of open groups

    def put(room: int, n: int, chain: tuple) -> None:
        if room not in open_by_room:
            open_by_room[room] = []
            bisect.insort(rooms, room)
        open_by_room[room].append((n, chain))

    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                n, chain = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room]
                    rooms.pop(at)
            else:
                room, n, chain = longest, -(-left // (longest // length)), ()
            m = min(room // length, left)
            filled = min(n, left // m)
            put(room - m * length, filled, (chain, length, m))
            left -= filled * m
            if n > filled and chain:
                put(room, n - filled, chain)
    return [group for groups in open_by_room.values() for group in groups]


def ranked_by_length(pieces: DataFrame, histogram: DataFrame) -> DataFrame:
    """`pieces` with `rank`, from 0 without gaps within each length."""
    spread = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.ceil(F.col("n") / RANGE_ROWS))
    # One row per length, `longest` rows at most: small enough to broadcast at any size of input.
    dealt = pieces.join(F.broadcast(histogram), "length").withColumn("range", spread).drop("n")
    ranges = dealt.groupBy("length", "range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("length", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("range_start"))
    inside = Window.partitionBy("length", "range").orderBy("doc_id", "piece", "ids_crc32")
    numbered = dealt.withColumn("row", F.row_number().over(inside))
    return numbered.join(ranges, ["length", "range"]).withColumn(
        "rank", F.col("range_start") + F.col("row") - 1
    ).drop("range", "row", "range_start")


def packed(pieces: DataFrame, longest: int = SEQUENCE) -> DataFrame:
    """`pieces` (a stored table) with sequence_id and offset."""
    spark = pieces.sparkSession
    histogram = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    plan = packing_plan({row.length: row.n for row in histogram.collect()}, longest)
    names = ["slot_length", "first", "last", "m", "sequence", "at"]
    columns = np.array(plan, np.int64).reshape(-1, 6).T
    slots = spark.createDataFrame(pa.table(dict(zip(names, columns))))
    slots = stored(slots, "pack-slots").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("first") / BLOCK), F.floor((F.col("last") - 1) / BLOCK)))
    )
    ranked = ranked_by_length(pieces, histogram).withColumn("rank_block", F.floor(F.col("rank") / BLOCK))
    turn = F.col("rank") - F.col("first")
    return ranked.join(
        slots,
        (F.col("length") == F.col("slot_length")) & (F.col("rank_block") == F.col("block"))
        & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")),
    ).select(
        *pieces.columns,
        (F.col("sequence") + F.floor(turn / F.col("m"))).alias("sequence_id"),
        (F.col("at") + turn % F.col("m") * F.col("length")).alias("offset"),
    )


def packed_documents(docs: DataFrame, longest: int = SEQUENCE, tokenizer: str | None = None) -> DataFrame:
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    pieces = stored(token_pieces(docs, path, "dropped", END_ID, longest), "pack-pieces")
    return packed(pieces, longest).withColumn("length", F.col("length").cast("long"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))
