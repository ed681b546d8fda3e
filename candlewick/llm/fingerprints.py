"""Document fingerprints: weighted word pairs vote on the signs of 128 bits.

The likeness of two fingerprints is the cosine that their angle stands for: cos(pi * differing bits / 128), at least 0.

`op5` also fingerprints an edited text of each document, which needs the next document in descending id order. Ids are
dealt into ranges; each range is sorted in its task and read with one document of look-ahead, and the first document of
every range is also sent to the range before it, so no order over all rows is built in one place.

Fingerprints within a Hamming radius are found with permuted block tables and joined to groups by stars, never by listing all
pairs; `op5` returns each document's group, named by its least fingerprint.

Defined cases: a null text is empty; texts without words have the zero fingerprint; equal texts have equal fingerprints;
a null id comes last; rows of one id follow each other in text order; the only document's next is itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewick.llm.common import WordHashes, in_rows, mixed, stored, table, text_bytes
from candlewick.llm.components import components

BITS = 128
SEED = 11
RADIUS = 3
FRONT_LIMIT = 20_000
ROWS = 512  # of a block of distances
_words = WordHashes(SEED)


def fingerprint(text: str | None) -> bytes:
    """128 bits; a pair's weight is the whole part of 16 times the root of its count, so that sums are exact."""
    words = text_bytes(text).lower().split()
    if not words:
        return bytes(BITS // 8)
    terms = _words.of(words)
    if len(terms) > 1:
        terms = mixed(terms[:-1] * np.uint64(3) + terms[1:])
    terms, counts = np.unique(terms, return_counts=True)
    weights = np.floor(16 * np.sqrt(counts))
    votes = np.zeros(BITS)
    for at in range(0, len(terms), 4096):
        part = terms[at : at + 4096]
        lanes = np.stack([part, mixed(part + np.uint64(0x9E3779B97F4A7C15))], 1)
        bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, BITS // 8), axis=1)
        votes += weights[at : at + 4096] @ bits.astype(np.float64)
    return np.packbits(votes * 2 > weights.sum()).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    apart = (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count()
    return max(0.0, float(np.cos(np.pi * apart / BITS)))


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) with the fingerprint as 32 hex digits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_rows(batches, ["doc_id", "text"], 4096):
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"),
                                "fingerprint": [fingerprint(text).hex() for text in batch["text"]]})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, fingerprint string")


def with_following(docs: DataFrame, parts: int) -> DataFrame:
    """`docs` dealt into partitions by descending id and sorted; `halo` rows hold the next partition's first document."""
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    steps = [i / parts for i in range(1, parts)]
    found = docs.select(F.percentile_approx(F.col("doc_id").cast("double"), steps, 10_000)).first()[0] if steps else None
    bounds = sorted(set(found or [0.0]))  # an empty table needs some bound, too
    cuts = Bucketizer(splits=[-float("inf"), *bounds, float("inf")], inputCol="_id", outputCol="_low", handleInvalid="keep")
    ranged = cuts.transform(docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("nan")))))
    last = len(bounds)
    place = F.when(F.col("doc_id").isNull(), last + 1).otherwise(last - F.col("_low")).cast("int")
    ranged = ranged.select("doc_id", "text", place.alias("part"))
    # One row per range, as many as there are partitions.
    heads = sorted((row.part, row.head) for row in ranged.groupBy("part").agg(F.max("doc_id").alias("head")).collect())
    before = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    copies = F.broadcast(spark.createDataFrame(before, "head long, before int"))
    halo = ranged.join(copies, F.col("doc_id").eqNullSafe(F.col("head"))).select(
        "doc_id", "text", F.col("before").alias("part"), F.lit(1).alias("halo"))
    return ranged.withColumn("halo", F.lit(0)).union(halo).repartitionById(last + 2, F.col("part")).sortWithinPartitions(
        "halo", F.col("doc_id").desc_nulls_last(), "text")


def edited_fingerprints(docs: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        previous, done = None, False
        for batch in in_rows(batches, ["doc_id", "text", "halo"]):
            rows = []
            for doc_id, text, halo in zip(batch["doc_id"], batch["text"], batch["halo"]):
                if done:
                    break
                text = text or ""
                own = fingerprint(text)
                if previous is not None:
                    before_id, before, mark = previous
                    changed = edited(before, text)
                    other = fingerprint(changed)
                    rows.append((before_id, len(before), hashlib.sha256(changed.encode()).hexdigest(), mark.hex(),
                                 other.hex(), likeness(mark, other), likeness(mark, own)))
                previous, done = (doc_id, text, own), bool(halo)
            out = pd.DataFrame(rows, columns=names)
            yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    return with_following(docs, parts).mapInPandas(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")


def _lane(hexed: Column, lane: int) -> Column:
    """16 hex digits as a signed long; the two halves are converted apart since one long cannot hold the unsigned value."""
    high = F.conv(F.substring(hexed, 16 * lane + 1, 8), 16, 10).cast("long")
    low = F.conv(F.substring(hexed, 16 * lane + 9, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(low)


def _digits(places: list[int]) -> Column:
    """Some hex digits of a fingerprint, as one string."""
    runs: list[list[int]] = []
    for at in places:
        if runs and runs[-1][1] == at:
            runs[-1][1] = at + 1
        else:
            runs.append([at, at + 1])
    return F.concat(*[F.substring("fingerprint", a + 1, b - a) for a, b in runs])


def _cut(places: list[int], parts: int) -> list[list[int]]:
    ends = [round(i * len(places) / parts) for i in range(parts + 1)]
    return [places[a:b] for a, b in zip(ends, ends[1:])]


def local_stars(lanes: np.ndarray, radius: int) -> np.ndarray:
    """For each of some fingerprints (two 64-bit lanes) the least index it reaches in steps of at most `radius` bits.

    Labels spread over blocks of distances, so that no list of pairs is built.
    """
    label = np.arange(len(lanes))
    while True:
        new = label.copy()
        for at in range(0, len(lanes), ROWS):
            apart = sum(np.bitwise_count(lanes[at : at + ROWS, i, None] ^ lanes[None, :, i]).astype(np.uint8) for i in (0, 1))
            new[at : at + ROWS] = np.where(apart <= radius, label[None, :], len(lanes)).min(1)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def near_links(values: DataFrame, radius: int = RADIUS, limit: int = FRONT_LIMIT) -> DataFrame:
    """Stars (u, v) that join all distinct `fingerprint`s of `values` that are at most `radius` bits apart.

    The bits are cut into `radius` + 2 blocks; partners agree in at least two of them. There is one table for each pair of blocks,
    permuted so that these stand in front, and candidates are what agrees in a table's front. Where a front is shared by more
    than `limit` fingerprints, the other bits are cut into `radius` + 1 blocks, one of which must agree as well.
    """
    blocks = _cut(list(range(BITS // 4)), radius + 2)
    pairs = list(combinations(range(radius + 2), 2))
    fronts, finer = [], []
    for i, j in pairs:
        front = blocks[i] + blocks[j]
        rest = [at for at in range(BITS // 4) if at not in front]
        fronts.append(F.xxhash64(F.lit(f"{i}-{j}"), _digits(front)))
        finer.append(F.array(*[
            F.xxhash64(F.lit(f"{i}-{j}-{n}"), _digits(front), _digits(part)) for n, part in enumerate(_cut(rest, radius + 1))]))
    tables = values.select("fingerprint", F.posexplode(F.array(*fronts)).alias("t", "front"))
    large = tables.groupBy("front").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("front", F.lit(True).alias("large"))
    dealt = tables.join(large, "front", "left").select("fingerprint", F.explode(
        F.when(F.col("large"), F.element_at(F.array(*finer), F.col("t") + 1)).otherwise(F.array("front"))).alias("front")).select(
        "front", _lane(F.col("fingerprint"), 0).alias("a"), _lane(F.col("fingerprint"), 1).alias("b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def joined(rows: np.ndarray) -> Iterator[pd.DataFrame]:
            """`rows` (front, a, b) hold whole fronts, sorted."""
            ends = np.append(np.flatnonzero(np.diff(rows[:, 0])) + 1, len(rows))
            for begin, end in zip(np.append(0, ends[:-1]).tolist(), ends.tolist()):
                if end - begin > 1:
                    lanes = np.ascontiguousarray(rows[begin:end, 1:]).view(np.uint64)
                    label = local_stars(lanes, radius)
                    at = np.flatnonzero(label != np.arange(len(label)))
                    if len(at):
                        name = [f"{x:016x}{y:016x}" for x, y in lanes.tolist()]
                        yield pd.DataFrame({"u": [name[i] for i in at], "v": [name[i] for i in label[at]]})

        held = np.zeros((0, 3), np.int64)
        for batch in batches:
            rows = np.concatenate([held, batch[["front", "a", "b"]].to_numpy(np.int64)])
            whole = int(np.searchsorted(rows[:, 0], rows[-1, 0])) if len(rows) else 0  # the last front may go on
            yield from joined(rows[:whole])
            held = rows[whole:]
        yield from joined(held)

    return dealt.repartition("front").sortWithinPartitions("front").mapInPandas(run, "u string, v string").distinct()


def near_groups(values: DataFrame, radius: int = RADIUS, limit: int = FRONT_LIMIT) -> DataFrame:
    """(fingerprint, near_group): each distinct fingerprint and the least one it reaches in steps of at most `radius` bits."""
    values = stored(values.select("fingerprint").distinct(), "fingerprints")
    joined = components(near_links(values, radius, limit)).select(F.col("u").alias("fingerprint"), F.col("v").alias("near_group"))
    return values.join(joined, "fingerprint", "left").select("fingerprint", F.coalesce("near_group", "fingerprint").alias("near_group"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = stored(edited_fingerprints(table(spark, sf_dir, "documents"), parts), "edited")
    return found.join(near_groups(found), "fingerprint")
