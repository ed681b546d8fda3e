"""Near-duplicate documents by SimHash, found with a Gray-order hierarchical index.

Fingerprints are taken once per distinct value. Two fingerprints within two bits agree in at least two of four 16-bit
blocks, so each goes to six groups, one per pair of blocks, and meets every partner in one of them. A group too large for
a task is split again by three blocks of its other 32 bits, one of which must agree as well; such a part holds at most
2^22 distinct fingerprints.

Within a group the fingerprints are sorted by Gray rank, so neighbours share many bits. Runs of `FANOUT` form a node that
keeps the bits all its members share; what an upper node has already is factored out of the lower ones. A search adds up
differences from the top and drops a whole node as soon as the sum exceeds the radius.

A task returns each fingerprint's smallest local partner instead of all pairs; `components` joins these stars.

Defined cases: a text without words (null and empty ones too) has fingerprint zero and is linked like any other; equal
fingerprints are one component; a component whose ids are all null has a null id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.llm.common import in_rows, signed, stored, table, text_bytes, text_key
from candlewick.llm.components import components, local_labels

SHINGLE = 3
RADIUS = 2
SEED = 42
FANOUT = 16
GROUP_LIMIT = 100_000
QUERY_ROWS = 8192
SEARCH_ROWS = 1 << 17  # of the groups that a task searches at a time
BLOCKS = 4


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = text_bytes(text).lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        terms = [b" ".join(words)]
    else:
        terms = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(term, SEED) for term in terms), ">u8")
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, t, f): the text's digest and the fingerprint as a signed long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_rows(batches, ["doc_id", "t", "text"], 4096):
            values = np.array([fingerprint(text, shingle) for text in batch["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "t": batch["t"], "f": signed(values)})

    return docs.select("doc_id", text_key(), "text").mapInPandas(run, "doc_id long, t binary, f long")


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each 64-bit word in the reflected Gray code."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def gray_index(group: np.ndarray, values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Levels from the roots (one per group) down to the values: first child, end, shared pattern, newly fixed bits.

    `group` and `values` are sorted by group and Gray rank.
    """
    levels = []
    owner, low, high = group, values, values
    while True:
        n = len(owner)
        new_group = np.append(True, owner[1:] != owner[:-1])
        start = np.flatnonzero(new_group)
        place = np.arange(n) - np.repeat(start, np.diff(np.append(start, n)))
        first = np.flatnonzero(place % FANOUT == 0)
        low, high = np.bitwise_and.reduceat(low, first), np.bitwise_or.reduceat(high, first)
        owner = owner[first]
        levels.append((first, np.append(first[1:], n), low, ~(low ^ high)))
        if len(np.unique(owner)) == len(owner):
            break
    levels.reverse()
    known = levels[0][3]
    out = [levels[0]]
    for (first, end, _, _), (lower_first, lower_end, pattern, shared) in zip(levels[:-1], levels[1:]):
        above = np.repeat(known, end - first)
        out.append((lower_first, lower_end, pattern, shared & ~above))
        known = shared
    return out


def near_pairs(group: np.ndarray, values: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), i < j, of one group with at most `radius` differing bits; sorted as for `gray_index`."""
    levels = gray_index(group, values)
    root = np.cumsum(np.append(True, group[1:] != group[:-1])) - 1
    for at in range(0, len(values), QUERY_ROWS):
        query = np.arange(at, min(at + QUERY_ROWS, len(values)))
        node, apart = root[query], np.zeros(len(query), np.int64)
        for first, end, pattern, fixed in levels:
            apart = apart + np.bitwise_count((values[query] ^ pattern[node]) & fixed[node])
            keep = apart <= radius
            query, node, apart = query[keep], node[keep], apart[keep]
            width = end[node] - first[node]
            child = np.repeat(first[node] - np.cumsum(width) + width, width) + np.arange(width.sum())
            query, apart, node = np.repeat(query, width), np.repeat(apart, width), child
        later = node > query
        query, node = query[later], node[later]
        near = np.bitwise_count(values[query] ^ values[node]) <= radius
        yield query[near], node[near]


def block_masks() -> list[int]:
    """One mask per pair of the four 16-bit blocks."""
    return [(0xFFFF << 16 * i) | (0xFFFF << 16 * j) for i in range(BLOCKS) for j in range(i)]


def _as_long(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _finer_masks(mask: int) -> list[int]:
    """The mask with each of three blocks of its other 32 bits."""
    free = [bit for bit in range(64) if not mask >> bit & 1]
    parts = (free[:11], free[11:22], free[22:])
    return [mask | sum(1 << bit for bit in part) for part in parts]


def links(values: DataFrame, radius: int = RADIUS, limit: int = GROUP_LIMIT) -> DataFrame:
    """Stars (u, v) that join all distinct fingerprints `f` of `values` within `radius` (at most 2) bits."""
    if not 0 <= radius <= 2:
        raise ValueError("the block pairs find partners within at most 2 bits")
    masks = block_masks()
    dealt = values.select("f", F.posexplode(F.array(*[F.col("f").bitwiseAND(F.lit(_as_long(m))) for m in masks])).alias("t", "k"))
    large = dealt.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("t", "k", F.lit(True).alias("large"))
    finer = F.element_at(F.array(*[
        F.array(*[F.col("f").bitwiseAND(F.lit(_as_long(m))) for m in _finer_masks(mask)]) for mask in masks
    ]), F.col("t") + 1)
    parts = dealt.join(large, ["t", "k"], "left").select(
        "f", "t", F.posexplode(F.when(F.col("large"), finer).otherwise(F.array("k"))).alias("part", "k"), "large"
    ).select("f", (F.col("t") * 4 + F.when(F.col("large"), F.col("part") + 1).otherwise(0)).alias("t"), "k")

    def joined(rows: np.ndarray) -> Iterator[pd.DataFrame]:
        """Stars of whole groups, `rows` being (t, k, f) in order of t and k."""
        fresh = np.append(True, (np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0))
        group = np.cumsum(fresh) - 1
        shared = np.bincount(group)[group] > 1
        group, f = group[shared], np.ascontiguousarray(rows[shared, 2]).view(np.uint64)
        if len(f) == 0:
            return
        order = np.lexsort((gray_rank(f), group))
        group, f = group[order], f[order]
        distinct, index = np.unique(f, return_inverse=True)
        a, b = zip(*near_pairs(group, f, radius))
        a, b = index[np.concatenate(a)], index[np.concatenate(b)]
        label = local_labels(len(distinct), a, b)
        near = np.flatnonzero(label != np.arange(len(distinct)))
        yield pd.DataFrame({"u": signed(distinct[near]), "v": signed(distinct[label[near]])})

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            held.append(batch[["t", "k", "f"]].to_numpy(np.int64))
            size += len(batch)
            if size >= SEARCH_ROWS:  # go on with the group that may not be complete
                rows = np.concatenate(held)
                last = (rows[:, 0] == rows[-1, 0]) & (rows[:, 1] == rows[-1, 1])
                whole = int(np.argmax(last))
                if whole:
                    yield from joined(rows[:whole])
                held, size = [rows[whole:]], 0
        if held:
            rows = np.concatenate(held)
            if len(rows):
                yield from joined(rows)

    return parts.repartition("t", "k").sortWithinPartitions("t", "k").mapInPandas(search, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, t, f, root, component_id) for every row of `docs`; t is the text's digest, root the least fingerprint reached."""
    marked = stored(fingerprints(docs, shingle), "simhash-docs")
    values = stored(marked.groupBy("f").agg(F.min("doc_id").alias("doc_id")), "simhash-values")
    joined = components(links(values, radius))
    owned = values.join(joined.withColumnRenamed("u", "f"), "f", "left").select(
        "f", F.coalesce("v", "f").alias("root"), "doc_id"
    )
    lowest = owned.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return marked.join(owned.select("f", "root").join(lowest, "root"), "f").select("doc_id", "t", "f", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """`docs` with one document of each component: the one with the smallest id (a null id counts as the largest)."""
    least = near_duplicates(docs, shingle, radius).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("first"))
    none, plain = F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("plain")
    kept = least.select(F.col("first.none").alias("none"), F.coalesce("first.doc_id", F.lit(0)).alias("plain"),
                        F.col("first.t").alias("t")).distinct()
    rows = docs.select(none, plain, text_key(), F.struct(*docs.columns).alias("row"))
    # Rows equal in id and text are told apart by nothing: one of them stays.
    return rows.join(kept, ["none", "plain", "t"]).dropDuplicates(["none", "plain", "t"]).select("row.*")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")
