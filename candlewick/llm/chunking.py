"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes; a chunk ends where its top bits are zero, so boundaries move with the content and an
insertion changes only the chunks around it. Of all chunks with one digest the first (least id, then place) stays; every
later copy is removed, however short.

Digests have 128 bits. Chunks are counted per digest with a partial step in each task, and only digests that repeat are
joined back, so a chunk that a third of the documents hold is no single task's work.

Boundaries never split a character. Null and empty texts have no chunks; a null id comes first; of rows equal in id and text
one counts as the first and all bytes of the others are later copies; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewick.llm.common import in_rows, mixed, packed_text, stored, table, text_bytes, text_key, unpacked

LEAST, MOST, CUT_BITS = 32, 256, 5
COPIES = 1 << 16  # copies of a row that are made from one array
#: One random 32-bit number per byte value.
_GEAR = (mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(32)).astype(np.uint32)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """h[i] = (h[i - 1] << 1) + gear[data[i]] over 32 bits, for all places at once by doubling the span."""
    h, span = _GEAR[data], 1
    while span < 32:
        longer = h.copy()
        longer[span:] += h[:-span] << np.uint32(span) if len(h) > span else 0
        h, span = longer, span * 2
    return h


def chunk_ends(data: np.ndarray) -> list[int]:
    """Ends of the chunks: at least `LEAST` bytes (the last may be shorter) and at most `MOST`."""
    inside = np.append((data[1:] & 0xC0) == 0x80, False)  # the next byte continues a character
    cuts = (np.flatnonzero((gear_hash(data) >> np.uint32(32 - CUT_BITS) == 0) & ~inside) + 1).tolist()
    ends, begin, size = [], 0, len(data)
    cuts.append(size)
    for cut in cuts:
        while cut - begin > MOST:
            end = begin + MOST
            while inside[end - 1] and end > begin + 1:
                end -= 1
            ends.append(end)
            begin = end
        if cut - begin >= LEAST or (cut == size and cut > begin):
            ends.append(cut)
            begin = cut
    return ends


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, t, place, d1, d2) of every chunk; a place is first byte << 9 | length."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_128_digest
        for batch in in_rows(batches, ["doc_id", "t", "text"]):
            owner, places, digests = [], [], []
            for i, text in enumerate(batch["text"]):
                raw = text_bytes(text)
                begin = 0
                for end in chunk_ends(np.frombuffer(raw, np.uint8)) if raw else ():
                    owner.append(i)
                    places.append(begin << 9 | (end - begin))
                    digests.append(digest(raw[begin:end]))
                    begin = end
            lanes = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64").array[owner], "t": batch["t"].to_numpy()[owner],
                                "place": np.array(places, np.int64), "d1": lanes[:, 0], "d2": lanes[:, 1]})

    return docs.select("doc_id", text_key(), "text").mapInPandas(
        run, "doc_id long, t binary, place long, d1 long, d2 long")


def removed_runs(places: np.ndarray, later: np.ndarray) -> list[tuple[int, int]]:
    """First byte and end of each run of later copies. `places` are a text's repeated chunks."""
    order = np.argsort(places)
    start, length = (places >> 9)[order][later[order]], (places & 511)[order][later[order]]
    out: list[list[int]] = []
    for a, n in zip(start.tolist(), length.tolist()):
        if out and out[-1][1] == a:
            out[-1][1] = a + n
        else:
            out.append([a, a + n])
    return [(a, b) for a, b in out]


def _names() -> list[Column]:
    """What names a row: id, whether there is none, digest of the text."""
    return [F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.col("doc_id").isNull().alias("no_id"), F.col("t")]


def without_copied_chunks(docs: DataFrame) -> DataFrame:
    """Every row of `docs`: doc_id, n_bytes, n_repeated (bytes in chunks that occur elsewhere), n_removed, text."""
    found = stored(chunks(docs), "chunks")
    repeated = found.groupBy("d1", "d2").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "t", "place")).alias("first")
    ).where("n > 1").drop("n")
    here = F.struct("doc_id", "t", "place")
    marked = found.join(repeated, ["d1", "d2"]).select(
        *_names(), F.struct("place", (~here.eqNullSafe(F.col("first"))).alias("later")).alias("chunk"))
    name = ["id", "no_id", "t"]
    listed = marked.groupBy(*name).agg(F.collect_set("chunk").alias("at"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_rows(batches, ["id", "no_id", "copies", "packed", "at"]):
            rows = []
            for doc_id, no_id, copies, packed, at in zip(*(batch[x] for x in batch.columns)):
                data, begin, parts = unpacked(packed), 0, []
                places = np.array([] if at is None else [x["place"] for x in at], np.int64)
                later = np.array([] if at is None else [x["later"] for x in at], bool)
                for a, b in removed_runs(places, later):
                    parts.append(data[begin:a])
                    begin = b
                kept = b"".join([*parts, data[begin:]])
                rows.append((doc_id, no_id, copies, len(data), int((places & 511).sum()), len(data) - len(kept), kept.decode()))
            yield pd.DataFrame(rows, columns=["id", "no_id", "copies", "n_bytes", "n_repeated", "n_removed", "text"])

    # Rows equal in id and text become one with a count, and as many again at the end.
    texts = docs.select("doc_id", text_key(), packed_text("text").alias("packed")).select(*_names(), "packed").groupBy(*name).agg(
        F.count(F.lit(1)).alias("copies"), F.min("packed").alias("packed"))
    one = texts.join(listed, name, "left").mapInPandas(
        run, "id long, no_id boolean, copies long, n_bytes long, n_repeated long, n_removed long, text string")
    block = one.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES}"))))
    copy = block.withColumn("copy", F.explode(F.sequence(
        F.col("block") * COPIES, F.least(F.col("block") * COPIES + COPIES, F.col("copies")) - 1)))
    first = F.col("copy") == 0
    return copy.select(
        F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), "n_bytes", F.when(first, F.col("n_repeated")).otherwise(F.col("n_bytes")).alias("n_repeated"),
        F.when(first, F.col("n_removed")).otherwise(F.col("n_bytes")).alias("n_removed"), F.when(first, F.col("text")).otherwise("").alias("text"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_copied_chunks(table(spark, sf_dir, "documents"))
