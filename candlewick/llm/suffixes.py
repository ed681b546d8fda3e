"""Removing repeated byte strings: buckets of suffixes, refined by the bucket identifiers of later offsets.

The bucket of an offset is named by an identifier of the q-gram there; that of twice the length comes from the
identifiers at the offset and q bytes later, and is reused for the next doubling (`ladder`). Equal identifiers of 200
bytes mean a repeated string. Three things keep this small:

* Only sampled suffixes enter buckets. A window of 200 bytes is filed under its least q-gram (its anchor), at most
  `STARTS` bytes into it, so equal windows have equal anchors. An anchor stands for a run of windows.
* A bucket with one member holds no repeat and is left out. Members whose whole context (all windows that may have this
  anchor) is equal repeat each other, are done, and go on as one.
* What is left of a bucket, distinct contexts of the same q-gram, meets in one task with the bytes of its windows, and is
  refined to full length there. A bucket of more than `BUCKET_LIMIT` contexts is refined by shuffles instead, so no task
  ever holds it: the windows of each context go in ever smaller groups (`LEVELS`) by the identifier of the bytes that all
  windows of a group share. A group alone with these is left out, groups with all bytes equal are done, and the rest
  goes on.

Identifiers have 64 bits; two different strings of a corpus of 10^9 candidate windows share one with a chance of 3 %.

Null and empty texts have no bytes; a text under 200 bytes is kept whole; rows of one id are told apart by a hash of the
text, and equal rows repeat each other; a null id is an id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.llm.common import in_rows, mixed, packed_text, release, signed, stored, table, text_bytes, text_key, unpacked

WINDOW = 200
GRAM = 32
STARTS = WINDOW - GRAM + 1
BUCKET_LIMIT = 2_000
LEVELS = (43, 11, 1)  # windows in a group
TASK_BYTES = 1 << 19  # of contexts refined at a time
PIECE = 1 << 19  # window starts of a text read at a time
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def ladder(data: np.ndarray, most: int) -> list[np.ndarray]:
    """Bucket identifiers of all offsets: the n-th array has those of the strings of 2^n bytes, up to `most` bytes.

    The identifier of 2n bytes comes from those of n bytes at the offset itself and n bytes later.
    """
    ids = [_BYTES[data]]
    n = 1
    while 2 * n <= most and len(ids[-1]) > n:
        now = ids[-1]
        ids.append(mixed(now[:-n] + (now[n:] << np.uint64(1)) + (now[n:] >> np.uint64(9)) * np.uint64(0xC2B2AE3D27D4EB4F)))
        n *= 2
    return ids


def strings(ids: list[np.ndarray], start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Identifiers of the strings at `start` of `length` bytes, each from two steps of the ladder that overlap."""
    length = np.broadcast_to(length, start.shape)
    out = np.zeros(len(start), np.uint64)
    step = np.minimum(np.log2(np.maximum(length, 1)).astype(np.int64), len(ids) - 1)
    for n in np.unique(step):
        at = step == n
        s, l = start[at], length[at]
        value = ids[n][s] + l.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        value = mixed(value * np.uint64(3) + ids[n][s + l - (1 << int(n))])
        out[at] = mixed(value)
    return out


def window_anchors(grams: np.ndarray, starts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all windows: the offset of each window's least q-gram (the first of equal ones), and the first and last
    window start that has it. Equal windows have equal anchors, however different their surroundings are."""
    keyed = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    n, size, low = len(grams) - starts + 1, 1, keyed
    while size * 2 <= starts:
        low = np.minimum(low[: len(low) - size], low[size:])
        size *= 2
    low = np.minimum(low[:n], low[starts - size : starts - size + n]) & np.uint64(0xFFFFFFFF)
    first = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    return low[first].astype(np.int64), first, np.append(first[1:], n) - 1


def context_identifiers(ids: list[np.ndarray], size: int, anchor: np.ndarray) -> np.ndarray:
    """Identifier of all bytes of the windows that may have each anchor, and of where the text ends them."""
    low, high = np.maximum(anchor - STARTS + 1, 0), np.minimum(anchor + WINDOW, size)
    ends = (low - anchor + STARTS) * 1024 + (high - anchor)
    return mixed(strings(ids, low, high - low) + ends.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def document_anchors(data: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, ...]:
    """q-gram identifier, context identifier, place and number of each anchor.

    A place is anchor << 16 | least << 8 | greatest distance of its windows' starts before it. Equal contexts within the
    text: the first has their number, the others 0. Long texts are read in pieces that overlap by a context.
    """
    parts = []
    for begin in range(0, len(data) - WINDOW + 1, piece):
        low = max(begin - STARTS + 1, 0)
        part = data[low : min(begin + piece + WINDOW + STARTS + WINDOW, len(data))]
        ids = ladder(part, 256)
        grams = ids[GRAM.bit_length() - 1]
        anchor, first, last = window_anchors(grams[begin - low : begin - low + piece + STARTS - 1], STARTS)
        anchor += begin - low
        context = context_identifiers(ids, len(part), anchor)
        parts.append(np.stack([anchor + low, first + begin, last + begin, signed(grams[anchor]), signed(context)]))
    anchor, first, last, gram, context = np.concatenate(parts, 1)
    fresh = np.append(True, anchor[1:] != anchor[:-1])  # a run of windows may go on in the next piece
    last = last[np.append(fresh[1:], True)]
    anchor, first, gram, context = (x[fresh] for x in (anchor, first, gram, context))
    place = anchor << 16 | (anchor - last) << 8 | (anchor - first)
    _, at, times = np.unique(context, return_index=True, return_counts=True)
    number = np.zeros(len(anchor), np.int64)
    number[at] = times
    return gram, context, place, number


def anchors(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_rows(batches, ["doc_id", "t", "text"]):
            found, which = [], []
            for i, text in enumerate(batch["text"]):
                data = np.frombuffer(text_bytes(text), np.uint8)
                if len(data) >= WINDOW:
                    found.append(document_anchors(data))
                    which.append(i)
            if found:
                gram, context, place, number = (np.concatenate(x) for x in zip(*found))
                at = np.repeat(which, [len(x[0]) for x in found])
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].astype("Int64").array[at], "t": batch["t"].to_numpy()[at],
                    "place": place, "gram": gram, "context": context, "number": number.astype(np.int32)})

    return docs.select("doc_id", text_key(), "text").mapInPandas(
        run, "doc_id long, t binary, place long, gram long, context long, number int")


def _with_texts(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """`rows` (doc_id, t, at) beside the texts of their documents, packed for the shuffle, and the other columns in `row`."""
    others = [F.col(name) for name in docs.columns if name not in ("doc_id", "text")] or [F.lit(None).alias("none")]
    texts = docs.select("doc_id", text_key(), packed_text("text").alias("packed"), F.struct(*others).alias("row"))
    return texts.alias("d").join(
        rows.alias("r"), F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.t") == F.col("r.t")), how
    ).select("d.doc_id", "d.t", "packed", "at", "row")


def contexts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The bytes of each member's windows: gram, large, doc_id, t, start, greatest (distance of the first window before the
    anchor), windows, data."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_rows(batches, ["doc_id", "t", "packed", "place", "gram", "large"]):
            rows = []
            for doc_id, t, packed, places, grams, large in zip(*(batch[name] for name in batch.columns)):
                data = unpacked(packed)
                for i in np.argsort(places, kind="stable"):
                    place = int(places[i])
                    anchor, least, greatest = place >> 16, place >> 8 & 255, place & 255
                    start = anchor - greatest
                    rows.append((grams[i], large[i], doc_id, t, start, greatest, greatest - least + 1,
                                 data[start : anchor - least + WINDOW]))
            out = pd.DataFrame(rows, columns=["gram", "large", "doc_id", "t", "start", "greatest", "windows", "data"])
            yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    listed = members.groupBy("doc_id", "t").agg(F.collect_list(F.struct("place", "gram", "large")).alias("at"))
    # Three arrays a text: as a list of structs each member would be a dict in Python, for all texts of an Arrow batch.
    beside = _with_texts(docs.select("doc_id", "text"), listed, "inner").select("doc_id", "t", "packed", "at.place", "at.gram", "at.large")
    return beside.mapInPandas(
        run, "gram long, large boolean, doc_id long, t binary, start long, greatest int, windows int, data binary")


def window_identifiers(rows: list[bytes], windows: np.ndarray) -> np.ndarray:
    """Identifiers of all windows of some contexts, one after the other."""
    data = np.frombuffer(b"".join(rows), np.uint8)
    begin = np.cumsum([0, *map(len, rows)])[:-1]
    offset = np.repeat(begin - np.cumsum(windows) + windows, windows) + np.arange(windows.sum())
    ids = ladder(data, WINDOW)
    return strings(ids, offset, np.full(len(offset), WINDOW)) if len(offset) else np.zeros(0, np.uint64)


def _spans(rows: pd.DataFrame, repeated: np.ndarray) -> pd.DataFrame:
    """doc_id, t, span: the runs of repeated windows, a span being first byte << 9 | length."""
    windows = rows["windows"].to_numpy()
    owner = np.repeat(np.arange(len(rows)), windows)
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = np.flatnonzero(repeated)
    fresh = np.append(True, (np.diff(at) > 1) | (np.diff(owner[at]) > 0))[: len(at)]
    first = at[fresh]
    last = at[np.append(fresh[1:], True)[: len(at)]] if len(at) else at
    start = rows["start"].to_numpy()[owner[first]] + turn[first]
    return pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64").array[owner[first]], "t": rows["t"].to_numpy()[owner[first]],
                         "span": start << 9 | (last - first + WINDOW)})


def refined_in_tasks(rows: DataFrame) -> DataFrame:
    """Spans of the windows that stand in more than one context of a bucket. `rows` are dealt out by bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(parts: list[pd.DataFrame]) -> pd.DataFrame:
            rows = pd.concat(parts, ignore_index=True)
            found = window_identifiers(list(rows["data"]), rows["windows"].to_numpy())
            _, index, times = np.unique(found, return_inverse=True, return_counts=True)
            return _spans(rows, times[index] > 1)

        held, size = [], 0
        for batch in in_rows(batches, ["gram", "doc_id", "t", "start", "windows", "data"], 1024):
            if size > TASK_BYTES:  # go on only with the bucket that may not be complete
                rows = pd.concat([*held, batch], ignore_index=True)
                open_ = rows["gram"] == rows["gram"].iloc[-1]
                if not open_.all():
                    yield done([rows[~open_]])
                held, size = [rows[open_]], 0
            else:
                held.append(batch)
            size += int(batch["data"].map(len).sum())
        if held:
            yield done(held)

    dealt = rows.repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInPandas(run, "doc_id long, t binary, span long")


def window_groups(rows: DataFrame, size: int) -> DataFrame:
    """The contexts cut into groups of `size` windows, by distance before the anchor, with the identifiers of the bytes
    that all windows of a whole group share (`core`) and of all bytes of those there are (`whole`)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_rows(batches, ["doc_id", "t", "start", "greatest", "windows", "data"], 128):
            greatest, windows = batch["greatest"].to_numpy(np.int64), batch["windows"].to_numpy(np.int64)
            least = greatest - windows + 1
            number = greatest // size - least // size + 1
            owner = np.repeat(np.arange(len(batch)), number)
            group = least[owner] // size + np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
            low, high = np.maximum(group * size, least[owner]), np.minimum(group * size + size - 1, greatest[owner])
            begin = np.cumsum([0, *map(len, batch["data"])])[:-1][owner] + greatest[owner]  # of the anchor
            ids = ladder(np.frombuffer(b"".join(batch["data"]), np.uint8), 256)
            shared = strings(ids, begin - group * size, np.full(len(owner), WINDOW - size + 1))
            whole = strings(ids, begin - high, WINDOW + high - low)
            kind = (group * 256 + size).astype(np.uint64)
            data, first = batch["data"].array, greatest[owner] - high
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64").array[owner], "t": batch["t"].to_numpy()[owner],
                "start": batch["start"].to_numpy()[owner] + first, "greatest": high, "windows": high - low + 1,
                "data": [data[i][a : a + n] for i, a, n in zip(owner, first, (high - low + WINDOW).tolist())],
                "core": signed(mixed(shared + kind)), "whole": signed(mixed(whole * np.uint64(3) + mixed(
                    ((group * 256 + low - group * size) * 256 + high - low).astype(np.uint64))))})

    return rows.mapInPandas(run, "doc_id long, t binary, start long, greatest int, windows int, data binary, core long, whole long")


def refined_by_shuffle(rows: DataFrame) -> DataFrame:
    """The same for large buckets, level by level. Equal groups go on as one, as the partner of what is left."""
    spans = None
    for size in LEVELS:
        groups = stored(window_groups(rows, size), "suffix-groups")
        one = stored(groups.groupBy("core", "whole").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "t", "start", "greatest", "windows", "data")).alias("first")
        ), "suffix-firsts")
        equal = stored(one.where("n > 1").select("whole"), "suffix-equal")
        found = groups.join(equal, "whole", "left_semi").select(
            "doc_id", "t", (F.shiftleft("start", 9) + F.col("windows") + (WINDOW - 1)).alias("span"))
        spans = found if spans is None else spans.union(found)
        left = stored(one.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core"), "suffix-left")
        rows = one.join(left, "core", "left_semi").select("first.*")
    return spans


def repeated_spans(docs: DataFrame, limit: int = BUCKET_LIMIT) -> DataFrame:
    """(doc_id, t, span) of all repeated windows; t is the text's digest, a span is first byte << 9 | length."""
    found = stored(anchors(docs), "suffix-anchors")
    grams = found.where("number > 0").groupBy("gram").agg(F.sum("number").alias("n")).where("n > 1").select("gram")
    # What a hot q-gram is joined to is stored first: both sides of the join are then shuffled, and Spark can split it.
    shared = stored(found.join(stored(grams, "suffix-grams"), "gram", "left_semi"), "suffix-shared")
    release(found)
    one = stored(shared.where("number > 0").groupBy("gram", "context").agg(
        F.sum("number").alias("n"), F.min(F.struct("doc_id", "t", "place")).alias("first")), "suffix-contexts")
    done = shared.join(stored(one.where("n > 1").select("context"), "suffix-equal"), "context", "left_semi")
    whole = done.select("doc_id", "t", (F.shiftleft(F.shiftright("place", 16) - F.col("place").bitwiseAND(255), 9)
                        + F.col("place").bitwiseAND(255) - F.shiftright("place", 8).bitwiseAND(255) + WINDOW).alias("span"))
    buckets = one.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "gram", (F.col("n") > limit).alias("large"))
    members = one.select("gram", "first.*").join(stored(buckets, "suffix-buckets"), "gram")
    rows = stored(contexts(docs, members), "suffix-rows")
    return whole.union(refined_in_tasks(rows.where(~F.col("large")))).union(refined_by_shuffle(rows.where("large")))


def kept_bytes(data: bytes, spans: np.ndarray) -> tuple[bytes, int, int]:
    """What is left without the spans, the number of bytes removed, and of maximal removed runs."""
    if not len(spans):
        return data, 0, 0
    cover = np.zeros(len(data) + 1, np.int32)
    np.add.at(cover, spans >> 9, 1)
    np.add.at(cover, (spans >> 9) + (spans & 511), -1)
    gone = np.cumsum(cover[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for every row of `docs`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_rows(batches, ["doc_id", "packed", "at"]):
            rows = []
            for doc_id, packed, at in zip(batch["doc_id"], batch["packed"], batch["at"]):
                data = unpacked(packed)
                spans = np.zeros(0, np.int64) if at is None else np.asarray(at, np.int64)
                rows.append((doc_id, len(data), *kept_bytes(data, spans)))
            out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "kept", "n_removed", "n_spans"])
            yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    listed = repeated_spans(docs).groupBy("doc_id", "t").agg(F.collect_list("span").alias("at"))
    return _with_texts(docs.select("doc_id", "text"), listed, "left").mapInPandas(
        run, "doc_id long, n_bytes long, kept binary, n_removed long, n_spans long")


def cleaned_documents(docs: DataFrame) -> DataFrame:
    """`docs` with the repeated bytes gone from the texts; what is left of a character cut in two goes with them."""

    @F.pandas_udf("string")
    def kept(packed: pd.Series, at: pd.Series) -> pd.Series:
        return pd.Series([
            kept_bytes(unpacked(x), np.zeros(0, np.int64) if y is None else np.asarray(y, np.int64))[0].decode(errors="ignore")
            for x, y in zip(packed, at)], index=packed.index)

    listed = repeated_spans(docs).groupBy("doc_id", "t").agg(F.collect_list("span").alias("at"))
    rows = _with_texts(docs, listed, "left").select("doc_id", kept("packed", "at").alias("text"), "row")
    columns = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.char_length("text").cast("long")
    return rows.select(*[columns.get(name, F.col("row")[name]).alias(name) for name in docs.columns])


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.lower(F.sha2("kept", 256)).alias("kept_sha256"))
