"""Language-model scoring with a log-frequency Bloom filter.

Counting: each task sums the n-grams of its documents and deals them by hash into segments; a segment's task sums what all
tasks sent, and packs its parts of the filter: an n-gram of quantised count level j is entered with levels 1 to j. An
entry has `BITS_PER_ENTRY` bits and `PROBES` probes at any size of corpus; parts of about `PART_BYTES` grow in number with
the entries. All bits of an entry stand in one 64-bit word: a probe is one read.

Scoring: an n-gram's level is found by probing levels 1, 2, ... until one is absent. A filter of at most `FILTER_BYTES` is
sent to all workers, as a file that those of an executor map and share. A larger one stays where it is stored: the distinct keys of some texts go to the parts that hold them, and the
levels come back to the texts. Both ways read the same parts and give the same scores. Probabilities are interpolated:

    p(w | h) = (c(hw) + k p(w | shorter h)) / (c(h) + k),   p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))

with k = c(h) ^ g, about how many distinct words follow a history seen c(h) times; g = log(distinct n-grams) / log(N).

The base score needs exact counts of single words. The most frequent `HEAD_WORDS` at most are sent to all workers; the
words below them, which no key holds many rows of, are joined to their counts by a shuffle.

Defined cases: a null or empty text is the end token alone; without training rows all probabilities are 1 of 1 (score 0);
repeated ids are scored row by row; a null id is held out or not as the empty text is.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.llm.common import (
    MASK, WordHashes, in_rows, mixed, remainder, signed, stored, table, text_bytes, unpacked,
)

ORDER = 2
SEED = 29
END, BEGIN = np.uint64(0x656E64), np.uint64(0x626567)
BASE = 1.5  # ratio of neighbouring count levels
LEVELS = 120
PROBES = 4
BITS_PER_ENTRY = 8.0
FILTER_BYTES = 256 << 20  # of a filter that is broadcast
PART_BYTES = 8 << 20
HEAD_WORDS = 500_000
FLUSH = 1_000_000
#: How rows with cells of some MB are written: one to a row group, so that neither writer nor reader holds several.
LARGE_CELLS = {"parquet.block.row.count.limit": "1", "parquet.enable.dictionary": "false"}
_words = WordHashes(SEED, 200_000)
_sent: list[tempfile.TemporaryDirectory] = []  # executors that start later fetch the files as well

_LOW = np.maximum.accumulate(np.floor(BASE ** np.arange(LEVELS))).astype(float)  # least count of each level


def level_of(counts: np.ndarray) -> np.ndarray:
    """Level of each count, from 1; counts of 0 have level 0."""
    return np.searchsorted(_LOW, counts, side="right")


#: The count that a level stands for: the middle of the counts it holds.
_MEAN = np.concatenate(([0.0], [(a + max(a, b - 1)) / 2 for a, b in zip(_LOW, np.append(_LOW[1:], _LOW[-1] * BASE))]))


def grams(text: str | None, order: int) -> list[np.ndarray]:
    """Keys of the 1-grams to `order`-grams that end at each place of the padded token row."""
    hashes = _words.of(text_bytes(text).lower().split())
    row = np.concatenate([np.full(order - 1, BEGIN), hashes, [END]]).astype(np.uint64)
    keys = [row]
    for n in range(2, order + 1):
        keys.append(mixed(keys[-1][:-1] * np.uint64(0x9E3779B97F4A7C15) + row[n - 1 :] + np.uint64(n)))
    return keys


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, index = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(index, weights=counts, minlength=len(distinct)).astype(np.int64)


def _segment(keys: np.ndarray, segments: int) -> np.ndarray:
    return ((mixed(keys ^ np.uint64(0xA5A5A5A5)) >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def _places(keys: np.ndarray, level: int, words: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Each key's 64-bit word of a segment's part at a level, and its bits there: all probes read one word."""
    a = mixed(keys + np.uint64(level * 0x9E3779B97F4A7C15 & MASK))
    fields = (a & np.uint64(0xFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    bits = np.zeros(len(keys), np.uint64)
    for probe in range(probes):
        bits |= np.uint64(1) << (fields >> np.uint64(58 - 6 * probe) & np.uint64(63))
    return ((a >> np.uint64(32)) * np.uint64(words) >> np.uint64(32)).astype(np.int64), bits


def gram_counts(docs: DataFrame, order: int, segments: int) -> DataFrame:
    """(segment, n, keys, counts): n-gram sums of parts of the corpus, packed as 64-bit numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[list[np.ndarray]] = [[] for _ in range(order)]

        def flushed() -> Iterator[pd.DataFrame]:
            for n in range(1, order + 1):
                if not held[n - 1]:
                    continue
                keys, counts = np.unique(np.concatenate(held[n - 1]), return_counts=True)
                held[n - 1] = []
                segment = _segment(keys, segments)
                rank = np.argsort(segment, kind="stable")
                cuts = np.searchsorted(segment[rank], np.arange(segments + 1))
                rows = [(s, n, keys[rank[a:b]].tobytes(), counts[rank[a:b]].astype("<u4").tobytes())
                        for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
                yield pd.DataFrame(rows, columns=["segment", "n", "keys", "counts"])

        size = 0
        for batch in in_rows(batches, ["text"]):
            for text in batch["text"]:
                for n, keys in enumerate(grams(text, order)):
                    held[n].append(keys)
                    size += len(keys)
                if size >= FLUSH:
                    yield from flushed()
                    size = 0
        yield from flushed()

    return docs.select("text").mapInPandas(run, "segment int, n int, keys binary, counts binary")


def segment_parts(sums: DataFrame, order: int, segments: int) -> DataFrame:
    """One row per segment: its exact word counts, its entries for the filter, and the number of each kind."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, dict[int, list]] = {}
        for batch in batches:
            for s, n, keys, counts in zip(batch["segment"], batch["n"], batch["keys"], batch["counts"]):
                held.setdefault(s, {}).setdefault(n, []).append((np.frombuffer(keys, "<u8"), np.frombuffer(counts, "<u4")))
        for s, by_order in held.items():
            words, distinct, entries, weights = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), [0] * order, [], []
            for n, parts in by_order.items():
                keys, counts = _summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
                distinct[n - 1] = len(keys)
                entries.append(keys)
                weights.append(level_of(counts))
                if n == 1:
                    real = keys != BEGIN
                    words = keys[real], counts[real]
            levels = np.concatenate(weights)
            by_level = np.bincount(level_of(words[1]), minlength=LEVELS + 1)
            yield pd.DataFrame({
                "segment": [s], "words": [words[0].tobytes()], "word_counts": [words[1].tobytes()],
                "by_level": [by_level.tolist()], "n_words": [int(words[1].sum())], "distinct": [distinct],
                "entries": [np.concatenate(entries).tobytes()], "levels": [levels.astype(np.uint8).tobytes()],
                "n_entries": [int(levels.sum())],
            })

    return sums.repartitionById(segments, F.col("segment")).mapInPandas(
        run, "segment int, words binary, word_counts binary, by_level array<long>, n_words long, distinct array<long>, "
             "entries binary, levels binary, n_entries long")


def in_fewer(frame: DataFrame, partitions: int, each_core: int) -> DataFrame:
    """`frame` in `partitions`, or `each_core` a core if that is more: a task takes several old partitions one after the
    other and holds no more than before. Each file costs an executor processes and buffers, however little is in it."""
    return frame.coalesce(max(partitions, each_core * frame.sparkSession.sparkContext.defaultParallelism))


def filter_part(keys: np.ndarray, levels: np.ndarray, words: int, probes: int) -> np.ndarray:
    part = np.zeros(words, np.uint64)
    for level in range(1, int(levels.max(initial=0)) + 1):
        at, bits = _places(keys[levels >= level], level, words, probes)
        np.bitwise_or.at(part, at, bits)
    return part


def levels_in(data: np.ndarray, keys: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Levels of `keys` whose parts of the filter are those rows of `data`."""
    level = np.zeros(len(keys), np.int64)
    words, data = data.shape[1], data.reshape(-1)
    for begin in range(0, len(keys), 1 << 15):  # what fits the processor's cache
        some = keys[begin : begin + (1 << 15)]
        left, row = np.arange(begin, begin + len(some)), part[begin : begin + (1 << 15)] * words
        for step in range(1, LEVELS + 1):
            at, bits = _places(some, step, words, PROBES)
            there = np.flatnonzero(data[row + at] & bits == bits)
            left, some, row = left[there], some[there], row[there]
            if not len(left):
                break
            level[left] = step
    return level


@dataclass
class Model:
    order: int
    segments: int  # parts of the filter
    data: np.ndarray | None  # a row of 64-bit words for each part, or None if the filter is not sent
    sent_as: str | None  # the file that has `data`, which itself is never sent
    stored_at: str  # folder of the filter's parts
    tokens: int
    words: int
    follow: list[float]  # for each order, the exponent g
    head: np.ndarray
    head_counts: np.ndarray

    def __getstate__(self) -> dict:
        return {**self.__dict__, "data": self.data.shape if self.data is not None else None}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        if self.data is not None:
            self.data = np.asarray(np.memmap(SparkFiles.get(self.sent_as), np.uint64, "r", shape=self.data))

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Quantised counts of `keys`."""
        if not self.segments:
            return np.zeros(len(keys))
        return _MEAN[levels_in(self.data, keys, _segment(keys, self.segments))]

    def score(self, rows: list[list[np.ndarray]], counted: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, ...]:
        """Of some texts' `grams` and what gives the quantised counts of keys: the log10 probability of each text, its
        tokens, and the exact counts of the tokens of all texts, one after the other, or -1 for those that are not in the
        head."""
        padding = self.order - 1
        sizes = np.array([len(keys[0]) for keys in rows]) - padding
        words, index = np.unique(np.concatenate([r[0] for r in rows]), return_inverse=True)
        counts = [counted(words)[index]]
        for n in range(2, self.order + 1):
            counts.append(counted(np.concatenate([r[n - 1] for r in rows])))
        ends = np.cumsum(sizes)
        token = np.arange(ends[-1])
        text = np.repeat(np.arange(len(rows)), sizes)
        # The n-grams of a text are its tokens and `order` - n places of padding before them.
        place = [token + (text + 1) * (self.order - n) for n in range(1, self.order + 1)]
        p = (counts[0][place[0]] + 0.5) / (self.tokens + 0.5 * (self.words + 1))
        for n in range(2, self.order + 1):
            history = counts[n - 2][place[n - 2] - 1]
            k = np.maximum(history, 1.0) ** self.follow[n - 1]
            p = (np.minimum(counts[n - 1][place[n - 1]], history) + k * p) / (history + k)
        scores = np.add.reduceat(np.log10(np.minimum(p, 1.0)), ends - sizes)
        exact = np.full(len(words), -1, np.int64)
        if len(self.head):
            at = np.minimum(np.searchsorted(self.head, words), len(self.head) - 1)
            exact = np.where(self.head[at] == words, self.head_counts[at], -1)
        return scores, sizes, exact[index][place[0]], words[index][place[0]]


def train(docs: DataFrame, order: int = ORDER, segments: int | None = None, most_bytes: int = FILTER_BYTES,
          head_words: int = HEAD_WORDS, part_bytes: int = PART_BYTES) -> tuple[Model, DataFrame]:
    """The model, and the stored counts (key, c) of all words too rare for its head."""
    spark = docs.sparkSession
    segments = segments or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = segment_parts(gram_counts(docs, order, segments), order, segments)
    parts = stored(in_fewer(counted, segments // 8, 4), "lm-parts", **LARGE_CELLS)
    # One row per segment, as many as there are partitions.
    known = parts.select("segment", "by_level", "n_words", "distinct", "n_entries").toPandas()
    # All parts get the size that the largest needs; a hash deals the entries out evenly.
    largest = int(known["n_entries"].max()) if len(known) else 0
    split = max(1, int(np.ceil(largest * BITS_PER_ENTRY / 8 / part_bytes)))  # parts of a segment: `_segment` nests them
    size = max(1, int(largest * BITS_PER_ENTRY / split) // 64)
    whole = segments * split * size * 8 <= most_bytes
    by_level = np.sum(list(known["by_level"]), axis=0) if len(known) else np.zeros(LEVELS + 1)
    above = np.cumsum(by_level[::-1])[::-1]  # words of each level or higher
    least = int(np.argmax(np.append(above, 0) <= head_words))
    low = int(_LOW[least - 1]) if 0 < least <= LEVELS else 0 if least == 0 else int(_LOW[-1] * BASE) + 1
    distinct = np.sum(list(known["distinct"]), axis=0) if len(known) else np.zeros(order)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s, keys, levels, words, counts in zip(*(batch[c] for c in (
                    "segment", "entries", "levels", "words", "word_counts"))):
                keys, levels = np.frombuffer(keys, "<u8"), np.frombuffer(levels, np.uint8)
                part = _segment(keys, segments * split)
                words, counts = np.frombuffer(words, "<u8"), np.frombuffer(counts, "<i8")
                common = counts >= low
                for number in range(s * split, (s + 1) * split):
                    mine = part == number
                    yield pd.DataFrame({
                        "part": [number], "data": [filter_part(keys[mine], levels[mine], size, PROBES).tobytes()],
                        "head": [words[common].tobytes()], "head_counts": [counts[common].tobytes()]})
                    common = np.zeros(len(words), bool)  # a segment's words stand with its first part

    filters = parts.select("segment", "entries", "levels", "words", "word_counts").mapInPandas(
        build, "part int, data binary, head binary, head_counts binary")
    built = stored(in_fewer(filters, segments * split * size * 8 // PART_BYTES, 2), "lm-filter", **LARGE_CELLS)
    parts_of = built.select("part", F.length("head").alias("n_head")).toPandas()
    heads = np.zeros(segments * split, np.int64)
    heads[parts_of["part"].to_numpy(int)] = np.cumsum([0, *parts_of["n_head"]])[:-1] // 8
    data, sent_as = None, None
    if whole:
        _sent.append(tempfile.TemporaryDirectory(prefix="candlewick-"))
        sent_as = f"lm-filter-{uuid.uuid4().hex}"
        path = os.path.join(os.path.realpath(_sent[-1].name), sent_as)
        data = np.memmap(path, np.uint64, "w+", shape=(segments * split, size))
    head, head_counts = (np.zeros(int(parts_of["n_head"].sum()) // 8, kind) for kind in ("<u8", "<i8"))
    # A filter of at most `most_bytes`, and at most `head_words` words, fetched a part at a time.
    for row in built.select("part", *["data"] * whole, "head", "head_counts").toLocalIterator():
        if whole:
            data[row.part] = np.frombuffer(row.data, np.uint64)
        word = heads[row.part]
        head[word : word + len(row.head) // 8] = np.frombuffer(row.head, "<u8")
        head_counts[word : word + len(row.head) // 8] = np.frombuffer(row.head_counts, "<i8")
    if whole:
        data.flush()
        spark.sparkContext.addFile(path)
    rank = np.argsort(head)
    tokens = int(known["n_words"].sum())
    follow = [float(np.log(max(d, 2)) / np.log(max(tokens, d, 2))) for d in distinct]
    model = Model(
        order, segments * split if len(parts_of) else 0, data, sent_as, built.stored_at,
        tokens, int(by_level.sum()), follow, head[rank], head_counts[rank],
    )

    def rare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for words, counts in zip(batch["words"], batch["word_counts"]):
                words, counts = np.frombuffer(words, "<u8"), np.frombuffer(counts, "<i8")
                few = counts < low
                yield pd.DataFrame({"key": signed(words[few]), "c": counts[few]})

    return model, parts.select("words", "word_counts").mapInPandas(rare, "key long, c long")


def asked_keys(docs: DataFrame, order: int, parts: int) -> DataFrame:
    """Bundles of texts, and the distinct keys of each by the part of the filter that holds them.

    A row of part -1 has a bundle's texts, packed, and their ids, which ids are null, and sizes; others have sorted keys.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = TaskContext.get().partitionId() << 32
        columns = ["bundle", "part", "data", "ids", "nulls", "sizes"]
        ids, nulls, texts, keys, size = [], [], [], [], 0

        def flushed() -> Iterator[pd.DataFrame]:
            for part, asked in by_part(np.unique(np.concatenate(keys)), parts):
                yield pd.DataFrame([(name, part, asked.tobytes(), None, None, None)], columns=columns)
            packed = zstandard.ZstdCompressor(level=1).compress(b"".join(texts))
            sizes = np.array(list(map(len, texts)), "<i8")
            yield pd.DataFrame([(name, -1, packed, np.array(ids, "<i8").tobytes(), bytes(nulls), sizes.tobytes())], columns=columns)

        for batch in in_rows(batches, ["doc_id", "text"]):
            for doc_id, null, text in zip(batch["doc_id"].astype("Int64").fillna(0), batch["doc_id"].isna(), batch["text"]):
                found = grams(text, order)
                ids.append(doc_id)
                nulls.append(null)
                texts.append(text_bytes(text))
                keys.append(np.unique(np.concatenate(found)))
                size += sum(map(len, found))
                if size >= FLUSH:
                    yield from flushed()
                    name, ids, nulls, texts, keys, size = name + 1, [], [], [], [], 0
        if ids:
            yield from flushed()

    return docs.select("doc_id", "text").mapInPandas(
        run, "bundle long, part int, data binary, ids binary, nulls binary, sizes binary")


def by_part(keys: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    part = _segment(keys, parts)
    rank = np.argsort(part, kind="stable")
    numbers, starts = np.unique(part[rank], return_index=True)
    return zip(numbers.tolist(), np.split(keys[rank], starts[1:]))


def answered_keys(asked: DataFrame, filters: DataFrame, parts: int) -> DataFrame:
    """(bundle, part, data): the levels of the keys of each row of keys, one byte each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, data = None, None
        for batch in batches:
            out = []
            for part, kind, bundle, content in zip(*(batch[c] for c in batch.columns)):
                if kind == 0:
                    held, data = part, np.frombuffer(content, np.uint64)[None]
                    continue
                keys = np.frombuffer(content, "<u8")
                level = levels_in(data, keys, np.zeros(len(keys), np.int64)) if held == part else np.zeros(len(keys))
                out.append((bundle, part, level.astype(np.uint8).tobytes()))
            yield pd.DataFrame(out, columns=["bundle", "part", "data"])

    filters = filters.select("part", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("bundle"), "data")
    keys = asked.where("part >= 0").select("part", F.lit(1).alias("kind"), "bundle", "data")
    return filters.union(keys).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "kind").mapInPandas(
        run, "bundle long, part int, data binary")


def scored(docs: DataFrame, model: Model, rare: DataFrame) -> DataFrame:
    """`doc_id` and what the contract names, for every row of `docs`."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    total = model.tokens + 0.5 * (model.words + 1)

    def scores_of(ids: pd.array, texts: list[str | None], counted: Callable[[np.ndarray], np.ndarray]) -> pd.DataFrame:
        m = sent.value
        scores, sizes, exact, words = m.score([grams(text, m.order) for text in texts], counted)
        cuts = np.cumsum(sizes)[:-1]
        known = exact >= 0
        base = np.where(known, np.log10((np.maximum(exact, 0) + 0.5) / total), 0.0)
        starts = np.append(0, cuts)
        other = [np.unique(w[~k], return_counts=True) for w, k in zip(np.split(words, cuts), np.split(known, cuts))]
        return pd.DataFrame({
            "doc_id": ids, "n_tokens": sizes,
            "head_known": np.add.reduceat(known.astype(np.int64), starts), "head_score": np.add.reduceat(base, starts),
            "score": scores, "other": [signed(w) for w, _ in other], "times": [n for _, n in other]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_rows(batches, ["doc_id", "text"]):
            yield scores_of(batch["doc_id"].astype("Int64").array, list(batch["text"]), sent.value.counts)

    def run_bundles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, levels = sent.value, {}
        for batch in batches:
            for bundle, kind, part, data, ids, nulls, sizes in zip(*(batch[c] for c in batch.columns)):
                if kind == 0:
                    levels[part] = np.frombuffer(data, np.uint8)
                    continue
                doc_ids = pd.arrays.IntegerArray(np.array(np.frombuffer(ids, "<i8")), np.array(np.frombuffer(nulls, bool)))
                raw, ends = unpacked(data), np.cumsum(np.frombuffer(sizes, "<i8")).tolist()
                texts = [raw[a:b].decode() for a, b in zip([0, *ends], ends)]
                keys = np.unique(np.concatenate([np.unique(np.concatenate(grams(text, m.order))) for text in texts]))
                level = np.zeros(len(keys), np.int64)
                level[np.argsort(_segment(keys, m.segments), kind="stable")] = np.concatenate(
                    [levels[number] for number in sorted(levels)])
                levels = {}
                for a in range(0, len(texts), 256):
                    yield scores_of(doc_ids[a : a + 256], texts[a : a + 256],
                                    lambda some: _MEAN[level[np.searchsorted(keys, some)]])

    columns = ("doc_id long, n_tokens long, head_known long, head_score double, score double, "
               "other array<long>, times array<long>")
    if model.data is not None or not model.segments:
        found = docs.select("doc_id", "text").mapInPandas(run, columns)
    else:
        asked = stored(asked_keys(docs, model.order, model.segments), "lm-asked")
        filters = docs.sparkSession.read.schema("part int, data binary").parquet(model.stored_at)
        about, no = ("ids", "nulls", "sizes"), F.lit(None).cast("binary")
        answers = answered_keys(asked, filters, model.segments).select(
            "bundle", F.lit(0).alias("kind"), "part", "data", *(no.alias(name) for name in about))
        texts = asked.where("part < 0").select("bundle", F.lit(1).alias("kind"), "part", "data", *about)
        found = answers.union(texts).repartition("bundle").sortWithinPartitions("bundle", "kind").mapInPandas(
            run_bundles, columns)
    # One row for each word below the head, the first of them with the text's own columns. A text without any gets a key of
    # its own that it asks for 0 times: null keys would all meet in one task.
    row, own = F.monotonically_increasing_id(), ("doc_id", "n_tokens", "head_known", "head_score", "score")
    asks = F.when(F.size("other") > 0, F.arrays_zip("other", "times")).otherwise(
        F.array(F.struct(F.xxhash64("row").alias("other"), F.lit(0).cast("long").alias("times"))))
    asked_of = found.withColumn("row", row).select("row", *own, F.posexplode(asks).alias("at", "o")).select(
        "row", *(F.when(F.col("at") == 0, F.col(name)).alias(name) for name in own),
        F.col("o.other").alias("key"), F.col("o.times").alias("times"))
    c = F.coalesce("c", F.lit(0))
    summed = asked_of.join(rare, "key", "left").groupBy("row").agg(
        *(F.max(name).alias(name) for name in own),
        F.sum(F.col("times") * F.log10((c + 0.5) / F.lit(total))).alias("below"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("below_known"))
    result = summed.select(
        "doc_id", "n_tokens", (F.col("head_known") + F.col("below_known")).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("head_score") + F.col("below")).alias("base_score"), "score")
    return in_fewer(result, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8, 2)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, rare = train(docs.where(remainder(F.col("doc_id"), 5) != 1))
    return scored(docs, model, rare).withColumn("held_out", remainder(F.col("doc_id"), 5) == 1)
