"""Line dedup: a sharded minimal perfect hash over the hashes of lines that several documents hold.

A line's key is the line without the white space `[\\x20\\x09-\\x0D]` around it, A-Z lower-cased; keys of fewer than
`LEAST_CHARS` code points never count. Keys are named by 128-bit digests. One aggregate (with a partial step, so that a very
common line is summed before the shuffle) gives each digest the number of documents that hold it and the smallest doc_id.
Digests of a single document need no entry: a probe that meets no fingerprint of its own is such a line.

The others are dealt by digest into shards of about `SHARD_KEYS` keys. A shard is a minimal perfect hash: levels of bit arrays,
a key's bit being set in the first level in which it collides with no other; the rank of that bit is the key's place in
two arrays, of 64-bit fingerprints and of counts, and in a third one, of smallest ids. Documents probe these arrays, all
lines of a batch at a time:

- while all shards together take at most `INDEX_BYTES` they are broadcast and each document is cleaned where it is read;
- beyond that the probes travel to the shards, which are dealt to as many tasks as the probes of each need, and only the
  ordinals of lines to drop travel back. Results are the same (tested).

Defined cases: a null or empty text is one empty line; a null doc_id counts as the largest (2^63 - 1), so lines that only rows without id
hold all stay; rows of one doc_id are documents of their own but none of them precedes another, so a key keeps all its
lines in rows of its smallest id; `text` and, if there, `n_chars` are what cleaning changes, other columns stay as they are; an
empty table gives an empty result.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from candlewick.llm.common import MASK, in_rows, mixed, signed, stored, table, text_bytes

LEAST_CHARS = 10
LEAST_DOCS = 2
SHARD_KEYS = 1 << 18
INDEX_BYTES = 256 << 20
PROBES = 1 << 21  # of one task
NO_ID = (1 << 63) - 1
SPREAD = 2.0  # bits of a level for each key that is left
LEVELS = 64


def key_digests(text: str | None, least: int = LEAST_CHARS) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The text's lines, for each line the ordinal of its key among the text's distinct ones (-1: too short), and the keys' digests."""
    raw = text_bytes(text)
    seen: dict[bytes, int] = {}
    ordinal = []
    for line in raw.lower().split(b"\n"):
        key = line.strip()
        if len(key) >= 4 * least or len(key) >= least and len(key.decode()) >= least:
            ordinal.append(seen.setdefault(key, len(seen)))
        else:
            ordinal.append(-1)
    digest = xxhash.xxh3_128_digest
    return raw.split(b"\n"), np.array(ordinal, np.int64), np.frombuffer(b"".join(map(digest, seen)), ">u8").astype(np.uint64).reshape(-1, 2)


def own_id(doc_id: Column) -> Column:
    """The id without nulls, which would turn a batch's ids into floating-point numbers."""
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID)).alias("own")


def line_counts(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """(a, b, docs, first): each key's digest, the number of rows of `docs` that hold it, and the smallest id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_rows(batches, ["own", "text"]):
            marks = [key_digests(text, least)[2] for text in batch["text"]]
            ids = np.repeat(batch["own"].to_numpy(np.int64), [len(x) for x in marks])
            both = signed(np.concatenate(marks))
            yield pd.DataFrame({"a": both[:, 0], "b": both[:, 1], "id": ids})

    held = docs.select(own_id(F.col("doc_id")), "text").mapInPandas(run, "a long, b long, id long")
    return held.groupBy("a", "b").agg(F.count(F.lit(1)).alias("docs"), F.min("id").alias("first"))


class LineShard:
    """A minimal perfect hash of some digests, and what it indexes."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, fingerprints: np.ndarray, counts: np.ndarray, firsts: np.ndarray):
        self.sizes, self.words, self.fingerprints, self.counts, self.firsts = sizes, words, fingerprints, counts, firsts
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        turn = np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 & MASK)
        return ((mixed(a ^ turn) + mixed(b + turn)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray, counts: np.ndarray, firsts: np.ndarray) -> LineShard:
        """All (a, b) differ."""
        left, sizes, bits = np.arange(len(a)), [], []
        for level in range(LEVELS):
            if len(left) == 0:
                break
            size = 64 * int(np.ceil(SPREAD * len(left) / 64))
            place = cls._place(a[left], b[left], level, size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = left[~alone[place]]
        if len(left):
            raise ValueError("digests repeat")
        words = np.packbits(np.concatenate(bits) if bits else np.zeros(0, bool), bitorder="little").view(np.uint64)
        shard = cls(np.array(sizes, np.int64), words, b, counts, firsts)
        slot = shard._slots(a, b)
        order = np.empty(len(a), np.int64)
        order[slot] = np.arange(len(a))
        most = int(counts.max(initial=0))
        shard.fingerprints, shard.firsts = b[order], firsts[order]
        shard.counts = counts[order].astype(np.min_scalar_type(most))
        return shard

    def _slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The place of each digest, if it is a key; -1 if it surely is none."""
        slot, left = np.full(len(a), -1, np.int64), np.arange(len(a))
        for level, size in enumerate(self.sizes.tolist()):
            place = self._place(a[left], b[left], level, size) + self.starts[level]
            word, bit = self.words[place >> 6], (place & 63).astype(np.uint64)
            here = (word >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            slot[left[here]] = (self.before[place >> 6] + below)[here]
            left = left[~here]
        return slot

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of documents and smallest id of each digest; 0 and `NO_ID` where the digest is no key."""
        slot = self._slots(a, b)
        known = slot >= 0
        known[known] = self.fingerprints[slot[known]] == b[known]
        counts, firsts = np.zeros(len(a), np.int64), np.full(len(a), NO_ID, np.int64)
        counts[known], firsts[known] = self.counts[slot[known]], self.firsts[slot[known]]
        return counts, firsts

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        for part in (self.sizes, self.words, self.fingerprints, self.counts, self.firsts):
            np.save(out, part, allow_pickle=False)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> LineShard:
        source = io.BytesIO(data)
        return cls(*(np.load(source, allow_pickle=False) for _ in range(5)))


class LineIndex:
    """The stored shards of a corpus; `held` has their bytes if they are few enough to broadcast."""

    def __init__(self, shards: DataFrame, n_shards: int, held: list[bytes | None] | None, least: int, least_docs: int):
        self.shards, self.n_shards, self.held, self.least, self.least_docs = shards, n_shards, held, least, least_docs


def build_index(docs: DataFrame, least: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, shard_keys: int = SHARD_KEYS,
                index_bytes: int = INDEX_BYTES) -> LineIndex:
    if least_docs < 2:
        raise ValueError("a line of one document is no copy")
    keys = stored(line_counts(docs, least).where(F.col("docs") >= least_docs), "line-keys")
    n = max(1, -(-keys.count() // shard_keys))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def made(shard: int, parts: list[np.ndarray]) -> pd.DataFrame:
            a, b, docs, first = np.concatenate(parts).T.copy()
            data = LineShard.build(a.view(np.uint64), b.view(np.uint64), docs, first).to_bytes()
            return pd.DataFrame({"shard": [shard], "probes": [int(docs.sum())], "data": [data]})

        at, parts = None, []
        for batch in batches:
            for shard, rows in batch.groupby("shard", sort=False):
                if at is not None and shard != at:
                    yield made(at, parts)
                    parts = []
                at = shard
                parts.append(rows[["a", "b", "docs", "first"]].to_numpy(np.int64))
        if parts:
            yield made(at, parts)

    dealt = keys.withColumn("shard", F.pmod("a", F.lit(n)).cast("int")).repartition("shard").sortWithinPartitions("shard")
    shards = stored(dealt.select("shard", "a", "b", "docs", "first").mapInPandas(
        build, "shard int, probes long, data binary"), "line-shards")
    size = shards.agg(F.sum(F.length("data"))).first()[0] or 0
    held = None
    if size <= index_bytes:
        held = [None] * n
        for row in shards.select("shard", "data").collect():
            held[row["shard"]] = bytes(row["data"])
    return LineIndex(shards, n, held, least, least_docs)


_loaded: dict[str, list[LineShard | None]] = {}


def cleaned(lines: list[bytes], gone: np.ndarray) -> str:
    return b"\n".join([line for line, out in zip(lines, gone.tolist()) if not out]).decode()


def _dropped_here(docs: DataFrame, index: LineIndex) -> DataFrame:
    """(row, n_lines, n_dropped, kept) with the broadcast index."""
    name = index.shards.stored_at
    shared = docs.sparkSession.sparkContext.broadcast(index.held)
    n, least, least_docs = index.n_shards, index.least, index.least_docs

    def shards() -> list[LineShard | None]:
        if name not in _loaded:
            _loaded.clear()
            _loaded[name] = [None if data is None else LineShard.from_bytes(data) for data in shared.value]
        return _loaded[name]

    @F.pandas_udf("n_lines long, n_dropped long, kept string")
    def clean(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        own = ids.to_numpy(np.int64)
        out = []
        for at in range(0, len(own), 256):  # texts of so many rows are split at a time
            found = [key_digests(text, least) for text in texts.iloc[at : at + 256]]
            size = [len(x[2]) for x in found]
            marks, drop = np.concatenate([x[2] for x in found]), np.zeros(sum(size), bool)
            at_shard = np.mod(signed(marks[:, 0]), n)
            owner = np.repeat(own[at : at + 256], size)
            for shard in np.unique(at_shard).tolist():
                if shards()[shard] is not None:
                    here = np.flatnonzero(at_shard == shard)
                    counts, firsts = shards()[shard].find(marks[here, 0], marks[here, 1])
                    drop[here] = (counts >= least_docs) & (firsts < owner[here])
            for (lines, ordinal, _), part in zip(found, np.split(drop, np.cumsum(size)[:-1])):
                gone = np.append(part, False)[ordinal]  # the ordinal -1 is the last
                out.append((len(lines), int(gone.sum()), cleaned(lines, gone)))
        return pd.DataFrame(out, columns=["n_lines", "n_dropped", "kept"])

    rows = docs.select(F.struct(*docs.columns).alias("row"))
    return rows.withColumn("c", clean(own_id(F.col("row.doc_id")), "row.text")).select("row", "c.*")


def _dropped_by_shards(docs: DataFrame, index: LineIndex, probes: int = PROBES) -> DataFrame:
    """The same for an index of any size: probes go to the shards' tasks, ordinals of lines to drop come back."""
    n, least, least_docs = index.n_shards, index.least, index.least_docs
    mark = F.md5(F.coalesce("text", F.lit("")))
    asked = "own long, mark string, ordinal int, shard int, turn long, a long, b long"

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn = 0
        for batch in in_rows(batches, ["own", "mark", "text"]):
            marks = [key_digests(text, least)[2] for text in batch["text"]]
            size = [len(x) for x in marks]
            both = signed(np.concatenate(marks))
            ordinal = np.concatenate([np.arange(x) for x in size]).astype(np.int32)
            yield pd.DataFrame({
                "own": batch["own"].repeat(size).to_numpy(), "mark": batch["mark"].repeat(size).to_numpy(),
                "ordinal": ordinal, "shard": np.mod(both[:, 0], n).astype(np.int32),
                "turn": np.arange(turn, turn + len(both)), "a": both[:, 0], "b": both[:, 1]})
            turn += len(both)

    # A shard gets a task for every `probes` probes, dealt in turn, so that a line of a third of all documents spreads.
    all_probes = docs.select(own_id(F.col("doc_id")), mark.alias("mark"), "text").mapInPandas(ask, asked)
    tasks = F.ceil(F.col("probes") / probes).cast("int")
    sizes = index.shards.select("shard", tasks.alias("tasks"))
    sent = all_probes.join(sizes, "shard").select(
        "shard", F.pmod("turn", F.col("tasks")).cast("int").alias("task"), F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("data"),
        "own", "mark", "ordinal", "a", "b")
    arrays = index.shards.select(
        "shard", F.explode(F.sequence(F.lit(0), tasks - 1)).alias("task"), F.lit(0).alias("kind"), "data",
        F.lit(0).cast("long").alias("own"), F.lit(None).cast("string").alias("mark"),
        # Zeros, as nulls would turn whole numbers of a batch into floating-point ones.
        F.lit(0).alias("ordinal"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = None
        for batch in batches:
            new = np.flatnonzero(batch["kind"].to_numpy() == 0)
            for begin, end in zip([0, *new], [*new, len(batch)]):
                part = batch.iloc[begin:end]
                if len(part) and part["kind"].iloc[0] == 0:
                    shard, part = LineShard.from_bytes(part["data"].iloc[0]), part.iloc[1:]
                if len(part):
                    a, b = (part[c].to_numpy(np.int64).view(np.uint64) for c in "ab")
                    counts, firsts = shard.find(a, b)
                    yield part[(counts >= least_docs) & (firsts < part["own"].to_numpy(np.int64))][["own", "mark", "ordinal"]]

    hits = arrays.union(sent).repartition("shard", "task").sortWithinPartitions("shard", "task", "kind").mapInPandas(
        answer, "own long, mark string, ordinal int")
    # One row a document: equal rows (same id and text) lose the same lines.
    drops = hits.groupBy("own", "mark").agg(F.collect_set("ordinal").alias("ordinals"))

    @F.pandas_udf("n_lines long, n_dropped long, kept string")
    def clean(texts: pd.Series, ordinals: pd.Series) -> pd.DataFrame:
        out = []
        for text, some in zip(texts, ordinals):
            lines, ordinal, marks = key_digests(text, least)
            drop = np.zeros(len(marks) + 1, bool)
            if some is not None:
                drop[np.asarray(some, np.int64)] = True
            gone = drop[ordinal]
            out.append((len(lines), int(gone.sum()), cleaned(lines, gone)))
        return pd.DataFrame(out, columns=["n_lines", "n_dropped", "kept"])

    rows = docs.select(F.struct(*docs.columns).alias("row"), own_id(F.col("doc_id")), mark.alias("mark")).join(
        drops, ["own", "mark"], "left")
    return rows.withColumn("c", clean("row.text", "ordinals")).select("row", "c.*")


def dropped_lines(docs: DataFrame, index: LineIndex) -> DataFrame:
    """(row, n_lines, n_dropped, kept) for each row of `docs`: the row itself, its lines, those to drop, the text that stays."""
    return _dropped_here(docs, index) if index.held is not None else _dropped_by_shards(docs, index)


def without_repeated_lines(docs: DataFrame, index: LineIndex | None = None) -> DataFrame:
    """`docs` without lines that a document of a smaller id holds as well."""
    found = dropped_lines(docs, index or build_index(docs))
    new: dict[str, Column] = {"text": F.when(F.col("row.text").isNull() & (F.col("kept") == ""), None).otherwise(F.col("kept"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
    return found.select(*[new.get(name, F.col("row")[name]).alias(name) for name in docs.columns])


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = dropped_lines(docs, build_index(docs))
    return found.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast(T.BinaryType()), 256).alias("kept_sha256"))


OP13_SQL = f"""
WITH split AS (
    SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
    SELECT doc_id, r, unnest(parts) AS line, unnest(range(len(parts))) AS i FROM split),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
held AS (
    SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= {LEAST_CHARS}
    GROUP BY key HAVING count(DISTINCT doc_id) >= {LEAST_DOCS}),
marked AS (
    SELECT doc_id, r, i, line, coalesce(held.first < doc_id, false) AS gone FROM keyed LEFT JOIN held USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, r"""
