"""Token ids in binary files: every id in the fewest bits that hold the vocabulary.

A file holds one range of documents in ascending doc_id order:

    magic | bits, ids per block (two 32-bit numbers)
    blocks: ids packed without gaps, lowest bit first; each block starts at a byte
    block offsets | doc_id | 1 where doc_id is null | first id of each document, and the end    (64-bit, flags 8-bit)
    documents, ids, blocks, place of the block offsets (four 64-bit numbers) | magic

All numbers are little-endian. Any range of ids is read by unpacking the blocks that hold it, with numpy.

Files go through the file system named by the shared folder's address. A task writes its file under a name of its own and
reports it in the manifest, so a repeated task leaves an unused file and never a mixed one.

Defined cases: a null or empty text is the end id alone; a null doc_id comes first; rows of one doc_id follow each other
in text order; an empty table gives no file and an empty result.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from candlewick.llm.common import encoder, in_rows, stored, table, tokenizer_path
from candlewick.session import shared_dir

MAGIC = b"CWIDS\x00\x00\x01"
BLOCK_IDS = 8192
END_ID = 0
READ_IDS = 1 << 20


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(spread[:, :bits].ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, bits: int, count: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype("<u4")
    spread = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[: count * bits].reshape(count, bits)
    whole = np.zeros((count, 32), np.uint8)
    whole[:, :bits] = spread
    return np.packbits(whole, axis=1, bitorder="little").view("<u4").ravel()


class TokenWriter:
    def __init__(self, out, bits: int, block_ids: int = BLOCK_IDS):
        self.out, self.bits, self.block_ids = out, bits, block_ids
        self.rest, self.n_rest, self.offsets = [], 0, []
        self.docs, self.nulls, self.starts, self.n_ids = [], [], [0], 0
        self.at = self._write(MAGIC + np.array([bits, block_ids], "<u4").tobytes())

    def _write(self, data: bytes) -> int:
        self.out.write(data)
        return len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(0 if doc_id is None else doc_id)
        self.nulls.append(doc_id is None)
        self.n_ids += len(ids)
        self.starts.append(self.n_ids)
        self.rest.append(ids)
        self.n_rest += len(ids)
        if self.n_rest >= 64 * self.block_ids:
            self._blocks(last=False)

    def _blocks(self, last: bool) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.zeros(0, "<u4")
        whole = len(ids) if last else len(ids) // self.block_ids * self.block_ids
        for at in range(0, whole, self.block_ids):
            self.offsets.append(self.at)
            self.at += self._write(pack_bits(ids[at : min(at + self.block_ids, whole)], self.bits))
        self.rest, self.n_rest = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._blocks(last=True)
        place = self.at
        self._write(np.array([*self.offsets, self.at], "<u8").tobytes())
        self._write(np.array(self.docs, "<i8").tobytes() + np.array(self.nulls, np.uint8).tobytes())
        self._write(np.array(self.starts, "<u8").tobytes())
        self._write(np.array([len(self.docs), self.n_ids, len(self.offsets), place], "<u8").tobytes() + MAGIC)


class TokenReader:
    def __init__(self, source):
        self.source = source
        size = source.size()
        tail = source.read_at(32 + len(MAGIC), size - 32 - len(MAGIC))
        head = source.read_at(len(MAGIC) + 8, 0)
        if tail[32:] != MAGIC or head[: len(MAGIC)] != MAGIC:
            raise ValueError("not a whole token file")
        self.bits, self.block_ids = (int(x) for x in np.frombuffer(head[len(MAGIC) :], "<u4"))
        n_docs, self.n_ids, n_blocks, place = (int(x) for x in np.frombuffer(tail[:32], "<u8"))
        index = source.read_at(size - 32 - len(MAGIC) - place, place)
        cuts = np.cumsum([0, 8 * (n_blocks + 1), 8 * n_docs, n_docs, 8 * (n_docs + 1)])
        part = [index[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        self.offsets = np.frombuffer(part[0], "<u8").astype(np.int64)
        self.docs, self.nulls = np.frombuffer(part[1], "<i8"), np.frombuffer(part[2], np.uint8).astype(bool)
        self.starts = np.frombuffer(part[3], "<u8").astype(np.int64)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids `first` to `last` - 1 of the file."""
        if first >= last:
            return np.zeros(0, "<u4")
        a, b = first // self.block_ids, (last - 1) // self.block_ids + 1
        data = self.source.read_at(int(self.offsets[b] - self.offsets[a]), int(self.offsets[a]))
        if (self.block_ids * self.bits) % 8 == 0:  # whole blocks end at a byte, so they unpack as one run
            out = unpack_bits(data, self.bits, min(b * self.block_ids, self.n_ids) - a * self.block_ids)
        else:
            cuts = self.offsets[a : b + 1] - self.offsets[a]
            out = np.concatenate([
                unpack_bits(data[cuts[i] : cuts[i + 1]], self.bits,
                            min(self.block_ids, self.n_ids - (a + i) * self.block_ids)) for i in range(b - a)
            ])
        return out[first - a * self.block_ids : last - a * self.block_ids]


def write_token_files(docs: DataFrame, folder: str, path: str, cut: str, end_id: int, shards: int) -> DataFrame:
    """Write the files and return the stored manifest: shard, path, n_docs, n_ids and the ids before the shard."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, writer = encoder(path, cut), None
        bits = bits_for(max(coder.tokenizer.get_vocab_size(), end_id + 1))
        shard = TaskContext.get().partitionId()
        system, place = fs.FileSystem.from_uri(folder)
        name = f"ids-{shard:06d}-{uuid.uuid4().hex}.bin"
        end = np.array([end_id], "<u4")
        for batch in in_rows(batches, ["doc_id", "text"]):
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                if writer is None:
                    system.create_dir(place, recursive=True)
                    writer = TokenWriter(system.open_output_stream(f"{place}/{name}"), bits)
                ids = np.concatenate([np.frombuffer(coder.encode(text), "<u4"), end])
                writer.add(None if pd.isna(doc_id) else int(doc_id), ids)
        if writer is not None:
            writer.close()
            writer.out.close()
            yield pd.DataFrame({"shard": [shard], "file": [f"{folder}/{name}"], "n_docs": [len(writer.docs)],
                                "n_ids": [writer.n_ids]})

    ranged = docs.select("doc_id", "text").repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    manifest = stored(ranged.mapInPandas(write, "shard int, file string, n_docs long, n_ids long"), "ids-manifest")
    # One row per file: summing them in order is a small step.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return stored(manifest.withColumn("ids_before", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "ids-files")


def read_token_files(manifest: DataFrame, shards: int) -> DataFrame:
    """One row per document as the files hold it: doc_id, start, n_tokens, ids_crc32."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, before in zip(batch["file"], batch["ids_before"]):
                system, place = fs.FileSystem.from_uri(file)
                with system.open_input_file(place) as source:
                    reader, first = TokenReader(source), 0
                    while first < len(reader.docs):
                        last = int(np.searchsorted(reader.starts, reader.starts[first] + READ_IDS, "right")) - 1
                        last = min(max(last, first + 1), len(reader.docs))
                        starts = reader.starts[first : last + 1]
                        ids, cuts = reader.ids(int(starts[0]), int(starts[-1])).tobytes(), (starts - starts[0]) * 4
                        yield pd.DataFrame({
                            "doc_id": pd.array(reader.docs[first:last], "Int64").copy(),
                            "start": starts[:-1] + before,
                            "n_tokens": np.diff(starts),
                            "ids_crc32": [zlib.crc32(ids[a:b]) for a, b in zip(cuts[:-1], cuts[1:])],
                        }).assign(doc_id=lambda x: x["doc_id"].mask(reader.nulls[first:last]))
                        first = last

    return manifest.select("shard", "file", "ids_before").repartitionById(shards, F.col("shard")).mapInPandas(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"{shared_dir(spark)}/llm/ids-{uuid.uuid4().hex}"
    manifest = write_token_files(
        table(spark, sf_dir, "documents"), folder, tokenizer_path("byte_bpe_50k.json"), "spaced", END_ID, shards
    )
    return read_token_files(manifest, shards)
