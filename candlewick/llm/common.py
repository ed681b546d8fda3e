"""What several operators share: stored tables, word hashes, memoised tokenisation."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from candlewick.session import shared_dir

#: The characters that separate words: space and the controls tab to carriage return, as `bytes.split()` has them.
WORD = r"[^\x20\x09-\x0D]+"
MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str, **options: str) -> DataFrame:
    """`frame` written to the shared folder and read again: computed once, and safe if an executor is lost. `options` are
    the Parquet writer's."""
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"
    frame.write.options(**options).parquet(path)
    back = spark.read.schema(frame.schema).parquet(path)
    back.stored_at = path
    return back


def release(*frames: DataFrame) -> None:
    """Delete tables made by `stored` that no later step reads."""
    for frame in frames:
        jvm = frame.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(frame.stored_at)
        path.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def text_bytes(text: str | None) -> bytes:
    return (text or "").encode()


def text_key(text: str = "text") -> Column:
    """128-bit digest that names a text; with the id it names a row, up to rows that are equal in both."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("t")


@F.pandas_udf(T.BinaryType())
def packed_text(texts: pd.Series) -> pd.Series:
    """Texts as they are shuffled: less than half the size."""
    pack = zstandard.ZstdCompressor(level=1).compress
    return pd.Series([pack(text_bytes(text)) for text in texts], index=texts.index, dtype=object)


def unpacked(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def remainder_of(text: Column, modulus: int) -> Column:
    return F.crc32(text.cast("binary")) % modulus


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as the empty text."""
    return remainder_of(F.coalesce(doc_id.cast("string"), F.lit("")), modulus)


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to `most` words."""

    def __init__(self, seed: int, most: int = 400_000):
        super().__init__()
        self.seed, self.most = seed, most

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word, self.seed)
        if len(word) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


#: All white space but the space and the line end, and the mark that separates pieces.
ODD_SPACE = tuple("\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000\0") + tuple(
    map(chr, range(0x2000, 0x200B)))
ASCII_SPACE = tuple(c for c in ODD_SPACE if c.isascii())


class Encoder:
    """Token ids of a text, as little-endian 32-bit bytes.

    Texts are cut where no token can cross: for `cut="spaced"` before a single space between two other characters and
    around a single line end, for `cut="dropped"` (white space never reaches a token) at spaces and line ends. The ids of each distinct piece come from the
    tokenizer once and are remembered. Of `most` pieces of up to 64 characters the half not used for longest is forgotten.
    A text that holds the string of a special token anywhere is encoded whole, as the tokenizer has it.
    """

    _cut = re.compile(r"(?<=\S)(?= \S)")
    _plain = re.compile(r" ?\S{1,64}")

    def __init__(self, path: str, cut: str, most: int = 1_200_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = tuple(token.content for token in self.tokenizer.get_added_tokens_decoder().values())
        self.tokenizer.encode_special_tokens = True  # not sought where a text has none
        self.cut, self.most, self.known, self.older = cut, most, {"": b""}, {}
        self.sizes = self.ends = None

    def pieces(self, text: str) -> list[str]:
        if self.cut == "dropped":
            return text.replace("\n", " ").split(" ")
        if any(pair in text for pair in ("  ", " \n", "\n ", "\n\n")) or text[:1].isspace() or text[-1:].isspace() or any(
                c in text for c in (ASCII_SPACE if text.isascii() else ODD_SPACE)):
            return self._cut.split(text)
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _tables(self) -> None:
        """Of each token: its bytes (byte-level tokens have one character per byte), and whether it ends a word."""
        self.sizes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        self.ends = np.zeros(len(self.sizes), bool)
        for token, one in self.tokenizer.get_vocab().items():
            self.sizes[one], self.ends[one] = len(token), token.endswith("</w>")

    def _cut_words(self, pieces: list[str]) -> tuple[list[str], np.ndarray, list[int], list[int]]:
        """Words of letters, perhaps with stops behind them: each gives one word or two that end with an end token."""
        bare = [piece.rstrip(".,;:!?") for piece in pieces]
        plain = [(piece, 2 - (word == piece)) for piece, word in zip(pieces, bare) if word.isalpha()]
        ids = self._ids(" ".join([piece for piece, _ in plain]))
        ends, count = np.flatnonzero(self.ends[ids]) + 1, np.cumsum([n for _, n in plain], dtype=np.int64)
        if not plain or count[-1] != len(ends):  # some letter became more than letters
            return [], ids, [], []
        cuts = ends[count - 1].tolist()
        return [piece for piece, _ in plain], ids, [0, *cuts[:-1]], cuts

    def _cut_bytes(self, pieces: list[str]) -> tuple[list[str], np.ndarray, list[int], list[int]]:
        """Pieces without white space but a space in front; those without one get a line end, a token of its own."""
        plain = [piece for piece in pieces if self._plain.fullmatch(piece)]
        bare = [piece[0] != " " for piece in plain]
        ids = self._ids("".join(["\n" + piece if b else piece for piece, b in zip(plain, bare)]))
        size = np.cumsum([len(piece.encode()) + b for piece, b in zip(plain, bare)], dtype=np.int64)
        cuts = np.searchsorted(np.cumsum(self.sizes[ids]), size) + 1
        return plain, ids, (np.append(0, cuts)[:-1] + np.array(bare, np.int64)).tolist(), cuts.tolist()

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of new pieces: those of plain form in one text, whose ids are then cut into theirs, the others alone."""
        if self.sizes is None:
            self._tables()
        plain, ids, begins, cuts = (self._cut_words if self.cut == "dropped" else self._cut_bytes)(pieces)
        data = ids.tobytes()
        found = {piece: data[4 * a : 4 * b] for piece, a, b in zip(plain, begins, cuts)}
        rest = [piece for piece in pieces if piece not in found]
        if rest:
            for piece, one in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
                found[piece] = np.array(one.ids, "<u4").tobytes()
        return found

    def encode(self, text: str | None) -> bytes:
        if text and any(mark in text for mark in self.special):
            self.tokenizer.encode_special_tokens = False
            try:
                return self._ids(text).tobytes()
            finally:
                self.tokenizer.encode_special_tokens = True
        pieces = self.pieces(text or "")
        parts = list(map(self.known.get, pieces))
        if None in parts:
            missing = [i for i, part in enumerate(parts) if part is None]
            new = {pieces[i] for i in missing}
            if len(self.known) + len(new) > self.most // 2:
                self.older, self.known = self.known, {"": b""}
            older = self.older
            found = {piece: older[piece] for piece in new if piece in older}
            found |= self._learn([piece for piece in new if piece not in found])
            for i in missing:
                parts[i] = found[pieces[i]]
            self.known.update(found if max(map(len, new)) <= 64 else {p: x for p, x in found.items() if len(p) <= 64})
        return b"".join(parts)


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, cut: str) -> Encoder:
    """One encoder for each worker process, so that its memory of pieces outlives a task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (path, cut) not in _encoders:
        _encoders[path, cut] = Encoder(path, cut)
    return _encoders[path, cut]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def in_rows(batches: Iterator[pd.DataFrame], columns: list[str], size: int = 256) -> Iterator[pd.DataFrame]:
    """Batches of at most `size` rows, so that what a task holds stays small beside long texts."""
    for batch in batches:
        for start in range(0, len(batch), size):
            yield batch[columns].iloc[start : start + size]
