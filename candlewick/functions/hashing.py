"""Stable shard number of a symbol."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DEFAULT_SHARDS = 5


def shard_number(symbol: Column, shards: int = DEFAULT_SHARDS) -> Column:
    """1 + (MD5 of the symbol, read as a 128-bit number) mod `shards`.

    The digest is folded in four 32-bit pieces, each step reduced mod `shards`, so that it stays within a long.
    """
    digest = F.md5(symbol.cast("binary"))
    rest = F.lit(0).cast("bigint")
    for piece in range(4):
        word = F.conv(F.substring(digest, 8 * piece + 1, 8), 16, 10).cast("bigint")
        rest = (rest * F.lit(2**32) + word) % F.lit(shards)
    return (rest + 1).cast("int")
