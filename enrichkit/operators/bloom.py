"""A Bloom filter before a shuffled join: rows that cannot match are dropped where they are read.

The filter of a table's keys is itself a table: a row per block of 8 words of 64 bits. A key's
hash names its block and one bit in each word, so one look-up decides. It is built by a
distributed aggregate (bits are or-ed map-side first), its size follows from the number of keys
and the bits given to each, and it is measured again before it is broadcast. Keys of the table
always pass; of others some hundredths do, and the join after it drops them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrichkit.functions.net import shl, shr
from enrichkit.operators.sizing import broadcast_limit, fits_broadcast
from enrichkit.session import ensure_checkpoint_dir

_WORDS = 8
_BLOCK_BITS = 64 * _WORDS
_BLOCK_BYTES = 16 + 8 + 8 * _WORDS  # as ``sizing`` counts a row of the filter
DEFAULT_BITS_PER_KEY = 16
LEAST_BITS_PER_KEY = 4
_BLOCK = "__block"


@dataclass(frozen=True)
class BloomFilter:
    """``blocks`` is the pinned table (block number, words), ``n_blocks`` the number of blocks
    that keys are hashed to (blocks without a key have no row)."""

    blocks: DataFrame
    n_blocks: int


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks).cast("bigint"))


def _bit(key: Column, word: int) -> Column:
    """The key's bit in a word: six bits of a second hash."""
    return shr(F.xxhash64(key, F.lit(word)), 58).bitwiseAND(63).cast("int")


def bloom_filter(
    df: DataFrame, key: str, n_keys: int, bits_per_key: int = DEFAULT_BITS_PER_KEY, max_bytes: int | None = None
) -> BloomFilter | None:
    """The filter of the ``n_keys`` distinct keys of ``df`` (null keys are left out), or None if
    it would not fit the broadcast bound with ``LEAST_BITS_PER_KEY`` bits a key.

    ``max_bytes`` is the bound, Spark's and this package's broadcast setting by default. A
    filter over the bound gets fewer bits a key, so it lets more rows through.
    """
    limit = broadcast_limit(df) if max_bytes is None else max_bytes
    most = max(0, limit) // _BLOCK_BYTES
    wanted = max(1, -(-n_keys * bits_per_key // _BLOCK_BITS))
    n_blocks = min(wanted, most)
    if n_blocks * _BLOCK_BITS < n_keys * LEAST_BITS_PER_KEY or n_blocks < 1:
        return None
    k = F.col(f"`{key}`")
    one = F.lit(1).cast("bigint")
    words = [F.bit_or(shl(one, _bit(k, i))).alias(f"__w{i}") for i in range(_WORDS)]
    blocks = df.where(k.isNotNull()).groupBy(_block(k, n_blocks).alias(_BLOCK)).agg(*words)
    ensure_checkpoint_dir(df.sparkSession)
    blocks = blocks.checkpoint(eager=True)
    return BloomFilter(blocks, n_blocks) if fits_broadcast(blocks, limit) else None


def possible_matches(df: DataFrame, key: str, bloom: BloomFilter) -> DataFrame:
    """The rows of ``df``, batch or stream, whose key may be in the filter. Map-only; rows with a
    null key are dropped."""
    k = F.col(f"`{key}`")
    probe = df.withColumn(_BLOCK, _block(k, bloom.n_blocks))
    held = probe.join(F.broadcast(bloom.blocks), _BLOCK, "inner")
    bits = [shr(f"__w{i}", _bit(k, i)).bitwiseAND(1) == 1 for i in range(_WORDS)]
    return held.where(k.isNotNull() & reduce(lambda a, b: a & b, bits)).select(*[F.col(f"`{c}`") for c in df.columns])
