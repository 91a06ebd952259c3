"""Bloom filters as tables of bitmaps, built and asked with built-in functions.

A filter is a set of blocks of 32,768 bits. A key belongs to one block and sets a few bits of
it, so asking for a key is an equi-join on its block. A key that was put in is always found;
another one is found by chance, for a few keys in a thousand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepull.functions.names import qcol

# Bits of one bitmap, fixed by the bitmap functions; bits a key takes of its filter, and sets.
BLOCK_BITS = 32_768
BITS_PER_KEY = 12
PROBES = 4


def key_hash(keys: Sequence[str]) -> Column:
    """What a filter knows of a key; equal only for equal types, too."""
    return F.xxhash64(*[qcol(name) for name in keys])


def blocks_for(rows: Column) -> Column:
    """Blocks of a filter for so many keys."""
    return F.greatest(F.ceil(rows * BITS_PER_KEY / BLOCK_BITS), F.lit(1)).cast("int")


def block_of(hashed: Column, blocks: Column) -> Column:
    return F.pmod(hashed, blocks).cast("int")


def _positions(hashed: Column) -> list[Column]:
    """The bits of a key, from another hash, 15 bits each."""
    other = F.xxhash64(hashed, F.lit("bits"))
    return [F.pmod(F.shiftrightunsigned(other, 15 * i), F.lit(BLOCK_BITS)) for i in range(PROBES)]


def bloom_blocks(hashes: DataFrame, group: Sequence[str], hashed: str, blocks: str) -> DataFrame:
    """(``group``, block, bits): the filters of the hashes of each group. ``blocks`` is the size of the group's filter."""
    spread = hashes.select(*[qcol(name) for name in group], block_of(qcol(hashed), qcol(blocks)).alias("block"), F.explode(F.array(*_positions(qcol(hashed)))).alias("bit"))
    return spread.groupBy(*[qcol(name) for name in group], "block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def may_hold(bits: Column, hashed: Column) -> Column:
    """Whether all bits of a key are set in its block."""
    out = F.lit(True)
    for position in _positions(hashed):
        byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        out = out & (F.getbit(byte, (position % 8).cast("int")) == 1)
    return out
