"""Which of many groups may hold a key: Bloom filters built and asked by DataFrame operations.

A filter is a set of blocks of 32,768 bits, Spark's own bitmap aggregate. The hash of a key names one
block and HASHES bits in it, so a key is one row when it is looked up. A group has 2 ** bits blocks, as many as
its keys need for KEYS of them in each: about one foreign key in a hundred seems to be there, and no
key that is there is missed. Bitmaps are built before the shuffle, task by task.

Defined cases. A key with a NULL part equals nothing, so it is left out when filters are built and when they are
asked. Repeated keys set the same bits. A group without keys has no filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a block: the size of Spark's bitmaps.
BLOCK = 32_768
KEYS = 3000
HASHES = 7


def _hashed(df: DataFrame, key: list[str], keep: list[str]) -> DataFrame:
    """The columns ``keep`` of rows whose key has no NULL, with the hash that names the block and that of the bits."""
    known = df.dropna(subset=key)
    return known.select(*keep, F.xxhash64(*key).alias("_block"), F.xxhash64(F.lit(1), *key).alias("_bits"))


def _block(bits: Column) -> Column:
    return F.col("_block").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)


def _places() -> Column:
    """The key's bits in its block."""
    first, step = F.pmod("_bits", F.lit(BLOCK)), F.pmod(F.shiftright("_bits", 20), F.lit(BLOCK // 2)) * 2 + 1
    return F.transform(F.array(*map(F.lit, range(HASHES))), lambda i: F.pmod(first + i * step, F.lit(BLOCK)))


def filters(keys: DataFrame, key: list[str], group: list[str]) -> DataFrame:
    """(group..., bits, block, bitmap) of the keys of each group."""
    sizes = keys.groupBy(*group).agg(F.count("*").alias("_n"))
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("_n") / KEYS))).cast("int")
    sized = _hashed(keys, key, group).join(sizes.select(*group, bits.alias("bits")), group)
    placed = sized.select(*group, "bits", _block(F.col("bits")).alias("block"), F.explode(_places()).alias("place"))
    return placed.groupBy(*group, "bits", "block").agg(F.bitmap_construct_agg(F.col("place")).alias("bitmap"))


def _is_set(bitmap: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def possible(keys: DataFrame, held: DataFrame, key: list[str], group: list[str], within: list[str]) -> DataFrame:
    """Distinct ``group`` of the filters ``held`` that may hold one of ``keys``; only filters that agree with a
    key in the columns ``within``, which both sides have, are asked."""
    sizes = held.select(*within, "bits").distinct()
    asked = _hashed(keys, key, within).join(sizes, within)
    asked = asked.select(*within, "bits", _block(F.col("bits")).alias("block"), _places().alias("_places"))
    met = asked.join(held, [*within, "bits", "block"])
    return met.filter(F.forall("_places", lambda p: _is_set(F.col("bitmap"), p))).select(*group).distinct()
