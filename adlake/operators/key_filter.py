"""A Bloom filter of keys as a relation, made and asked with built-in functions.

Bits lie in buckets of 32,768, a bitmap a row. Both bits of a key are in one
bucket, so one broadcast join asks for a key, before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 32768  # Fixed value: what one bitmap of Spark holds
BITS_A_KEY = 16  # one key in a hundred passes by mistake
MOST_BUCKETS = 4096  # 16 MB of bitmaps, the most that is ever broadcast


def _places(keys: list[str], buckets: int) -> tuple[Column, list[Column]]:
    """The bucket of a key and its two bits there."""
    bits = F.xxhash64(*keys, F.lit(1))
    return (
        F.pmod(F.xxhash64(*keys), F.lit(buckets)),
        [F.pmod(bits, F.lit(BUCKET_BITS)), F.pmod(F.shiftrightunsigned(bits, 32), F.lit(BUCKET_BITS))],
    )


def buckets_for(rows: int) -> int:
    """Buckets of a filter of so many keys; 0 where 16 MB would let most pass."""
    needed = -(-rows * BITS_A_KEY // BUCKET_BITS)
    return 0 if needed > MOST_BUCKETS * 4 else min(max(1, needed), MOST_BUCKETS)


def key_filter(source: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """``(_bucket, _bitmap)`` rows of the keys of ``source``."""
    bucket, bits = _places(keys, buckets)
    placed = source.select(bucket.alias("_bucket"), F.explode(F.array(*bits)).alias("_bit"))
    # Dealt out first: otherwise every task makes a bitmap of almost every bucket.
    return placed.repartition("_bucket").groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))


def _asked(frame: DataFrame, keys: list[str], filters: DataFrame, buckets: int, how: str) -> tuple[DataFrame, Column]:
    """Rows beside the bitmap of their bucket, and whether it has both their bits."""
    bucket, bits = _places(keys, buckets)

    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring("_bitmap", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10)
        return F.getbit(byte.cast("bigint"), (bit % 8).cast("int")) == 1

    asked = frame.withColumn("_bucket", bucket).join(F.broadcast(filters), "_bucket", how)
    return asked, is_set(bits[0]) & is_set(bits[1])


def may_hold(frame: DataFrame, keys: list[str], filters: DataFrame, buckets: int) -> DataFrame:
    """Rows whose key may be in the filter: all that are, few that are not."""
    asked, both = _asked(frame, keys, filters, buckets, "inner")
    return asked.where(both).select(*frame.columns)


def cannot_hold(frame: DataFrame, keys: list[str], filters: DataFrame, buckets: int) -> DataFrame:
    """The other rows: their key is surely not in the filter."""
    asked, both = _asked(frame, keys, filters, buckets, "left")
    return asked.where(~F.coalesce(both, F.lit(False))).select(*frame.columns)
