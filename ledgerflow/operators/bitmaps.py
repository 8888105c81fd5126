"""Exact sets of integers as bitmaps (D1c, J2, X2 for large key sets).

A set of 64-bit integers is a table (bucket, bits): bucket covers 32,768
consecutive integers with one bit each, so a dense key set of a billion keys
is 125 MB instead of tens of GB of rows. Bitmaps are built by a partial
aggregation and answer membership exactly; where they fit a broadcast, the
tested side is not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.session import scratch_path

#: Bytes of one bucket's bits.
BUCKET_BYTES = 4096


def key_bitmaps(keys: DataFrame, key: str | Column) -> DataFrame:
    """(bm_bucket, bm_bits) of the set values of an integer column. A key that
    a third of all rows hold costs each task one bit."""
    k = (F.col(key) if isinstance(key, str) else key).cast("long").alias("bm_key")
    known = keys.select(k).where(F.col("bm_key").isNotNull())
    return known.groupBy(F.bitmap_bucket_number("bm_key").alias("bm_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bm_key")).alias("bm_bits"))


def stage_bitmaps(keys: DataFrame, key: str | Column, max_broadcast: int = 1 << 30) -> tuple[DataFrame, bool]:
    """The key set's bitmaps as a written table, and whether they are at most
    ``max_broadcast`` bytes (by their counted buckets), so that they may be
    broadcast: 1 GB are eight billion keys if these are dense."""
    path = scratch_path(keys.sparkSession, "key-bitmaps")
    made = key_bitmaps(keys, key)
    made.write.parquet(path)
    bitmaps = keys.sparkSession.read.schema(made.schema).parquet(path)
    return bitmaps, bitmaps.count() * BUCKET_BYTES <= max_broadcast


def bit_is_set(bits: Column, value: Column) -> Column:
    """Whether the bit of an integer is set in its bucket's bits (false without bits)."""
    at = F.bitmap_bit_position(value)
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))


def mark_members(df: DataFrame, value: Column, bitmaps: DataFrame, mark: str, broadcast: bool | None = None) -> DataFrame:
    """``df`` with the boolean ``mark``: whether ``value`` (an integer; NULL is
    in no set) is in the set. ``broadcast=True`` is the caller's statement that
    the bitmaps fit; otherwise Catalyst decides by their bytes."""
    v, b = "__lf_bm_value", "__lf_bm_bucket"
    # NULL has no bucket: a salt below all buckets keeps such rows spread
    spread = F.lit(-(1 << 60)) - F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))
    left = df.withColumn(v, value.cast("long"))
    left = left.withColumn(b, F.coalesce(F.bitmap_bucket_number(F.col(v)), spread))
    right = bitmaps.select("bm_bucket", "bm_bits")
    joined = left.join(F.broadcast(right) if broadcast else right, F.col(b) == F.col("bm_bucket"), "left")
    return joined.withColumn(mark, bit_is_set(F.col("bm_bits"), F.col(v))).select(*df.columns, mark)
