"""Exact distinct counts that merge: bitmaps of dense numbers, cut into buckets.

A value's number names a bucket and a bit in it.  The bitmaps of any groups merge by
OR, bucket by bucket, so one set of them answers every coarser grouping; a bitmap has a
fixed size, and a group of much data is spread over its buckets.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmaps(rows: DataFrame, keys: list[str], number: str = "number") -> DataFrame:
    """One bitmap per key and bucket; rows without a number are left out."""
    placed = rows.filter(F.col(number).isNotNull()).select(
        *keys, F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("bit")
    )
    return placed.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merged_bitmaps(bits: DataFrame, keys: list[str]) -> DataFrame:
    """The bitmaps of a coarser grouping, or of several batches of the same one."""
    return bits.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bits: DataFrame, keys: list[str], name: str = "distinct_values") -> DataFrame:
    """How many distinct values each key has."""
    counted = merged_bitmaps(bits, keys).withColumn("_ones", F.bitmap_count("bits"))
    return counted.groupBy(*keys).agg(F.sum("_ones").alias(name))
