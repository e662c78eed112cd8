"""Dense numbers for the values of a column, without one task seeing them all."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, key: str, first: int = 0, ranges: int | None = None) -> DataFrame:
    """``key`` distinct and not null, with ``number`` counting up from ``first`` in the
    order of the keys.

    Rows are dealt by ranges of the key, numbered within a range, and offset by the
    lengths of the ranges before it: one small row per range.  The ranges are drawn from
    the data, so write the result before it is used twice.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = df.filter(F.col(key).isNotNull()).select(key).distinct()
    dealt = keys.repartitionByRange(ranges, key).withColumn("_range", F.spark_partition_id())
    within = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    counted = dealt.withColumn("_within", within)
    # The largest number within a range is its length.
    lengths = counted.groupBy("_range").agg(F.max("_within").alias("_length"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = lengths.select("_range", F.coalesce(F.sum("_length").over(before), F.lit(0)).alias("_offset"))
    number = F.col("_offset") + F.col("_within") - 1 + F.lit(first)
    return counted.join(offsets, "_range").select(key, number.cast("bigint").alias("number"))
