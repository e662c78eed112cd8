"""Left join that survives a key holding a large share of the left side."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE = "_slice"


def slices_of(df: DataFrame) -> int:
    """As many as the session has shuffle partitions, which grow with its data."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def find_hot_keys(df: DataFrame, key: str, slices: int) -> list:
    """Keys with more than ``1/slices`` of all rows, so fewer than ``slices`` of them,
    at any size of the table."""
    total = df.count()
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    heavy = counts.filter(F.col("rows") * slices > total)
    return [row[0] for row in heavy.select(key).collect()]


def _is_hot(key: str, hot: list) -> Column:
    """Written so that it is the same in both ANSI modes, where null IN () differs."""
    named = F.coalesce(F.col(key).isin([k for k in hot if k is not None]), F.lit(False))
    return named | (F.col(key).isNull() & F.lit(None in hot))


def left_join_unique(
    left: DataFrame, right: DataFrame, key: str, hot: list, slices: int
) -> DataFrame:
    """``left`` LEFT JOIN ``right``, where ``right`` has one row per key.

    Rows of hot keys are dealt over ``slices`` tasks, and the few right rows of
    those keys are repeated once per slice; every other row keeps slice 0.  Null
    keys match nothing but are dealt out too.  Rows are dealt in reading order,
    which a re-run of a task over the same input split repeats.  The slice stays
    in the result as ``_slice``, as a tie-break for sorting copies of one row.
    """
    if not hot:
        return left.join(right, key, "left").withColumn(SLICE, F.lit(0).cast("bigint"))
    dealt = F.monotonically_increasing_id() % slices
    every_slice = F.sequence(F.lit(0).cast("bigint"), F.lit(slices - 1).cast("bigint"))
    first_slice = F.array(F.lit(0).cast("bigint"))
    sliced_left = left.withColumn(SLICE, F.when(_is_hot(key, hot), dealt).otherwise(F.lit(0)))
    sliced_right = right.withColumn(
        SLICE, F.explode(F.when(_is_hot(key, hot), every_slice).otherwise(first_slice))
    )
    return sliced_left.join(sliced_right, [key, SLICE], "left")
