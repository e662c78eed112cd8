"""High-water mark: which bronze rows silver has not seen."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest_stamp(df: DataFrame, column: str = "ingestion_timestamp") -> DataFrame:
    """One row with the newest stamp; null for an empty table."""
    return df.agg(F.max(column).alias("mark"))


def batch_high_water_mark(silver: DataFrame | None) -> int | None:
    """Newest bronze stamp of the batches silver has taken, in microseconds, or None.

    A batch's bound stands in each of its rows: rows that lost a deduplication or were
    rejected count as taken, though none of their own stamps is in silver.  Rows of a
    table written before the bound was kept have their own stamp.
    """
    if silver is None:
        return None
    bound = F.coalesce("batch_mark", "ingestion_timestamp")
    return high_water_mark(silver.select(bound.alias("batch_mark")), "batch_mark")


def high_water_mark(silver: DataFrame | None, column: str = "ingestion_timestamp") -> int | None:
    """Newest bronze stamp carried in silver, in microseconds since 1970, or None.

    Bronze's own stamp is used rather than silver's: a bronze append that lands
    while silver runs is stamped before silver is, and would be skipped for ever.
    Microseconds rather than a Python datetime, which is ambiguous at the end of
    daylight saving time.  The scan reads one column that is constant within a
    run, so it costs file footers and a few dictionary pages.
    """
    if silver is None:
        return None
    micros = newest_stamp(silver, column).select(F.unix_micros(F.col("mark").cast("timestamp")))
    return micros.first()[0]


def newer_than(bronze: DataFrame, mark: int | None, column: str = "ingestion_timestamp") -> DataFrame:
    """Rows strictly newer than the mark; all rows when there is none.

    The date predicate skips whole partitions before any file is opened.  It is
    two days wider than the mark because each run dated its rows in its own
    session's time zone, and zones lie up to 26 hours apart.
    """
    if mark is None:
        return bronze
    moment = F.timestamp_micros(F.lit(mark))
    fresh = F.col(column) > moment
    if "ingestion_date" in bronze.columns:
        fresh = fresh & (F.col("ingestion_date") >= F.date_sub(moment.cast("date"), 2))
    return bronze.filter(fresh)
