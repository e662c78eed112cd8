"""Stamps that say where and when a row came from, and row counters."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def stamp_ingestion(
    raw: DataFrame, run_id: str, source: str, stamp: Column | None = None
) -> DataFrame:
    """Add the lineage columns of bronze.  ``stamp`` defaults to the time of the query."""
    moment = F.current_timestamp() if stamp is None else stamp
    return raw.withColumns({
        "ingestion_timestamp": moment,
        "ingestion_id": F.lit(run_id),
        "source_file": F.lit(source),
        "ingestion_date": moment.cast("date"),
    })


def stamp_processing(
    df: DataFrame, run_id: str | None = None, stamp: Column | None = None
) -> DataFrame:
    """Add the time, and for silver also the id, of the processing run."""
    added = {"processing_timestamp": F.current_timestamp() if stamp is None else stamp}
    if run_id is not None:
        added["processing_id"] = F.lit(run_id)
    return df.withColumns(added)


def count_rows(df: DataFrame, counter: Observation) -> DataFrame:
    """Count the rows that pass here, in the pass that does the work.

    Put it last before the write.  There the count is exact: tasks of the last
    stage are counted once, while map tasks run again after an executor loss are
    counted again.  It is nearly free there too, but further down it breaks
    the generated code in two and has every row copied.
    """
    return df.observe(counter, F.count(F.lit(1)).alias("rows"))


def observe_ingestion(stamped: DataFrame, seen: Observation) -> DataFrame:
    """Count the rows that are written and note their first and last stamps and dates."""
    micros = F.unix_micros("ingestion_timestamp")
    return stamped.observe(
        seen, F.count(F.lit(1)).alias("rows_written"),
        F.min(micros).alias("first_micros"), F.max(micros).alias("last_micros"),
        F.min("ingestion_date").alias("first_date"), F.max("ingestion_date").alias("last_date"),
    )
