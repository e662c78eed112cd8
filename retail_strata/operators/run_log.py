"""What the run logs of two layers say: which ingestions wait, which attempts broke off.

An ingestion is known by its id, its file and its first and last stamp, so the order in
which ingestions are stamped, land and are taken does not matter.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INGESTION = ["ingestion_id", "source_file", "first_micros", "last_micros"]
STARTED, FINISHED, ABANDONED = "started", "finished", "abandoned"


def of_state(log: DataFrame, state: str) -> DataFrame:
    return log.filter(F.col("state") == state)


def outstanding(source_log: DataFrame, target_log: DataFrame) -> DataFrame:
    """Ingestions that ended with rows in the source layer and that no ended run of the
    target layer took."""
    landed = of_state(source_log, FINISHED).filter("rows_written > 0")
    return landed.join(of_state(target_log, FINISHED), INGESTION, "left_anti")


def broken_off(log: DataFrame) -> DataFrame:
    """Entries of attempts that started and did not end."""
    ended = log.filter(F.col("state") != STARTED).select("attempt")
    return of_state(log, STARTED).join(ended, "attempt", "left_anti")


def rows_of(table: DataFrame, ingestions: DataFrame) -> DataFrame:
    """The rows of ``table`` that came with the given ingestions."""
    key = ingestions.select(*[F.col(c).alias(f"_{c}") for c in INGESTION])
    micros = F.unix_micros("ingestion_timestamp")
    same = (
        (F.col("ingestion_id") == F.col("_ingestion_id")) & (F.col("source_file") == F.col("_source_file"))
        & micros.between(F.col("_first_micros"), F.col("_last_micros"))
    )
    return table.join(key, same, "left_semi")
