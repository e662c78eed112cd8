"""The run log: an append-only table per layer and table of what every run did.

An attempt writes an entry before it touches its table and one when its rows are there.
Silver's entries name the ingestions of the batch; what waits is the difference of
bronze's log and silver's, so neither table is opened to find out.  An attempt without
an end broke off somewhere between its entries: whoever comes next looks once for its
rows, completes them if there are some, and writes the end.

Every addition is a folder of its own, so additions at the same time do not meet.
"""

import time
import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from retail_strata.operators.run_log import ABANDONED, FINISHED, INGESTION, STARTED, broken_off, of_state, outstanding
from retail_strata.schemas import RUN_LOG
from retail_strata.sources.literals import literal_rows
from retail_strata.sources.readers import path_exists
from retail_strata.sources.writers import append_parquet


class RunLog:
    """The log of one table of one layer."""

    def __init__(self, spark: SparkSession, layer: str, table: str):
        self.spark, self.path = spark, f"{layer}/run_log/{table}"

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def entries(self) -> DataFrame:
        """All entries; none before the first."""
        if not self.exists():
            return literal_rows(self.spark, RUN_LOG, [])
        return self.spark.read.schema(RUN_LOG).option("recursiveFileLookup", True).parquet(self.path)

    def broken_off(self) -> list[Row]:
        return broken_off(self.entries()).collect()

    def has_finished(self, run_id: str) -> bool:
        return not of_state(self.entries(), FINISHED).filter(F.col("run_id") == run_id).isEmpty()

    def add(self, attempt: str, run_id: str, state: str, ingestions: list[dict]) -> None:
        """One row per ingestion, all with the same attempt, run and state."""
        now = int(time.time() * 1_000_000)
        common = {"attempt": attempt, "run_id": run_id, "state": state, "logged_micros": now}
        rows = [[{**i, **common}.get(name) for name in RUN_LOG.fieldNames()] for i in ingestions]
        entry = literal_rows(self.spark, RUN_LOG, rows).coalesce(1)
        append_parquet(entry, f"{self.path}/entry-{uuid.uuid4().hex}")

    def start(self, run_id: str, ingestions: list[dict]) -> str:
        attempt = uuid.uuid4().hex
        self.add(attempt, run_id, STARTED, ingestions)
        return attempt

    def finish(self, attempt: str, run_id: str, ingestions: list[dict]) -> None:
        self.add(attempt, run_id, FINISHED, ingestions)

    def abandon(self, attempt: str, run_id: str, ingestions: list[dict]) -> None:
        self.add(attempt, run_id, ABANDONED, ingestions)


def ingestion_keys(entries: list[Row] | list[dict]) -> list[dict]:
    """Only what names an ingestion and tells where its rows lie."""
    names = [*INGESTION, "first_date", "last_date", "rows_read"]
    return [{name: entry[name] for name in names} for entry in entries]


def waiting(source: RunLog, target: RunLog) -> list[dict]:
    """The ingestions that the target has not taken, with the rows each brings.  One row
    per ingestion of the time since the last run comes to the driver."""
    found = outstanding(source.entries(), target.entries())
    found = found.withColumn("rows_read", F.col("rows_written")).select(*INGESTION, "first_date", "last_date", "rows_read")
    return ingestion_keys(found.distinct().collect())


def as_frame(spark: SparkSession, ingestions: list[dict]) -> DataFrame:
    schema = StructType([RUN_LOG[name] for name in INGESTION])
    return literal_rows(spark, schema, [[i[name] for name in INGESTION] for i in ingestions])


def days_of(ingestions: list[dict]) -> list[date]:
    """The partition dates their rows lie in."""
    days = set()
    for i in ingestions:
        length = (i["last_date"] - i["first_date"]).days
        days.update(i["first_date"] + timedelta(d) for d in range(length + 1))
    return sorted(days)


def adopt(spark: SparkSession, log: RunLog, table: DataFrame) -> None:
    """Write the log of a table that was filled before logs were kept: one pass over its
    stamps, once."""
    micros = F.unix_micros("ingestion_timestamp")
    found = table.groupBy("ingestion_id", "source_file").agg(
        F.min(micros).alias("first_micros"), F.max(micros).alias("last_micros"),
        F.min("ingestion_date").alias("first_date"), F.max("ingestion_date").alias("last_date"),
        F.count(F.lit(1)).alias("rows_written"),
    )
    for row in found.collect():
        log.finish(uuid.uuid4().hex, row.ingestion_id, [row.asDict()])
