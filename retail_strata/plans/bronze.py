"""Raw files -> bronze: read, stamp, append, log."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from retail_strata.operators.lineage import observe_ingestion, stamp_ingestion
from retail_strata.plans.compaction import read_table
from retail_strata.plans.run_log import RunLog, adopt
from retail_strata.plans.side_by_side import side_by_side
from retail_strata.plans.tables import ENTITIES, Entity, Layers
from retail_strata.schemas import INGESTION_STAMPS
from retail_strata.sources.readers import RAW_RECORD, READERS, read_if_exists, read_parquet
from retail_strata.sources.writers import append_parquet


@dataclass(frozen=True)
class StageResult:
    """What one stage did to one table; ``rows`` counts by name."""

    table: str
    path: str
    rows: dict[str, int]


def bronze_log(spark: SparkSession, layers: Layers, table: str) -> RunLog:
    """The table's run log, written first for a table that was filled without one."""
    log = RunLog(spark, layers.bronze, table)
    if not log.exists():
        filled = read_if_exists(spark, f"{layers.bronze}/{table}", INGESTION_STAMPS)
        if filled is not None:
            adopt(spark, log, filled)
    return log


def ingest_file(
    spark: SparkSession, layers: Layers, raw_format: str, source_file: str, table: str,
    run_id: str, schema: StructType | None = None, stamp: Column | None = None,
) -> StageResult:
    """Append one raw file to a bronze table, partitioned by ingestion date; earlier
    runs stay.  ``raw_format`` is json, csv or parquet; without a schema it is inferred.
    With one, records that it does not hold in full stay as text in ``raw_record``.

    One pass and no shuffle: the rows are counted while they are written.  A run
    has one ingestion date, so every task writes to one partition folder.  Silver takes
    the rows once their end is in the run log.
    """
    raw = READERS[raw_format](spark, f"{layers.raw}/{source_file}", schema)
    path, log = f"{layers.bronze}/{table}", bronze_log(spark, layers, table)
    attempt = log.start(run_id, [{"ingestion_id": run_id, "source_file": source_file}])
    written = append_stamped(stamp_ingestion(raw, run_id, source_file, stamp), path)
    log.finish(attempt, run_id, [{"ingestion_id": run_id, "source_file": source_file, **written}])
    return StageResult(table, path, {"written": written["rows_written"]})


def append_stamped(stamped: DataFrame, path: str) -> dict:
    """Append to bronze; the rows written with their first and last stamps and dates."""
    seen = Observation(f"{path} written")
    append_parquet(observe_ingestion(stamped, seen), path, by=("ingestion_date",))
    return seen.get


def resume_ingestion(
    spark: SparkSession, layers: Layers, entity: Entity, run_id: str, attempt: str
) -> StageResult | None:
    """Complete an ingestion that broke off: append the raw records that are not there
    yet, if some are, and write its end.  None when nothing of it had landed."""
    path, log = f"{layers.bronze}/{entity.bronze_table}", RunLog(spark, layers.bronze, entity.bronze_table)
    named = {"ingestion_id": run_id, "source_file": entity.raw_file}
    raw = READERS[entity.raw_format](spark, f"{layers.raw}/{entity.raw_file}", entity.raw_schema)
    schema = StructType([*raw.schema.fields, *INGESTION_STAMPS.fields])
    table = read_if_exists(spark, path, schema)
    landed = None if table is None else table.filter(
        (F.col("ingestion_id") == run_id) & (F.col("source_file") == entity.raw_file)
    )
    if landed is None or landed.isEmpty():
        log.abandon(attempt, run_id, [named])
        return None
    micros = landed.agg(F.max(F.unix_micros("ingestion_timestamp"))).first()[0]
    missing = raw.exceptAll(landed.select(*raw.columns))
    added = append_stamped(stamp_ingestion(missing, run_id, entity.raw_file, F.timestamp_micros(F.lit(micros))), path)
    whole = Observation(f"{path} of {run_id}")
    observe_ingestion(read_parquet(spark, path, schema).filter(
        (F.col("ingestion_id") == run_id) & (F.col("source_file") == entity.raw_file)
    ), whole).write.format("noop").mode("overwrite").save()
    log.finish(attempt, run_id, [{**named, **whole.get}])
    return StageResult(entity.bronze_table, path, {"written": added["rows_written"]})


def ingest_all(
    spark: SparkSession, layers: Layers, run_id: str, stamp: Column | None = None
) -> list[StageResult]:
    """Customers, products, sales and payments.

    If one fails, the others are still appended.  A table whose log has the run's end is
    left as it is and one it broke off in is completed, so repeating the ingestion under
    its ``run_id`` completes it and takes nothing twice.
    """

    def ingest(e: Entity) -> StageResult:
        path = f"{layers.bronze}/{e.bronze_table}"
        log = bronze_log(spark, layers, e.bronze_table)
        if log.exists():
            if log.has_finished(run_id):
                return StageResult(e.bronze_table, path, {"written": 0})
            for broken in log.broken_off():
                if broken.run_id == run_id:
                    done = resume_ingestion(spark, layers, e, run_id, broken.attempt)
                    if done is not None:
                        return done
        return ingest_file(
            spark, layers, e.raw_format, e.raw_file, e.bronze_table, run_id, e.raw_schema, stamp
        )

    return side_by_side(spark, ingest, ENTITIES)


def read_bronze(spark: SparkSession, layers: Layers) -> dict[str, DataFrame]:
    return {
        e.bronze_table: read_table(spark, f"{layers.bronze}/{e.bronze_table}", e.bronze_schema) for e in ENTITIES
    }


def read_unheld(spark: SparkSession, layers: Layers, entity: Entity) -> DataFrame:
    """Bronze rows whose typed columns do not hold the whole raw record, with its text."""
    schema = StructType(list(entity.bronze_schema.fields)).add(RAW_RECORD, "string")
    rows = read_parquet(spark, f"{layers.bronze}/{entity.bronze_table}", schema)
    return rows.filter(F.col(RAW_RECORD).isNotNull())
