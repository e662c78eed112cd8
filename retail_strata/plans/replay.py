"""Records that bronze kept as text, repaired and ingested again, once each.

A record is known by a hash of its text, ingestion and file, which its repaired row
carries in bronze: a record that was replayed before is passed over, whatever run,
repair or retry comes with it.  Only records that silver's checks reject as they stand
are replayed, as the others are in silver already.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from retail_strata.functions import quoted
from retail_strata.operators.checks import OLDER, REASONS
from retail_strata.operators.lineage import stamp_ingestion
from retail_strata.plans.bronze import StageResult, append_stamped, bronze_log, read_unheld
from retail_strata.plans.tables import Entity, Layers
from retail_strata.sources.readers import RAW_RECORD, read_parquet

RECORD = "record_hash"
SOURCE = "replay"


def unheld_records(spark: SparkSession, layers: Layers, entity: Entity) -> DataFrame:
    """Kept records that fail silver's checks and were not replayed, with their hash."""
    kept = read_unheld(spark, layers, entity).filter(F.col("source_file") != SOURCE)
    record = F.sha2(F.to_json(F.struct("ingestion_id", "source_file", RAW_RECORD)), 256)
    failing = F.size(F.array_remove(REASONS, OLDER)) > 0
    marked = entity.judge(kept.withColumn(RECORD, record)).filter(failing)
    bronze = StructType([*entity.bronze_schema.fields, StructField(RECORD, StringType())])
    done = read_parquet(spark, f"{layers.bronze}/{entity.bronze_table}", bronze)
    done = done.filter((F.col("source_file") == SOURCE) & F.col(RECORD).isNotNull()).select(RECORD)
    return marked.join(done, RECORD, "left_anti").select(RECORD, RAW_RECORD, "ingestion_id", "source_file")


def replay_unheld(
    spark: SparkSession, layers: Layers, entity: Entity, repair: Callable[[DataFrame], DataFrame], run_id: str,
    stamp: Column | None = None,
) -> StageResult | None:
    """Append what ``repair`` makes of the waiting records: it is given their text as
    ``raw_record`` and returns the raw columns beside ``record_hash``, without the records
    it cannot repair.  None where no record waits.  The next silver run takes the rows."""
    waiting = unheld_records(spark, layers, entity)
    repaired = repair(waiting)
    raw = repaired.select(*[F.col(quoted(f.name)).cast(f.dataType) for f in entity.raw_schema.fields], RECORD)
    if raw.isEmpty():
        return None
    path, log = f"{layers.bronze}/{entity.bronze_table}", bronze_log(spark, layers, entity.bronze_table)
    named = {"ingestion_id": run_id, "source_file": SOURCE}
    attempt = log.start(run_id, [named])
    written = append_stamped(stamp_ingestion(raw, run_id, SOURCE, stamp), path)
    log.finish(attempt, run_id, [{**named, **written}])
    return StageResult(entity.bronze_table, path, {"written": written["rows_written"]})


def repaired_json(text: Column, entity: Entity) -> Callable[[DataFrame], DataFrame]:
    """A repair that corrects the text and parses it as JSON; a record that still does not
    parse whole goes on waiting."""
    broken = "_still_broken"
    schema = StructType([*entity.raw_schema.fields, StructField(broken, StringType())])

    def repair(records: DataFrame) -> DataFrame:
        row = F.from_json(text, schema, {"columnNameOfCorruptRecord": broken})
        return records.select(RECORD, row.alias("r")).select(RECORD, "r.*").filter(F.col(broken).isNull()).drop(broken)

    return repair
