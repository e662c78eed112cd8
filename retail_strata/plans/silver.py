"""Bronze -> silver: take what is new, refine it, append it, log it."""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from retail_strata.operators.checks import REASONS, reason_counts
from retail_strata.operators.incremental import batch_high_water_mark
from retail_strata.operators.lineage import count_rows, stamp_processing
from retail_strata.operators.run_log import STARTED, rows_of
from retail_strata.plans.bronze import StageResult, bronze_log
from retail_strata.plans.compaction import read_table
from retail_strata.plans.run_log import RunLog, as_frame, days_of, ingestion_keys, waiting
from retail_strata.plans.side_by_side import side_by_side
from retail_strata.plans.tables import ENTITIES, Entity, Layers
from retail_strata.sources.literals import literal_rows
from retail_strata.sources.readers import read_if_exists, read_parquet, written_by_stream
from retail_strata.sources.writers import append_parquet, overwrite_parquet, spread_for_write


def silver_log(spark: SparkSession, layers: Layers, entity: Entity) -> RunLog:
    """The table's run log, written first for a table that was filled without one: what
    its mark says it took."""
    log = RunLog(spark, layers.silver, entity.silver_table)
    if not log.exists():
        path = f"{layers.silver}/{entity.silver_table}"
        mark = batch_high_water_mark(read_if_exists(spark, path, entity.silver_schema))
        if mark is not None:
            taken = [i for i in waiting(bronze_log(spark, layers, entity.bronze_table), log) if i["last_micros"] <= mark]
            if taken:
                log.finish(log.start("adopted", taken), "adopted", taken)
    return log


def bronze_rows(spark: SparkSession, layers: Layers, entity: Entity, ingestions: list[dict]) -> DataFrame:
    """Bronze rows of the given ingestions; only the partitions of their dates are opened."""
    bronze = read_table(spark, f"{layers.bronze}/{entity.bronze_table}", entity.bronze_schema)
    ids = sorted({i["ingestion_id"] for i in ingestions})
    bronze = bronze.filter(F.col("ingestion_date").isin(days_of(ingestions)) & F.col("ingestion_id").isin(ids))
    return rows_of(bronze, as_frame(spark, ingestions))


def silver_batch(
    spark: SparkSession, layers: Layers, entity: Entity, run_id: str, ingestions: list[dict],
    stamp: Column | None = None, laid_out: bool = False,
) -> DataFrame:
    """The silver rows of a batch: the same ones whenever the batch is made again.
    ``laid_out`` brings them together for the write first, so that the stamps, which are
    the same in all rows, are not shuffled."""
    refined = entity.refine(bronze_rows(spark, layers, entity, ingestions))
    if laid_out:
        refined = spread_for_write(refined, entity.silver_partitions)
    bound = max(i["last_micros"] for i in ingestions)
    stamped = stamp_processing(refined, run_id, stamp)
    return stamped.withColumn("batch_mark", F.timestamp_micros(F.lit(bound)))


def _append(batch: DataFrame, path: str, entity: Entity, laid_out: bool = False) -> int:
    written = Observation(f"{entity.name} written")
    rows = batch if laid_out else spread_for_write(batch, entity.silver_partitions)
    append_parquet(count_rows(rows, written), path, by=entity.silver_partitions)
    return written.get["rows"]


def _complete(
    spark: SparkSession, layers: Layers, entity: Entity, log: RunLog, stamp: Column | None
) -> None:
    """End the attempts that broke off.  Their rows are looked for by the ingestions they
    took; what is missing of a batch that has landed in part is made again and appended."""
    broken: dict[str, list] = {}
    for entry in log.broken_off():
        broken.setdefault(entry.attempt, []).append(entry)
    path = f"{layers.silver}/{entity.silver_table}"
    for attempt, entries in broken.items():
        run_id, ingestions = entries[0].run_id, ingestion_keys(entries)
        silver = read_if_exists(spark, path, entity.silver_schema)
        landed = None if silver is None else rows_of(silver, as_frame(spark, ingestions))
        if landed is None or landed.isEmpty():
            log.abandon(attempt, run_id, ingestions)
            continue
        names = [f.name for f in entity.silver_schema.fields if f.name not in ("processing_timestamp", "processing_id")]
        # An empty partition value reads back as null.
        kinds = dict(silver_batch(spark, layers, entity, run_id, ingestions, stamp).dtypes)
        empty = {p: F.nullif(F.col(p), F.lit("")) for p in entity.silver_partitions if kinds[p] == "string"}
        whole = silver_batch(spark, layers, entity, run_id, ingestions, stamp).withColumns(empty).select(*names)
        missing = stamp_processing(whole.exceptAll(landed.select(*names)), run_id, stamp)
        there = landed.count()
        written = there + _append(missing, path, entity)
        log.finish(attempt, run_id, [{**i, "rows_written": written} for i in ingestions])


def _judged_batch(
    spark: SparkSession, layers: Layers, entity: Entity, run_id: str, ingestions: list[dict],
    stamp: Column | None, attempt: str,
) -> tuple[DataFrame, dict[str, int]]:
    """The silver rows of a batch by way of a table of all its rows, written in one pass
    with what each failed, and the counts by reason."""
    rows = entity.judge(bronze_rows(spark, layers, entity, ingestions))
    bound = max(i["last_micros"] for i in ingestions)
    rows = stamp_processing(rows, run_id, stamp).withColumn("batch_mark", F.timestamp_micros(F.lit(bound)))
    seen = Observation(f"{entity.name} judged")
    rows = rows.observe(seen, *reason_counts(entity.rules)).withColumn("rejected", F.size(REASONS) > 0)
    path = f"{layers.silver}/judged/{entity.silver_table}/attempt={attempt}"
    overwrite_parquet(rows, path, ("rejected",))
    accepted = read_parquet(spark, f"{path}/rejected=false", rows.drop("rejected").schema) if seen.get["accepted"] else (
        rows.limit(0).drop("rejected")
    )
    return accepted.select(*entity.silver_schema.fieldNames()), seen.get


def read_rejects(spark: SparkSession, layers: Layers, entity: Entity) -> DataFrame:
    """Rows that silver runs with ``keep_rejects`` left out, with what each failed."""
    log = RunLog(spark, layers.silver, entity.silver_table).entries()
    done = [r.attempt for r in log.filter(F.col("state") != STARTED).select("attempt").distinct().collect()]
    schema = StructType([*entity.silver_schema.fields])
    schema = schema.add(REASONS, ArrayType(StringType())).add("attempt", "string").add("rejected", "boolean")
    rows = read_if_exists(spark, f"{layers.silver}/judged/{entity.silver_table}", schema)
    rows = literal_rows(spark, schema, []) if rows is None else rows
    return rows.filter(F.col("rejected") & F.col("attempt").isin(done)).drop("rejected", "attempt")


def refine_entity(
    spark: SparkSession, layers: Layers, entity: Entity, run_id: str, stamp: Column | None = None,
    keep_rejects: bool = False,
) -> StageResult | None:
    """Refine the bronze ingestions that silver has not taken; None when there are none.

    What waits is told by the run logs of both layers: neither silver nor bronze's
    history is opened, and an ingestion counts as taken by its own key, whenever it was
    stamped and whenever it landed.  An attempt that broke off is completed first, under
    its own id.  One silver run a table at a time.

    If every new row is rejected, silver and its log stay as they are and the next run
    reads the same rows again.

    ``keep_rejects`` writes all rows of the batch once, with the checks each failed, and
    silver from those that failed none; the result then counts rows by reason, and rows
    read are rows written and rows rejected.
    """
    path = f"{layers.silver}/{entity.silver_table}"
    if written_by_stream(spark, path):
        raise ValueError(f"{path} is fed by a stream; go on with the stream")
    source, log = bronze_log(spark, layers, entity.bronze_table), silver_log(spark, layers, entity)
    if not source.exists():  # fails as any missing table does
        read_parquet(spark, f"{layers.bronze}/{entity.bronze_table}", entity.bronze_schema)
    if log.exists():
        _complete(spark, layers, entity, log, stamp)
    ingestions = waiting(source, log)
    if not ingestions:
        return None
    attempt = log.start(run_id, ingestions)
    counts: dict[str, int] = {}
    if keep_rejects:
        batch, counts = _judged_batch(spark, layers, entity, run_id, ingestions, stamp, attempt)
    else:
        batch = silver_batch(spark, layers, entity, run_id, ingestions, stamp, laid_out=True)
    written = _append(batch, path, entity, laid_out=not keep_rejects)
    end = log.finish if written else log.abandon
    end(attempt, run_id, [{**i, "rows_written": written} for i in ingestions])
    read = sum(i["rows_read"] for i in ingestions)
    rejected = {name: rows for name, rows in counts.items() if name.startswith("rejected")}
    return StageResult(entity.silver_table, path, {"read": read, "written": written, **rejected})


def refine_all(
    spark: SparkSession, layers: Layers, run_id: str, stamp: Column | None = None
) -> list[StageResult]:
    """All four entities; those without new rows are left out of the result."""

    def refine(entity: Entity) -> StageResult | None:
        return refine_entity(spark, layers, entity, run_id, stamp)

    results = side_by_side(spark, refine, ENTITIES)
    return [result for result in results if result is not None]


def read_silver(spark: SparkSession, layers: Layers) -> dict[str, DataFrame]:
    return {
        e.silver_table: read_table(spark, f"{layers.silver}/{e.silver_table}", e.silver_schema) for e in ENTITIES
    }
