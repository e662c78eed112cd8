"""The whole run: optional feeds, bronze, silver, gold, report."""

import warnings
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_strata.operators.reports import ingestion_report, row_counts
from retail_strata.plans.bronze import StageResult, ingest_all
from retail_strata.plans.feeds import write_feeds
from retail_strata.plans.gold import aggregate_all
from retail_strata.plans.silver import refine_all
from retail_strata.plans.tables import ENTITIES, GOLD_SCHEMAS, Layers
from retail_strata.sources.readers import read_if_exists


def new_run_id() -> str:
    """Start time of the run, to the microsecond so that two runs rarely share one."""
    return datetime.now(UTC).strftime("%Y%m%d_%H%M%S_%f")


def existing_tables(spark: SparkSession, layers: Layers) -> dict[str, dict[str, DataFrame]]:
    """The tables of each layer that are there already."""
    paths = {
        "bronze": {e.bronze_table: (layers.bronze, e.bronze_schema) for e in ENTITIES},
        "silver": {e.silver_table: (layers.silver, e.silver_schema) for e in ENTITIES},
        "gold": {table: (layers.gold, schema) for table, schema in GOLD_SCHEMAS.items()},
    }
    found = {
        layer: {t: read_if_exists(spark, f"{root}/{t}", schema) for t, (root, schema) in tables.items()}
        for layer, tables in paths.items()
    }
    return {layer: {t: df for t, df in tables.items() if df is not None} for layer, tables in found.items()}


def layer_report(spark: SparkSession, layers: Layers) -> DataFrame | None:
    """Rows per table of every layer; None before the first run."""
    parts = [
        row_counts(tables).select(F.lit(layer).alias("layer"), "table_name", "row_count")
        for layer, tables in existing_tables(spark, layers).items()
        if tables
    ]
    if not parts:
        return None
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def bronze_report(spark: SparkSession, layers: Layers) -> DataFrame | None:
    """Rows and ingestion runs per bronze table; None before the first run."""
    tables = existing_tables(spark, layers)["bronze"]
    return ingestion_report(tables) if tables else None


@dataclass(frozen=True)
class RunResult:
    run_id: str
    stages: list[StageResult]
    report: DataFrame | None


def run_all(
    spark: SparkSession, layers: Layers, run_id: str | None = None,
    regenerate: bool = False, dedup_scope: str = "batch",
) -> RunResult:
    """Every stage in order.  An exception in a stage ends the run there and carries its
    id in a note: repeated under that ``run_id``, the run goes on where it ended and takes
    nothing twice.  A failing report only warns.  ``regenerate`` writes new raw customers,
    products and sales."""
    run_id = run_id or new_run_id()
    if regenerate:
        write_feeds(spark, layers)
    try:
        stages = ingest_all(spark, layers, run_id)
        stages += refine_all(spark, layers, run_id)
        stages += aggregate_all(spark, layers, dedup_scope)
    except Exception as error:
        error.add_note(f"to complete this run, repeat it with run_id={run_id!r}")
        raise
    try:
        report = layer_report(spark, layers)
    except PySparkException as error:
        warnings.warn(f"no report: {error}", stacklevel=2)
        report = None
    return RunResult(run_id, stages, report)
