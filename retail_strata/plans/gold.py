"""Silver -> gold: recompute the business tables, all four or some of them."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from retail_strata.operators import business
from retail_strata.operators.cleanse import latest_customers
from retail_strata.operators.lineage import count_rows, stamp_processing
from retail_strata.plans.bronze import StageResult
from retail_strata.plans.compaction import read_table
from retail_strata.plans.side_by_side import side_by_side
from retail_strata.plans.tables import CUSTOMERS, GOLD_SCHEMAS, PAYMENTS, PRODUCTS, SALES, Entity, Layers
from retail_strata.sources.writers import overwrite_parquet, spread_for_write

SUMMARY, METRICS, PERFORMANCE, PAYMENT_ANALYSIS = GOLD_SCHEMAS
PARTITIONS = {SUMMARY: (), METRICS: ("state",), PERFORMANCE: ("category",), PAYMENT_ANALYSIS: ()}


def build_table(spark: SparkSession, layers: Layers, table: str, dedup_scope: str = "batch") -> DataFrame:
    """One gold table from the silver tables it needs.

    Silver may hold a customer once per run.  ``dedup_scope="batch"`` keeps one
    gold row for each of them; ``"table"`` keeps the newest version only.
    """
    if dedup_scope not in ("batch", "table"):
        raise ValueError(f"dedup_scope is 'batch' or 'table', not {dedup_scope!r}")

    def silver(entity: Entity) -> DataFrame:
        return read_table(spark, f"{layers.silver}/{entity.silver_table}", entity.silver_schema)

    if table == SUMMARY:
        return business.sales_summary(silver(SALES))
    if table == METRICS:
        customers = silver(CUSTOMERS)
        if dedup_scope == "table":
            customers = latest_customers(customers)
        return business.customer_metrics(customers, silver(SALES))
    if table == PERFORMANCE:
        return business.product_performance(silver(PRODUCTS), silver(SALES), ranked=False)
    if table == PAYMENT_ANALYSIS:
        return business.payment_analysis(silver(PAYMENTS))
    raise ValueError(f"no gold table {table!r}")


def build_gold(
    spark: SparkSession, layers: Layers, dedup_scope: str = "batch", tables: Iterable[str] = tuple(GOLD_SCHEMAS)
) -> dict[str, tuple[DataFrame, tuple[str, ...]]]:
    """Each gold table, or those named, with its partition columns."""
    return {table: (build_table(spark, layers, table, dedup_scope), PARTITIONS[table]) for table in tables}


def aggregate_all(
    spark: SparkSession, layers: Layers, dedup_scope: str = "batch", stamp: Column | None = None,
    tables: Iterable[str] = tuple(GOLD_SCHEMAS),
) -> list[StageResult]:
    """Overwrite the gold tables, or those named.  The partitioned ones are not sorted
    before the write, which would not keep the order; sort when reading."""
    frames = build_gold(spark, layers, dedup_scope, tables)

    def overwrite(table: str) -> StageResult:
        frame, by = frames[table]
        path, written = f"{layers.gold}/{table}", Observation(f"{table} written")
        stamped = stamp_processing(spread_for_write(frame, by) if by else frame, stamp=stamp)
        overwrite_parquet(count_rows(stamped, written), path, by)
        return StageResult(table, path, {"written": written.get["rows"]})

    return side_by_side(spark, overwrite, frames)


def read_gold(spark: SparkSession, layers: Layers) -> dict[str, DataFrame]:
    return {
        table: spark.read.schema(schema).parquet(f"{layers.gold}/{table}")
        for table, schema in GOLD_SCHEMAS.items()
    }
