"""Silver -> gold by increments: the states of each silver batch, and their merge.

``fold_batches`` reads the rows of the silver batches that have no state yet, and no
others; ``incremental_gold`` merges the states of all batches, which hold one row per
key and batch.  A batch's states lie in a folder of their own, named after the silver
attempt, and count once the run log of the gold layer has them: a fold that broke off is
simply made again.
"""

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_strata.operators.business import OFFER, PROFILE
from retail_strata.operators.hot_keys import SLICE, find_hot_keys, left_join_unique, slices_of
from retail_strata.operators.partials import (
    PAYMENTS_BY_METHOD, SALES_BY_CUSTOMER, SALES_BY_MONTH, SALES_BY_PRODUCT, buyers_of_month, merged_summary,
)
from retail_strata.operators.run_log import FINISHED, STARTED, of_state, rows_of
from retail_strata.plans.compaction import read_table
from retail_strata.plans.run_log import RunLog, as_frame, ingestion_keys
from retail_strata.plans.side_by_side import side_by_side
from retail_strata.plans.silver import silver_log
from retail_strata.plans.tables import CUSTOMERS, ENTITIES, GOLD_SCHEMAS, PAYMENTS, PRODUCTS, SALES, Entity, Layers
from retail_strata.sources.writers import overwrite_parquet

SUMMARY, METRICS, PERFORMANCE, PAYMENT_ANALYSIS = GOLD_SCHEMAS

#: What each batch of an entity leaves behind.
STATES: dict[str, dict[str, Callable[[DataFrame], DataFrame]]] = {
    SALES.name: {
        "sales_by_month": SALES_BY_MONTH.of_batch,
        "buyers_of_month": buyers_of_month,
        "sales_by_customer": SALES_BY_CUSTOMER.of_batch,
        "sales_by_product": SALES_BY_PRODUCT.of_batch,
    },
    CUSTOMERS.name: {"profiles": lambda customers: customers.select(*PROFILE)},
    PRODUCTS.name: {"offers": lambda products: products.select(*OFFER)},
    PAYMENTS.name: {"payments_by_method": PAYMENTS_BY_METHOD.of_batch},
}
HOUR = 3600 * 1_000_000


def silver_batches(spark: SparkSession, layers: Layers, entity: Entity) -> dict[str, list[dict]]:
    """The ingestions of every finished silver attempt, and when it started."""
    log = silver_log(spark, layers, entity).entries()
    begun = {r.attempt: r.logged_micros for r in of_state(log, STARTED).collect()}
    batches: dict[str, list[dict]] = {}
    for entry in of_state(log, FINISHED).collect():
        started = begun.get(entry.attempt, 0)
        batches.setdefault(entry.attempt, []).append({**entry.asDict(), "started_micros": started})
    return batches


def rows_of_batch(spark: SparkSession, layers: Layers, entity: Entity, batch: list[dict]) -> DataFrame:
    """Silver rows of one batch.  Files written before the batch began are not opened;
    where that does not give the rows the log counted, as after a copy of the table or
    an adoption, all are."""
    since = max(min(i["started_micros"] for i in batch) - HOUR, 0) // 1_000_000
    moment = datetime.fromtimestamp(since, UTC).strftime("%Y-%m-%dT%H:%M:%S")
    path, reader = f"{layers.silver}/{entity.silver_table}", spark.read.schema(entity.silver_schema)
    keys = as_frame(spark, ingestion_keys(batch))
    # The stamps as constants, too: row groups of other batches are passed over by their statistics.
    first, last = min(i["first_micros"] for i in batch), max(i["last_micros"] for i in batch)
    stamps = F.col("ingestion_timestamp").between(*[F.timestamp_micros(F.lit(micros)) for micros in (first, last)])
    taken = stamps & F.col("ingestion_id").isin(sorted({i["ingestion_id"] for i in batch}))
    recent = reader.option("modifiedAfter", moment).option("timeZone", "UTC").parquet(path)
    rows = rows_of(recent.filter(taken), keys)
    if rows.count() != batch[0]["rows_written"]:
        rows = rows_of(read_table(spark, path, entity.silver_schema).filter(taken), keys)
    return rows


def fold_entity(spark: SparkSession, layers: Layers, entity: Entity) -> int:
    """States of the batches that have none; how many there were."""
    log = RunLog(spark, layers.gold, f"states_{entity.name}")
    done = {r.attempt for r in of_state(log.entries(), FINISHED).select("attempt").distinct().collect()}
    fresh = {a: b for a, b in silver_batches(spark, layers, entity).items() if a not in done}
    for attempt, batch in fresh.items():
        rows = rows_of_batch(spark, layers, entity, batch)

        def write(name: str) -> None:
            overwrite_parquet(STATES[entity.name][name](rows), f"{layers.gold}/states/{name}/batch={attempt}")

        side_by_side(spark, write, STATES[entity.name])
        log.finish(attempt, batch[0]["run_id"], batch)
    return len(fresh)


def fold_batches(spark: SparkSession, layers: Layers) -> dict[str, int]:
    """States of all new silver batches; the number of batches by entity."""
    folded = side_by_side(spark, lambda entity: fold_entity(spark, layers, entity), ENTITIES)
    return {entity.name: batches for entity, batches in zip(ENTITIES, folded)}


def read_states(spark: SparkSession, layers: Layers, entity: Entity, name: str) -> DataFrame:
    """The states of the batches that the log has."""
    log = RunLog(spark, layers.gold, f"states_{entity.name}")
    done = [r.attempt for r in of_state(log.entries(), FINISHED).select("attempt").distinct().collect()]
    # The schema follows from what makes the state; no file is opened to learn it.
    empty = spark.createDataFrame([], entity.silver_schema)
    schema = STATES[entity.name][name](empty).schema
    if not done:
        return spark.createDataFrame([], schema)
    paths = [f"{layers.gold}/states/{name}/batch={attempt}" for attempt in sorted(done)]
    return spark.read.schema(schema).parquet(*paths)


def incremental_gold(spark: SparkSession, layers: Layers, table: str) -> DataFrame:
    """One gold table from states; equal to ``build_table`` over the same batches."""

    def states(entity: Entity, name: str) -> DataFrame:
        return read_states(spark, layers, entity, name)

    if table == SUMMARY:
        return merged_summary(states(SALES, "sales_by_month"), states(SALES, "buyers_of_month"))
    if table == METRICS:
        spending = SALES_BY_CUSTOMER.merged(states(SALES, "sales_by_customer"))
        return states(CUSTOMERS, "profiles").join(spending, "customer_id", "left")
    if table == PERFORMANCE:
        offers, slices = states(PRODUCTS, "offers"), slices_of(states(PRODUCTS, "offers"))
        hot = find_hot_keys(offers, "product_id", slices)
        turnover = SALES_BY_PRODUCT.merged(states(SALES, "sales_by_product"))
        return left_join_unique(offers, turnover, "product_id", hot, slices).drop(SLICE)
    if table == PAYMENT_ANALYSIS:
        merged = PAYMENTS_BY_METHOD.merged(states(PAYMENTS, "payments_by_method"))
        return merged.sort(PAYMENTS_BY_METHOD.keys)
    raise ValueError(f"no gold table {table!r}")
