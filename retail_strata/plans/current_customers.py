"""The newest version of every customer, kept up to date batch by batch.

Customers are dealt to a fixed number of parts by a hash of their id.  A silver batch is
merged into the parts it touches; the other parts are neither read nor written.  As the
newest version wins whatever the order, a batch that is merged twice changes nothing.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_strata.operators.cleanse import latest_customers
from retail_strata.plans.gold_increments import rows_of_batch, silver_batches
from retail_strata.plans.tables import CUSTOMERS, Layers
from retail_strata.sources.versions import VersionedTable

TABLE = "customers_current"


def _table(spark: SparkSession, layers: Layers) -> VersionedTable:
    return VersionedTable(spark, f"{layers.gold}/{TABLE}", CUSTOMERS.silver_schema)


def merge_customers(spark: SparkSession, layers: Layers, parts: int = 64) -> dict[str, list[int]]:
    """Merge the silver batches that are not in yet; the parts each of them changed.
    ``parts`` is a property of the table: give the same number every time."""
    table, changed = _table(spark, layers), {}
    done = table.batches()
    number = F.pmod(F.xxhash64("customer_id"), F.lit(parts)).cast("int")
    for attempt, batch in silver_batches(spark, layers, CUSTOMERS).items():
        if attempt in done:
            continue
        fresh = rows_of_batch(spark, layers, CUSTOMERS, batch)
        touched = sorted(r[0] for r in fresh.select(number).distinct().collect())
        merged = latest_customers(table.read(touched).unionByName(fresh)).withColumn("_part", number)
        spread = merged.repartition(F.col("_part"))
        table.replace(spread, "_part", touched, attempt)
        changed[attempt] = touched
    return changed


def current_customers(spark: SparkSession, layers: Layers) -> DataFrame:
    return _table(spark, layers).read()
