"""Customers as a file stream: the newest row per customer and ingestion window.

The state store holds one row per customer of the windows that are still open; a window
is given out, once and whole, when the watermark has passed its end.  Deduplication comes
before the checks, as in the batch job.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from retail_strata.operators.checks import passed
from retail_strata.operators.cleanse import CUSTOMER_RULES, NEWEST_BY, clean_customers
from retail_strata.operators.lineage import stamp_processing
from retail_strata.plans.tables import CUSTOMERS, Layers
from retail_strata.sources.readers import path_exists, written_by_stream


def newest_in_window(raw: DataFrame, window: str, delay: str) -> DataFrame:
    """The customers of every ingestion window.  Ties are broken as in the batch job: by
    the columns that say what is newest and then by all others, null below any value."""
    cleaned = clean_customers(raw)
    newest_by = [c for c in NEWEST_BY if c in cleaned.columns]
    order = [*newest_by, *[c for c in cleaned.columns if c not in newest_by and c != "customer_id"]]
    newest = F.max_by(F.struct(*cleaned.columns), F.struct(*order)).alias("newest")
    grouped = cleaned.withWatermark("ingestion_timestamp", delay).groupBy(
        F.window("ingestion_timestamp", window).alias("ingested"), "customer_id"
    ).agg(newest)
    return grouped.select("newest.*", F.col("ingested.end").alias("batch_mark")).filter(passed(CUSTOMER_RULES))


def start_customer_stream(
    spark: SparkSession, layers: Layers, run_id: str, checkpoint: str, window: str = "1 hour",
    delay: str = "10 minutes", files_per_batch: int | None = None,
) -> StreamingQuery:
    """Refine the bronze files not seen yet, append the windows that are over to silver,
    and stop.

    Where the batch job takes what came since its last run, the stream takes what was
    ingested in one ``window``.  A window is over once a row is ``delay`` newer than its
    end, so the last one waits in the state store for the next ingestion.  Rows stamped
    that much before the newest one already seen are late and left out; the batch job
    takes them.
    """
    path = f"{layers.silver}/{CUSTOMERS.silver_table}"
    if path_exists(spark, path) and not written_by_stream(spark, path):
        raise ValueError(f"{path} holds batch appends, which a stream would hide; use refine_entity")
    reader = spark.readStream.schema(CUSTOMERS.bronze_schema).option("maxFileAge", "36500d")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    fresh = reader.parquet(f"{layers.bronze}/{CUSTOMERS.bronze_table}")
    refined = stamp_processing(newest_in_window(fresh, window, delay), run_id)
    return (
        refined.select(*CUSTOMERS.silver_schema.fieldNames())
        .writeStream.outputMode("append")
        .partitionBy(*CUSTOMERS.silver_partitions)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
