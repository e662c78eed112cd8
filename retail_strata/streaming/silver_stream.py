"""Bronze -> silver as a file stream.

The checkpoint remembers which bronze files were read, so the stream needs no
high-water mark, takes files that land late, and does not read a file twice.
"""

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from retail_strata.operators.lineage import stamp_processing
from retail_strata.plans.tables import CUSTOMERS, Entity, Layers
from retail_strata.sources.readers import path_exists, written_by_stream
from retail_strata.sources.writers import spread_for_write


def start_silver_stream(
    spark: SparkSession, layers: Layers, entity: Entity, run_id: str, checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Refine the bronze files not seen yet, append them to silver, and stop.

    For products, sales and payments, into a table no batch job writes.  Customers need the newest row per key of
    a whole batch, which a stream does not offer: use the batch job for them.
    ``files_per_batch`` bounds the size of a micro-batch, and so what is lost
    when one has to be run again.
    """
    if entity is CUSTOMERS:
        raise ValueError("customers are deduplicated: use refine_entity")
    path = f"{layers.silver}/{entity.silver_table}"
    if path_exists(spark, path) and not written_by_stream(spark, path):
        raise ValueError(f"{path} holds batch appends, which a stream would hide; use refine_entity")
    # Files are taken whatever their age: the source would pass over those much older
    # than the newest one, and a restored or late file may be.
    reader = spark.readStream.schema(entity.bronze_schema).option("maxFileAge", "36500d")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    fresh = reader.parquet(f"{layers.bronze}/{entity.bronze_table}")
    laid_out = spread_for_write(entity.refine(fresh), entity.silver_partitions)
    return (
        stamp_processing(laid_out, run_id)
        .writeStream.outputMode("append")
        .partitionBy(*entity.silver_partitions)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
