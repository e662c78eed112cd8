"""Tables whose files are dealt by a hash of a key, so that joins and aggregates on the
key need no exchange.

Spark keeps the number of buckets in its catalog, so these are catalog tables over
folders of the caller's.  The entries live as long as the session's catalog does; the
files stay.
"""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


class BucketedTables:
    def __init__(self, spark: SparkSession, database: str, path: str):
        self.spark, self.database, self.path = spark, database, path

    def write(self, table: str, rows: DataFrame, key: str, buckets: int) -> None:
        """Replace a table.  Rows are brought together by key first, so that a bucket is
        one file; a hot key makes one large bucket, as it would one large task."""
        spread = rows.repartition(buckets, key)
        writer = spread.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
        writer.option("path", f"{self.path}/{table}").saveAsTable(f"{self.database}.{table}")

    def read(self, table: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{table}")


@contextmanager
def bucketed_tables(spark: SparkSession, database: str, path: str) -> Iterator[BucketedTables]:
    """A database of the session's catalog for the time of the block; the files remain."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    try:
        yield BucketedTables(spark, database, path)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
