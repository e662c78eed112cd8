"""Tables whose parts are replaced one by one while others read them.

A part is a folder ``part=<n>/version=<id>``.  A manifest of appended entries names the
current version of each part, and readers open that one only.  A writer puts whole new
versions beside the old ones and then adds one manifest entry for all of them, which is
the moment at which readers change over; a writer that breaks off before leaves files
that no reader sees.
"""

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_strata.sources.literals import literal_rows
from retail_strata.sources.readers import path_exists
from retail_strata.sources.writers import append_parquet

PART, VERSION = "part", "version"
MANIFEST = T.StructType([
    T.StructField(PART, T.IntegerType()), T.StructField(VERSION, T.StringType()),
    T.StructField("batch", T.StringType()), T.StructField("micros", T.LongType()),
])


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def _manifest(self) -> DataFrame:
        path = f"{self.path}/manifest"
        if not path_exists(self.spark, path):
            return literal_rows(self.spark, MANIFEST, [])
        return self.spark.read.schema(MANIFEST).option("recursiveFileLookup", True).parquet(path)

    def current(self) -> dict[int, str]:
        """The current version of each part: as many entries as the table has parts."""
        newest = F.max_by(VERSION, F.struct("micros", VERSION)).alias(VERSION)
        return dict(tuple(r) for r in self._manifest().groupBy(PART).agg(newest).collect())

    def batches(self) -> set[str]:
        """The batches that changed the table."""
        return {r.batch for r in self._manifest().select("batch").distinct().collect()}

    def read(self, parts: list[int] | None = None) -> DataFrame:
        """The current rows, of all parts or of some; other folders are not opened."""
        current = self.current()
        wanted = [f"{p}/{v}" for p, v in current.items() if parts is None or p in parts]
        if not wanted:
            return literal_rows(self.spark, self.schema, [])
        schema = T.StructType([*self.schema.fields, *MANIFEST.fields[:2]])
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/data")
        named = F.concat_ws("/", F.col(PART).cast("string"), F.col(VERSION))
        return rows.filter(named.isin(wanted)).select(*self.schema.fieldNames())

    def replace(self, rows: DataFrame, part: str, parts: list[int], batch: str) -> None:
        """Give the named parts new versions.  ``rows`` holds all their rows, with the
        part's number in column ``part``; a part without rows becomes empty."""
        version = uuid.uuid4().hex
        placed = rows.withColumn(PART, F.col(part)).withColumn(VERSION, F.lit(version))
        append_parquet(placed.select(*self.schema.fieldNames(), PART, VERSION), f"{self.path}/data", (PART, VERSION))
        now = int(time.time() * 1_000_000)
        entry = literal_rows(self.spark, MANIFEST, [[p, version, batch, now] for p in parts])
        append_parquet(entry.coalesce(1), f"{self.path}/manifest/entry-{uuid.uuid4().hex}")
