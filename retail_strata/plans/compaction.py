"""Small files of a table packed into full ones, while runs go on.

Bronze and silver gather files with every run.  Compaction packs the small files of each
partition into groups of about ``target_bytes``, writes a group's rows into a staging
folder, and swaps them in by entries of a manifest: the files of a group are
``replaced`` by its staging folder in one appended entry.  Readers that follow the
manifest (``CompactedTable.read``) open a file or the folder that replaced it, never both, and
files that other runs append meanwhile are in no entry and are simply read too.

Nothing is deleted or moved.  A compaction that breaks off leaves a staging folder that
no entry names.  ``replaced_files`` lists what the manifest has put out of use, for a
retention job of the store.
"""

import re
import time
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_strata.sources.literals import literal_rows
from retail_strata.sources.readers import path_exists, read_parquet
from retail_strata.sources.writers import append_parquet

MANIFEST = T.StructType([
    T.StructField("replaced", T.ArrayType(T.StringType())), T.StructField("folder", T.StringType()),
    T.StructField("rows", T.LongType()), T.StructField("micros", T.LongType()),
])


@dataclass(frozen=True)
class Compaction:
    """What one compaction did.  ``files_at_most`` follows from the lengths of the files
    before: no packing by this target may leave more."""

    groups: int
    files_before: int
    files_after: int
    files_at_most: int


def table_files(spark: SparkSession, path: str, manifest: DataFrame | None = None) -> DataFrame:
    """``path``, ``length`` and ``partition`` (its ``column=value`` folders) of the files
    that are in use.  Only the listing is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    files = listed.load(path).select("path", "length")
    files = files.withColumn("partition", F.regexp_extract("path", "((?:/[^/=]+=[^/]*)*)/[^/]*$", 1))
    if manifest is not None:
        gone = manifest.select(F.explode("replaced").alias("path"))
        files = files.join(gone, "path", "left_anti")
    return files


def packed(files: DataFrame, target_bytes: int) -> DataFrame:
    """Groups of small files of one partition, in order of their size: ``partition``, ``slot``
    and ``paths``.  Files of at least half the target stay alone and are left out, as are
    groups of one.

    The running length of a partition's small files, smallest first, is cut at multiples
    of the target, so a group is smaller than two targets and no driver loop packs.
    """
    small = files.filter(F.col("length") * 2 < target_bytes)
    order = Window.partitionBy("partition").orderBy("length", "path").rowsBetween(Window.unboundedPreceding, 0)
    slot = F.expr(f"(running - length) div {target_bytes}")
    placed = small.withColumn("running", F.sum("length").over(order)).withColumn("slot", slot)
    groups = placed.groupBy("partition", "slot").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return groups.filter(F.size("paths") > 1)


def most_files(files: DataFrame, target_bytes: int) -> int:
    """How many files packing may leave: one a partition, and two for every target's worth
    of bytes in it, as files of half the target stay alone."""
    held = files.groupBy("partition").agg(F.sum("length").alias("held"))
    return held.agg(F.sum(F.expr(f"1 + 2 * held div {target_bytes}"))).first()[0] or 0


class CompactedTable:
    """A table folder with its manifest and staging folders beside it, in ``<path>_compact``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.side = f"{self.path}_compact"

    def manifest(self) -> DataFrame:
        path = f"{self.side}/manifest"
        if not path_exists(self.spark, path):
            return literal_rows(self.spark, MANIFEST, [])
        return self.spark.read.schema(MANIFEST).option("recursiveFileLookup", True).parquet(path)

    def files(self) -> DataFrame:
        """The files in use: of the table and of the staging folders that entries name."""
        manifest = self.manifest()
        files = table_files(self.spark, self.path, manifest)
        if path_exists(self.spark, f"{self.side}/data"):
            staged = table_files(self.spark, f"{self.side}/data", manifest)
            folder = F.regexp_extract("path", "/(group-[^/]*)/", 1)
            named = manifest.select(F.col("folder").alias("_folder"))
            staged = staged.join(named, folder == F.col("_folder"), "left_semi")
            files = files.unionByName(staged)
        return files

    def read(self) -> DataFrame:
        """The rows of the files in use."""
        found = [r.path for r in self.files().select("path").collect()]
        return self._rows_of(found).drop("_metadata") if found else literal_rows(self.spark, self.schema, [])

    def compact(self, target_bytes: int, by: tuple[str, ...]) -> Compaction:
        """Pack the small files in use; ``by`` are the partition columns of the table."""
        before = self.files()
        groups = packed(before, target_bytes).collect()
        counts, most = before.count(), most_files(before, target_bytes)
        if not groups:
            return Compaction(0, counts, counts, most)
        folder, paths = f"group-{uuid.uuid4().hex}", [p for g in groups for p in g.paths]
        rows = self._rows_of(paths)
        expected = rows.count()
        # A group's files stay together: the rows of a file carry its group's number, which
        # is the number of the one task that writes them.
        numbered = [[p, i] for i, g in enumerate(groups) for p in g.paths]
        kinds = T.StructType([T.StructField("_path", T.StringType()), T.StructField("_group", T.IntegerType())])
        placed = rows.withColumn("_path", F.col("_metadata.file_path")).join(
            literal_rows(self.spark, kinds, numbered), "_path"
        )
        spread = placed.repartitionById(len(groups), "_group").drop("_path", "_group")
        append_parquet(spread, f"{self.side}/data/{folder}", by)
        written = self.spark.read.schema(self.schema).parquet(f"{self.side}/data/{folder}").count()
        if written != expected:
            raise ValueError(f"{folder} holds {written} of {expected} rows; the table is as it was")
        now = int(time.time() * 1_000_000)
        entry = literal_rows(self.spark, MANIFEST, [[paths, folder, written, now]])
        append_parquet(entry.coalesce(1), f"{self.side}/manifest/entry-{uuid.uuid4().hex}")
        return Compaction(len(groups), counts, self.files().count(), most)

    def _rows_of(self, paths: list[str]) -> DataFrame:
        """The rows of some files, with where they come from.  A staging folder keeps the
        partition folders of its files below its own."""
        by_base: dict[str, list[str]] = {}
        for path in paths:
            group = re.search("/(group-[^/]*)/", path)
            by_base.setdefault(f"{self.side}/data/{group[1]}" if group else self.path, []).append(path)
        frames = [
            self.spark.read.schema(self.schema).option("basePath", base).parquet(*files).select("*", "_metadata")
            for base, files in sorted(by_base.items())
        ]
        return reduce(DataFrame.unionByName, frames)


def replaced_files(table: CompactedTable) -> DataFrame:
    """Files that no reader of the manifest opens any more."""
    return table.manifest().select(F.explode("replaced").alias("path"), "micros")


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of a layer, by its manifest where it was compacted."""
    table = CompactedTable(spark, path, schema)
    return table.read() if path_exists(spark, f"{table.side}/manifest") else read_parquet(spark, path, schema)
