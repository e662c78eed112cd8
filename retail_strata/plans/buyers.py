"""Distinct customers by month, quarter and year from one set of bitmaps."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_strata.operators.distinct_bitmaps import bitmaps, distinct_counts
from retail_strata.operators.numbering import numbered
from retail_strata.sources.readers import read_if_exists, read_parquet
from retail_strata.sources.writers import append_parquet, overwrite_parquet

LEVELS = {"month": "order_month", "quarter": "int((order_month + 2) div 3)", "year": "1"}


class Buyers:
    """A dictionary of customers and the bitmaps of the batches added so far, below one
    folder.  Numbers are dense and stay: a batch numbers only the customers that are new."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def dictionary(self) -> DataFrame | None:
        return read_if_exists(self.spark, f"{self.folder}/numbers", self._schema())

    def _schema(self):
        return self.spark.range(0).selectExpr("string(id) AS customer_id", "id AS number").schema

    def add(self, sales: DataFrame, batch: str) -> None:
        """Number the new customers of a batch and write its bitmaps.  Repeating a batch
        under its name replaces its bitmaps and finds no new customer."""
        known = self.dictionary()
        customers = sales.select("customer_id")
        first = 0
        if known is not None:
            customers = customers.join(known, "customer_id", "left_anti")
            largest = known.agg(F.max("number")).first()[0]
            first = 0 if largest is None else largest + 1
        append_parquet(numbered(customers, "customer_id", first), f"{self.folder}/numbers")
        rows = sales.join(self.dictionary(), "customer_id").select("order_year", "order_month", "number")
        overwrite_parquet(bitmaps(rows, ["order_year", "order_month"]), f"{self.folder}/bitmaps/batch={batch}")

    def bitmaps(self) -> DataFrame:
        return read_parquet(self.spark, f"{self.folder}/bitmaps")

    def rollup(self) -> DataFrame:
        """``level`` (month, quarter or year), ``order_year``, ``period`` and ``customers``:
        each from the monthly bitmaps, none from rows."""
        parts = []
        for level, period in LEVELS.items():
            placed = self.bitmaps().withColumn("period", F.expr(period))
            counts = distinct_counts(placed, ["order_year", "period"], "customers")
            parts.append(counts.select(F.lit(level).alias("level"), "order_year", "period", "customers"))
        return reduce(DataFrame.unionByName, parts)
