"""Rows that are written out in the program."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_rows(spark: SparkSession, schema: T.StructType, rows: Sequence[Sequence]) -> DataFrame:
    """A frame of the given rows.  They are constants of the plan, so Spark knows their
    size, which it does not of rows that are shipped from Python."""
    names = ", ".join(f"c{i}" for i in range(len(schema.fields)))
    given = rows or [[None] * len(schema.fields)]
    values = {f"p{i}_{j}": value for i, row in enumerate(given) for j, value in enumerate(row)}
    marks = ", ".join("(" + ", ".join(f":p{i}_{j}" for j in range(len(row))) + ")" for i, row in enumerate(given))
    made = spark.sql(f"SELECT * FROM VALUES {marks} AS t({names})", args=values)
    typed = made.select(*[F.col(f"c{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])
    return typed if rows else typed.limit(0)
