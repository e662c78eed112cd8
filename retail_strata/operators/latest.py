"""Latest row per key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.functions import quoted


def latest_per_key(df: DataFrame, keys: list[str], newest_by: list[str]) -> DataFrame:
    """Keep the one row per key that is largest by ``newest_by``, nulls last.

    Rows that tie there are compared on all their other columns, so the survivor
    never depends on how the data is distributed.  ``row_number() = 1`` lets Spark
    keep one row per key in every map task before the shuffle: a key with a third
    of all rows sends one row per task, not all of them.
    """
    return place_per_key(df, keys, newest_by).filter("_place = 1").drop("_place")


def place_per_key(df: DataFrame, keys: list[str], newest_by: list[str]) -> DataFrame:
    """All rows with their place in their key, from 1 for the newest, as ``_place``."""
    ties = [c for c in df.columns if c not in keys and c not in newest_by]
    group = ", ".join(map(quoted, keys))
    order = ", ".join(f"{quoted(c)} DESC NULLS LAST" for c in [*newest_by, *ties])
    place = F.expr(f"row_number() OVER (PARTITION BY {group} ORDER BY {order})")
    return df.withColumn("_place", place)
