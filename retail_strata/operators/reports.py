"""Row counts of tables."""

from functools import reduce

from pyspark.sql import DataFrame

from retail_strata.functions import named, quoted


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table; Parquet answers the count from its footers."""
    return _stack([
        df.agg(*named(table_name=f"'{name}'", row_count="count(1)")) for name, df in tables.items()
    ])


def ingestion_report(tables: dict[str, DataFrame], run_column: str = "ingestion_id") -> DataFrame:
    """Rows and number of ingestion runs per table."""
    runs = f"count(DISTINCT {quoted(run_column)})"
    return _stack([
        df.agg(*named(table_name=f"'{name}'", row_count="count(1)", ingestions=runs))
        for name, df in tables.items()
    ])
