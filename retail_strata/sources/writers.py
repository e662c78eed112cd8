"""Sinks."""

from pyspark.sql import DataFrame


def spread_for_write(df: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Bring the rows of each partition value together so that a task writes few,
    full files instead of one small file per value.

    A rebalance rather than a plain repartition: a value holding a third of the
    table is cut into pieces of the advisory size, and small values share a task.
    The cutting needs adaptive execution; a session without it keeps the rows
    where they are, as one task per hot value would be worse than small files.
    Works for a micro-batch of a stateless stream too.
    """
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    return df.hint("rebalance", *by) if adaptive else df


def append_parquet(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    df.write.mode("append").partitionBy(*by).parquet(path)


def overwrite_parquet(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    """Replace the whole table, partitions that no longer occur included,
    whatever overwrite mode the session prefers."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*by).parquet(path)


def write_json_lines(
    df: DataFrame, path: str, mode: str = "overwrite", by: tuple[str, ...] = (),
    compression: str | None = None,
) -> None:
    df.write.mode(mode).partitionBy(*by).json(path, compression=compression)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", by: tuple[str, ...] = ()) -> None:
    """CSV with a header line; text keeps its outer spaces."""
    (
        df.write.mode(mode)
        .partitionBy(*by)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
