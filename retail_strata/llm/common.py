"""Shared steps: written tables, Python on the workers, safe cutting of texts."""

import ctypes
import gc
import re
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_strata.sources.scratch import scratch_folder

ROOT = str(Path(__file__).resolve().parents[2])
LATIN_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TWO_SPACES = re.compile(r"\s\s")
BEFORE_SPACE = re.compile(r"(?<=\S)(?= \S)")


ROWS_PER_BATCH = 1000
CELLS = 4096  # numbers in a row of those that make up an array

_held: dict[tuple, object] = {}


def held_by_worker(make: Callable, *arguments):
    """``make(*arguments)``, made once in a Python process and kept until another is asked
    for: workers serve stage after stage, and what one stage held is not beside the next."""
    key = (make, *arguments)
    if key not in _held:
        release_models()
        _held[key] = make(*arguments)
    return _held[key]


def release_models() -> None:
    """What earlier stages left in this process goes back to the system."""
    _held.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver found it, and hand
    them whole texts a thousand at a time, as they live beside the executor's heap."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ROWS_PER_BATCH:
        spark.conf.set(rows, str(ROWS_PER_BATCH))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends there, and a
    lost executor costs no more than its own tasks."""
    path = scratch_folder(df.sparkSession, f"llm-{purpose}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gathered(cells: DataFrame, size: int, kind: str) -> np.ndarray:
    """An array of ``size`` numbers on the driver: ``value`` at each ``place`` there is a
    row for, one at most, and 0 elsewhere.  The numbers come as bytes, ``CELLS`` a row: as
    rows of their own they would take the driver some fifty times the array."""

    def together(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        block = np.zeros(CELLS, dtype=kind)
        block[group["place"].to_numpy() % CELLS] = group["value"].to_numpy()
        return pd.DataFrame({"block": key, "numbers": [block.tobytes()]})

    blocks = cells.withColumn("block", F.expr(f"place div {CELLS}")).groupBy("block")
    array = np.zeros(-(-size // CELLS) * CELLS, dtype=kind)
    for block, numbers in blocks.applyInPandas(together, "block bigint, numbers binary").collect():
        array[block * CELLS : (block + 1) * CELLS] = np.frombuffer(numbers, dtype=kind)
    return array[:size]


def whole_text(column: str = "text"):
    """Null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def space_chunks(text: str) -> list[str]:
    """Cut before single spaces between two non-space characters.  Byte-level
    pre-tokenisers always cut there, so chunks can be encoded one by one."""
    if TWO_SPACES.search(text):
        return BEFORE_SPACE.split(text)
    first, *rest = text.split(" ")
    chunks = [" " + part for part in rest]
    return [first, *chunks] if first else chunks
