"""Token ids of documents in files of Simple-8b blocks, in document order.

The files are Parquet rows, so any store Spark reaches will do.  A row is one block
of whole documents: at least one, and no more than ``BLOCK_IDS`` ids unless a single
document is longer.  Rows carry the shard (ascending in ``doc_id``), the ids before
the block in its shard, the documents' ids and lengths, and the coded words.

Null texts are empty and hold the end id alone; null ``doc_id`` come first; equal
``doc_id`` are ordered by text, and repeated rows are all kept.  An empty table gives
empty files.  Other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retail_strata.llm import simple8b
from retail_strata.llm.byte_tokens import byte_tokens
from retail_strata.llm.common import whole_text, workers_find_package

BLOCK_IDS = 65_536
FILE_SCHEMA = (
    "shard int, block int, before bigint, doc_ids array<bigint>, lengths array<bigint>, "
    "count bigint, words binary, block_starts binary, escapes binary"
)
FILE_ARROW = pa.schema({
    "shard": pa.int32(), "block": pa.int32(), "before": pa.int64(), "doc_ids": pa.list_(pa.int64()),
    "lengths": pa.list_(pa.int64()), "count": pa.int64(), "words": pa.binary(), "block_starts": pa.binary(),
    "escapes": pa.binary(),
})


def _block(shard: int, block: int, before: int, docs: list[tuple]) -> dict:
    ids = np.frombuffer(b"".join(ids for _, ids in docs), dtype="<u4")
    coded = simple8b.encode(ids)
    return {
        "shard": shard, "block": block, "before": before,
        "doc_ids": [key for key, _ in docs], "lengths": [len(ids) // 4 for _, ids in docs],
        **coded._asdict(),
    }


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Encode ``text`` of every row and write the files.  Documents are dealt by range
    of ``doc_id``; no task needs to know another's."""
    spark = docs.sparkSession
    workers_find_package(spark)
    end = np.array([end_id], dtype="<u4").tobytes()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        tokens, held, held_ids = byte_tokens(tokenizer), [], 0
        for batch in batches:
            rows = []
            for key, ids in zip(batch["doc_id"].to_pylist(), tokens.encode(batch["text"], end)):
                if held and held_ids + len(ids) // 4 > BLOCK_IDS:
                    rows.append(_block(shard, block, before, held))
                    block, before, held, held_ids = block + 1, before + held_ids, [], 0
                held.append((key, ids))
                held_ids += len(ids) // 4
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=FILE_ARROW)
        if held:
            yield pa.RecordBatch.from_pylist([_block(shard, block, before, held)], schema=FILE_ARROW)

    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    ordered = ordered.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(blocks, FILE_SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``
    (little-endian unsigned 32-bit).  What is broadcast is one row per shard."""
    workers_find_package(spark)
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = files.groupBy("shard").agg(F.sum("count").alias("ids"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("shard_start"))
    placed = files.join(F.broadcast(offsets), "shard")

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                ids = simple8b.decode(simple8b.Coded(row.count_, row.words, row.block_starts, row.escapes))
                lengths = np.asarray(row.lengths, dtype=np.int64)
                ends = np.cumsum(lengths)
                raw = ids.astype("<u4").tobytes()
                yield pd.DataFrame({
                    "doc_id": pd.array([None if pd.isna(k) else int(k) for k in row.doc_ids], dtype="Int64"),
                    "start": row.shard_start + row.before + ends - lengths,
                    "n_tokens": lengths,
                    "ids": [raw[4 * (e - n) : 4 * e] for e, n in zip(ends, lengths)],
                })

    columns = placed.withColumnRenamed("count", "count_")
    return columns.mapInPandas(documents, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
