"""Sum-of-squares online packing of documents into windows of a fixed length.

Every task packs its own rows, in their order, and numbers its windows below its own
partition number, so there is no shuffle and nothing to agree on.  Whole windows are
cut off a document first; the rest goes to the fill level that makes the sum of
squared counts of partly filled windows smallest, the counts being kept in an array
by level.  Documents may be cut, so what is still open at the end of a task, or when
more than ``max_open`` windows are open, is poured into full windows; the very last
rest of a task becomes windows of power-of-two length, which need no padding.

A null text is empty and holds the end id alone; null, equal or repeated ``doc_id`` are
packed row by row; an empty table gives no piece; other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.llm.byte_tokens import byte_tokens
from retail_strata.llm.common import whole_text, workers_find_package

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)
PIECES_ARROW = pa.schema({
    "doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids": pa.binary(), "doc_tokens": pa.int64(),
    "sequence_id": pa.int64(), "offset": pa.int64(),
})
PER_TASK = 1 << 40


class Packer:
    """One task's windows.  A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, first_id: int, size: int, max_open: int):
        self.next_id, self.size, self.max_open = first_id, size, max_open
        self.counts = np.zeros(size + 1, dtype=np.int64)
        self.open: list[list[list]] = [[] for _ in range(size + 1)]
        self.rows: list[tuple] = []

    def add(self, key, ids: bytes) -> None:
        tokens, size = len(ids) // 4, self.size
        whole = tokens - tokens % size
        for start in range(0, whole, size):
            self._emit([(key, start, ids[4 * start : 4 * (start + size)], tokens)])
        if tokens > whole:
            self._place((key, whole, ids[4 * whole :], tokens))
        if self.counts.sum() > self.max_open:
            self._pour(last=False)

    def _place(self, piece: tuple) -> None:
        n, counts, size = len(piece[2]) // 4, self.counts, self.size
        # Half the change of the sum of squares for each level the piece may join.
        change = (counts[n:] - counts[: size + 1 - n]) + 1.0
        change[counts[: size + 1 - n] == 0] = np.inf
        if counts[size - n]:
            change[size - n] = 0.5 - counts[size - n]
        change[0] = counts[n] + 0.5
        level = int(np.argmin(change))
        if level:
            window = self.open[level].pop()
            counts[level] -= 1
        else:
            window = []
        window.append(piece)
        if level + n == size:
            self._emit(window)
        else:
            self.open[level + n].append(window)
            counts[level + n] += 1

    def _emit(self, window: list[tuple]) -> None:
        offset = 0
        for key, start, ids, tokens in window:
            self.rows.append((key, start, len(ids) // 4, ids, tokens, self.next_id, offset))
            offset += len(ids) // 4
        self.next_id += 1

    def _pour(self, last: bool) -> None:
        pieces = [p for level in reversed(self.open) for window in level for p in window]
        left = sum(len(p[2]) // 4 for p in pieces)
        self.open = [[] for _ in range(self.size + 1)]
        self.counts[:] = 0
        pieces.reverse()
        while left >= self.size or (last and left):
            # The largest power of two in the rest, or a whole window.
            room = self.size if left >= self.size else 1 << (left.bit_length() - 1)
            left -= room
            window = []
            while room:
                key, start, ids, tokens = pieces.pop()
                n = min(room, len(ids) // 4)
                window.append((key, start, ids[: 4 * n], tokens))
                if 4 * n < len(ids):
                    pieces.append((key, start + n, ids[4 * n :], tokens))
                room -= n
            self._emit(window)
        if left:
            self.open[left].append(pieces[::-1])
            self.counts[left] += 1

    def finish(self) -> None:
        self._pour(last=True)

    def take(self) -> pa.RecordBatch:
        columns = [pa.array(values, type=kind) for values, kind in zip(zip(*self.rows), PIECES_ARROW.types)]
        self.rows = []
        return pa.RecordBatch.from_arrays(columns, schema=PIECES_ARROW)


def pack(
    docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 0, max_open: int = 4096
) -> DataFrame:
    """One row per piece: whose ids it holds, from where, and where it lies."""
    workers_find_package(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() * PER_TASK, size, max_open)
        tokens = byte_tokens(tokenizer)
        for batch in batches:
            for key, ids in zip(batch["doc_id"].to_pylist(), tokens.encode(batch["text"], end)):
                packer.add(key, ids)
                if len(packer.rows) >= 4096:
                    yield packer.take()
        packer.finish()
        if packer.rows:
            yield packer.take()

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return texts.mapInArrow(pieces, PIECES)
