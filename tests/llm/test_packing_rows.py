"""Pieces go to Spark as Arrow rows."""

import numpy as np
import pyarrow as pa

from retail_strata.llm.packing import Packer


def test_pieces_leave_as_arrow_rows():
    packer = Packer(5, 4, 10)
    packer.add(None, np.arange(6, dtype="<u4").tobytes())
    packer.finish()
    rows = packer.take()
    assert isinstance(rows, pa.RecordBatch) and not packer.rows
    assert rows.column("doc_id").to_pylist() == [None, None]
    assert rows.select(["start", "length", "sequence_id", "offset"]).to_pylist() == [
        {"start": 0, "length": 4, "sequence_id": 5, "offset": 0}, {"start": 4, "length": 2, "sequence_id": 6, "offset": 0},
    ]
