"""Arrays reach the driver as blocks of bytes, not as a row a number."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from retail_strata.llm.common import CELLS, gathered, workers_find_package
from retail_strata.llm.ngram_join import SLOTS, slot_counts
from retail_strata.llm.suffix_dedup import _bitmap


@pytest.fixture
def rows_sent(spark, monkeypatch):
    """How many rows each collect or toPandas gives the driver."""
    workers_find_package(spark)
    kind, sent = type(spark.range(1)), []
    for name in ("collect", "toPandas"):
        def counted(self, taken=getattr(kind, name)):
            rows = taken(self)
            sent.append(len(rows))
            return rows

        monkeypatch.setattr(kind, name, counted)
    return sent


def test_blocks_make_the_array(spark):
    cells = spark.range(3 * CELLS).filter("id % 3 <> 0").selectExpr("id AS place", "-id AS value")
    places = np.arange(2 * CELLS + 5)
    assert (gathered(cells.filter(F.col("place") < len(places)), len(places), "int64") == np.where(places % 3, -places, 0)).all()
    assert not gathered(cells.limit(0), 10, "uint32").any()


def test_bitmap_of_keys(spark, rows_sent):
    keys = spark.range(40_000).select(F.xxhash64("id").alias("key"))
    bits = _bitmap(keys)
    slots = np.array([r.key for r in keys.toLocalIterator()]) % (len(bits) * 32)
    expected = np.zeros(len(bits) * 32, dtype=np.uint8)
    expected[slots] = 1
    assert (np.unpackbits(bits.view(np.uint8), bitorder="little") == expected).all()
    assert max(rows_sent) <= len(bits) // CELLS + 1


def test_counts_of_slots(spark, rows_sent):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat_ws(' ', 'a', id, id + 1, id + 2) AS text")
    words, shingles = slot_counts(docs, 2)
    assert (len(words), words.sum(), len(shingles), shingles.sum()) == (SLOTS, 12_000, SLOTS, 9_000)
    assert max(rows_sent) <= 2 * SLOTS // CELLS
