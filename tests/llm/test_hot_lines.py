"""A line that many documents hold, shorter than a repeat."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from retail_strata.llm import suffix_dedup as sd
from retail_strata.llm.suffix_dedup import deduplicated

LINE = [f"line{i}" for i in range(45)]


def documents(pairs: int, count: int) -> tuple[pd.DataFrame, list[set[int]]]:
    """Documents around one line; each of the pairs shares ten more words, before it (even
    pairs) or four before and six after it (odd ones)."""
    draw = random.Random(7)
    fresh = lambda n: [f"w{draw.getrandbits(60):x}" for _ in range(n)]
    texts = [fresh(30) + LINE + fresh(30) for _ in range(count)]
    places = draw.sample(range(count), 2 * pairs)
    planted = []
    for i in range(pairs):
        a, b = sorted(places[2 * i : 2 * i + 2])
        before, after = (10, 0) if i % 2 == 0 else (4, 6)
        texts[b][30 - before : 30] = texts[a][30 - before : 30]
        texts[b][75 : 75 + after] = texts[a][75 : 75 + after]
        planted.append((a, b, before, after))
    return pd.DataFrame({"doc_id": range(count), "text": [" ".join(t) for t in texts]}), planted


@pytest.mark.parametrize("count", [1500, 3000], ids=["one chunk", "several chunks"])
def test_matches_that_need_the_left_context(spark, count):
    table, planted = documents(20, count)
    out = deduplicated(spark.createDataFrame(table)).filter("repeats IS NOT NULL").toPandas().set_index("doc_id")
    assert set(out.index) == {d for a, b, _, _ in planted for d in (a, b)}
    for a, b, before, after in planted:
        old = table.text[b].split(" ")
        assert out.text[a] == table.text[a]
        assert out.text[b].split() == old[: 30 - before] + old[75 + after :]


def carried(spark, texts: list[str]) -> pd.DataFrame:
    """Rows of the second round: how many of each key and of each passage."""
    docs = spark.createDataFrame(pd.DataFrame({"doc": range(len(texts)), "text": texts}))
    docs = sd._with_key(docs.withColumn("none", F.lit(False)))
    found = sd._compared(sd._records(docs, 50), 50).filter("starts IS NOT NULL").select("key", "passage").toPandas()
    return found.groupby("key").size().max(), found.groupby(["key", "passage"]).size().max()


def test_second_round_of_a_hot_key_is_dealt_by_passage(spark):
    table, _ = documents(2, 3000)
    of_key, of_passage = carried(spark, list(table.text))
    assert of_key >= 3000
    assert of_passage <= 4


def test_a_line_many_times_in_each_document(spark):
    line = " ".join(f"line{i}" for i in range(10))
    texts = [f"own{i} " + " ".join([line] * 60) for i in range(100)]
    _, of_passage = carried(spark, texts)
    assert of_passage <= 10  # one for each batch and chunk, not for each of the 55 places
    out = deduplicated(spark.createDataFrame(pd.DataFrame({"doc_id": range(100), "text": texts}))).toPandas()
    left = dict(zip(out.doc_id, out.text))
    assert left[0] == texts[0]
    assert all(left[i].strip() == f"own{i}" for i in range(1, 100))
