"""A pattern is looked for once a text, however many matches it has."""

import re

from pyspark.sql import functions as F

from retail_strata.llm.secrets import BASE, KEY_RUN, SecretModel, _random_places, _spans


def mentions(column, name):
    return len(re.findall(rf"\b{name}\(", str(column)))


def test_texts_are_searched_once_a_pattern(spark):
    for pattern, group in ((KEY_RUN, 0), (BASE[0][1], 2)):
        spans = _spans(F.col("text"), pattern, 0, 0, group)
        assert mentions(spans, "split") == 1
        assert mentions(spans, "regexp_extract_all") == 1 + (group > 0)
    places = _random_places(F.col("text"), SecretModel(tuple([0.5] * 68 * 68)))
    assert mentions(places, "instr") == 1


def test_places_of_many_matches(spark):
    text = " ".join(f"é{'Kq7' * 6}{i:04d}" for i in range(700)) + " end"
    found = spark.createDataFrame([(text,)], "text string").select(_spans(F.col("text"), KEY_RUN, 3, 0).alias("s")).first().s
    assert [(s.start, s.end, s.value) for s in found] == [(*m.span(), m[0]) for m in re.finditer(KEY_RUN, text)]
    assert len(found) == 700
