"""Random keys beside spans of fixed patterns and inside longer runs."""

import random

import pandas as pd

from retail_strata.llm.secrets import find_secrets, redact, train_secrets

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
WORDS = "service storage configuration account production europe customer archive monthly report index public".split()


def drawn(draw, n, letters=LETTERS):
    return "".join(draw.choice(letters) for _ in range(n))


def test_random_keys_in_parts_of_runs(spark):
    draw = random.Random(3)
    learned = [f"password = {drawn(draw, 40)}" for _ in range(400)]
    forms = (str.lower, str.title, str.upper, lambda w: f"{w}{draw.randrange(1000)}_{w}")
    learned += [" ".join(draw.choice(forms)(draw.choice(WORDS)) for _ in range(60)) for _ in range(400)]
    model = train_secrets(spark.createDataFrame(pd.DataFrame({"text": learned})))
    path = lambda n: "/".join(draw.choice(WORDS) for _ in range(n))
    keys, texts = [], []
    for i in range(20):
        own = [drawn(draw, 40) for _ in range(2)]
        access = "AKIA" + drawn(draw, 16, LETTERS[:26])
        texts.append([
            f"see {access}/{own[0]} now", f"see {own[0]}/{access}/{own[1]} now",
            f"see /{path(30)}/{own[0]}/{path(30)} now", f"see {path(20)}/{own[0]}/{path(20)}/{own[1]}/{path(20)} now",
        ][i % 4])
        keys.append([k for k in own if k in texts[-1]])
    clean = [f"see {path(40)} and {drawn(draw, 30, LETTERS[52:])}" for _ in range(20)]
    docs = spark.createDataFrame(pd.DataFrame({"n": range(40), "text": texts + clean}))
    out = redact(docs, model).toPandas().sort_values("n").text.tolist()
    for own, text in zip(keys, out):
        assert not any(k[i : i + 10] in text for k in own for i in range(len(k) - 9)), text
    assert out[20:] == clean
    for row in find_secrets(docs, model).collect():
        for span in row.spans:
            assert row.text[span.start : span.end].endswith(span.value)
            assert span.kind != "random" or span.end - span.start >= 16
