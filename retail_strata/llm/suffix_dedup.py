"""Repeated passages by a sparse suffix array.

Only suffixes at content-selected positions are kept: the least hash of ``GRAM`` words
in every window of starts, so that any passage of ``least_words`` words has one in the
same place wherever it occurs.  Suffixes whose first ``GRAM`` words occur once are
dropped.  Each of the others stands for the passages of exactly ``least_words`` words
that select it, one for every number of words to its left.  Suffixes are sorted by
their first words, then their passages by hash, so that all copies of a passage stand
together whatever sorts around them.  A passage in different documents is a repeat;
all but the one with the smallest key (``doc_id``, nulls last, then a hash of the text)
lose their copies, so that every passage stays somewhere.  Longer repeats are their
passages put together.

A task holds the suffixes of one key, ``HOT`` at most, and one batch.  A key with more is
dealt over several tasks and compared batch by batch; the first document of each
passage there goes on to a second round, dealt by passage.

Words are runs of characters that are no ASCII white space, A-Z in lower case.  Null
texts have none.  Rows with equal ``doc_id`` and text count as one document, and all of
them stay.  An empty table has no repeats.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_strata.llm.common import gathered, release_models, whole_text, workers_find_package, written
from retail_strata.llm.shingles import gram_hashes, groups, word_hashes

GRAM = 30
HOT = 2000
WORDS = re.compile(r"[^\t-\r ]+")
MAX_BITS = 27
RECORD = "key bigint, none boolean, doc bigint, body bigint, start int, passages binary"
FOUND = "none boolean, doc bigint, body bigint, first int, last int, cut boolean, key bigint, passage bigint, starts array<int>"


def selected(grams: np.ndarray, window: int) -> np.ndarray:
    """Position of the least hash (the first of equals) for every window of starts."""
    window = min(window, len(grams))
    least = np.lib.stride_tricks.sliding_window_view(grams, window).argmin(axis=1)
    return least + np.arange(len(least))


def _edges(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before; the first one does."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _ends(first: np.ndarray, n: int) -> np.ndarray:
    """The last place of each of the groups of n rows that begin at ``first``."""
    return np.append(first[1:], n)[: len(first)] - 1


def _suffixes(texts: list[str], least_words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(place of the text, its word hashes, for each suffix the first passage that
    selects it, keys) of texts that are long enough."""
    for part in groups(texts):
        hashes, bounds = word_hashes(texts[part])
        grams = gram_hashes(hashes, GRAM)
        for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            if b - a >= least_words:
                own = grams[a : b - GRAM + 1]
                at = selected(own, least_words - GRAM + 1)
                first = np.flatnonzero(_edges(at))
                yield part.start + i, hashes[a:b], first, own[at[first]].view(np.int64)


def _bitmap(keys: DataFrame) -> np.ndarray:
    """A bit for each slot with a repeated key: about 16 bits a key, ``1 << MAX_BITS`` at
    most, so that the driver and the tasks hold 16 MB at worst.  Beyond that the bits
    let more suffixes through, which the exact join drops."""
    bits = min(MAX_BITS, max(10, int(keys.count() * 16).bit_length()))
    words = keys.select(F.expr(f"pmod(key, {1 << bits}L)").alias("slot")).selectExpr(
        "slot div 32 AS place", "shiftleft(1L, cast(slot % 32 AS int)) AS bit"
    )
    return gathered(words.groupBy("place").agg(F.bit_or("bit").alias("value")), 1 << (bits - 5), "uint32")


def _records(docs: DataFrame, least_words: int) -> DataFrame:
    """The suffixes that share their first words with another, with the hashes of their
    passages (the first begins at word ``start``, each next one word later), and how many
    suffixes have the ``key``."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_models()
        for batch in batches:
            found = [k for *_, k in _suffixes(list(batch["text"]), least_words)]
            yield pd.DataFrame({"key": np.concatenate(found) if found else np.zeros(0, np.int64)})

    counts = docs.mapInPandas(keys, "key bigint").groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    counts = written(counts.filter("members > 1"), "suffix-keys")
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(counts))

    def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bitmap = shared.value
        size = np.uint64(len(bitmap) * 32 - 1)
        for batch in batches:
            rows = []
            names = list(zip(batch["none"], batch["doc"], batch["body"]))
            for i, words, first, key in _suffixes(list(batch["text"]), least_words):
                slot = key.view(np.uint64) & size
                set_bit = bitmap[(slot >> np.uint64(5)).astype(np.int64)] >> (slot & np.uint64(31)).astype(np.uint32) & 1
                on = np.flatnonzero(set_bit)
                if not len(on):
                    continue
                passages = gram_hashes(words, least_words)
                last = _ends(first, len(passages))
                for k, a, b in zip(key[on].tolist(), first[on].tolist(), last[on].tolist()):
                    rows.append((k, *names[i], a, passages[a : b + 1].tobytes()))
            yield pd.DataFrame(rows, columns=["key", "none", "doc", "body", "start", "passages"])

    return written(docs.mapInPandas(around, RECORD).join(counts, "key"), "suffix-records")


def _met(records: pd.DataFrame, least_words: int) -> pd.DataFrame:
    """Repeats among some suffixes; and of a hot key, for each passage its first document
    and where it ``starts`` there, as it may meet a smaller one elsewhere."""
    passage = np.frombuffer(b"".join(records["passages"]), dtype=np.int64)
    sizes = records["passages"].str.len().to_numpy(dtype=np.int64) // 8
    row = np.repeat(np.arange(len(records)), sizes)
    start = records["start"].to_numpy()[row] + np.arange(len(row)) - (np.cumsum(sizes) - sizes)[row]
    key, hot = records["key"].to_numpy()[row], (records["members"] > HOT).to_numpy()[row]
    none, doc, body = (records[c].to_numpy() for c in ("none", "doc", "body"))
    order = np.lexsort((body, doc, none))
    place = np.empty(len(records), dtype=np.int64)
    place[order] = np.cumsum(_edges(none[order], doc[order], body[order]))
    place = place[row]

    by = np.lexsort((start, place, passage, key))
    new = _edges(key[by], passage[by])
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    owner, other = place[by][first][group], place[by][_ends(first, len(by))][group]
    repeated, cut, again = (np.zeros(len(by), dtype=bool) for _ in range(3))
    repeated[by], cut[by] = owner != other, owner != place[by]
    again[by] = ~_edges(key[by], passage[by], place[by], start[by])

    # Neighbouring passages of a suffix with one fate are one span.
    fate = repeated + cut.astype(np.int8)
    begin = np.flatnonzero(_edges(row, fate))
    end = _ends(begin, len(row))
    told = fate[begin] > 0
    begin, end = begin[told], end[told]
    # One row a passage that is carried, however often its document holds it.
    kept = by[(hot & ~cut & ~again)[by]]
    split = np.flatnonzero(_edges(key[kept], passage[kept]))
    one = kept[split]
    at, last = np.concatenate([begin, one]), np.concatenate([end, one])
    out = pd.DataFrame({
        "none": none[row[at]], "doc": doc[row[at]], "body": body[row[at]],
        "first": start[at], "last": start[last] + least_words, "cut": cut[at],
        "key": key[at], "passage": passage[at],
    })
    starts = np.split(start[kept].astype(np.int32), split[1:])[: len(one)]
    out["starts"] = pd.Series([None] * len(begin) + starts, dtype=object)
    return out


def _compared(records: DataFrame, least_words: int) -> DataFrame:
    salt = F.pmod(F.xxhash64("doc", "body"), F.ceil(F.col("members") / HOT)).cast("int")
    dealt = records.withColumn("salt", salt)
    dealt = dealt.repartition("key", "salt").sortWithinPartitions("key", "salt").drop("salt")

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if len(rows):
                # The last key may go on in the next batch.  A hot one meets again later.
                going_on = (rows["key"] == rows["key"].iloc[-1]) & (rows["members"] <= HOT)
                held = rows[going_on]
                yield _met(rows[~going_on], least_words)
        if held is not None:
            yield _met(held, least_words)

    return written(dealt.mapInPandas(scanned, FOUND), "suffix-found")


def _carried(found: DataFrame, least_words: int) -> DataFrame:
    """The second round: dealt by passage, not by key; a row a passage and batch."""
    same = Window.partitionBy("key", "passage")
    name = F.struct("none", "doc", "body")
    met = found.filter("starts IS NOT NULL")
    met = met.withColumns({"owner": F.min(name).over(same), "other": F.max(name).over(same)}).filter("owner != other")
    first = met.select("none", "doc", "body", F.explode("starts").alias("first"), (name != F.col("owner")).alias("cut"))
    return first.withColumn("last", F.col("first") + least_words)


def _with_key(docs: DataFrame) -> DataFrame:
    """Rows with the ``body`` hash that tells texts of one ``doc_id`` apart."""
    return docs.withColumn("body", F.xxhash64(whole_text()))


def repeated_passages(docs: DataFrame, least_words: int = 50) -> DataFrame:
    """``doc_id``, ``body`` (hash of the text) and ``passages``: from word ``first`` up to
    word ``last``, and whether that copy is to be ``cut``; documents with repeats only."""
    workers_find_package(docs.sparkSession)
    doc_id = F.col("doc_id").cast("bigint")
    texts = _with_key(docs.select(
        doc_id.isNull().alias("none"), F.coalesce(doc_id, F.lit(0)).cast("bigint").alias("doc"), whole_text().alias("text")
    ))
    found = _compared(_records(texts, least_words), least_words)
    columns = ["none", "doc", "body", "first", "last", "cut"]
    spans = found.filter("starts IS NULL").select(*columns).union(_carried(found, least_words).select(*columns))
    passages = F.collect_set(F.struct("first", "last", "cut")).alias("passages")
    named = spans.groupBy("none", "doc", "body").agg(passages)
    return named.select(F.when(~F.col("none"), F.col("doc")).alias("doc_id"), "body", "passages")


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if merged and first <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(last, merged[-1][1]))
        else:
            merged.append((first, last))
    return merged


def deduplicated(docs: DataFrame, least_words: int = 50) -> DataFrame:
    """All columns of all rows, ``text`` without the copies that are cut, and ``repeats``
    and ``removed``: the passages found and those cut, as start:end in code points of
    the old text, comma-joined (null where a document has none).  A column of the caller's
    with one of these two names gives way."""
    found = repeated_passages(docs, least_words)
    # Under names of our own in between, so that no column of the caller's meets ours.
    aside = {c: "text" if c == "text" else f"_c{i}" for i, c in enumerate(docs.columns)}
    keyed = _with_key(docs.toDF(*aside.values())).withColumn("_id", F.col(aside["doc_id"]).cast("bigint"))
    named = found.select(F.col("doc_id").alias("_other"), F.col("body").alias("_body"), "passages")
    joined = keyed.join(named, F.expr("_id <=> _other AND body = _body"), "left").drop("body", "_id", "_other", "_body")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, repeats, removed = [], [], []
            for text, passages in zip(batch["text"], batch["passages"]):
                if passages is None:
                    texts.append(text)
                    repeats.append(None)
                    removed.append(None)
                    continue
                words = [m.span() for m in WORDS.finditer(text)]
                places = lambda spans: [(words[a][0], words[b - 1][1]) for a, b in _merged(spans)]
                gone = places([(p["first"], p["last"]) for p in passages if p["cut"]])
                kept, at = [], 0
                for start, end in gone:
                    kept.append(text[at:start])
                    at = end
                texts.append("".join(kept) + text[at:])
                repeats.append(",".join(f"{a}:{b}" for a, b in places([(p["first"], p["last"]) for p in passages])))
                removed.append(",".join(f"{a}:{b}" for a, b in gone))
            yield batch.drop(columns="passages").assign(text=texts, repeats=repeats, removed=removed)

    kinds = ", ".join(f"{aside[f.name]} {f.dataType.simpleString()}" for f in docs.schema.fields)
    done = joined.mapInPandas(cut, f"{kinds}, repeats string, removed string")
    own = [F.col(inner).alias(c) for c, inner in aside.items() if c not in ("repeats", "removed")]
    return done.select(*own, "repeats", "removed")
