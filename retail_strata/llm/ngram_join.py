"""Jaccard self-join of word-shingle sets by adaptive multi-match prefixes.

Shingles are ordered from rare to frequent, as counts over all rows have it.  Two sets
that reach the threshold share at least l of the first n - o + l shingles, for every l,
where o is the overlap a set of n needs.  Each set takes the l that its estimated
candidates make cheapest; longer prefixes ask for more shared shingles.

Rows with equal sets are one class and are worked on once.  Classes of long lists are
first compared with a few representatives of each list and put together where they
match, then those left over with members of the largest group, so that a large group of
near copies takes a linear number of comparisons.  Last, all pairs that are still apart and
share enough of their prefixes are looked at.  Lists of more than ``BLOCK`` members are
dealt to blocks for that, whose prefixes are compared inside tasks: a row is made for a
member and a block it meets, never for a pair that does not share enough.  Pairs are told
apart by sketches first, a bit or two a shingle; whole sets are read only for those left.
No link between classes of different components remains unseen.

Null texts and texts without words have empty sets and are linked with nothing.  Rows
without a ``doc_id`` take part; a component's id is its smallest ``doc_id`` that is not
null.  Repeated rows are in one component; an empty table gives an empty one.
"""

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_strata.llm.common import gathered, release_models, whole_text, workers_find_package, written
from retail_strata.llm.components import components
from retail_strata.llm.shingles import groups, packed, shingle_sets, unpacked, word_hashes

SLOTS = 1 << 18
LEVELS = range(4, 33)
LONG_LIST = 16  # members from which a list is worth representatives
DRAWS = 4  # representatives of a list
STAR_MATCHES = 4  # shared prefix shingles that make comparing with a representative worthwhile
VERIFY_COST = 12.0  # of a candidate, in postings looked at
BLOCK = 256  # members of a list that are compared at once
TOKENS_AT_ONCE = 8192  # prefix shingles of two blocks that are compared at once
LOG_STEPS = 1024  # steps of a logarithm: whole numbers, whose sums are the same everywhere
MAX_BROADCAST = 500_000  # rows of one number


def _sets_of(batch: pd.DataFrame, words: int, weigh=None) -> Iterator[tuple]:
    texts = list(batch["text"])
    keys = list(batch["doc_id"])
    for part in groups(texts):
        yield from zip(keys[part], shingle_sets(texts[part], words, weigh))


def _set_id(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def slot_counts(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """How often words, and shingles of the sets, of each of ``SLOTS`` slots occur, over
    all rows.  The driver gets these two arrays, whatever the input."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_models()
        totals = np.zeros((2, SLOTS), dtype=np.int64)
        for batch in batches:
            texts = list(batch["text"])
            for part in groups(texts):
                hashes, _ = word_hashes(texts[part])
                shingles = np.concatenate(shingle_sets(texts[part], words))
                for total, seen in zip(totals, (hashes, shingles)):
                    total += np.bincount((seen % SLOTS).astype(np.int64), minlength=SLOTS)
        place = np.flatnonzero(totals)
        yield pd.DataFrame({"place": place, "n": totals.ravel()[place]})

    slots = docs.mapInPandas(counted, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("value"))
    counts = gathered(slots, 2 * SLOTS, "int64")
    return counts[:SLOTS], counts[SLOTS:]


class Rarity:
    """Estimated number of sets that hold a shingle, as a logarithm: what its words'
    frequencies make likely, or what its slot holds beyond chance, if that is more."""

    def __init__(self, words: np.ndarray, shingles: np.ndarray):
        total = max(int(words.sum()), 1)
        mean = shingles.mean()
        self.log_words = np.log(total)
        self.of_word = np.rint(np.log(np.maximum(words, 1) / total) * LOG_STEPS).astype(np.int64)
        self.of_slot = np.log(np.maximum(shingles - mean - 5 * np.sqrt(mean), 1.0))

    def weigh(self, hashes: np.ndarray) -> np.ndarray:
        return self.of_word[(hashes % SLOTS).astype(np.int64)]

    def estimate(self, shingles: np.ndarray, word_sums: np.ndarray) -> np.ndarray:
        return np.maximum(word_sums / LOG_STEPS + self.log_words, self.of_slot[(shingles % SLOTS).astype(np.int64)])


def least_overlap(n, percent: int):
    """Smallest overlap with any set that reaches the threshold, for a set of n."""
    return -(-n * percent // 100)


def _prefix(shingles: np.ndarray, often: np.ndarray, percent: int) -> np.ndarray:
    """The shingles of the prefix whose level has the least estimated cost.
    ``often`` is the logarithm of how many sets are likely to hold each shingle."""
    n = len(shingles)
    base = n - least_overlap(n, percent)
    order = np.lexsort((shingles, often))[: base + max(LEVELS)]
    looked_at = np.cumsum(1.0 + np.exp(np.minimum(often[order], 60.0)))
    levels = [k for k in LEVELS if base + k <= n] or [n - base]
    level = min(levels, key=lambda k: looked_at[base + k - 1] * (1 + VERIFY_COST / k))
    return shingles[order[: base + level]]


def _sketch(shingles: np.ndarray) -> bytes:
    """Whether an odd number of the shingles has each of the last bits: of two sets, at
    least as many shingles differ as these bits."""
    bits = 1 << max(6, len(shingles).bit_length())
    seen = np.bincount((shingles % bits).astype(np.int64), minlength=bits)
    return np.packbits((seen & 1).astype(np.uint8), bitorder="little").tobytes()


def _differing(left: bytes, right: bytes) -> int:
    """Bits in which two sketches differ, the longer one folded to the other's length."""
    short, long = sorted((left, right), key=len)
    folded, bits = int.from_bytes(long, "little"), 8 * len(long)
    while bits > 8 * len(short):
        bits //= 2
        folded = (folded >> bits) ^ (folded & ((1 << bits) - 1))
    return (folded ^ int.from_bytes(short, "little")).bit_count()


def _classes(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (``doc_id``, ``body``, ``set_id``, ``n``) and classes (``node``, ``set_id``, ``n``,
    ``length``, ``prefix`` and ``sketch``), one for each distinct set that is not empty."""
    shared = docs.sparkSession.sparkContext.broadcast(Rarity(*slot_counts(docs, words)))

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rarity = shared.value
        for batch in batches:
            rows = []
            for body, (key, (shingles, sums)) in zip(batch["body"], _sets_of(batch, words, rarity.weigh)):
                often = rarity.estimate(shingles, sums)
                prefix = _prefix(shingles, often, percent) if len(shingles) else shingles
                found = _set_id(shingles), len(shingles), len(prefix), packed(prefix), _sketch(shingles)
                rows.append((key, body, *found))
            out = pd.DataFrame(rows, columns=["doc_id", "body", "set_id", "n", "length", "prefix", "sketch"])
            out["doc_id"] = pd.array([None if pd.isna(k) else int(k) for k in out["doc_id"]], dtype="Int64")
            yield out

    kinds = "doc_id bigint, body bigint, set_id binary, n bigint, length int, prefix binary, sketch binary"
    rows = written(docs.mapInPandas(prefixes, kinds), "ngram-rows")
    classes = rows.filter("n > 0").groupBy("set_id").agg(
        *[F.any_value(name).alias(name) for name in ("n", "length", "prefix", "sketch")]
    )
    classes = classes.withColumn("node", F.monotonically_increasing_id())
    return rows.select("doc_id", "body", "set_id", "n"), written(classes, "ngram-classes")


def _postings(classes: DataFrame, percent: int) -> DataFrame:
    """One row per class and prefix shingle; ``length`` is the prefix's, and of two sets
    that reach the threshold the rarest shared shingle is ``early`` in both prefixes."""

    def exploded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["length"].to_numpy()
            rows = {name: np.repeat(batch[name].to_numpy(), sizes) for name in ("node", "n", "length")}
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            rows["early"] = place <= rows["n"] - least_overlap(rows["n"], percent)
            yield pd.DataFrame({"shingle": unpacked(b"".join(batch["prefix"])).astype(np.int64), **rows})

    kinds = "shingle bigint, node bigint, n bigint, length int, early boolean"
    return classes.select("node", "n", "length", "prefix").mapInPandas(exploded, kinds)


def _only(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Semi-join; the keys are broadcast if they are counted to be few."""
    few = keys.count() <= MAX_BROADCAST
    return df.join(F.broadcast(keys) if few else keys, on, "left_semi")


def _sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """``node`` and ``shingles`` of the classes named, from one more pass over the texts."""
    wanted = written(classes.select("node", "set_id").join(nodes, "node", "left_semi"), "ngram-wanted")
    if wanted.isEmpty():
        return wanted.select("node", F.col("set_id").alias("shingles"))

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(_set_id(s), packed(s)) for _, s in _sets_of(batch, words) if len(s)]
            yield pd.DataFrame(found, columns=["set_id", "shingles"])

    found = _only(docs.mapInPandas(sets, "set_id binary, shingles binary"), wanted.select("set_id"), "set_id")
    found = found.groupBy("set_id").agg(F.any_value("shingles").alias("shingles"))
    return written(wanted.join(found, "set_id").select("node", "shingles"), "ngram-sets")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def _alike(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) that may reach the threshold by their sketches."""
    left, right = (classes.select(
        F.col("node").alias(x), F.col("n").alias(f"{x}_n"), F.col("sketch").alias(f"{x}_sketch")
    ) for x in "ab")

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total = batch["a_n"] + batch["b_n"]
            most = total - 2 * -(-total * percent // (100 + percent))
            apart = [_differing(*sketches) for sketches in zip(batch["a_sketch"], batch["b_sketch"])]
            yield batch.loc[np.array(apart, dtype=np.int64) <= most.to_numpy(), ["a", "b"]]

    joined = pairs.join(left, "a").join(right, "b")
    return joined.mapInPandas(close, "a bigint, b bigint")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) of classes whose sets reach the threshold exactly."""
    left, right = (sets.toDF(x, f"{x}_set") for x in "ab")

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = []
            for a, b in zip(batch["a_set"], batch["b_set"]):
                a, b = unpacked(a), unpacked(b)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                good.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield batch.loc[good, ["a", "b"]]

    joined = pairs.join(left, "a").join(right, "b")
    return written(joined.mapInPandas(reach, "a bigint, b bigint"), "ngram-links")


def _joined(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components of the links and of those ``found`` before."""
    if found is not None:
        links = links.union(found.select(F.col("id").alias("a"), F.col("component").alias("b")))
    return written(components(links, "ngram"), "ngram-components")


def _apart(shared: DataFrame, found: DataFrame, crowds: DataFrame | None = None) -> DataFrame:
    """Postings with their ``component``, of lists that hold more than one, and the
    ``largest`` component of each list; ``crowded`` is how many of the node's other lists
    are long, as ``crowds`` counts them."""
    marks = found.toDF("node", "component")
    if crowds is None:
        marks = marks.withColumn("crowded", F.lit(0).cast("bigint"))
    else:
        marks = written(marks.join(crowds, "node", "full"), "ngram-marks")
    listed = shared.join(marks, "node", "left").withColumns({
        "component": F.coalesce("component", "node"), "crowded": F.coalesce("crowded", F.lit(0).cast("bigint")),
    })
    listed = written(listed, "ngram-listed")
    sizes = listed.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("shingle").agg(
        F.max(F.struct("size", "component")).alias("top"), F.count(F.lit(1)).alias("kinds")
    ).filter("kinds > 1").select("shingle", F.col("top.component").alias("largest"))
    return written(listed.join(written(largest, "ngram-largest"), "shingle"), "ngram-apart")


def _star_pairs(apart: DataFrame, turn: int, percent: int) -> DataFrame:
    """Members of each list with ``DRAWS`` members of its largest component; ones that
    meet in several lists and have matching sizes."""
    drawn = [
        F.min(F.when(F.expr("component = largest"), F.struct(
            F.xxhash64("node", F.lit(turn * DRAWS + i)).alias("h"),
            F.col("node").alias("other"), F.col("n").alias("size"),
        ))).alias(f"draw{i}") for i in range(DRAWS)
    ]
    first = apart.groupBy("shingle").agg(*drawn)
    first = first.select("shingle", F.explode(F.array_distinct(F.array(*[f"draw{i}" for i in range(DRAWS)]))).alias("r"))
    first = written(first.select("shingle", "r.other", "r.size"), "ngram-first")
    outside = apart.filter("component <> largest") if turn else apart
    met = outside.join(first, "shingle").filter(
        f"node <> other AND least(n, size) * 100 >= greatest(n, size) * {percent}"
    )
    prefix = F.least("n", "size") - F.ceil(F.least("n", "size") * percent / 100) + 1
    pairs = met.groupBy(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).agg(
        F.count(F.lit(1)).alias("met"), F.max(prefix).alias("prefix")
    )
    return pairs.filter(F.col("met") >= F.least("prefix", F.lit(STAR_MATCHES))).select("a", "b")


def _remaining_pairs(apart: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that share enough prefix shingles.  A pair that
    reaches the threshold overlaps by so much, of which no more lies beyond the prefixes
    than is left there."""
    long = apart.filter(F.col("met") > BLOCK)
    if long.isEmpty():
        return _pairs_of_lists(apart, percent)
    sizes = long.groupBy("shingle").agg(
        F.count_if(F.expr("early AND component <> largest")).alias("outside"),
        F.count_if(F.expr("early AND component = largest")).alias("inside"),
    )
    dealt = written(long.filter("early").join(written(sizes, "ngram-crowded"), "shingle"), "ngram-dealt")
    of_blocks = _pairs_of_blocks(dealt, classes, percent)
    return _pairs_of_lists(apart.filter(F.col("met") <= BLOCK), percent).union(of_blocks).distinct()


def _pairs_of_lists(apart: DataFrame, percent: int) -> DataFrame:
    """In each list, members of smaller components meet all others.  ``crowded`` is how many
    shingles of a prefix are in other lists, all of which may be shared."""
    x, y = apart.filter("component <> largest").alias("x"), apart.alias("y")
    joined = x.join(y, F.expr(
        "x.shingle = y.shingle AND x.component <> y.component"
        " AND (y.component = y.largest OR x.node < y.node)"
        f" AND least(x.n, y.n) * 100 >= greatest(x.n, y.n) * {percent}"
    ))
    overlap = f"ceil((x.n + y.n) * {percent} / {100 + percent})"
    pairs = joined.select(
        F.expr("least(x.node, y.node)").alias("a"), F.expr("greatest(x.node, y.node)").alias("b"),
        F.expr(f"{overlap} - greatest(x.n - x.length, y.n - y.length) - least(x.crowded, y.crowded)").alias("need"),
    )
    pairs = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("met"), F.any_value("need").alias("need"))
    return pairs.filter("met >= need").select("a", "b")


def _pairs_of_blocks(dealt: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The same for long lists: a list's largest component and all others are dealt to
    blocks by hash, and each block of others meets every block, prefixes in hand."""
    outside, inside = (F.ceil(F.greatest(name, F.lit(1)) / BLOCK) for name in ("outside", "inside"))
    hashed, other = F.xxhash64("node"), F.expr("component <> largest")
    dealt = dealt.drop("met").withColumns({
        "own": F.when(other, F.pmod(hashed, outside)).otherwise(outside + F.pmod(hashed, inside)),
        "met": F.explode(F.sequence(F.lit(0).cast("bigint"), F.when(other, outside + inside).otherwise(outside) - 1)),
    })
    dealt = dealt.join(classes.select("node", "prefix"), "node")

    def compared(key: tuple[Any, ...], group: pd.DataFrame) -> pd.DataFrame:
        _, left, right = key
        x, y = group[group["own"] == left], group[group["own"] == right]
        good = _shared(list(x["prefix"]), list(y["prefix"]))
        (a, a_n, a_length, a_part), (b, b_n, b_length, b_part) = (
            [side[name].to_numpy() for name in ("node", "n", "length", "component")] for side in (x, y)
        )
        a, a_n, a_length, a_part = (column[:, None] for column in (a, a_n, a_length, a_part))
        overlap = -(-(a_n + b_n) * percent // (100 + percent))
        good = good >= overlap - np.maximum(a_n - a_length, b_n - b_length)
        good &= (a_part != b_part) & (np.minimum(a_n, b_n) * 100 >= np.maximum(a_n, b_n) * percent)
        a, b = np.broadcast_arrays(a, b)
        a, b = a[good], b[good]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

    blocks = dealt.groupBy("shingle", F.least("own", "met").alias("left"), F.greatest("own", "met").alias("right"))
    return blocks.applyInPandas(compared, "a bigint, b bigint")


def _shared(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """How many shingles each of ``left`` has in common with each of ``right``."""
    met = np.zeros((len(left), len(right)), dtype=np.float32)
    sides = []
    for packs in (left, right):
        holder = np.repeat(np.arange(len(packs)), [len(p) // 6 for p in packs])
        sides.append((unpacked(b"".join(packs)), holder))
    common = np.intersect1d(sides[0][0], sides[1][0])
    for at in range(0, len(common), TOKENS_AT_ONCE):
        some = common[at : at + TOKENS_AT_ONCE]
        held = []
        for packs, (tokens, holder) in zip((left, right), sides):
            place = np.minimum(np.searchsorted(some, tokens), len(some) - 1)
            hit = some[place] == tokens
            has = np.zeros((len(packs), len(some)), dtype=np.float32)
            has[holder[hit], place[hit]] = 1
            held.append(has)
        met += held[0] @ held[1].T
    return met


def _placed(docs: DataFrame, words: int, percent: int, rounds: int) -> DataFrame:
    """``doc_id``, ``body`` (hash of the text), ``n`` and ``component`` of every row."""
    workers_find_package(docs.sparkSession)
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"), F.xxhash64(whole_text()).alias("body")
    )
    rows, classes = _classes(texts, words, percent)
    postings = _postings(classes, percent)
    met = F.count(F.lit(1)).over(Window.partitionBy("shingle"))
    shared = written(postings.withColumn("met", met).filter("met > 1"), "ngram-postings")
    found = sets = None
    long_lists = written(shared.filter(F.col("met") >= LONG_LIST), "ngram-long-lists")
    for turn in range(rounds):
        if found is None:
            apart = long_lists.withColumns({"component": F.col("node"), "largest": F.col("node")})
        else:
            apart = _apart(long_lists, found)
        pairs = written(_alike(_star_pairs(apart, turn, percent), classes, percent), "ngram-pairs")
        more = _sets(texts, classes, _ends(pairs) if sets is None else _ends(pairs).join(sets, "node", "left_anti"), words)
        sets = more if sets is None else sets.union(more)
        found = _joined(found, _verified(pairs, sets, percent))
    crowds = shared.filter(F.col("met") > BLOCK).groupBy("node").agg(F.count(F.lit(1)).alias("crowded"))
    apart = _apart(shared, found, crowds)
    pairs = written(_alike(_remaining_pairs(apart, classes, percent), classes, percent), "ngram-pairs")
    sets = sets.union(_sets(texts, classes, _ends(pairs).join(sets, "node", "left_anti"), words))
    found = _joined(found, _verified(pairs, sets, percent))

    named = classes.select("set_id", "node").join(found.toDF("node", "component"), "node", "left")
    named = named.select("set_id", F.coalesce("component", "node").alias("component"))
    return written(rows.join(named, "set_id", "left").drop("set_id"), "ngram-placed")


def ngram_join(docs: DataFrame, words: int = 5, percent: int = 80, rounds: int = 2) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row: sets of ``words``-word
    shingles are linked from a Jaccard similarity of ``percent`` hundredths."""
    placed = _placed(docs, words, percent, rounds)
    smallest = placed.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return placed.join(written(smallest, "ngram-smallest"), "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, rounds: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps its smallest ``doc_id``
    (nulls last, then the smaller hash of the text), one row of equal ones."""
    placed = _placed(docs, words, percent, rounds).filter("component IS NOT NULL")
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "body")
    first = written(placed.groupBy("component").agg(F.min(key).alias("first")), "ngram-first")
    gone = placed.join(first, "component").filter(key != F.col("first"))
    gone = written(gone.select("doc_id", "body").distinct(), "ngram-gone").toDF("_doc_id", "_body")
    same = F.expr("CAST(doc_id AS bigint) <=> _doc_id AND xxhash64(coalesce(text, '')) = _body")
    kept = docs.join(gone, same, "left_anti")
    repeated = placed.groupBy("doc_id", "body").count().filter("count > 1").drop("count")
    repeated = written(repeated, "ngram-repeated").toDF("_doc_id", "_body")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, same, "left_anti").union(once)
