"""Hard negatives by inner product, with coordinate pruning over length buckets.

Rows are sorted by label and length and cut into buckets.  A bucket holds, for every
coordinate, the list of its rows sorted by that coordinate of the unit vectors.  For an
anchor and a score to reach, the angle that is left to a row limits each coordinate of
it; the ranges of the anchor's ``focus`` largest coordinates are looked up in the sorted
lists and intersected, and what is left is scored in whole numbers.  Where the ranges
hold most of a bucket, the whole bucket is scored at once.

An anchor's positives are the best ``positives`` other rows of its label.  For each of
them the best ``negatives`` rows of other labels are wanted whose score is between
``low`` and ``high`` percent of the positive's.  Both searches look through a share of
the buckets first, which gives the scores to reach in the others; every other bucket is
then looked through for every anchor, dealt over (part of the anchors, part of the
buckets).  No pair of rows leaves a task but the few best of each anchor.

Rows take no part with a null label, a null or empty vector, a null component, or a
length of 2^30 or more (their scores may not fit a long).  Vectors of different size are
not compared.  Null ids come after all others among equal scores; repeated rows are rows
of their own, and repeated anchors are mined each; an empty table gives an empty one.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_strata.llm.common import workers_find_package, written

BUCKET_ROWS, BUCKET_VALUES = 4096, 1 << 18
ANCHORS_TOGETHER, BUCKETS_TOGETHER = 1024, 8
SLACK = 1e-9
BUCKET = (
    "bucket bigint, dim int, longest double, labels array<string>, codes binary, nodes binary, ids binary, "
    "unnamed binary, vectors binary, orders binary"
)
ANCHOR = ["node", "id", "unnamed", "label", "dim", "vector"]


class Bucket:
    """Rows of like length with their sorted coordinate lists."""

    def __init__(self, row):
        self.labels = {label: code for code, label in enumerate(row.labels)}
        self.codes = np.frombuffer(row.codes, dtype=np.int32)
        self.nodes, self.ids = (np.frombuffer(x, dtype=np.int64) for x in (row.nodes, row.ids))
        self.unnamed = np.frombuffer(row.unnamed, dtype=np.uint8)
        self.vectors = np.frombuffer(row.vectors, dtype=np.int64).reshape(len(self.nodes), row.dim)
        self.orders = np.frombuffer(row.orders, dtype=np.int32).reshape(row.dim, len(self.nodes))
        self.dim, self.longest = row.dim, row.longest
        self.floats = self.vectors.astype(float)
        unit = self.floats / np.maximum(np.sqrt((self.floats**2).sum(axis=1, keepdims=True)), 1.0)
        self.unit = unit.T
        self.sorted = np.take_along_axis(self.unit, self.orders, axis=1)

    def candidates(self, anchor: np.ndarray, length: float, reach: int | None, focus: int) -> np.ndarray | None:
        """Rows that may score ``reach`` with the anchor; None for all of them."""
        if reach is None or reach <= 0 or length == 0:
            return None
        cosine = reach / (length * self.longest) if self.longest else np.inf
        if cosine > 1 + SLACK:
            return np.zeros(0, dtype=np.int64)
        unit = anchor / length
        at = np.argsort(-np.abs(unit), kind="stable")[:focus]
        angle, own = np.arccos(min(cosine, 1.0)), np.arccos(np.clip(unit[at], -1.0, 1.0))
        least = np.cos(np.minimum(own + angle, np.pi)) - SLACK
        most = np.cos(np.maximum(own - angle, 0.0)) + SLACK
        ranges = [
            (np.searchsorted(self.sorted[f], a, "left"), np.searchsorted(self.sorted[f], b, "right"))
            for f, a, b in zip(at, least, most)
        ]
        shortest = int(np.argmin([b - a for a, b in ranges]))
        first, end = ranges[shortest]
        if 2 * (end - first) > len(self.nodes):
            return None
        found = self.orders[at[shortest], first:end]
        for f, a, b in zip(at, least, most):
            values = self.unit[f, found]
            found = found[(values >= a) & (values <= b)]
        return found

    def scores(self, anchor: np.ndarray, length: float, rows: np.ndarray | None) -> np.ndarray:
        """Inner products in whole numbers; doubles hold them where they are small."""
        if length * self.longest < 1 << 52:
            chosen = self.floats if rows is None else self.floats[rows]
            return (chosen @ anchor.astype(float)).astype(np.int64)
        return (self.vectors if rows is None else self.vectors[rows]) @ anchor


def _best_first(scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> np.ndarray:
    return np.lexsort((ids, unnamed, -scores))


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Buckets of sorted rows of one size; a new label starts one if the last is not tiny."""
    held: list = []
    made = TaskContext.get().partitionId() << 32

    def bucket() -> pd.DataFrame:
        nonlocal made
        node, ident, unnamed, label, dim, length, vectors = zip(*held)
        vectors = np.array(vectors, dtype=np.int64)
        unit = vectors / np.maximum(np.sqrt((vectors.astype(float) ** 2).sum(axis=1, keepdims=True)), 1.0)
        labels = sorted(set(label))
        code = {one: i for i, one in enumerate(labels)}
        made += 1
        return pd.DataFrame([{
            "bucket": made, "dim": dim[0], "longest": max(length), "labels": labels,
            "codes": np.array([code[one] for one in label], dtype=np.int32).tobytes(),
            "nodes": np.array(node, dtype=np.int64).tobytes(), "ids": np.array(ident, dtype=np.int64).tobytes(),
            "unnamed": np.array(unnamed, dtype=np.uint8).tobytes(), "vectors": vectors.tobytes(),
            "orders": np.argsort(unit.T, axis=1, kind="stable").astype(np.int32).tobytes(),
        }])

    for batch in batches:
        for row in batch.itertuples(index=False):
            room = max(1, min(BUCKET_ROWS, BUCKET_VALUES // row.dim))
            if held and (
                row.dim != held[0][4] or len(held) >= room or (row.label != held[-1][3] and 8 * len(held) >= room)
            ):
                yield bucket()
                held = []
            held.append(tuple(row))
    if held:
        yield bucket()


def _usable(vectors: DataFrame) -> DataFrame:
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("anchor").alias("anchor"), F.col("vector").cast("array<bigint>").alias("vector"),
    )
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = rows.filter("label IS NOT NULL AND size(vector) > 0").withColumn("length", F.sqrt(square))
    rows = rows.filter((F.col("length") < float(1 << 30)) & F.forall("vector", lambda x: x.isNotNull()))
    return rows.select(
        F.monotonically_increasing_id().alias("node"), F.coalesce("vec_id", F.lit(0)).alias("id"),
        F.col("vec_id").isNull().alias("unnamed"), "label", F.size("vector").alias("dim"), "length", "vector",
        F.coalesce("anchor", F.lit(False)).alias("anchor"),
    )


def _searched(buckets: DataFrame, anchors: DataFrame, parts: list[int], chunks: int, work, kinds: str) -> DataFrame:
    """``work(buckets, anchors)`` for every part of the buckets and every chunk of the
    anchors.  Buckets carry their ``part``; anchors are repeated for each part named."""
    left = buckets.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = anchors.withColumn("chunk", F.pmod(F.xxhash64("node"), F.lit(chunks)).cast("int"))
    right = right.withColumn("part", F.explode(F.sequence(F.lit(parts[0]), F.lit(parts[-1]))))

    def group(found: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return work([Bucket(row) for row in found.sort_values("longest", ascending=False).itertuples()], asked)

    keys = ["part", "chunk"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(group, kinds)


def hard_negatives(
    vectors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, focus: int = 4
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and
    ``negative_score``.  ``vectors`` has ``vec_id``, ``label``, ``vector`` (whole numbers)
    and ``anchor`` (boolean); further columns are ignored."""
    spark = vectors.sparkSession
    workers_find_package(spark)
    rows = written(_usable(vectors), "negatives-rows")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["dim", "label", "length", "node"]
    dealt = rows.drop("anchor").repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    index = written(dealt.mapInPandas(_packed, BUCKET), "negatives-index")
    anchors = rows.filter("anchor").select(*ANCHOR)
    chunks = max(1, -(-anchors.count() // ANCHORS_TOGETHER))
    # Parts of a few buckets each; the first is looked through before the others.
    parts = max(2, -(-index.count() // BUCKETS_TOGETHER))
    index = index.withColumn("part", F.pmod(F.xxhash64("bucket"), F.lit(parts)).cast("int"))

    def both_rounds(anchors: DataFrame, work, kinds: str, reach, purpose: str) -> DataFrame:
        """The first part without a score to reach, the others with what it found."""
        first = written(_searched(index.filter("part = 0"), anchors, [0], chunks, work, kinds), f"{purpose}-first")
        asked = reach(first, anchors)
        rest = _searched(index.filter("part > 0"), asked, [1, parts - 1], chunks, work, kinds)
        return first.union(written(rest, f"{purpose}-rest"))

    # Positives.
    def best_of_label(buckets: list[Bucket], asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        for a in asked.itertuples():
            anchor = np.asarray(a.vector, dtype=np.int64)
            length = float(np.sqrt((anchor.astype(float) ** 2).sum()))
            reach = None if np.isnan(a.reach) else int(a.reach)
            best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0, np.int64))
            for b in buckets:
                code = b.labels.get(a.label)
                if code is None or b.dim != a.dim:
                    continue
                found = b.candidates(anchor, length, reach, focus)
                found = np.flatnonzero(b.codes == code) if found is None else found[b.codes[found] == code]
                found = found[b.nodes[found] != a.node]
                scores = b.scores(anchor, length, found)
                best = tuple(np.concatenate(pair) for pair in zip(best, (scores, b.ids[found], b.unnamed[found], b.nodes[found])))
                top = _best_first(*best[:3])[:positives]
                best = tuple(x[top] for x in best)
                if len(top) == positives:
                    reach = int(best[0][-1]) if reach is None else max(reach, int(best[0][-1]))
            out += [(a.node, *found) for found in zip(*best)]
        return pd.DataFrame(out, columns=["node", "score", "id", "unnamed", "other"]).astype({"unnamed": bool})

    found_kinds = "node bigint, score bigint, id bigint, unnamed boolean, other bigint"
    by_anchor = Window.partitionBy("node").orderBy(F.col("score").desc(), "unnamed", "id", "other")

    def reach_of_label(first: DataFrame, anchors: DataFrame) -> DataFrame:
        reached = first.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        reached = reached.filter(F.col("n") >= positives).select("node", F.col("least").cast("double").alias("found"))
        return anchors.drop("reach").join(reached, "node", "left").withColumnRenamed("found", "reach")

    asked = anchors.withColumn("reach", F.lit(None).cast("double"))
    found = both_rounds(asked, best_of_label, found_kinds, reach_of_label, "negatives-positives")
    chosen = found.withColumn("place", F.row_number().over(by_anchor)).filter(F.col("place") <= positives)
    chosen = written(chosen, "negatives-chosen")

    # Negatives: the scores of an anchor's positives are the windows its negatives lie in.
    windows = chosen.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("place", "score"))).alias("windows"))
    windows = windows.select("node", F.col("windows.place").alias("places"), F.col("windows.score").alias("scores"))

    def best_of_others(buckets: list[Bucket], asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        for a in asked.itertuples():
            anchor = np.asarray(a.vector, dtype=np.int64)
            length = float(np.sqrt((anchor.astype(float) ** 2).sum()))
            bounds = [(p, -(-low * s // 100), high * s // 100) for p, s in zip(a.places, map(int, a.scores))]
            bounds = [b for b in bounds if b[1] <= b[2]]
            reached = dict(zip(a.places, a.reaches))
            best: dict[int, tuple] = {}
            for b in buckets if bounds else []:
                if b.dim != a.dim:
                    continue
                at_least = [max(least, int(reached.get(p, least))) for p, least, _ in bounds]
                found = b.candidates(anchor, length, min(at_least), focus)
                found = np.arange(len(b.nodes)) if found is None else found
                own = b.labels.get(a.label)
                if own is not None:
                    found = found[b.codes[found] != own]
                scores = b.scores(anchor, length, found)
                kept = (scores >= min(at_least)) & (scores <= max(most for _, _, most in bounds))
                found, scores = found[kept], scores[kept]
                sort = _best_first(scores, b.ids[found], b.unnamed[found])
                found, scores = found[sort], scores[sort]
                for (place, _, most), least in zip(bounds, at_least):
                    start = np.searchsorted(-scores, -most, "left")
                    end = min(np.searchsorted(-scores, -least, "right"), start + negatives)
                    some = found[start:end]
                    if not len(some):
                        continue
                    new = (scores[start:end], b.ids[some], b.unnamed[some], b.nodes[some])
                    held = tuple(np.concatenate(pair) for pair in zip(best[place], new)) if place in best else new
                    top = _best_first(*held[:3])[:negatives]
                    best[place] = tuple(x[top] for x in held)
                    if len(top) == negatives:
                        reached[place] = max(least, int(best[place][0][-1]))
            out += [(a.node, place, *found) for place, held in best.items() for found in zip(*held)]
        names = ["node", "place", "score", "id", "unnamed", "other"]
        return pd.DataFrame(out, columns=names).astype({"unnamed": bool, "place": "int32"})

    def reach_of_others(first: DataFrame, anchors: DataFrame) -> DataFrame:
        reached = first.groupBy("node", "place").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        reached = reached.filter(F.col("n") >= negatives).groupBy("node").agg(
            F.map_from_entries(F.collect_list(F.struct("place", "least"))).alias("found")
        )
        joined = anchors.drop("reaches").join(reached, "node", "left")
        # Integer's least value where there is nothing to reach yet.
        found = F.transform("places", lambda p: F.coalesce(F.col("found")[p], F.lit(-(1 << 62))))
        return joined.withColumn("reaches", found).drop("found")

    asked = anchors.join(windows, "node").withColumn(
        "reaches", F.transform("places", lambda p: F.lit(-(1 << 62)).cast("bigint"))
    )
    mined_kinds = "node bigint, place int, score bigint, id bigint, unnamed boolean, other bigint"
    mined = both_rounds(asked, best_of_others, mined_kinds, reach_of_others, "negatives-mined")
    by_window = Window.partitionBy("node", "place").orderBy(F.col("score").desc(), "unnamed", "id", "other")
    mined = mined.withColumn("rank", F.row_number().over(by_window)).filter(F.col("rank") <= negatives)

    def named(prefix: str):
        return F.when(~F.col(f"{prefix}_unnamed"), F.col(f"{prefix}_key"))

    positive = chosen.select(
        "node", "place", F.col("id").alias("positive_key"), F.col("unnamed").alias("positive_unnamed"),
        F.col("score").alias("positive_score"),
    )
    own = anchors.select("node", F.col("id").alias("anchor_key"), F.col("unnamed").alias("anchor_unnamed"))
    negative = mined.select(
        "node", "place", "rank", F.col("id").alias("negative_key"), F.col("unnamed").alias("negative_unnamed"),
        F.col("score").alias("negative_score"),
    )
    return negative.join(positive, ["node", "place"]).join(own, "node").select(
        named("anchor").alias("anchor_id"), named("positive").alias("positive_id"), "rank",
        named("negative").alias("negative_id"), "positive_score", "negative_score",
    )
