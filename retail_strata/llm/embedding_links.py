"""Embedding near-duplicates by a pivot-permutation index.

A bounded sample of the vectors are the pivots.  Every vector is described by its
``nearest`` pivots in order.  Vectors of one label that share at least ``shared`` pivots
are compared by cosine in double precision; a pair is compared in the list of its first
shared pivot only, so a vector stands in the inverted lists of those of its pivots after
which enough others are left to be shared.

Rows with equal label and vector are one class.  A list is cut into parts of bounded
size and its parts are compared pairwise, each pair of parts being a task's group: a
vector is dealt out once a list and part.  Inside a group a ``block`` of vectors meets a
block at a time, so that the matrices of pairs are bounded as well.  A group returns, for
each of its vectors, how many links it found and one link to the head of its own
component there: never the pairs themselves.

Vectors that are null, empty, zero or hold null or non-finite parts, and rows without a
label, are linked with nothing.  Vectors of different length are not compared.  A
component's id is its smallest ``vec_id`` that is not null.  Repeated rows count as
links of each other; an empty table gives an empty one.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.llm.common import workers_find_package, written
from retail_strata.llm.components import components


def _unit(vectors: np.ndarray) -> np.ndarray:
    """By the largest part first, so that no square overflows or vanishes."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


BLOCKS_A_PART = 16


def _put_together(head: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the components of each pair of places; ``head`` has the first place of the
    component of every place, before and afterwards."""
    while True:
        a, b = head[a], head[b]
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(head, np.maximum(a, b), np.minimum(a, b))
        while (head[head] != head).any():
            head[:] = head[head]


def _spans(start: int, end: int, block: int) -> list[slice]:
    return [slice(a, min(a + block, end)) for a in range(start, end, block)]


def embedding_links(
    vectors: DataFrame, threshold: float = 0.93, pivots: int = 64, nearest: int = 8,
    shared: int = 3, block: int = 256,
) -> DataFrame:
    """``vec_id``, ``n_links`` (rows linked directly) and ``component_id`` of every row."""
    spark = vectors.sparkSession
    workers_find_package(spark)
    kind = vectors.select("embedding").schema[0].dataType.simpleString()
    exact = "f4" if kind == "array<float>" else "f8"  # holds the numbers of a vector as they are
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & finite & some, F.lit(False))
    rows = rows.withColumn("vector", F.when(usable, F.col("vector")))
    classes = rows.filter("vector IS NOT NULL").groupBy("label", "vector").agg(F.count(F.lit(1)).alias("size"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "embedding-classes")
    # The sample is of a fixed number of vectors, the same ones on every run.
    drawn = classes.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(pivots).collect()
    points: dict[int, np.ndarray] = {}
    for (vector,) in drawn:
        points.setdefault(len(vector), []).append(vector)
    points = {size: _unit(np.array(found)) for size, found in points.items()}

    def described(batches):
        for batch in batches:
            for size, part in batch.groupby(batch["vector"].map(len)):
                part = part.copy()
                unit = _unit(np.array(part["vector"].tolist(), dtype=float))
                near = points.get(size, np.zeros((1, size)))  # no pivot of this length: one list for all
                order = np.argsort(-(unit @ near.T), axis=1, kind="stable")[:, :nearest]
                vectors = part.pop("vector")
                yield part.assign(
                    label=part["label"] + f"/{size}", permutation=list(order.astype(np.int32)),
                    packed=[np.array(v, dtype=exact).tobytes() for v in vectors],
                )

    kinds = "label string, size bigint, node bigint, permutation array<int>, packed binary"
    described_rows = written(classes.select("label", "vector", "size", "node").mapInPandas(described, kinds), "embedding-index")
    needed = F.least(F.lit(shared), F.size("permutation"))
    first = F.slice(F.sort_array("permutation"), F.lit(1), F.size("permutation") - needed + 1)
    lists = described_rows.withColumn("pivot", F.explode(first))
    sizes = lists.groupBy("label", "pivot").agg(F.count(F.lit(1)).alias("members"))
    many = block * BLOCKS_A_PART
    sizes = written(sizes.withColumn("parts", F.ceil(F.col("members") / many).cast("int")), "embedding-lists")
    cut = lists.join(sizes, ["label", "pivot"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    # Every pair of parts of a list, a part with itself included, is one group.
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.select(
        "label", "pivot", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "own", "node", "size", "permutation", "packed",
    )

    def compared(key, group: pd.DataFrame) -> pd.DataFrame:
        _, pivot, i, j = key
        group = group.sort_values(["own", "node"])
        n, node, size = len(group), group["node"].to_numpy(), group["size"].to_numpy()
        unit = np.frombuffer(b"".join(group["packed"]), dtype=exact).reshape(n, -1)
        unit = _unit(unit.astype(float))
        order = np.array(group["permutation"].tolist())
        holds = np.zeros((n, max(pivots, 1)), dtype=np.float32)
        np.put_along_axis(holds, order, 1.0, axis=1)
        earlier = np.ascontiguousarray(holds[:, : int(pivot)])
        least = min(shared, order.shape[1])
        if i == j:
            spans = _spans(0, n, block)
            tiles = [(x, y) for at, x in enumerate(spans) for y in spans[at:]]
        else:
            middle = int((group["own"] == i).sum())
            tiles = [(x, y) for x in _spans(0, middle, block) for y in _spans(middle, n, block)]
        links, head = np.zeros(n, dtype=np.int64), np.arange(n)
        for x, y in tiles:
            candidate = holds[x] @ holds[y].T >= least
            candidate &= earlier[x] @ earlier[y].T == 0  # else an earlier list compares the pair
            if x == y:
                candidate = np.triu(candidate, 1)
            if candidate.any():
                linked = candidate & (unit[x] @ unit[y].T >= threshold)
                a, b = np.nonzero(linked)
                if len(a):
                    links[x] += linked @ size[y]
                    links[y] += size[x] @ linked
                    _put_together(head, a + x.start, b + y.start)
        found = links > 0
        return pd.DataFrame({"node": node[found], "links": links[found], "head": node[head][found]})

    found = met.groupBy("label", "pivot", "i", "j").applyInPandas(compared, "node bigint, links bigint, head bigint")
    found = written(found, "embedding-found")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = components(found.select(F.col("node").alias("a"), F.col("head").alias("b")), "embedding")
    known = classes.join(counts, "node", "left").join(named.toDF("node", "component"), "node", "left")
    known = known.select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component"),
    )
    placed = written(rows.join(known, ["label", "vector"], "left"), "embedding-placed")
    smallest = placed.filter("component IS NOT NULL").groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return placed.join(written(smallest, "embedding-smallest"), "component", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
