"""Mixing sources to target weights by pivotal dependent rounding.

Sources stand in code-point order, null last, and have ``weights`` in turn.  They share
the size of all documents by weight; a target stops at ``most`` times its source's size
and the excess is shared again, which comes to one level: target = min(cap, level * weight).

A document is to be taken ``target / source size`` times: a whole number of times, and
once more with the fraction that is left.  The fractions of two documents are rounded
together: words go from one to the other, at random, until one of them has its whole
copy or none, so that the words taken of the two together stay what they were.  A task
rounds one bucket of a source from its longest to its shortest document and is left with
at most one open fraction.  Those of ``FAN`` buckets at a time are rounded together in
the next round, and so on up a tree, until one a source is left, which goes to the
nearer side: a source misses its target by less than one document.

Rows with equal id, source and text are one class with a number of members, so a
document repeated a billion times is one row here.  Buckets and random numbers follow
from what a class holds, so reruns agree, whatever the partitions.

A null text has no words; null sources are one source; null ids are kept; documents
without words take nothing; an empty table gives an empty one; other columns are left out.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_strata.llm.common import whole_text, workers_find_package, written
from retail_strata.operators.hot_keys import SLICE, left_join_unique, slices_of

# Fixed value: what a word is.
WORD = r"[^\x20\x09-\x0D]+"
FAN = 64
CHUNK = 65_536
OPEN = "source_no bigint, node bigint, bucket bigint, id bigint, size bigint, print bigint, share double"


def settle(sizes: np.ndarray, shares: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Rounds shares to 0 or 1, in the given order, all but one at most.  The sum of
    size times share stays, and every share stays what it is on average."""
    shares = shares.astype(float).tolist()
    open_at = -1
    for i, (size, draw) in enumerate(zip(sizes.tolist(), draws.tolist())):
        if not 0.0 < shares[i] < 1.0:
            continue
        if size == 0:
            shares[i] = float(draw < shares[i])
            continue
        if open_at < 0:
            open_at = i
            continue
        p, q, ratio = shares[open_at], shares[i], size / sizes[open_at]
        up, down = min(1.0 - p, q * ratio), min(p, (1.0 - q) * ratio)
        if draw * (up + down) < down:
            p, q = (1.0, q - up / ratio) if up == 1.0 - p else (p + up, 0.0)
        else:
            p, q = (0.0, q + down / ratio) if down == p else (p - down, 1.0)
        p, q = (round(x) if min(abs(x), abs(1.0 - x)) < 1e-12 else x for x in (p, q))
        shares[open_at], shares[i] = p, q
        if not 0.0 < p < 1.0:
            open_at = i if 0.0 < q < 1.0 else -1
    return np.array(shares, dtype=float)


def _rounded(group: pd.DataFrame, last: bool) -> pd.DataFrame:
    """One group with its shares settled, longest documents first; where it is the
    ``last`` of its source, the share left open goes to the nearer side."""
    group = group.sort_values(["size", "id", "print"], ascending=[False, True, True], kind="stable")
    shares = settle(group["size"].to_numpy(), group["share"].to_numpy(), group["draw"].to_numpy())
    return group.assign(share=np.where(shares < 0.5, 0.0, 1.0) if last else shares)


def _draw(seed: int) -> Column:
    """A number from 0 to 1 that follows from the class."""
    return F.pmod(F.xxhash64(F.lit(seed), "source_no", "id", "size", "print"), F.lit(1 << 53)) / F.lit(float(1 << 53))


def classes_of(docs: DataFrame) -> DataFrame:
    """One row per distinct (doc_id, source, text) with its size and members."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.regexp_count(whole_text(), F.lit(WORD)).cast("bigint").alias("size"),
        F.xxhash64(whole_text()).alias("print"),
    )
    return rows.groupBy("doc_id", "source", "size", "print").agg(F.count(F.lit(1)).alias("members"))


def source_targets(classes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """``source``, its place ``source_no``, size, weight, classes and target.

    Places are counted within ranges of the sorted sources and offset by the ranges
    before; the level is found by rounds of one aggregate.  Sources are never gathered.
    """
    spark = classes.sparkSession
    sources = classes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("members")).alias("source_size"), F.count(F.lit(1)).alias("classes")
    )
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = sources.repartitionByRange(ranges, F.col("source").isNull(), "source")
    ordered = written(ordered.withColumn("range", F.spark_partition_id()), "mix-sources")
    lengths = ordered.groupBy("range").agg(F.count(F.lit(1)).alias("length"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = lengths.select("range", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last()))
    placed = ordered.withColumn("within", within).join(offsets, "range")
    number = F.col("offset") + F.col("within") - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (number % len(weights)).cast("int") + 1)
    placed = placed.select(
        "source", number.alias("source_no"), "source_size", "classes", weight.cast("bigint").alias("weight"),
        (F.col("source_size") * most).alias("cap"),
    )
    placed = written(placed, "mix-places")
    total, level = placed.agg(F.sum("source_size")).first()[0] or 0, 0.0
    full, open_weight = 0, placed.agg(F.sum("weight")).first()[0] or 0
    while open_weight:
        higher = (total - full) / open_weight
        if higher <= level:
            break
        level = higher
        is_full = F.col("cap") < F.col("weight") * F.lit(level)
        full, open_weight = placed.agg(
            F.coalesce(F.sum(F.when(is_full, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~is_full, F.col("weight"))), F.lit(0)),
        ).first()
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level))
    return placed.withColumn("target", target).drop("cap")


def _round(last: bool):
    """One node of the tree: the open shares of its buckets settled together."""
    names = [field.split(" ")[0] for field in OPEN.split(", ")]

    def together(group: pd.DataFrame) -> pd.DataFrame:
        return _rounded(group, last)[names]

    return together


def _tree(first: DataFrame, largest: int, seed: int) -> DataFrame:
    """``source_no``, ``bucket`` and ``share`` of the open classes, one a bucket, settled
    in rounds of ``FAN`` buckets each; every round is a written table."""
    done, nodes = [], largest
    level, waiting = 0, first
    while True:
        level, nodes = level + 1, -(-nodes // FAN)
        last = nodes <= 1
        placed = waiting.withColumn("node", F.expr(f"node div {FAN}")).withColumn("draw", _draw(seed + level))
        rounded = placed.groupBy("source_no", "node").applyInPandas(_round(last), OPEN)
        rounded = written(rounded, f"mix-round-{level}")
        done.append(rounded.filter("share = 0 OR share = 1"))
        if last:
            break
        waiting = rounded.filter("share > 0 AND share < 1")
    settled = done[0]
    for more in done[1:]:
        settled = settled.union(more)
    return settled.select("source_no", "bucket", "share")


def mixed_classes(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 13,
    bucket_classes: int = 4_096,
) -> DataFrame:
    """Classes with ``copies`` of every member and how many have one ``more``."""
    spark = docs.sparkSession
    workers_find_package(spark)
    classes = written(classes_of(docs), "mix-classes")
    targets = written(source_targets(classes, weights, most), "mix-targets")
    key = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source"))
    slices = slices_of(classes)
    counted, largest = targets.agg(F.sum("classes"), F.max("classes")).first()
    if not counted:
        largest = counted = 0
    # Fewer than ``slices`` sources can hold more than one slice's share of the classes.
    hot = [r[0] for r in targets.filter(F.col("classes") * slices > counted).select(key).collect()]
    facts = targets.select(
        key.alias("source_key"), "source_no", "source_size", "target",
        F.greatest(F.ceil(F.col("classes") / bucket_classes), F.lit(1)).alias("buckets"),
    )
    joined = left_join_unique(classes.withColumn("source_key", key), facts, "source_key", hot, slices).drop(SLICE)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = joined.withColumn("rate", rate).withColumn("copies", F.floor("rate"))
    # Of m members with the same fraction, its whole multiple is settled; one stays open.
    more = F.col("members") * (F.col("rate") - F.col("copies"))
    joined = joined.select(
        "source", "source_no", "source_size", "target", "buckets", "size", "print", "members", "copies",
        F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("unnamed"),
        F.floor(more).alias("more"), (more - F.floor(more)).alias("share"),
        F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size", "print"), F.col("buckets")).alias("bucket"),
    ).withColumn("draw", _draw(seed))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.schema.fields if f.name != "draw")
    names = [f.name for f in joined.schema.fields if f.name != "draw"]

    def rounded(group: pd.DataFrame) -> pd.DataFrame:
        return _rounded(group, last=bool(group["buckets"].iloc[0] == 1))[names]

    first = written(joined.groupBy("source_no", "bucket").applyInPandas(rounded, kinds), "mix-first-round")
    settled = first
    if largest > bucket_classes:
        is_open = "share > 0 AND share < 1"
        waiting = first.filter(is_open).withColumn("node", F.col("bucket"))
        waiting = waiting.select("source_no", "node", "bucket", "id", "size", "print", "share")
        ends = _tree(waiting, -(-largest // bucket_classes), seed)
        late = first.filter(is_open).drop("share").join(ends, ["source_no", "bucket"])
        settled = first.filter(f"NOT ({is_open})").unionByName(late)
    return settled.select(
        F.when(~F.col("unnamed"), F.col("id")).alias("doc_id"), "source", "size", "print", "source_size", "target",
        "members", "copies", (F.col("more") + F.col("share").cast("bigint")).alias("more"),
    )


def _each(classes: DataFrame, number: str, name: str) -> DataFrame:
    """One row for 1 .. ``number`` of each class, dealt out in pieces where there are many."""
    few = classes.filter(f"{number} <= {CHUNK}").withColumn(name, F.expr(f"explode(sequence(1L, {number}))"))
    many = classes.filter(f"{number} > {CHUNK}")
    many = many.withColumn("_piece", F.expr(f"explode(sequence(0L, ({number} - 1) div {CHUNK}))"))
    many = many.repartition("_piece", "print").withColumn(
        name, F.expr(f"explode(sequence(_piece * {CHUNK} + 1L, least((_piece + 1L) * {CHUNK}, {number})))")
    )
    return few.unionByName(many.drop("_piece"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and
    ``taken`` (words) of every document; options as in ``mixed_classes``."""
    classes = written(mixed_classes(docs, **options).filter("members > 0"), "mix-settled")
    copies = F.col("copies") + (F.col("member") <= F.col("more")).cast("bigint")
    return _each(classes, "members", "member").select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: ``doc_id``, ``source`` and ``text``, once for every copy."""
    classes = written(mixed_classes(docs, **options), "mix-settled")
    key = ["doc_id", "source", "size", "print"]
    total = classes.select(*key, (F.col("members") * F.col("copies") + F.col("more")).alias("total"))
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), "text",
        F.regexp_count(whole_text(), F.lit(WORD)).cast("bigint").alias("size"), F.xxhash64(whole_text()).alias("print"),
    )
    texts = texts.groupBy(*key).agg(F.max("text").alias("text"))
    same = [texts[c].eqNullSafe(total[c]) for c in key]
    wanted = texts.join(total.filter("total > 0"), same).select(*[texts[c] for c in key], "text", "total")
    return _each(wanted, "total", "copy").select("doc_id", "source", "text")
