"""SpotSigs: document fingerprints from chains of content words after common words.

The most frequent short words of the collection are the anchors.  Each occurrence of an
anchor gives a signature: the anchor and the next ``chain`` words that are no anchors.
A document's fingerprint is the sorted set of its signatures' hashes; a document
without any uses its words instead.  Two fingerprints are compared by Jaccard
similarity, which cannot exceed the ratio of their lengths: with a threshold, pairs
whose lengths rule out a likeness are not intersected.  Pairs are given; there is no
search for likely ones and no partition by length.

Only Spark's own functions are used.  A null text is empty; the fingerprint of a text
without words is empty, and equal only to another empty one (likeness 1).  Repeated
rows are worked on row by row.
"""

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_strata.llm.common import whole_text

HEX_DIGITS = 12


def words_of(text: Column) -> Column:
    """Letters and digits in lower case, every word followed by one space."""
    return F.ltrim(F.regexp_replace(F.concat(F.lower(text), F.lit(" ")), r"[^\p{L}\p{N}]+", " "))


def common_words(docs: DataFrame, anchors: int = 32, longest: int = 5) -> list[str]:
    """The most frequent words of at most ``longest`` letters, over all documents."""
    short = rf"\b\p{{L}}{{1,{longest}}}\b"
    words = docs.select(F.explode(F.regexp_extract_all(words_of(whole_text()), F.lit(short), F.lit(0))).alias("word"))
    top = words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(anchors)
    return [row[0] for row in top.collect()]


def signatures(text: Column, anchors: list[str], chain: int = 2) -> Column:
    """Sorted distinct hashes of the signatures of a text."""
    words = words_of(text)
    everything = F.array_remove(F.split(words, " "), "")
    if anchors:
        named = "|".join(re.escape(a) for a in sorted(anchors, key=len, reverse=True))
        marked = F.regexp_replace(F.concat(F.lit(" "), words), rf" (?=(?:{named}) )", " ~")
        step = r" (?:~[^ ]++ )*+[^~ ][^ ]*+"
        first = r"[^ ]++" + step
        spots = F.regexp_extract_all(marked, F.lit(rf"~(?=({first}(?:{step}){{{chain - 1}}} ))"), F.lit(1))
        spots = F.transform(spots, lambda s: F.regexp_replace(s, " ~[^ ]+", ""))
        everything = F.when(F.size(spots) > 0, spots).otherwise(everything)
    return F.array_sort(F.array_distinct(F.transform(everything, lambda s: F.xxhash64(s))))


def fingerprint(found: Column) -> Column:
    """The set as text: low hex digits of each hash, in the set's order."""
    return F.array_join(F.transform(found, lambda h: F.right(F.lpad(F.hex(h), 16, "0"), F.lit(HEX_DIGITS))), "")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two sets; 0 without intersecting them where the lengths
    alone keep it below ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    exact = shared / (F.size(a) + F.size(b) - shared)
    return (
        F.when(large == 0, F.lit(1.0))
        .when((small == 0) | (small < large * least), F.lit(0.0))
        .otherwise(exact)
    )


def with_next(docs: DataFrame, key: str, carried: list[str], tie: str) -> DataFrame:
    """Rows with ``next``, the ``carried`` columns of the row after it in descending
    order of the key (nulls last, ties by descending ``tie``); the first follows the last.

    Keys are cut into many ranges, each ordered on its own.  The first row of a range is
    also put at the end of the range before it, so no range needs another's rows.
    """
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = docs.approxQuantile(key, [i / ranges for i in range(1, ranges)], 0.1 / ranges)
    bounds = sorted(set(bounds))
    in_range = F.size(F.filter(F.lit(bounds) if bounds else F.array().cast("array<double>"), lambda b: b <= F.col(key)))
    placed = docs.withColumn("_range", F.when(F.col(key).isNull(), -1).otherwise(in_range))
    heads = placed.groupBy("_range").agg(F.max(F.struct(
        F.col(key).alias("_key"), F.col(tie).alias("_tie"), *[F.col(c).alias(f"_{c}") for c in carried]
    )).alias("_head"))
    # One row per range: small enough for one task.
    order = Window.orderBy("_range")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = heads.select(
        F.coalesce(F.lead("_range").over(order), F.first("_range").over(everything)).alias("_range"),
        F.lit(True).alias("_end"),
        F.col("_head._key").alias(key), *[F.col(f"_head._{c}").alias(c) for c in carried],
    )
    both = placed.withColumn("_end", F.lit(False)).unionByName(ends, allowMissingColumns=True)
    after = Window.partitionBy("_range").orderBy("_end", F.desc_nulls_last(key), F.desc_nulls_last(tie))
    follower = F.lead(F.struct(*carried)).over(after)
    return both.withColumn("next", follower).filter(~F.col("_end")).drop("_end", "_range")
