"""Secrets in texts: fixed patterns, and strings that look drawn at random.

Two character Markov models, of random strings and of ordinary identifiers, give the
logarithm of a likelihood ratio for every pair of neighbouring characters.  They are
trained from labelled samples: the values that the fixed patterns find, and the other
words of the same texts.  What fixed patterns leave of a run of key characters is a
secret as a whole if its mean ratio per pair reaches a threshold.  If not, its stretches
of ``LEAST`` characters and more that do are: each goes from where the sum of ratios above
the threshold leaves zero to its highest point, and ends when the sum is back at zero or
has fallen by ``DROP``.  Pairs with a separator, which ordinary words do not have, count
as a ratio of zero there.

Only Spark's own functions are used.  A null text is empty and has no span; a run of
digits alone, or a stretch without a letter, is no secret; equal rows give equal results; with no text to learn from
only the fixed patterns find anything.  Positions are code points, end exclusive.
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_strata.functions import quoted
from retail_strata.llm.common import whole_text

# The patterns of the base kinds, in the order in which they are listed.
# For the last two, a longer least length and starting at a run's start find the same
# runs as a check afterwards.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (("assign", ASSIGN, 8), ("access", r"AKIA[A-Z0-9]{12,}", 0), ("hex", r"(?<![0-9a-f])[0-9a-f]{32,}+", 0))
KINDS = ("assign", "access", "hex", "random")

KEY_RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")  # in any text that ASSIGN matches
WORD = r"[A-Za-z][A-Za-z0-9_]{3,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
LEAST = 16
DROP = 10.0
STEP = 256
SHARE_STEPS = 1_000_000


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once: lambdas are interpreted, and work out
    whatever expression they hold again for every element and at every mention."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _before(lengths: Column) -> Column:
    """Sum of the earlier lengths for each place of an array, in two levels, so that an
    array of n costs n times ``STEP`` rather than n times n.  ``lengths`` is mentioned in
    lambdas: a column or a lambda's own variable."""
    add = lambda total, x: total + x
    zero = F.lit(0).cast("bigint")
    n = F.size(lengths)
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(n / STEP).cast("int") - 1, F.lit(0))),
        lambda b: F.aggregate(F.slice(lengths, b * STEP + 1, F.lit(STEP)), zero, add),
    )

    def sums(earlier: Column) -> Column:
        def at(i: Column) -> Column:
            b = F.floor(i / STEP).cast("int")
            return F.get(earlier, b) + F.aggregate(F.slice(lengths, b * STEP + 1, i - b * STEP), zero, add)

        return F.transform(F.sequence(F.lit(0), n - 1), at)

    earlier = _once(blocks, lambda found: F.transform(
        F.sequence(F.lit(0), F.size(found) - 1), lambda b: F.aggregate(F.slice(found, F.lit(1), b), zero, add)
    ))
    return F.when(n > 0, _once(earlier, sums)).otherwise(F.array().cast("array<bigint>"))


SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string,value:string>"


def _spans(text: Column, pattern: str, rank: int, least: int, group: int = 0, only: Column | None = None) -> Column:
    """Spans of the matches of a pattern whose value (a group) is long enough.  ``only``
    is a cheaper condition without which there is no match."""
    none = F.array().cast(f"array<{SPAN}>")

    def kept(whole: Column) -> Column:
        value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
        gaps = F.split(text, pattern, -1)
        # Gap, match, gap, match, ...: the end of match i lies after gaps and matches up to i.
        through = F.zip_with(gaps, whole, lambda g, m: (F.length(g) + F.coalesce(F.length(m), F.lit(0))).cast("bigint"))
        made = _once(through, lambda here: F.transform(
            F.arrays_zip(_before(here).alias("before"), here.alias("here"), whole.alias("match"), value.alias("value")),
            lambda x: F.struct(
                (x["before"] + x["here"] - F.length(x["match"])).alias("start"), F.lit(rank).alias("rank"),
                (x["before"] + x["here"]).alias("end"), F.lit(KINDS[rank]).alias("kind"), x["value"].alias("value"),
            ),
        ))
        spans = F.filter(made, lambda s: s["value"].isNotNull() & (F.length(s["value"]) >= least))
        return F.when(F.size(whole) > 0, spans).otherwise(none)

    found = _once(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), kept)
    return found if only is None else F.when(only, found).otherwise(none)


def base_spans(text: Column) -> list[Column]:
    """Spans of each base kind."""
    low = F.lower(text)
    keyword = reduce(lambda a, b: a | b, [F.contains(low, F.lit(k)) for k in KEYWORDS])
    only = (keyword, F.contains(text, F.lit("AKIA")), None)
    return [
        _spans(text, pattern, i, least, 2 if least else 0, condition)
        for i, ((_, pattern, least), condition) in enumerate(zip(BASE, only))
    ]


RESULTS = ["assign", "access", "hex", "spans"]


@dataclass(frozen=True)
class SecretModel:
    """Log-likelihood ratio of each pair of characters, by the second's place in the
    alphabet after the first's; empty if there was nothing to learn from."""

    ratios: tuple[float, ...]
    threshold: float = 1.0


def _pairs(strings: Column) -> Column:
    """Neighbouring characters of every string of an array."""
    inner = lambda s: F.transform(
        F.sequence(F.lit(1), F.length(s) - 1), lambda i: F.substring(s, i, F.lit(2))
    )
    return F.flatten(F.transform(F.filter(strings, lambda s: F.length(s).between(2, 4096)), inner))


def train_secrets(docs: DataFrame, sample_docs: int = 4000, threshold: float = 1.0) -> SecretModel:
    """Train on about ``sample_docs`` documents, chosen by a hash of their text.  What
    reaches the driver is one count per pair of characters and label."""
    total = docs.count()
    share = int(SHARE_STEPS * min(1.0, sample_docs / max(total, 1)))
    hashed = F.pmod(F.xxhash64("body"), F.lit(SHARE_STEPS))
    texts = docs.select(whole_text().alias("body")).filter(hashed < share)
    values = F.transform(F.concat(*base_spans(F.col("body"))), lambda s: s["value"])
    words = F.regexp_extract_all(F.col("body"), F.lit(WORD), F.lit(0))
    # Words that touch no found value; a found one stands in the text as it is.
    ordinary = F.filter(words, lambda w: F.length(w) < 32)
    labelled = texts.select(values.alias("values"), ordinary.alias("words"))
    sampled = labelled.select(F.explode(F.array(
        F.struct(F.lit(1).alias("random"), F.col("values").alias("strings")),
        F.struct(F.lit(0).alias("random"), F.when(F.size("values") == 0, F.col("words")).alias("strings")),
    )).alias("s")).select("s.*")
    pairs = sampled.select("random", F.explode(_pairs(F.col("strings"))).alias("pair"))
    counts = {(r[0], r[1]): r[2] for r in pairs.groupBy("random", "pair").count().collect()}
    if not counts:
        return SecretModel((), threshold)
    size = len(ALPHABET)
    # Unseen pairs: as likely as any for random strings; rarer for ordinary ones.
    table = {}
    for label, prior in ((1, 1.0), (0, 0.2)):
        for first in ALPHABET:
            seen = [counts.get((label, first + second), 0) + prior for second in ALPHABET]
            for second, n in zip(ALPHABET, seen):
                table[label, first, second] = log(n / sum(seen))
    return SecretModel(
        tuple(table[1, a, b] - table[0, a, b] for a in ALPHABET for b in ALPHABET[:size]), threshold
    )


PLACES = "array<struct<start:bigint,end:bigint>>"


def _parts(run: Column, fixed: Column) -> Column:
    """Places in the text of what base spans, by start, leave of a run."""
    place = lambda start, end: F.array(F.struct(start.alias("start"), end.alias("end")))
    left = F.aggregate(
        F.filter(fixed, lambda s: (s["start"] < run["end"]) & (run["start"] < s["end"])),
        F.struct(run["start"].alias("at"), F.array().cast(PLACES).alias("parts")),
        lambda state, s: F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(s["start"] > state["at"], F.concat(state["parts"], place(state["at"], s["start"])))
            .otherwise(state["parts"]).alias("parts"),
        ),
        lambda state: F.concat(state["parts"], place(state["at"], run["end"])),
    )
    return F.filter(left, lambda p: p["end"] - p["start"] >= LEAST)


def _random_places(string: Column, model: SecretModel) -> Column:
    """Places of the secrets in a string (a lambda's own variable) of key characters."""
    ratios, size = model.ratios, len(ALPHABET)
    plain = [c.isalnum() or c == "_" for c in ALPHABET]
    above = [
        (r if plain[i // size] and plain[i % size] else 0.0) - model.threshold for i, r in enumerate(ratios)
    ]
    n = F.length(string).cast("bigint")
    whole = lambda pairs: ~string.rlike("^[0-9]+$") & (F.aggregate(
        pairs, F.lit(0.0), lambda t, p: t + F.get(F.lit(list(ratios)), p)
    ) / (n - 1) >= model.threshold)

    def state(at, first, last, sum_, best, out):
        named = {"at": at, "first": first, "last": last, "sum": sum_, "best": best, "out": out}
        return F.struct(*[c.alias(name) for name, c in named.items()])

    def told(s):
        one = F.array(F.struct(s["first"].alias("start"), s["last"].alias("end")))
        return F.when(s["last"] - s["first"] >= LEAST, F.concat(s["out"], one)).otherwise(s["out"])

    def step(s, gain):
        after = s["sum"] + gain
        at = s["at"] + 1  # of the pair's second character
        return F.when((after <= 0) | (after < s["best"] - DROP), state(at, at, at + 1, F.lit(0.0), F.lit(0.0), told(s))).when(
            after > s["best"], state(at, s["first"], at + 1, after, after, s["out"])
        ).otherwise(state(at, s["first"], s["last"], after, s["best"], s["out"]))

    zero = F.lit(0).cast("bigint")
    begin = state(zero, zero, zero + 1, F.lit(0.0), F.lit(0.0), F.array().cast(PLACES))
    lettered = lambda pairs: F.filter(
        F.aggregate(F.transform(pairs, lambda p: F.get(F.lit(above), p)), begin, step, told),
        lambda p: F.substring(string, (p["start"] + 1).cast("int"), (p["end"] - p["start"]).cast("int")).rlike("[A-Za-z]"),
    )
    found = lambda pairs: F.when(
        whole(pairs), F.array(F.struct(zero.alias("start"), n.alias("end")))
    ).otherwise(lettered(pairs))
    places = F.transform(F.split(string, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    pairs = _once(places, lambda at: F.zip_with(
        F.slice(at, F.lit(1), F.length(string) - 1), F.slice(at, F.lit(2), F.length(string) - 1),
        lambda a, b: a * size + b,
    ))
    return _once(pairs, found)


def find_secrets(docs: DataFrame, model: SecretModel) -> DataFrame:
    """All columns, with ``assign``, ``access``, ``hex`` (base spans by kind) and
    ``spans`` (all of them and the random ones, by start, then kind).  A column of the
    caller's with one of these names gives way."""
    found = _found(docs.select(F.struct("*").alias("_row"), whole_text().alias("_text")), model)
    own = [F.col(f"_row.{quoted(c)}") for c in docs.columns if c not in RESULTS]
    return found.select(*own, *RESULTS)


def _found(base: DataFrame, model: SecretModel) -> DataFrame:
    """The results beside ``_row`` and ``_text``."""
    text = F.col("_text")
    runs = _spans(text, KEY_RUN, len(BASE), 0)
    base = base.withColumns(dict(zip(KINDS, base_spans(text))) | {"_runs": runs})
    fixed = F.concat("assign", "access", "hex")
    if not model.ratios:
        return base.withColumn("spans", F.array_sort(fixed))
    cut = lambda value, start, end: F.substring(value, (start + 1).cast("int"), (end - start).cast("int"))

    def secrets(run: Column) -> Column:
        def of_part(part: Column) -> Column:
            whole = cut(run["value"], part["start"] - run["start"], part["end"] - run["start"])
            return _once(whole, lambda value: F.transform(_random_places(value, model), lambda p: F.struct(
                (part["start"] + p["start"]).alias("start"), F.lit(len(BASE)).alias("rank"),
                (part["start"] + p["end"]).alias("end"), F.lit(KINDS[-1]).alias("kind"),
                cut(value, p["start"], p["end"]).alias("value"),
            )))

        return F.flatten(F.transform(_parts(run, F.col("_fixed")), of_part))

    random = F.flatten(F.transform("_runs", secrets))
    random = F.when(F.size("_runs") > 0, random).otherwise(F.array().cast(f"array<{SPAN}>"))
    return base.withColumn("_fixed", F.array_sort(fixed)).withColumn("spans", F.array_sort(F.concat("_fixed", random)))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, model: SecretModel, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with a mark in place of each secret; overlapping spans
    share one."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    merged = F.aggregate(
        "spans", empty,
        lambda out, s: F.when(
            (F.size(out) > 0) & (s["start"] < F.element_at(out, -1)["end"]),
            F.concat(
                F.slice(out, F.lit(1), F.size(out) - 1),
                F.array(F.struct(
                    F.element_at(out, -1)["start"].alias("start"),
                    F.greatest(F.element_at(out, -1)["end"], s["end"]).alias("end"),
                )),
            ),
        ).otherwise(F.concat(out, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )
    end = lambda i: F.when(i > 0, F.get(F.col("_cuts"), i - 1)["end"]).otherwise(F.lit(0).cast("bigint"))
    stop = lambda i: F.coalesce(F.get(F.col("_cuts"), i)["start"], F.length("_text").cast("bigint"))
    kept = F.transform(
        F.sequence(F.lit(0), F.size("_cuts")),
        lambda i: F.substring(F.col("_text"), (end(i) + 1).cast("int"), (stop(i) - end(i)).cast("int")),
    )
    found = _found(docs.select(F.struct("*").alias("_row"), whole_text().alias("_text")), model)
    found = found.withColumn("_cuts", F.when(F.size("spans") > 0, merged))
    text = F.when(F.col("_cuts").isNull(), F.col("_row.text")).otherwise(F.array_join(kept, mark))
    return found.select(*[text.alias(c) if c == "text" else F.col(f"_row.{quoted(c)}") for c in docs.columns])
