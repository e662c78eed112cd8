"""Checks by name: rows that pass all of them, or all rows with what they failed.

A check is a positive condition, so a null in it fails the row.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REASONS = "reject_reasons"
OLDER = "older_version"


def passed(rules: dict[str, str]) -> str:
    """All checks as one condition."""
    return " AND ".join(rules.values())


def judged(rows: DataFrame, rules: dict[str, str], older: str | None = None) -> DataFrame:
    """Every row with the names of the checks it fails, in the order of the rules; none
    for a row that passes.  ``older`` is a condition for rows that a newer one replaces."""
    failing = {**({OLDER: f"NOT ({older})"} if older else {}), **rules}
    reasons = ", ".join(f"if(coalesce({rule}, false), NULL, '{name}')" for name, rule in failing.items())
    return rows.withColumn(REASONS, F.expr(f"array_compact(array({reasons}))"))


def reason_counts(rules: dict[str, str]) -> list:
    """Aggregates over judged rows: all, accepted, rejected, and rejected by each check."""
    accepted = F.size(REASONS) == 0
    return [
        F.count(F.lit(1)).alias("judged"), F.count_if(accepted).alias("accepted"),
        F.count_if(~accepted).alias("rejected"),
        *[F.count_if(F.array_contains(REASONS, name)).alias(f"rejected_{name}") for name in (OLDER, *rules)],
    ]
