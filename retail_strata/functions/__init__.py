"""Expressions shared by the layers, all Spark built-ins.

They are SQL text: ``F.expr`` parses a whole expression in one call, while a
``Column`` built piece by piece costs the driver milliseconds per piece, which
adds up to seconds on wide plans.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def columns(**expressions: str) -> dict[str, Column]:
    """For ``withColumns``."""
    return {name: F.expr(text) for name, text in expressions.items()}


def named(**expressions: str) -> list[Column]:
    """For ``select`` and ``agg``."""
    return [F.expr(f"{text} AS {quoted(name)}") for name, text in expressions.items()]
