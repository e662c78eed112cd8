"""Text clean-up and lenient parsing.

The ``try_`` forms give null for a value that does not parse, whether the
session runs in ANSI mode or not, so one bad row never fails a job.
"""


def trimmed(column: str) -> str:
    """Without outer spaces; tabs and line ends stay."""
    return f"trim({column})"


def lowered(column: str) -> str:
    return f"lower(trim({column}))"


def uppered(column: str) -> str:
    return f"upper(trim({column}))"


def digits(column: str) -> str:
    """Only the digits; a value without any becomes the empty string, not null."""
    return f"regexp_replace({column}, '[^0-9]', '')"


def instant(column: str) -> str:
    return f"try_to_timestamp({column})"


def day(column: str) -> str:
    return f"try_cast({column} AS date)"


def money(column: str) -> str:
    """decimal(10,2), rounded half up; null when the value does not fit."""
    return f"try_cast({column} AS decimal(10,2))"
