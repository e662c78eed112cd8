"""Aggregate expressions of the gold tables."""


def mean(column: str) -> str:
    """Average to two decimals.  For decimal(10,2) input Spark averages to six
    decimals half up and then rounds half up again."""
    return f"round(avg({column}), 2)"


def mean_of_money(total: str, number: str) -> str:
    """What ``mean`` gives, from sum and count, for amounts that are not negative: to
    millionths half up and then to cents half up, in whole numbers."""
    millionths = f"((2 * CAST({total} * 100 AS decimal(28,0)) * 10000 + {number}) div (2 * {number}))"
    return f"CASE WHEN {number} > 0 THEN CAST(({millionths} + 5000) div 10000 AS decimal(11,0)) * 0.01BD END"


def mean_of_whole_numbers(total: str, number: str) -> str:
    return f"CASE WHEN {number} > 0 THEN round(double({total}) / double({number}), 2) END"
