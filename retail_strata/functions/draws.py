"""Repeatable pseudo-random draws from a row number, in integer arithmetic.

The same row always gets the same values, on any cluster and after any task
retry, and any SQL engine can compute them.  All intermediate products stay
inside bigint for every row number.
"""

PRIME = 2147483647


def draw(row: str, stream: int) -> str:
    """A value in 0 .. PRIME-1 for this row; ``stream`` selects an independent series."""
    spread = f"((({row} + 1) % {PRIME}L * 48271L + {stream * 7919}L) % {PRIME}L)"
    return f"({spread} * ({spread} % 65521L + {stream + 1}L) % {PRIME}L)"


def pick(row: str, stream: int, size: int) -> str:
    """A value in 0 .. size-1, for sizes up to PRIME."""
    return f"({draw(row, stream)} % {size}L)"


def pick_row(row: str, stream: int, size: int) -> str:
    """A value in 0 .. size-1 for tables of any length: two draws make one wide one."""
    return f"(({draw(row, stream)} * {PRIME}L + {draw(row, stream + 1)}) % {size}L)"
