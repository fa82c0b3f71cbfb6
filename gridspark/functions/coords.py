"""Column letters, column numbers and A1 coordinates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def col_index(letters: Column) -> Column:
    """``A`` is 1, ``XFD`` is 16384; NULL for anything but letters."""
    upper = F.upper(F.trim(letters))
    # Cell by cell, so without a lambda, which is not compiled: the letters from the last one backward.
    value = lambda i: F.ascii(F.substring(upper, -i, 1)) - 64
    size = F.length(upper)
    number = value(1) + F.when(size > 1, 26 * value(2)).otherwise(0) + F.when(size > 2, 676 * value(3)).otherwise(0)
    return F.when(upper.rlike("^[A-Z]{1,3}$"), number)


def col_letter(index: Column) -> Column:
    """Inverse of :func:`col_index`, up to three letters."""
    last = (index - 1) % 26
    rest = ((index - 1 - last) / 26).cast("int")
    middle = (rest - 1) % 26
    first = ((rest - 1 - middle) / 26).cast("int")
    letter = lambda offset: F.char(F.lit(65) + offset)
    return F.concat(
        F.when(first > 0, letter(first - 1)).otherwise(""),
        F.when(rest > 0, letter(middle)).otherwise(""),
        letter(last),
    )


def a1_row(a1: Column) -> Column:
    return F.regexp_extract(a1, r"(\d+)$", 1).try_cast("bigint")


def a1_col(a1: Column) -> Column:
    return col_index(F.regexp_extract(a1, r"^\$?([A-Za-z]+)", 1))
