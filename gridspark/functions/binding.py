"""A value computed once inside a larger expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it.

    What stands in ``body`` is not compiled with the expressions around it. It is for rare values: these would grow
    beyond what the compiler takes.
    """
    return F.get(F.transform(F.array(value), body), 0)
