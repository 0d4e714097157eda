"""Small expression helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``.

    A plain Column is an expression tree: used twice it may be computed twice, and inside a
    lambda once per element. A one-element ``transform`` binds the result instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def stable_round(value: Column, places: int) -> Column:
    """Round a distributed mean repeatably.

    Partial sums arrive in any order, which moves the last bits of a double. Rounding to ten
    places first removes that noise, so an exact tie rounds the same way on every run.
    """
    return F.round(F.round(value, 10), places)
