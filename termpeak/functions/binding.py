"""Naming an intermediate value within one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times within ``body``.

    A fold over no elements: it starts from ``value`` and finishes with ``body``.
    Catalyst never substitutes an expression for a lambda variable, so ``value``
    is not evaluated again at each use, and a fold, unlike a transform, hands its
    result on without copying it.
    """
    nothing = F.array().cast("array<int>")
    return F.aggregate(nothing, value, lambda state, _: state, body)
