"""Naming an intermediate value inside one Column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and hand it to `use`, however often that mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
