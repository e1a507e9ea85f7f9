"""Evaluate an expression once and refer to it many times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` sees ``value`` as a lambda variable, so a costly value is neither repeated in the plan nor recomputed."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
