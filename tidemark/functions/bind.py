"""Values that are worked out once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once even where plans are rewritten: a lambda binds it."""
    return F.transform(F.array(value), use)[0]
